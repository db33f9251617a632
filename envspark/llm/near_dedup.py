"""Near-duplicate groups by MinHash with sequential Bayesian verification.

1. Each text becomes its set of distinct word shingles (64-bit hashes); equal sets
   are one node, so copies cost one row. A node keeps 16 bits of each MinHash.
2. Bands of `ROWS` values put nodes into buckets. Enough bands are used that a pair
   at the threshold shares no bucket with probability below `miss` only.
3. Within a bucket every node is paired with the bucket's smallest and largest node,
   never with all others. Signatures of a pair are compared batch by batch; the pair is
   dropped once the posterior probability that its similarity reaches the
   threshold falls below `miss`. Survivors are verified on their full shingle sets.
4. Buckets whose nodes are not yet in one component are gone through again in chunks:
   every pair of different components is compared in the same way, inside of tasks, which
   finds the links that the first round could not see. Pairs within a component are left
   out, since they cannot change it.

Components come from edge contraction, a few joins on hashed ids. A node id is a
64-bit hash of the whole set; 64 further bits tell sets of one id apart, which then get ids of their own.

Cases: a text without words, or null, has an empty set and is linked with nothing;
fewer words than a shingle make one shingle of all; repeated rows are judged each, and
equal ones get equal results; a null id is never the smallest; a similarity of exactly the threshold is a link;
a very long text is one set, held by one task; an empty table gives no rows. Ids are whole numbers. Other columns are ignored
by `components` and passed through by `without_near_duplicates`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envspark.llm.common import fresh, slices, span_hashes, stash, texts_of, word_hashes

SHINGLE_WORDS, THRESHOLD = 5, 0.8
ROWS = 5
MISS = 1e-6
BATCH = 20
# nodes of a bucket that are compared with as many others at once
CHUNK = 64
SEED = 20_240_501


def bands_for(threshold: float, miss: float = MISS, rows: int = ROWS) -> int:
    """Bands that leave a pair at the threshold unseen with probability `miss` at most."""
    return math.ceil(math.log(miss) / math.log1p(-threshold ** rows))


def least_matches(threshold: float, hashes: int, miss: float = MISS, batch: int = BATCH) -> list[tuple[int, int]]:
    """After so many compared values, the fewest equal ones that keep a pair.

    With a uniform prior, m equal ones of n give the posterior Beta(m + 1, n - m + 1), and
    P(similarity >= t) is the chance of at most m successes in n + 1 trials of chance t.
    """
    out = []
    for n in [*range(batch, hashes, batch), hashes]:
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, bounds = word_hashes(texts, lower=True)
    for low, high in zip(bounds[:-1], bounds[1:]):
        if high == low:
            yield np.empty(0, dtype=np.uint64)
            continue
        starts = np.arange(low, max(low, high - size) + 1)
        own = span_hashes(words[low:high], starts - low, np.minimum(starts - low + size, high - low))
        yield np.unique(own)


def _multipliers(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(SEED).integers(0, 2 ** 32, size=(2, hashes), dtype=np.uint32)
    return drawn[0] | np.uint32(1), drawn[1]


def signature(values: np.ndarray, hashes: int) -> bytes:
    """The low 16 bits of each MinHash."""
    times, flip = _multipliers(hashes)
    folded = (values >> np.uint64(32)).astype(np.uint32)[:, None]
    least = np.full(hashes, 2 ** 32 - 1, dtype=np.uint32)
    for i in range(0, len(folded), 4096):
        np.minimum(least, ((folded[i:i + 4096] ^ flip) * times).min(axis=0), out=least)
    least ^= least >> np.uint32(15)
    return least.astype(np.uint16).tobytes()


def _features(size: int, hashes: int, text_at: int, node_bits: int = 64):
    half = 1 << (node_bits - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(texts_of(batch.column(text_at)))
            counts, nodes, checks, signs = [], [], [], []
            for low, high in slices([len(t) for t in texts]):
                for values in shingle_sets(texts[low:high], size):
                    counts.append(len(values))
                    if len(values):
                        digest = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                        nodes.append(int.from_bytes(digest[:8], "little") % (2 * half) - half)
                        checks.append(int.from_bytes(digest[8:], "little", signed=True))
                        signs.append(signature(values, hashes))
                    else:
                        nodes.append(None)
                        checks.append(None)
                        signs.append(None)
            kept = [batch.column(i) for i in range(batch.num_columns) if i != text_at]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(counts, pa.int64()), pa.array(nodes, pa.int64()), pa.array(checks, pa.int64()),
                 pa.array(signs, pa.binary())],
                names=[*(n for i, n in enumerate(batch.schema.names) if i != text_at), "n_shingles", "node", "check", "sign"])
    return run


def _likely(steps: list[tuple[int, int]]):
    """Keep pairs whose signatures may belong to similar sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(c.to_pylist()), dtype=np.uint16).reshape(batch.num_rows, -1)
                           for c in (a, b))
            alive, equal, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64), 0
            for n, least in steps:
                equal += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
                keep = equal >= least
                alive, equal, done = alive[keep], equal[keep], n
            yield batch.select(["a", "b"]).take(pa.array(alive))
    return run


def _similar(size: int, threshold_percent: int):
    """Keep pairs whose full sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=256)
        def values(text: bytes) -> np.ndarray:
            return next(shingle_sets([text], size))

        for batch in batches:
            keep = [_reaches(values(a), values(b), threshold_percent)
                    for a, b in zip(texts_of(batch.column(2)), texts_of(batch.column(3)))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def contracted(edges: DataFrame) -> DataFrame | None:
    """(node, root) of every node that has an edge; `edges` has long columns a and b. None without edges."""
    maps: list[DataFrame] = []
    edges = stash(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stash(both.groupBy("a").agg(F.min("b").alias("p")).select(
            F.col("a").alias("node"), F.least("a", "p").alias("root")))
        maps.append(up)
        first = up.select(F.col("node").alias("a"), F.col("root").alias("x"))
        second = up.select(F.col("node").alias("b"), F.col("root").alias("y"))
        moved = edges.join(first, "a").join(second, "b").filter("x <> y")
        edges = stash(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not maps:
        return None
    roots = maps[-1]
    for earlier in reversed(maps[:-1]):
        later = roots.select(F.col("node").alias("root"), F.col("root").alias("top"))
        roots = stash(earlier.join(later, "root", "left").select("node", F.coalesce("top", "root").alias("root")))
    return roots


def _pairs_checked(pairs: DataFrame, nodes: DataFrame, steps, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Of candidate pairs (a, b), those that are similar; signatures first, then full sets."""
    def with_both(found: DataFrame, source: DataFrame, value: str) -> DataFrame:
        for side in ("a", "b"):
            found = found.join(source.select(F.col("node").alias(side), F.col(value).alias(f"{value}_{side}")), side)
        return found.select("a", "b", f"{value}_a", f"{value}_b")

    likely = stash(with_both(pairs, nodes, "sign").mapInArrow(_likely(steps), "a long, b long"))
    return stash(with_both(likely, texts, "text").mapInArrow(_similar(size, percent), "a long, b long"))


def _nodes_of(feats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents and the nodes, one per different set. Sets that share a node id, which hardly ever
    happens, but for the one of least check get a new id of id and check."""
    while True:
        nodes = stash(feats.filter("node IS NOT NULL").groupBy("node").agg(
            F.first("sign").alias("sign"), F.min(F.struct("id", "body")).alias("holder"),
            F.min("check").alias("least"), F.max("check").alias("most")))
        shared = nodes.filter("least <> most").select("node", "least")
        if shared.isEmpty():
            return feats, nodes.select("node", "sign", "holder")
        own = F.coalesce(F.col("check") == F.col("least"), F.lit(True))
        feats = stash(feats.join(shared, "node", "left").withColumn(
            "node", F.when(own, F.col("node")).otherwise(F.xxhash64("node", "check"))).select(*feats.columns))


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
               threshold_percent: int = round(100 * THRESHOLD), miss: float = MISS, node_bits: int = 64) -> DataFrame:
    """One row per document: `key`, body (hash of its text), n_shingles, component_id, kept."""
    threshold = threshold_percent / 100
    bands = bands_for(threshold, miss)
    hashes = bands * ROWS
    steps = least_matches(threshold, hashes, miss)
    keyed = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("body"),
                        F.col(f"`{text}`").alias("text"))
    feats, nodes = _nodes_of(stash(keyed.mapInArrow(
        _features(shingle, hashes, 2, node_bits), "id long, body long, n_shingles long, node long, check long, sign binary")))
    band = F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band")
    width = 2 * ROWS
    members = nodes.select("node", "sign", band).select(
        F.expr(f"xxhash64(band, substring(sign, band * {width} + 1, {width}))").alias("bucket"), "band", "node")
    # aggregates are stored before they are joined back, so that Spark may split a frequent key in the join
    hubs = stash(members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
                 .filter("low <> high"))
    shared = stash(members.join(hubs, "bucket"))

    active = shared.select("node").distinct().join(nodes.select("node", "holder"), "node").select(
        "node", F.col("holder.id").alias("id"), F.col("holder.body").alias("body"))
    held = keyed.alias("k").join(active.alias("a"), [F.col("k.id").eqNullSafe(F.col("a.id")),
                                                    F.col("k.body") == F.col("a.body")])
    texts = stash(held.select("node", "text").dropDuplicates(["node"]))
    signs = nodes.select("node", "sign")

    star = (shared.filter("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b"))
            .unionByName(shared.filter("node <> high AND low <> node").select(
                F.col("node").alias("a"), F.col("high").alias("b"))).distinct())
    links = _pairs_checked(star, signs, steps, texts, shingle, threshold_percent)
    roots = contracted(links)

    more = _links_across(shared, roots, nodes, texts, steps, shingle, threshold_percent)
    if not more.isEmpty():
        roots = contracted(links.unionByName(more))

    group = F.col("node")
    labelled = feats.select("id", "body", "n_shingles", "node")
    if roots is not None:
        labelled = labelled.join(roots, "node", "left")
        group = F.coalesce("root", "node")
    labelled = labelled.withColumn("g", group)
    first = stash(labelled.filter("g IS NOT NULL").groupBy("g").agg(F.min("id").alias("first")))
    out = labelled.join(first, "g", "left")
    component = F.when(F.col("g").isNull(), F.col("id")).otherwise(F.col("first"))
    return out.select(F.col("id").alias(key), "body", "n_shingles", component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def _links_across(shared: DataFrame, roots: DataFrame | None, nodes: DataFrame, texts: DataFrame, steps, size: int,
                  percent: int) -> DataFrame:
    """Links between nodes of a bucket that are not yet in one component.

    Nodes of such a bucket are dealt into chunks of about `CHUNK`, those of the smallest node's component
    apart from the others, and chunks are compared two at a time, except where all of their nodes are in one
    component. No row per pair is made: a comparison returns links only, at most one for
    every two components that it joins.
    """
    spark = shared.sparkSession
    if roots is None:
        placed = shared.select("bucket", "band", "node", F.col("node").alias("c"), F.col("low").alias("main"))
    else:
        of_low = roots.select(F.col("node").alias("low"), F.col("root").alias("low_root"))
        placed = shared.join(roots, "node", "left").join(of_low, "low", "left").select(
            "bucket", "band", "node", F.coalesce("root", "node").alias("c"), F.coalesce("low_root", "low").alias("main"))
    mixed = placed.groupBy("bucket").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.count("*").alias("n"))
    # in a bucket of two the first round has compared the only pair
    wanted = stash(mixed.filter("x <> y AND n > 2").select(
        "bucket", F.expr(f"int((n - 1) div {CHUNK}) + 1").alias("chunks")))
    chunk = F.struct(F.expr("c <> main").alias("out"), F.pmod(F.xxhash64("node"), F.col("chunks")).alias("n"))
    dealt = placed.join(wanted, "bucket").select("bucket", "band", "node", "c", chunk.alias("chunk"))
    full = dealt.join(nodes.select("node", "sign"), "node").join(texts, "node")
    chunks = stash(full.groupBy("bucket", "band", "chunk").agg(
        F.collect_list(F.struct("node", "c", "sign", "text")).alias("m"),
        F.min("c").alias("low"), F.max("c").alias("high")))
    pairs = chunks.alias("x").join(chunks.alias("y"), "bucket").filter(
        "x.chunk <= y.chunk AND NOT (x.low = x.high AND y.low = y.high AND x.low = y.low)").select(
        "x.band", F.expr("x.chunk = y.chunk").alias("same"), F.col("x.m").alias("x"), F.col("y.m").alias("y"))
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "16")  # rows are large here
    try:
        return stash(pairs.mapInArrow(_across(steps, size, percent), "a long, b long"))
    finally:
        spark.conf.set(setting, before)


def _across(steps: list[tuple[int, int]], size: int, percent: int):
    """Links between the components of two chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=256)
        def values(text: bytes) -> np.ndarray:
            return next(shingle_sets([text], size))

        def members(chunk):
            node, c, sign, text = (chunk.values.field(i) for i in range(4))
            marks = np.frombuffer(b"".join(sign.to_pylist()), dtype=np.uint16).reshape(len(node), -1)
            return node.to_pylist(), c.to_pylist(), marks, list(texts_of(text))

        for batch in batches:
            links: list[tuple[int, int]] = []
            for row in range(batch.num_rows):
                band, same = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                x, y = members(batch.column(2)[row]), members(batch.column(3)[row])
                parent: dict[int, int] = {}

                def root(c: int) -> int:
                    while parent.get(c, c) != c:
                        c = parent[c]
                    return c

                for i, j in _candidates(x, y, band, same, steps):
                    p, q = root(x[1][i]), root(y[1][j])
                    if p != q and _reaches(values(x[3][i]), values(y[3][j]), percent):
                        parent[p] = q
                        links.append((x[0][i], y[0][j]))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()),
                                              pa.array([b for _, b in links], pa.int64())], names=["a", "b"])
    return run


def _candidates(x, y, band: int, same: bool, steps: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Pairs of two chunks to verify, most alike first: of two components, likely by
    signature, and in no bucket of an earlier band together."""
    open_ = np.array(x[1])[:, None] != np.array(y[1])[None, :]
    if same:
        open_ &= np.arange(len(x[1]))[:, None] < np.arange(len(y[1]))[None, :]
    i, j = np.nonzero(open_)
    left, right = x[2], y[2]
    equal, done = np.zeros(len(i), dtype=np.int64), 0
    for n, least in steps:
        equal += (left[i, done:n] == right[j, done:n]).sum(axis=1)
        keep = equal >= least
        i, j, equal, done = i[keep], j[keep], equal[keep], n
    if band:
        earlier = (left[i, :band * ROWS] == right[j, :band * ROWS]).reshape(len(i), band, ROWS).all(axis=2).any(axis=1)
        i, j, equal = i[~earlier], j[~earlier], equal[~earlier]
    order = np.argsort(-equal, kind="stable")
    yield from zip(i[order].tolist(), j[order].tolist())


def _reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 |x and y| >= percent |x or y|."""
    low, high = sorted((len(x), len(y)))
    if 100 * low < percent * high:
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group, the one of smallest id, with its columns as they are; of equal rows one stays."""
    found = components(docs, key, text, **options).filter("kept")
    number, body = fresh(docs, "_number"), fresh(docs, "_body")
    lowest = F.lit(-2 ** 63)  # stands for a null id, so that plain equality joins
    found = found.select(F.coalesce(F.col(key), lowest).alias(number), F.col("body").alias(body)).distinct()
    rows = docs.withColumn(number, F.coalesce(F.col(f"`{key}`").cast("long"), lowest)).withColumn(
        body, F.xxhash64(F.col(f"`{text}`")))
    return rows.join(found, [number, body]).dropDuplicates([number, body]).drop(number, body)
