"""Substring deduplication by relative Lempel-Ziv parsing against an index of the whole corpus.

A window is `WINDOW` consecutive words of a document. A window is a copy if the same
words also start earlier: in a document of smaller id, or earlier in the same document.
Words inside copies are removed.

1. Reference blocks. Every window elects the six-word gram of smallest hash inside it as
   its anchor; neighbouring windows with one anchor form a block. Equal windows elect
   the same anchor, so copies of a window meet under the anchor's hash, and one row per
   block indexes the whole corpus (about one row for eight words).
2. Greedy factors. A document is parsed block by block. A block whose words occurred
   earlier under its anchor is a copy as a whole, and neighbouring copies join into the
   longest possible factor.
3. Factor boundaries. Where a block is the first of its kind but its anchor is known from
   other blocks, a factor may begin or end inside it. Its windows are looked up one by one.

Before a shuffle each batch of documents keeps one row per anchor and settles the rest
by itself, so a very frequent passage sends one row per batch, not one per document.

Cases: a null or empty text has no words; texts shorter than a window stay whole; a null
id counts as smaller than any other; repeated rows have the same places, none of which is
earlier, so they do not remove each other's words; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envspark.llm.common import mix, slices, span_hashes, texts_of, word_hashes

WINDOW, GRAM = 20, 6
_NO_ID = -2 ** 63

# kinds of rows under one anchor or window
ONE, COPY, CHECK, MANY = range(4)
_TAG_BITS = 26
_ROWS = "key long, other long, id long, place long"
_TAG = f"place & {(1 << _TAG_BITS) - 1}"
_COUNT = "if(place >> 28 & 15 = 0, other, place >> 28 & 15)"


def _pack(start, count, kind, tag):
    """Start (31 bits), number of windows (4), kind (2) and tag of the text (26) in one number."""
    return (start << 32) | (count << 28) | (kind << _TAG_BITS) | tag


def anchored(words: np.ndarray, bounds: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Blocks of all texts: text number, first window, number of windows, anchor hash, block hash."""
    n = len(words)
    if n < window:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(5))
    grams = span_hashes(words, np.arange(n - gram + 1), np.arange(gram, n + 1))
    width = window - gram + 1
    least = grams[:n - window + 1].copy()
    for i in range(1, width):
        np.minimum(least, grams[i:i + len(least)], out=least)
    anchor = np.zeros(len(least), dtype=np.int64)
    for i in reversed(range(width)):  # the first of equal grams wins, so that equal windows agree
        anchor[grams[i:i + len(least)] == least] = i
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(least)]
    first = np.flatnonzero(np.arange(len(least)) + window <= bounds[text + 1])
    anchor = anchor[first] + first
    begins = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(first) else first
    counts = np.diff(np.concatenate([begins, [len(first)]]))
    starts = first[begins]
    blocks = span_hashes(words, starts, starts + counts + window - 1)
    return text[starts], starts - bounds[text[starts]], counts, grams[anchor[begins]], blocks


def _spread(ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Keys that put settled rows anywhere."""
    return mix(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + places.astype(np.uint64)).astype(np.int64)


def _settled(key: np.ndarray, other: np.ndarray, ids: np.ndarray, start: np.ndarray, count: np.ndarray,
             tag: np.ndarray, by_window: bool) -> pa.RecordBatch:
    """Rows of one batch with at most one row per key still open.

    Of equal (key, other) the earliest stays and later ones are copies. Where a key keeps
    several blocks, all are to be checked and one row tells other batches of it; a
    window's rows differ in `other` only by chance and stay.
    """
    kind = np.full(len(key), ONE)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    shared = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(key) else order
    shared = shared[np.lexsort((start[shared], ids[shared], other[shared], key[shared]))]
    told = np.empty(0, dtype=np.int64)
    if len(shared):
        k, o, i, s = key[shared], other[shared], ids[shared], start[shared]
        new_key = np.concatenate([[True], k[1:] != k[:-1]])
        new_block = new_key | np.concatenate([[True], o[1:] != o[:-1]])
        lead = np.flatnonzero(new_block)[np.cumsum(new_block) - 1]
        later = (i > i[lead]) | ((i == i[lead]) & (s > s[lead]))
        kind[shared[later]] = COPY
        if not by_window:
            group = np.cumsum(new_key) - 1
            several = np.bincount(group, weights=new_block)[group] > 1
            kind[shared[several & ~later]] = CHECK
            told = k[new_key & several]
    open_ = kind != COPY
    copies = _factors(*(x[~open_] for x in (ids, tag, start, count)))
    place = _pack(start, count, kind, tag)[open_]
    settled = _spread(ids[open_], place)
    nothing = np.zeros(len(told), dtype=np.int64)
    one = kind[open_] == ONE
    return _rows(np.concatenate([np.where(one, key[open_], settled), told]),
                 np.concatenate([np.where(one, other[open_], 0), nothing]),
                 np.concatenate([ids[open_], nothing]), np.concatenate([place, _pack(nothing, 0, MANY, 0)]), *copies)


def _factors(ids: np.ndarray, tag: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Neighbouring copies of a text as longest factors: id, tag, start, number of windows."""
    order = np.lexsort((start, tag, ids))
    ids, tag, start, end = ids[order], tag[order], start[order], (start + count)[order]
    new = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (tag[1:] != tag[:-1])
                                         | (start[1:] != end[:-1])])[:len(ids)])
    last = np.concatenate([new[1:], [len(ids)]])[:len(new)] - 1
    return ids[new], tag[new], start[new], end[last] - start[new]


def _rows(key, other, ids, place, *factors) -> pa.RecordBatch:
    """Open rows and factors; a factor's length is too long for `place` and stands in `other`."""
    if factors:
        f_id, f_tag, f_start, f_count = factors
        f_place = _pack(f_start, 0, COPY, f_tag)
        key, other = np.concatenate([key, _spread(f_id, f_place)]), np.concatenate([other, f_count])
        ids, place = np.concatenate([ids, f_id]), np.concatenate([place, f_place])
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (key, other, ids, place)],
                                      names=["key", "other", "id", "place"])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tag, text) to one row per block."""
    for batch in batches:
        ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        texts, parts = list(texts_of(batch.column(2))), []
        for low, high in slices([len(t) for t in texts]):
            text, start, count, key, block = anchored(*word_hashes(texts[low:high]))
            text = text + low
            parts.append((key.astype(np.int64), block.astype(np.int64), ids[text], start, count, tags[text]))
        if parts:
            yield _settled(*(np.concatenate(c) for c in zip(*parts)), by_window=False)


def _boundaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tag, text, places, counts) to factors of whole blocks and the windows that need a look."""
    nothing = (np.empty(0, dtype=np.int64),)
    for batch in batches:
        ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        texts, parts, factors = list(texts_of(batch.column(2))), [nothing * 6], [nothing * 4]
        for low, high in slices([len(t) for t in texts]):
            words, bounds = word_hashes(texts[low:high])
            twins = mix(words ^ np.uint64(0x5851F42D4C957F2D))
            for i in range(low, high):
                packed, count = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (3, 4))
                start = packed >> 32
                check = ((packed >> _TAG_BITS) & 3) == CHECK
                same = np.ones(len(start), dtype=np.int64)
                factors.append(tuple(x[~check] for x in (ids[i] * same, tags[i] * same, start, count)))
                if check.any():
                    one = np.repeat(start[check], count[check]) + _within(count[check])
                    at = one + bounds[i - low]
                    same = np.ones(len(one), dtype=np.int64)
                    parts.append((span_hashes(words, at, at + WINDOW).astype(np.int64),
                                  span_hashes(twins, at, at + WINDOW).astype(np.int64),
                                  ids[i] * same, one, same, tags[i] * same))
        yield _settled(*(np.concatenate(c) for c in zip(*parts)), by_window=True)
        yield _rows(*nothing * 4, *_factors(*(np.concatenate(c) for c in zip(*factors))))


def _within(counts: np.ndarray) -> np.ndarray:
    """0 .. count-1 for each count."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def joined(starts: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Longest runs (start, number) of neighbouring windows; starts ascend."""
    if len(starts):
        ends = starts + counts
        reach = np.maximum.accumulate(ends)
        new = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]]))
        yield from zip(starts[new], reach[np.concatenate([new[1:], [len(starts)]]) - 1] - starts[new])


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, starts, lengths in windows) to words, removed words, kept text and factors."""
    for batch in batches:
        words_n, removed_n, kept_texts, spans = [], [], [], []
        for i, text in enumerate(texts_of(batch.column(0))):
            words = text.split()
            starts = batch.column(1)[i].values
            removed, own = 0, []
            if starts is not None and len(starts):
                starts, counts = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (1, 2))
                order = np.argsort(starts, kind="stable")
                out, done = [], 0
                for start, count in joined(starts[order], counts[order]):
                    start, end = max(int(start), done), int(start + count) + WINDOW - 1
                    own += [start, end]
                    out += words[done:start]
                    removed += end - start
                    done = end
                kept = out + words[done:]
            else:
                kept = words
            words_n.append(len(words))
            removed_n.append(removed)
            kept_texts.append(b" ".join(kept))
            spans.append(own)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[3:], pa.array(words_n, pa.int64()), pa.array(removed_n, pa.int64()),
             pa.array(kept_texts, pa.binary()).cast(pa.string()), pa.array(spans, pa.list_(pa.int64()))],
            names=[*batch.schema.names[3:], "n_words", "n_removed", "kept", "removed_spans"])


def _open_and_copies(rows: DataFrame) -> DataFrame:
    """Rows of anchors: drop what is unique, mark copies and blocks to check."""
    kind = F.expr(f"(place >> {_TAG_BITS}) & 3")
    here = F.struct(F.col("id"), F.expr("place >> 32"))
    block, anchor = Window.partitionBy("key", "other"), Window.partitionBy("key")
    # by anchor first: rows dealt by anchor serve the blocks too, the other way round they would be dealt twice
    seen = (rows.withColumn("kind", kind)
            .withColumn("n", F.sum(F.expr(f"int(kind IN ({ONE}, {MANY}))")).over(anchor))
            .withColumn("many", F.max(F.col("kind") == MANY).over(anchor))
            .withColumn("low", F.min(F.when(F.col("kind") == ONE, F.col("other"))).over(anchor))
            .withColumn("high", F.max(F.when(F.col("kind") == ONE, F.col("other"))).over(anchor))
            .withColumn("lead", F.min(F.when(F.col("kind") == ONE, here)).over(block)))
    later = here > F.col("lead")
    found = (F.when(F.col("kind").isin(COPY, CHECK), F.col("kind"))
             .when((F.col("kind") == MANY) | (F.col("n") == 1), F.lit(None))
             .when(later, F.lit(COPY))
             .when(F.col("many") | (F.col("low") != F.col("high")), F.lit(CHECK)))
    settled = F.expr(f"(place & ~{3 << _TAG_BITS}L)").bitwiseOR(F.shiftleft(F.col("found").cast("long"), _TAG_BITS))
    return seen.withColumn("found", found).filter("found IS NOT NULL").select(
        "id", F.expr(_TAG).alias("tag"), settled.alias("place"), F.expr(_COUNT).alias("count"))


def _copied_windows(rows: DataFrame) -> DataFrame:
    """Rows of windows and factors: those that are copies, as (id, tag, start, count)."""
    kind = F.expr(f"(place >> {_TAG_BITS}) & 3")
    here = F.struct(F.col("id"), F.expr("place >> 32"))
    same = Window.partitionBy("key", "other")
    seen = rows.withColumn("kind", kind).withColumn("lead", F.min(F.when(F.col("kind") == ONE, here)).over(same))
    return seen.filter((F.col("kind") == COPY) | (here > F.col("lead"))).select(
        "id", F.expr(_TAG).alias("tag"), F.expr("place >> 32").alias("start"), F.expr(_COUNT).alias("count"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, n_words, n_removed, kept (words left, joined by one space), removed_spans (starts and ends in turn)."""
    body = F.col(f"`{text}`")
    # the same three columns serve both joins, so that texts are shuffled once
    texts = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(_NO_ID)).alias("id"),
        F.expr(f"xxhash64(`{text}`) & {(1 << _TAG_BITS) - 1}").alias("tag"), body.alias("text"))
    blocks = texts.mapInArrow(_index, _ROWS)
    # shuffled as single rows: lists of one or two would be larger than the rows
    places = _open_and_copies(blocks).repartition("id", "tag").groupBy("id", "tag").agg(
        F.collect_list(F.struct("place", "count")).alias("at"))
    looked = texts.join(places, ["id", "tag"]).select("id", "tag", "text", "at.place", "at.count")
    windows = looked.mapInArrow(_boundaries, _ROWS)
    spans = _copied_windows(windows).repartition("id", "tag").groupBy("id", "tag").agg(
        F.collect_list(F.struct("start", "count")).alias("spans"))
    kept = texts.join(spans, ["id", "tag"], "left").select("text", "spans.start", "spans.count", "id")
    found = kept.mapInArrow(_keep, "id long, n_words long, n_removed long, kept string, removed_spans array<long>")
    own = F.when(F.col("id") != _NO_ID, F.col("id")).cast(dict(docs.dtypes)[key])
    return found.select(own.alias(key), "n_words", "n_removed", "kept", "removed_spans")
