"""Aligning the tokens of two tokenizers on the bytes that they share.

1. Both tokenizers cut the same bytes. Within a step of many documents, laid end to end, every token
   points to its farthest-right overlapping token of the other side: a B token to the A token
   of its last byte, an A token to the B token of its last byte if that ends later. A token that ends
   where one of the other side ends is terminal. Successors are doubled, all tokens at once, until nothing
   moves; then each token knows the terminal token of its component, which labels the group.
2. The ends of both sides, merged, are the links: each piece between two neighbouring ends lies in one token of
   either side. Links are counted by pair of ids within a document.
3. Documents that hold a pair are counted over the corpus: first within blocks of neighbouring documents, of
   about `BLOCK_BYTES` of text each, then over blocks. Each block gets the counts of its own pairs back and
   looks them up for its documents. A pair that every document holds is thus one row per block,
   and no task needs the table of all pairs.

Cases: null and empty texts, and texts that one of the tokenizers does not give back byte for byte, have
no tokens, groups and links; repeated rows count as documents of their own; ties for the highest count are all best;
a null key is kept; a very long text is cut for the tokenizers where a blank starts a word, is a block of its own,
and its tokens have to fit into a task's memory; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envspark.llm.byte_bpe import encoder, pieces_of
from envspark.llm.common import slices, texts_of

#: text whose documents share a lookup of pair counts
BLOCK_BYTES = 16 << 20
#: text of one vectorized step
STEP_BYTES = 1 << 19
_BLANK = "▁"


class PieceEncoder:
    """Ids and bytes of a sentencepiece model that adds a blank in front."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = list(map(self.model.id_to_piece, range(self.model.get_piece_size())))
        self.bytes_of = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace(_BLANK, " ").encode()
                         for i, p in enumerate(pieces)]
        # pieces with a blank only in front cannot reach over the start of a word
        self.by_word = all(_BLANK not in p.lstrip(_BLANK) for p in pieces)

    def ids(self, text: str) -> list[int]:
        if not self.by_word:
            return self.model.encode(text)
        first, *rest = pieces_of(text)
        found = self.model.encode(first)
        for piece in rest:  # it starts with the blank that the model adds
            found.extend(self.model.encode(piece[1:]))
        return found


class Aligner:
    """The vectorized alignment of one worker process."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = encoder(path_a, True), PieceEncoder(path_b)
        names_a = [self.a.bytes_of.get(i, b"") for i in range(max(self.a.bytes_of) + 1)]
        self.size_a = np.array([len(x) for x in names_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.b.bytes_of], dtype=np.int64)
        self.bits_b = max(1, len(self.size_b).bit_length())
        self.bits = self.bits_b + max(1, len(self.size_a).bit_length())
        if self.bits > 42:
            raise ValueError("the vocabularies have too many ids for a step's sort key")
        # ids as text with what may follow them: an A id "," or "|", a B id ",", ";" or nothing
        text = [b"%d%s" % (i, end) for n, ends in ((len(names_a), (b",", b"|")), (len(self.size_b), (b",", b";", b"")))
                for end in ends for i in range(n)]
        self.text = np.empty(len(text), dtype=object)
        self.text[:] = text

    def tokens(self, text: bytes) -> tuple[list[int], list[int]]:
        """The ids of both sides, or none if either side does not give the bytes back."""
        if text:
            line = text.decode()
            a, b = self.a.ids(" " + line), self.b.ids(line)
            if (b"".join(map(self.a.bytes_of.__getitem__, a)) == b"".join(map(self.b.bytes_of.__getitem__, b)) == b" " + text):
                return a, b
        return [], []

    def step(self, texts: list[bytes]) -> dict[str, np.ndarray | list[bytes]]:
        both = [self.tokens(t) for t in texts]
        n_a, n_b = (np.array([len(x[side]) for x in both], dtype=np.int64) for side in (0, 1))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x[side] for x in both), np.int64, int(n.sum()))
                        for side, n in ((0, n_a), (1, n_b)))
        size_a, size_b = self.size_a[ids_a], self.size_b[ids_b]
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        n_bytes = int(end_a[-1]) if len(end_a) else 0
        bounds = np.concatenate([[0], np.concatenate([[0], end_a])[np.cumsum(n_a)]])
        # what each byte lies in
        at_a, at_b = np.repeat(np.arange(len(ids_a)), size_a), np.repeat(np.arange(len(ids_b)), size_b)
        at_doc = np.repeat(np.arange(len(texts)), np.diff(bounds))

        label = end_a[components(end_a, end_b, at_a, at_b)]  # where each token's group ends
        is_end = marked(n_bytes, label)
        group = np.cumsum(is_end)[label - 1] - 1
        n_groups = np.bincount(at_doc[is_end], minlength=len(texts))

        last = np.flatnonzero(marked(n_bytes, end_a) | marked(n_bytes, end_b))  # the last byte of each link
        doc = at_doc[last]
        pairs, links = np.unique((doc << self.bits) | (ids_a[at_a[last]] << self.bits_b) | ids_b[at_b[last]], return_counts=True)
        held = np.bincount(pairs >> self.bits, minlength=len(texts))
        a = (pairs >> self.bits_b) & ((1 << (self.bits - self.bits_b)) - 1)
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": np.bincount(doc, minlength=len(texts)),
                "groups": self._written(ids_a, ids_b, group[:len(ids_a)], group[len(ids_a):], n_groups, n_a + n_b),
                "held": held, "pairs": (a << 32) | (pairs & ((1 << self.bits_b) - 1)), "links": links}

    def _written(self, ids_a, ids_b, group_a, group_b, n_groups, n_tokens) -> list[bytes]:
        """`a1,a2|b1;a3|b2` of each document."""
        total = int(n_groups.sum())
        upto_a, upto_b = (np.cumsum(np.bincount(g, minlength=total)) for g in (group_a, group_b))
        place_a = np.arange(len(ids_a)) + np.concatenate([[0], upto_b])[group_a]
        place_b = np.arange(len(ids_b)) + upto_a[group_b]
        last_a = np.append(group_a[1:] != group_a[:-1], True)[:len(ids_a)]
        last_b = np.append(group_b[1:] != group_b[:-1], True)[:len(ids_b)]
        ends_doc = np.zeros(total, dtype=bool)
        ends_doc[np.cumsum(n_groups)[n_groups > 0] - 1] = True
        which = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        which[place_a] = ids_a + len(self.size_a) * last_a
        which[place_b] = 2 * len(self.size_a) + ids_b + len(self.size_b) * (last_b * (1 + ends_doc[group_b]))
        written = self.text[which].tolist()
        bounds = np.concatenate([[0], np.cumsum(n_tokens)]).tolist()
        return [b"".join(written[low:high]) for low, high in zip(bounds, bounds[1:])]


def components(end_a: np.ndarray, end_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """The terminal A token of the component of every token, A tokens first, by pointer jumping.

    `at_a` and `at_b` say which token each byte lies in.
    """
    far_b, far_a = at_b[end_a - 1], at_a[end_b - 1]
    own = np.arange(len(end_a))
    successor = np.concatenate([np.where(end_b[far_b] > end_a, len(end_a) + far_b, own), far_a])
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            return successor
        successor = doubled


def marked(n_bytes: int, ends: np.ndarray) -> np.ndarray:
    """Which bytes are the last before one of the ends."""
    found = np.zeros(n_bytes, dtype=bool)
    found[ends - 1] = True
    return found


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker process and pair of vocabularies."""
    return Aligner(path_a, path_b)


def _map(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        block, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts = list(texts_of(batch.column(1)))
            for low, high in slices([len(t) for t in texts], STEP_BYTES):
                size = sum(map(len, texts[low:high]))
                if filled and filled + size > BLOCK_BYTES:
                    block, filled = block + 1, 0
                filled += size
                found = tool.step(texts[low:high])
                bounds = np.concatenate([[0], np.cumsum(found["held"])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(np.full(high - low, block, dtype=np.int64)),
                     *[pa.array(found[n]) for n in ("n_a", "n_b", "n_groups", "n_links")],
                     pa.array(found["groups"], pa.binary()).cast(pa.string()),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(found["pairs"])),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(found["links"].astype(np.int32)))],
                    names=[batch.schema.names[0], *ALIGNED])
    return run


ALIGNED = ("block", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links")


def aligned(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: `key`, block, n_a, n_b, n_groups, n_links, the groups as text (`a1,a2|b1;a3|b2,b3`), and
    its different linked pairs (A id * 2**32 + B id) with the number of links of each.

    `block` depends on how Spark splits the table: write the frame (`common.stash`) before it is read twice.
    """
    kinds = ("long", "long", "long", "long", "long", "string", "array<long>", "array<int>")
    added = ", ".join(f"{n} {k}" for n, k in zip(ALIGNED, kinds))
    plain = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    found = plain.mapInArrow(_map(path_a, path_b), f"key {dict(plain.dtypes)['key']}, {added}")
    return found.withColumnRenamed("key", key)


def _look_up(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """Add n_best and count_sum to the documents of a block."""
    order = np.argsort(counts["pair"].to_numpy())
    known, documents, best = (counts[n].to_numpy()[order] for n in ("pair", "documents", "best"))
    pairs = rows["pairs"].combine_chunks()
    links = rows["links"].combine_chunks().flatten().to_numpy().astype(np.int64)
    at = np.searchsorted(known, pairs.flatten().to_numpy())
    bounds = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy())])

    def totals(values):
        return pa.array(np.diff(np.concatenate([[0], np.cumsum(values)])[bounds]).astype(np.int64))

    kept = rows.drop_columns(["block", "pairs", "links"])
    return (kept.append_column("n_best", totals(links * best[at]))
            .append_column("count_sum", totals(links * documents[at])))


def weighed(found: DataFrame) -> DataFrame:
    """Replace block, pairs and links of a written `aligned` frame by n_best and count_sum.

    A pair's count is the number of documents that hold it. n_best counts the links whose pair has the highest count
    of its A id, count_sum adds up the counts of all links.
    """
    held = (found.select("block", F.explode("pairs").alias("pair"))
            .groupBy("block", "pair").agg(F.count("*").alias("n")))
    first_id = F.shiftright("pair", 32).alias("a")
    documents = held.groupBy("pair").agg(F.sum("n").alias("documents"))
    most = documents.groupBy(first_id).agg(F.max("documents").alias("most"))  # at most a row per id of A
    counts = (documents.select("*", first_id).join(F.broadcast(most), "a")
              .select("pair", "documents", (F.col("documents") == F.col("most")).cast("long").alias("best")))
    needed = held.select("block", "pair").join(counts, "pair").select(F.col("block").alias("of"), "pair", "documents", "best")
    kept = [f for f in found.schema.fields if f.name not in ("block", "pairs", "links")]
    added = [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]
    return (found.groupBy("block").cogroup(needed.groupBy("of"))
            .applyInArrow(_look_up, T.StructType([*kept, *added])))
