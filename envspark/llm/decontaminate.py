"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A window is `window` consecutive words of a benchmark item; an item of fewer words,
but not none, is one window. Windows of equal length form a matcher: a shift table
over blocks of words skips positions where no window can end, buckets by the last
block select the windows that may end here, and comparing the words confirms them.
Item texts travel to the executors in blocks of a bounded number of words; each further block is
one more scan over the stored state of the scan before, so any number of items works. A worker process
builds the tables of a block once. Words are numbers there, and a window is a place in its item, so that a
word of an item costs a few hundred bytes.

Cases: a null or empty text has no words and no hits; a null or empty item has no
windows; an item without id marks words but is not listed; rows of one item_id count as
one item; repeated rows are judged each; an empty benchmark hits nothing; windows that several items have
name all of them; a very long text is searched whole, its words held at once; an empty table gives no
rows. Other columns of the documents pass through, whatever their names.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envspark.llm.common import fresh, mapped, stash, texts_of

WINDOW = 10
# words of item texts that are sent to executors at once, and bytes for items of few words
BLOCK_TOKENS, BLOCK_BYTES = 1_000_000, 32 << 20
# words in a block of the shift table
BLOCK_WORDS = 2

#: digits and a-z as they are, A-Z in lower case, everything beyond ASCII kept, all else a gap
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Matcher:
    """Windows of one length over items of numbered words, with the tables of the search."""

    def __init__(self, length: int, items: Sequence[array], base: int):
        self.length, self.block, self.base, self.items = length, min(BLOCK_WORDS, length), base, items
        self.farthest = length - self.block + 1
        self.shift: dict[int, int] = {}
        #: different windows by last block and hash of the words, as the place (item, start) of one of them
        self.buckets: dict[int, int] = {}
        #: further items that have the window of a place
        self.others: dict[int, list[int]] = {}
        for number, words in enumerate(items):
            for end in range(length, len(words) + 1):
                self._add(number, words, end)

    def _add(self, number: int, words: array, end: int) -> None:
        length, shift = self.length, self.shift
        for back in range(self.farthest):
            key = self._block(words, end - back)
            if shift.get(key, self.farthest) > back:
                shift[key] = back
        window = words[end - length:end]
        bucket, place = self._find(self._block(words, end), window)
        if place is None:
            self.buckets[bucket] = number << 32 | end - length
        elif place >> 32 != number:
            owners = self.others.setdefault(place, [])
            if not owners or owners[-1] != number:
                owners.append(number)

    def _block(self, words: array, end: int) -> int:
        """The one or two words that end at a place, as one number."""
        return words[end - 1] if self.block == 1 else words[end - 2] * self.base + words[end - 1]

    def _find(self, block: int, window: array) -> tuple[int, int | None]:
        """The bucket of a window and, if it is known, its place: words are compared, hashes only select."""
        bucket = hash((block, window.tobytes()))
        while (place := self.buckets.get(bucket)) is not None:
            start = place & 0xFFFFFFFF
            if self.items[place >> 32][start:start + self.length] == window:
                return bucket, place
            bucket += 1
        return bucket, None

    def search(self, words: array) -> Iterator[tuple[int, list[int]]]:
        """Where windows begin, in ascending order, and the items that have them. Words of no item are 0."""
        end, n = self.length, len(words)
        while end <= n:
            block = self._block(words, end)
            step = self.shift.get(block, self.farthest)
            if not step:
                _, place = self._find(block, words[end - self.length:end])
                if place is not None:
                    yield end - self.length, [place >> 32, *self.others.get(place, ())]
            end += step or 1


class Search:
    """The matchers of a block of items, one per length of window."""

    def __init__(self, texts: Sequence[bytes], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        numbers = self.numbers
        items = [array("q", [numbers.setdefault(w, len(numbers) + 1) for w in words_of(t)]) for t in texts]
        lengths = sorted({min(window, len(words)) for words in items} - {0})
        # an item has windows of its own length only
        self.matchers = [Matcher(length, [i if min(window, len(i)) == length else array("q") for i in items], len(numbers) + 1)
                         for length in lengths]

    def numbered(self, words: list[bytes]) -> array:
        return array("q", [self.numbers.get(w, 0) for w in words])


_searches: dict[str, tuple[list[str | None], Search]] = {}


def search_of(name: str, block, window: int) -> tuple[list[str | None], Search]:
    """The ids and the search of a block, built once per worker process; one block is kept."""
    if name not in _searches:
        _searches.clear()
        items = block()
        _searches[name] = [i for i, _ in items], Search([t for _, t in items], window)
    return _searches[name]


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Starts and ends of the union of spans, in turn."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _item_blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """Items in blocks of about `limit` words; a block is the most that the driver holds."""
    block, size = [], 0
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).cast("binary").alias("t"))
    for row in rows.filter("t IS NOT NULL").toLocalIterator():
        # a word of an item costs as much as so many bytes of its text
        cost = max(len(words_of(bytes(row.t))), len(row.t) * BLOCK_TOKENS // BLOCK_BYTES)
        if block and size + cost > limit:
            yield block
            block, size = [], 0
        block.append((row.i, bytes(row.t)))
        size += cost
    yield block


def find_windows(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                 item_text: str = "text", window: int = WINDOW, prefix: str = "hit",
                 block_words: int = BLOCK_TOKENS) -> tuple[DataFrame, dict[str, str]]:
    """Add to each document its number of words, the spans of words inside windows and the items found.

    Returns the frame and the names of the added columns by `words`, `spans`
    (starts and ends in turn, of the union) and `items` (ids as strings, sorted).
    """
    names = {k: fresh(docs, f"{prefix}_{k}") for k in ("words", "spans", "items")}
    state = (docs.withColumn(names["words"], F.lit(0).cast("long"))
             .withColumn(names["spans"], F.array().cast("array<bigint>"))
             .withColumn(names["items"], F.array().cast("array<string>")))
    place = {k: state.columns.index(v) for k, v in names.items()}
    at = docs.columns.index(text)
    spark = docs.sparkSession
    for number, block in enumerate(_item_blocks(benchmark, item, item_text, block_words)):
        if number:
            state = stash(state)
        sent = spark.sparkContext.broadcast(block)
        state = mapped(state, _scanner(sent, uuid.uuid4().hex, at, place, window))
    return state, names


def _scanner(sent, name: str, at: int, place: dict[str, int], window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, search = search_of(name, lambda: sent.value, window)
        for batch in batches:
            counts, spans, found = [], [], []
            old = zip(batch.column(place["spans"]).to_pylist(), batch.column(place["items"]).to_pylist())
            for body, (had, items) in zip(texts_of(batch.column(at)), old):
                words = search.numbered(words_of(body))
                hits, seen = list(zip(had[::2], had[1::2])), set(items)
                for matcher in search.matchers:
                    for start, owners in matcher.search(words):
                        hits.append((start, start + matcher.length))
                        seen.update(ids[o] for o in owners)
                counts.append(len(words))
                spans.append(merged(hits))
                found.append(sorted(seen - {None}))
            columns = list(batch.columns)
            columns[place["words"]] = pa.array(counts, pa.int64())
            columns[place["spans"]] = pa.array(spans, pa.list_(pa.int64()))
            columns[place["items"]] = pa.array(found, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
    return scan


def hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", window: int = WINDOW, **options) -> DataFrame:
    """One row per document: its words, the words inside windows, the items that have such windows."""
    found, names = find_windows(docs.select(key, "text"), benchmark, window=window, **options)
    spans = F.col(names["spans"])
    length = F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                         F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        key, F.col(names["words"]).alias("n_words"), length.alias("n_hit"),
        F.size(names["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(names["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(spans) > 0).alias("contaminated"), F.col(names["items"]).alias("items"), spans.alias("spans"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any word inside a window, with their columns as they are."""
    found, names = find_windows(docs, benchmark, **options)
    return found.filter(F.size(names["spans"]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
