"""Token counts of a unigram tokenizer without making tokens: count-only Viterbi.

The best segmentation of a text is the one of largest score; dynamic programming over its
characters carries the best score and the number of pieces to each position. An Aho-Corasick
automaton over the vocabulary names the pieces that end at a position, longest first. As in
the tokenizer, a later candidate replaces the best only if it is strictly better, so of equal
ones the longest last piece wins; a character that is no piece by itself may be unknown at
the least score minus 10 and counts as one piece per UTF-8 byte.

Scores are whole numbers, so sums are exact and a text may be cut where no piece
crosses: before the first of a run of blanks. Such parts repeat, and a worker keeps the results of short
ones, in a memory bounded in bytes. Of a part, only the scores that the longest piece can reach back to are held.

Blanks become U+2581, one of which stands before the text unless it begins with a blank.

Cases: a null or empty text has no tokens and score 0; ties are the tokenizer's, as above; repeated rows are
counted each; a very long text, with or without blanks, takes little more memory than itself and its list of parts; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envspark.llm.common import texts_of

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
# memory of a worker for results of parts, and characters of the longest part that it keeps
KNOWN_BYTES, KNOWN_LENGTH = 48 << 20, 100
# what an entry takes besides its text, and bytes per character at most
ENTRY_BYTES, CHARACTER_BYTES = 300, 4
# scores that are held at once, if pieces are not longer
HELD = 4096

_PARTS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_CROSSING = re.compile(f"[^{BLANK}]{BLANK}")


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file; pieces that stand for control signs or bytes get the least score."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in ids]
    least = min(model.get_score(i) for i in ids if not special[i])
    return [(model.id_to_piece(i), least if special[i] else model.get_score(i)) for i in ids]


class Memory:
    """Results of parts, in two generations: when the younger one is full, it becomes the older one, whose
    entries are dropped unless they were asked for meanwhile."""

    def __init__(self, limit: int = KNOWN_BYTES):
        self.limit, self.size = limit // 2, 0
        self.young: dict[str, tuple[int, float]] = {}
        self.old: dict[str, tuple[int, float]] = {}

    def get(self, part: str) -> tuple[int, float] | None:
        found = self.young.get(part)
        if found is None:
            found = self.old.get(part)
            if found is not None:
                self.keep(part, found)
        return found

    def keep(self, part: str, found: tuple[int, float]) -> None:
        if len(part) > KNOWN_LENGTH:
            return
        self.size += ENTRY_BYTES + CHARACTER_BYTES * len(part)
        if self.size > self.limit:
            self.old, self.young, self.size = self.young, {}, ENTRY_BYTES + CHARACTER_BYTES * len(part)
        self.young[part] = found


class Counter:
    """Counts the pieces of texts under a vocabulary of (piece, score)."""

    def __init__(self, pieces: list[tuple[str, float]]):
        from ahocorasick import Automaton

        self.automaton = Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        exact = all(float(score).is_integer() for _, score in pieces)
        self.by_part = exact and not any(_CROSSING.search(piece) for piece, _ in pieces)
        self.reach = max([1, *(len(piece) for piece, _ in pieces)])
        self.known = Memory()

    def viterbi(self, part: str) -> tuple[int, float]:
        """Number of pieces and score of the best segmentation."""
        best, count = [0.0], [0]  # at the positions from `first` on
        first, held = 0, max(HELD, 2 * self.reach)
        matches = iter(self.automaton.iter(part))
        match = next(matches, None)
        for end, character in enumerate(part, 1):
            if len(best) > held:
                first += len(best) - self.reach
                del best[:-self.reach], count[:-self.reach]
            top, pieces, single = None, 0, False
            while match is not None and match[0] == end - 1:
                length, score = match[1]
                total = best[end - length - first] + score
                if top is None or total > top:
                    top, pieces = total, count[end - length - first] + 1
                single = single or length == 1
                match = next(matches, None)
            if not single:
                total = best[-1] + self.unknown
                if top is None or total > top:
                    top, pieces = total, count[-1] + len(character.encode())
            best.append(top)
            count.append(pieces)
        return count[-1], best[-1]

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        text = text.replace(" ", BLANK)
        if not text.startswith(BLANK):
            text = BLANK + text
        if not self.by_part:
            return self.viterbi(text)
        number, total, known = 0, 0.0, self.known
        for part in _PARTS.findall(text):
            found = known.get(part)
            if found is None:
                found = self.viterbi(part)
                known.keep(part, found)
            number += found[0]
            total += found[1]
        return number, total


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter per worker process and vocabulary."""
    return Counter(vocabulary(path))


def counted(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, n_tokens, best_score of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            found = [count(t.decode()) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())],
                names=[batch.schema.names[0], "n_tokens", "best_score"])

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, best_score double")
