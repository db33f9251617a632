"""Language identification with blended-spectrum presence kernels, Nystroem landmarks and kernel ridge regression.

A text is the set of its character n-grams (bytes of lower-cased letters; anything else is
a gap), hashed into a block of `SIZES[n]` places for each n. The kernel of two texts is
the mean over n of |A and B| / sqrt(|A| |B|). Landmark texts stand for the kernel: with
their kernel matrix M, a text's row k of kernel values becomes k M^-1/2, on which one ridge
regression per language is fitted. Scoring multiplies the presence matrix of a batch
by the landmarks and the result by the folded weights.

A long text is judged in equal pieces of at most `PIECE` bytes, whose values are averaged: presence says
nothing of how much of a text is in a language, its pieces do.

The best margin does not say whether a text is in any of the languages: with the h of a text, the same
regression for the constant 1, its margins add up to (2 - languages) * h, so that foreign text with a small h scores
about 0.5. A piece is claimed if its h is at least `LEAST_FIT` and either its two best margins are
`LEAST_GAP` apart or the landmarks span `LEAST_NORM` of its squared norm, as they do for
a mixture of their languages. A text is claimed if at least half of its pieces with letters are.

Learned from a bounded sample of rows, each with its whole text: per language the documents of least hash of
id and text among those with a label whose crc32(id as text) mod `FOLDS` is not 0, `PER_LANGUAGE` of them, or fewer
where `SAMPLE` rows would be exceeded in all. A document's row of kernel values is the mean over its pieces, which
is what scoring averages too. A landmark is one piece with letters, drawn by the text's hash.

Cases: a null text and one without letters are `und` with score 0, as is everything where
there is nothing to learn from; more than `MAX_LANGUAGES` labels are refused; a null id is not held out and not
learned from; rows that repeat an id are rows of their own; ties go to the first language in order; repeated rows
get equal results; a very long text is judged by all its pieces, a megabyte at a time; an empty table gives no rows;
other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envspark.llm.common import LOWER, fresh, mapped, slices, stash, texts_of

UNKNOWN = "und"
#: places of the hashed n-grams by n
SIZES = {1: 256, 2: 2048, 3: 8192}
WIDTH = sum(SIZES.values())
PER_LANGUAGE, LANDMARKS, RIDGE = 400, 192, 0.05
#: labels that are learned at most, rows that are learned from in all, and landmarks per label at least
MAX_LANGUAGES, SAMPLE, LANDMARKS_EACH = 256, 40_000, 4
FOLDS = 5
#: parts of the range of hashes that are counted before rows are ranked
SHARES = 4096
PIECE = 2048
# set on rows of the learned folds, judged by fits without them, against unlearned languages and random letters
LEAST_FIT, LEAST_GAP, LEAST_NORM = 0.5, 0.5, 0.5
# what a row of the presence matrix counts as, besides its text
ROW_BYTES = 4096

#: bytes of letters, lower-cased; all other bytes are a gap
_FOLD = np.where((LOWER >= 97) & (LOWER <= 122) | (LOWER >= 128), LOWER, 32).astype(np.uint8)
_FOLD_TABLE = _FOLD.tobytes()


def presence(texts: Sequence[bytes]) -> np.ndarray:
    """Which n-grams each text has: one row per text, blocks of places by n."""
    widest = max(SIZES)
    # a gap before each text and enough after it to end its n-grams, which begin in the text or its gap before
    data = _FOLD[np.frombuffer(b"".join(b" " + t + b" " * widest for t in texts), dtype=np.uint8)].astype(np.uint32)
    lengths = np.array([len(t) + 1 + widest for t in texts], dtype=np.int64)
    row = np.repeat(np.arange(len(texts)), lengths)
    own = np.arange(len(data)) < np.repeat(np.cumsum(lengths) - widest, lengths)
    out = np.zeros((len(texts), WIDTH), dtype=bool)
    begin, code = 0, np.zeros(len(data), dtype=np.uint32)
    for n, size in SIZES.items():
        code = code[:len(data) - n + 1] | (data[n - 1:] << np.uint32(8 * (n - 1)))
        place = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - size.bit_length() + 1)
        seen = own[:len(code)] & (data[:len(code)] != 32) if n == 1 else own[:len(code)]
        out[row[:len(code)][seen], begin + place[seen]] = True
        begin += size
    return out


def scaled(marks: np.ndarray) -> np.ndarray:
    """Rows whose scalar products are the kernel."""
    out, begin = marks.astype(np.float32), 0
    for size in SIZES.values():
        block = out[:, begin:begin + size]
        block /= np.sqrt(np.maximum(block.sum(axis=1, keepdims=True), 1) * len(SIZES))
        begin += size
    return out


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    landmarks: np.ndarray  # packed presence bits
    weights: np.ndarray  # landmarks by languages and the constant 1
    root: np.ndarray  # landmarks by the directions that they span

    def judged(self, texts: Sequence[bytes], landmarks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margins, one row per text and column per language, the mean over the text's pieces; and which texts are claimed."""
        parts = [pieces(t) for t in texts]
        rows, claims, every = [], [], [p for ps in parts for p in ps]
        for low, high in slices([len(p) + ROW_BYTES for p in every]):
            marks = presence(every[low:high])
            kernel = scaled(marks) @ landmarks.T
            fitted = kernel @ self.weights
            rows.append(fitted[:, :-1])
            claims.append(np.stack([marks[:, :SIZES[1]].any(axis=1), self.claims(kernel, fitted)], axis=1))
        starts = np.cumsum([0, *[len(p) for p in parts[:-1]]])
        lettered, claimed = np.add.reduceat(np.concatenate(claims).astype(np.int64), starts).T
        means = np.add.reduceat(np.concatenate(rows), starts) / np.array([len(p) for p in parts])[:, None]
        return means, (claimed > 0) & (2 * claimed >= lettered)

    def claims(self, kernel: np.ndarray, fitted: np.ndarray) -> np.ndarray:
        """Which pieces are in a language or in several of them."""
        ordered = np.sort(fitted[:, :-1], axis=1)
        # one language alone has no other to be apart from
        apart = ordered[:, -1] - ordered[:, -2] >= LEAST_GAP if len(self.languages) > 1 else False
        return (fitted[:, -1] >= LEAST_FIT) & (apart | (((kernel @ self.root) ** 2).sum(axis=1) >= LEAST_NORM))

    def unpacked(self) -> np.ndarray:
        return scaled(np.unpackbits(self.landmarks, axis=1, count=WIDTH).astype(bool))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def pieces(text: bytes) -> list[bytes]:
    """The whole text in equal pieces."""
    count = max(1, -(-len(text) // PIECE))
    cuts = [i * len(text) // count for i in range(count + 1)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def drawn(text: bytes) -> bytes:
    """One of the pieces with letters, by the text's hash."""
    parts = pieces(text)
    lettered = [p for p in parts if p.translate(_FOLD_TABLE).strip()] or parts
    return lettered[zlib.crc32(text) % len(lettered)]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The presence bits of a drawn piece of each text."""
    for batch in batches:
        texts, bits = [drawn(t) for t in texts_of(batch.column(2))], []
        for low, high in slices([len(t) + ROW_BYTES for t in texts]):
            bits += [r.tobytes() for r in np.packbits(presence(texts[low:high]), axis=1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], names=["lang", "n", "bits"])


def kernel_means(texts: Sequence[bytes], landmarks: np.ndarray) -> np.ndarray:
    """The kernel values of each text with the landmarks, the mean over its pieces."""
    out = np.zeros((len(texts), len(landmarks)), dtype=np.float32)
    for row, text in zip(out, texts):
        parts = pieces(text)
        for low, high in slices([len(p) + ROW_BYTES for p in parts]):
            row += (scaled(presence(parts[low:high])) @ landmarks.T).sum(axis=0)
        row /= len(parts)
    return out


def _cuts(named: DataFrame, per_language: int) -> DataFrame:
    """(lang, cut): the least part of the range of hashes up to which each language has its rows, or all of them."""
    sizes = named.groupBy("lang", "part").agg(F.count("*").alias("n"))  # at most `SHARES` rows a language
    upto = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    return before.filter(F.col("before") < per_language).groupBy("lang").agg(F.max("part").alias("cut"))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang",
        per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> Model | None:
    """Fit on the bounded sample; None if no document can be learned from."""
    body, id_ = F.col(f"`{text}`"), F.col(f"`{key}`")
    usable = docs.filter(F.col(f"`{label}`").isNotNull() & id_.isNotNull() & ~held_out(id_) & has_letters(body))
    named = usable.select(F.col(f"`{label}`").cast("string").alias("lang"), F.xxhash64(id_.cast("string"), body).alias("spread"),
                          body.alias("text")).withColumn("part", F.shiftrightunsigned("spread", 52))
    cuts = stash(_cuts(named, per_language))
    languages = tuple(sorted(r.lang for r in cuts.select("lang").limit(MAX_LANGUAGES + 1).collect()))
    if not languages:
        return None
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"column {label!r} has more than {MAX_LANGUAGES} labels to learn")
    each = max(1, min(per_language, SAMPLE // len(languages)))
    landmarks = max(landmarks, LANDMARKS_EACH * len(languages))

    # rows above the cuts cannot be among the first; Spark limits the others per task before it ranks them
    near = named.join(F.broadcast(cuts), "lang").filter("part <= cut")  # one row per language
    first = Window.partitionBy("lang").orderBy("part", "spread", "text")
    chosen = stash(near.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= each).select("lang", "n", "text"))
    bits = chosen.mapInArrow(_packed, "lang string, n int, bits binary")
    # landmarks in turn from each language
    marks = np.stack([np.frombuffer(r.bits, dtype=np.uint8) for r in bits.orderBy("n", "lang").limit(landmarks).collect()])
    base = scaled(np.unpackbits(marks, axis=1, count=WIDTH).astype(bool))
    sent = docs.sparkSession.sparkContext.broadcast(marks)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scaled(np.unpackbits(sent.value, axis=1, count=WIDTH).astype(bool))
        for batch in batches:
            rows = [r.tobytes() for r in kernel_means(list(texts_of(batch.column(2))), own)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["lang", "n", "row"])

    rows = sorted(chosen.mapInArrow(means, "lang string, n int, row binary").collect(), key=lambda r: (r.lang, r.n))
    kernel = np.stack([np.frombuffer(r.row, dtype=np.float32) for r in rows]).astype(np.float64)
    own = np.array([languages.index(r.lang) for r in rows])
    weights, root = solved(base.astype(np.float64), kernel, own, len(languages))
    return Model(languages, marks, weights.astype(np.float32), root.astype(np.float32))


def solved(base: np.ndarray, kernel: np.ndarray, own: np.ndarray, languages: int) -> tuple[np.ndarray, np.ndarray]:
    """Ridge regression per language, and of the constant 1, on the directions that the landmarks span.

    `base` has the scaled landmarks, `kernel` the rows' kernel values with them, `own` the rows' languages.
    """
    values, vectors = np.linalg.eigh(base @ base.T)
    keep = values > 1e-8 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    points = kernel @ root
    share = (1.0 / np.bincount(own))[own][:, None]  # each language weighs the same
    target = np.column_stack([np.where(own[:, None] == np.arange(languages), 1.0, -1.0), np.ones(len(own))])
    weights = np.linalg.solve(points.T @ (points * share) + RIDGE / len(own) * np.eye(points.shape[1]),
                              points.T @ (target * share))
    return root @ weights, root


def identified(docs: DataFrame, model: Model | None, text: str = "text") -> tuple[DataFrame, str, str]:
    """Add the predicted language and its score; returns the frame and the names of both columns."""
    found, name, score, claim = judged(docs, model, text)
    return found.drop(claim), name, score


def claimed(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The documents that are in a learned language or in several of them."""
    found, _, _, claim = judged(docs, model, text)
    return found.filter(F.col(claim)).select(*[F.col(f"`{c}`") for c in docs.columns])


def judged(docs: DataFrame, model: Model | None, text: str = "text") -> tuple[DataFrame, str, str, str]:
    """Add the predicted language, its score and whether the text is claimed; returns the frame and the names of the columns."""
    names = fresh(docs, "lang_pred"), fresh(docs, "score"), fresh(docs, "claimed")
    letters = fresh(docs, "_letters")
    marked = docs.withColumn(letters, has_letters(F.col(f"`{text}`")))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        landmarks = known.unpacked() if known else None
        for batch in batches:
            some = batch.column(batch.num_columns - 1).to_pylist()
            found, score, claim = [UNKNOWN] * len(some), [0.0] * len(some), [False] * len(some)
            if known:
                texts = [t if s else b"" for t, s in zip(texts_of(batch.column(at)), some)]
                for low, high in slices([len(t) + ROW_BYTES for t in texts]):
                    margins, claims = known.judged(texts[low:high], landmarks)
                    best = margins.argmax(axis=1)
                    top = np.clip((margins.max(axis=1) + 1) / 2, 0, 1)
                    for i in range(low, high):
                        if some[i]:
                            found[i], score[i] = known.languages[best[i - low]], float(top[i - low])
                            claim[i] = bool(claims[i - low])
            columns = [*batch.columns, pa.array(found, pa.string()), pa.array(score, pa.float64()), pa.array(claim, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    added = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()),
             T.StructField(names[2], T.BooleanType())]
    return mapped(marked, run, added).drop(letters), *names
