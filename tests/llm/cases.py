"""Rows that every operator has to take, and plain versions of what operators do."""

from __future__ import annotations

import random
import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "node long, score double, n_words long, bucket long, kept boolean, id long, `a.b` string, _salt int")
EXTRA = (7, 0.5, 3, 1, True, 9, "x", 2)


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), *EXTRA)


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(f"{draw.choice('bcdfgklmnprst')}{draw.choice('aeiou')}{draw.randrange(400)}" for _ in range(n))


def edited(text: str, seed: int, changes: int) -> str:
    draw, parts = random.Random(seed), text.split(" ")
    for _ in range(changes):
        parts[draw.randrange(len(parts))] = f"new{draw.randrange(10 ** 6)}"
    return " ".join(parts)


def odd_rows() -> list[tuple]:
    """Nulls, empty and white texts, repeated rows, copies, a long text, odd characters."""
    base, long = words(1, 120), words(2, 30_000)
    return [
        row(1, base), row(2, base), row(3, base + "\n"), row(4, edited(base, 5, 2)), row(5, edited(base, 6, 40)),
        row(6, None), row(7, ""), row(8, " \t\n"), row(9, "one"), row(10, "one two"), row(11, "two words"),
        row(12, long), row(13, words(3, 50) + " " + " ".join(long.split()[500:700])),
        row(14, "same same " * 60), row(15, "Ünïcödé ÉTÉ \u00a0 \u2003 日本語 テスト 😀 a\x00b \x1c x"), row(16, base.upper()),
        row(17, words(4, 60)), row(17, words(4, 60)), row(17, words(5, 60)), row(None, words(6, 40)), row(None, None),
        row(18, words(7, 30), None, None), row(-5, words(8, 25)), row(2 ** 53 + 1, words(9, 25)), row(2 ** 53, base),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def split_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def as_counts(rows) -> dict:
    out: dict = {}
    for r in rows:
        out[tuple(r)] = out.get(tuple(r), 0) + 1
    return out
