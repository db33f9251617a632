"""Pseudonyms and fingerprints, the operators made of SQL functions."""

from __future__ import annotations

import hashlib
import re

from cases import as_counts, frame, odd_rows, row, split_words, words
from pyspark.sql import functions as F

from envspark.llm import fingerprints, pseudonyms

VALUES = [
    ("+1 (437) 555-0689", r"\+1 \(\d{3}\) \d{3}-\d{4}"), ("4111 1111 1111 1111", r"\d{4} \d{4} \d{4} \d{4}"),
    ("4539578763621486", r"\d{16}"), ("DE89 3704 0044 0532 0130 00", r"DE\d\d( \d{4}){4} \d\d"),
    ("GB82WEST12345698765432", r"GB\d\dWEST\d{14}"), ("2024-02-29", r"\d{4}-\d\d-\d\d"), ("31.12.1999", r"\d\d?\.\d\d?\.\d{4}"),
    ("02/28/2000", r"\d\d/\d\d/\d{4}"), ("078-05-1120", r"\d{3}-\d\d-\d{4}"), ("192.168.0.1", r"\d{1,3}(\.\d{1,3}){3}"),
    ("a.b+c@mail.example.com", r"user-[0-9a-f]{16}@example\.invalid"),
    ('token = "1eb9c654e721b4f812088970e66a6345cee33dd6', r'token = "[0-9a-f]{40}'),
]
INVALID = ["4111-1111-1111-1112", "2023-02-29", "666-12-1234", "000-12-1234", "256.1.1.1", "1.2.3.4.5", "DE89370400440532013001",
           "31/12/1999", "12.0", "version 3.", "a@b", "1700-01-01", "+123"]


def replaced(spark, texts, key="k"):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out, count = pseudonyms.pseudonymized(docs, key)
    return {r.doc_id: (r.text, r[count]) for r in out.collect()}


def test_values_are_replaced_within_their_format(spark):
    texts = [f"é {v}*** and «{v}»" for v, _ in VALUES] + INVALID
    got = replaced(spark, texts)
    for i, (value, shape) in enumerate(VALUES):
        text, count = got[i]
        inside = re.fullmatch(r"é (.*)\*\*\* and «(.*)»", text)
        assert count == 2 and inside[1] == inside[2] != value and re.fullmatch(shape, inside[1]), text
    for i, value in enumerate(INVALID):
        assert got[len(VALUES) + i] == (value, 0)
    assert replaced(spark, texts) == got and replaced(spark, texts, "other")[0] != got[0]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def test_numbers_beside_numbers_and_words_are_found(spark):
    spaced, plain, account = "4111 1111 1111 1111", "4539578763621486", "AT61 1904 3002 3457 3201"
    cases = [("room 12 ", spaced, ""), ("", "4111111111111111", " 123"), ("", spaced, " 12/25"), ("2024 ", spaced, ""),
             ("1 2 3 ", plain, " 4 5 6 7"), ("", "4111-1111-1111-1111", "-12"), ("", account, " IBAN"), ("", account, " NR 12"),
             ("NR12 ", account, " ABCD"), ("IBAN ", account, ""), ("", account, "")]
    alone = replaced(spark, [value for _, value, _ in cases])
    got = replaced(spark, [f"{a}{v}{b}" for a, v, b in cases])
    for i, (before, value, after) in enumerate(cases):
        assert alone[i][0] != value and got[i] == (f"{before}{alone[i][0]}{after}", 1)
    both = replaced(spark, [f"{spaced} {plain} {account} {spaced} 02/28/2000", "9 " * 3000 + plain, "1234 5678 " * 40])
    text, count = both[0]
    assert count == 5 and not any(v in text for v in (spaced, plain, account, "02/28/2000"))
    assert plain not in both[1][0] and both[1][1] >= 1 and len(both[1][0]) == 6016 and len(both[2][0]) == 400


def test_pseudonyms_stay_valid_and_apart(spark):
    cards = [n for n in (f"4{i:015d}" for i in range(4000)) if luhn(n)]
    days = [f"20{y:02d}-{m:02d}-{d:02d}" for y in range(20) for m in range(1, 13) for d in range(1, 29)]
    numbers = [f"{a:03d}-{g:02d}-0007" for a in (1, 665, 667, 899) for g in range(1, 100)]
    hosts = [f"10.0.{i}.{j}" for i in range(20) for j in range(20)]
    for values, valid in ((cards, luhn), (days, None), (numbers, lambda v: v[:3] not in ("000", "666") and v[0] != "9"),
                          (hosts, lambda v: all(int(p) < 256 for p in v.split(".")))):
        got = [t for t, _ in replaced(spark, values).values()]
        assert len(set(got)) == len(values)
        assert valid is None or all(valid(v) for v in got)
    iban = replaced(spark, ["DE89370400440532013000"])[0][0]
    assert int(iban[4:] + "1314" + iban[2:4]) % 97 == 1


def test_feistel_is_a_permutation(spark):
    rows = spark.range(7 * 9).select(pseudonyms.feistel(F.floor(F.col("id") / 9), F.col("id") % 9, (F.lit(7), F.lit(9)), "k", "t").alias("s"))
    assert len({(r.s.a, r.s.b) for r in rows.collect()}) == 63
    digits = spark.createDataFrame([(f"{i:03d}",) for i in range(1000)], "d string")
    assert len({r[0] for r in digits.select(pseudonyms.permuted_digits(F.col("d"), "k", "t")).collect()}) == 1000


def test_pseudonyms_leave_the_rest_alone(spark):
    docs = frame(spark, odd_rows())
    out, count = pseudonyms.pseudonymized(docs, "k")
    assert out.columns == [*docs.columns, count]
    assert as_counts(r[:-1] for r in out.collect()) == as_counts(docs.collect())
    assert pseudonyms.pseudonymized(frame(spark, []), "k")[0].collect() == []


def shingles(text):
    parts = split_words(text)
    return {tuple(parts[i:i + 5]) for i in range(max(1, len(parts) - 4))} if parts else set()


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark):
    rows = [r for r in odd_rows() if r[0] not in (None, 17)] + [row(800 + i, words(i // 2, 12 + 7 * i)) for i in range(80)]
    for buckets in (1, 9):
        got = {r.doc_id: r for r in fingerprints.fingerprinted(frame(spark, rows), buckets=buckets).collect()}
        ordered = sorted((r[0], r[1] or "") for r in rows)
        assert len(got) == len(ordered)
        off = []
        for (doc_id, text), (next_id, following) in zip(ordered, ordered[1:] + ordered[:1]):
            n, r = len(text), got[doc_id]
            changed = text[:n - n // 2] + following[:n // 2]
            assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
            off += [r.near_edited - alike(shingles(text), shingles(changed)),
                    r.near_next - alike(shingles(text), shingles(following))]
            if text == changed:
                assert r.fingerprint == r.edited_fingerprint and r.near_edited == 1
        assert max(map(abs, off)) < 0.2 and abs(sum(off) / len(off)) < 0.02
        by_text = {}
        for doc_id, text in ordered:
            assert by_text.setdefault(text, got[doc_id].fingerprint) == got[doc_id].fingerprint


def test_fingerprints_of_repeated_and_missing_ids(spark):
    rows = odd_rows() + [row(17, words(900 + i, 20)) for i in range(60)] + [row(None, words(990 + i, 20)) for i in range(60)]
    got = fingerprints.fingerprinted(frame(spark, rows).repartition(5), buckets=12).collect()
    assert as_counts((r.doc_id, r.n_chars) for r in got) == as_counts((r[0], len(r[1] or "")) for r in rows)
    one = fingerprints.fingerprinted(frame(spark, [row(1, "a b c d e f")])).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert fingerprints.fingerprinted(frame(spark, [])).collect() == []
