"""Substring dedup, near-dedup and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import combinations

import pytest
from cases import as_counts, edited, frame, odd_rows, row, split_words, words
from compare import connect, differences
from conftest import SMALL

from envspark.llm import decontaminate, near_dedup, substring_dedup
from envspark.llm.oracle import ORACLE
from envspark.llm.queries import queries


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(queries()[name](spark, SMALL), connect(SMALL), ORACLE[name]) == []


def plain_kept(rows, window=20):
    seen, out = {}, []
    key = lambda d: -2 ** 63 if d is None else d
    for r in rows:
        parts = split_words(r[1])
        for s in range(len(parts) - window + 1):
            w, at = tuple(parts[s:s + window]), (key(r[0]), s)
            seen[w] = min(seen.get(w, at), at)
    for r in rows:
        parts = split_words(r[1])
        gone = set()
        for s in range(len(parts) - window + 1):
            if seen[tuple(parts[s:s + window])] < (key(r[0]), s):
                gone.update(range(s, s + window))
        out.append((r[0], len(parts), len(gone), " ".join(p for i, p in enumerate(parts) if i not in gone)))
    return out


def test_substrings(spark):
    passage = words(100, 60)
    rows = odd_rows() + [row(100 + i, f"{words(200 + i, 15 + i)} {passage} {words(300 + i, 9)}") for i in range(30)]
    rows += [row(200, " ".join(passage.split()[:25] + words(9, 3).split() + passage.split()[20:45]))]
    for parts in (1, 7):
        got = substring_dedup.deduplicated(frame(spark, rows).repartition(parts)).collect()
        assert as_counts((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == as_counts(plain_kept(rows))
        for r in got:
            assert sum(b - a for a, b in zip(r.removed_spans[::2], r.removed_spans[1::2])) == r.n_removed


def test_substrings_of_nothing(spark):
    assert substring_dedup.deduplicated(frame(spark, [])).collect() == []


def plain_components(rows, size, percent):
    sets = []
    for r in rows:
        parts = split_words(re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        sets.append(frozenset(tuple(parts[i:i + size]) for i in range(max(1, len(parts) - size + 1))) if parts else frozenset())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            root[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        first = (min(ids) if ids else None) if sets[i] else r[0]
        out.append((r[0], len(sets[i]), first, r[0] == first))
    return out


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, size, percent):
    rows = odd_rows()
    for g in range(6):
        base = words(1000 + g, 80)
        rows += [row(1000 + 50 * g + i, edited(base, 50 * g + i, i % 5)) for i in range(40)]
    got = near_dedup.components(frame(spark, rows), shingle=size, threshold_percent=percent).collect()
    assert as_counts((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == as_counts(
        plain_components(rows, size, percent))


def test_sets_that_share_a_node_id_are_told_apart(spark):
    """With ids of three bits nearly all sets share one."""
    rows = odd_rows() + [row(1000 + i, edited(words(1000 + i // 4, 60), i, i % 4)) for i in range(60)]
    got = near_dedup.components(frame(spark, rows), shingle=3, threshold_percent=85, node_bits=3).collect()
    assert as_counts((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == as_counts(plain_components(rows, 3, 85))


def test_near_duplicates_keep_one_row_of_a_group(spark):
    docs = frame(spark, odd_rows())
    kept = near_dedup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect())
    assert sum(i == (True, 17) for i in ids) == 2  # two texts under one id, one of them twice
    assert (True, 1) in ids and (True, 2) not in ids and (True, 4) not in ids and (True, 5) in ids
    assert near_dedup.without_near_duplicates(frame(spark, [])).collect() == []


def test_bands_and_pruning_keep_their_promises():
    for t in (0.8, 0.85):
        bands = near_dedup.bands_for(t)
        assert (1 - t ** near_dedup.ROWS) ** bands <= near_dedup.MISS
        steps = near_dedup.least_matches(t, bands * near_dedup.ROWS)
        assert steps[-1][0] == bands * near_dedup.ROWS and all(m <= n * t for n, m in steps)


def item_rows():
    long = words(2, 30_000).split()
    return [(1, " ".join(long[510:540])), (2, "one"), (3, None), (4, ""), (None, words(4, 60)), (5, "two, WORDS!"),
            (5, words(7, 30)), (6, "ünïcödé été"), (10, words(4000, 12))]


def plain_hits(rows, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                               re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    owners = {}
    for item, text in items:
        w = cut(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            owners.setdefault(n, {}).setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for r in rows:
        parts, hit, found = cut(r[1]), set(), set()
        for n, known in owners.items():
            for s in range(len(parts) - n + 1):
                of = known.get(tuple(parts[s:s + n]))
                if of:
                    hit.update(range(s, s + n))
                    found |= of
        names = sorted(str(f) for f in found if f is not None)
        out.append((r[0], len(parts), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block_words", [1_000_000, 8])
def test_decontamination(spark, block_words):
    rows = odd_rows() + [row(300, "x " + words(4000, 12) + " y"), row(301, words(4000, 9))]
    items = spark.createDataFrame(item_rows(), "item_id long, text string")
    got = decontaminate.hits(frame(spark, rows), items, block_words=block_words).drop("items", "spans").collect()
    assert as_counts(got) == as_counts(plain_hits(rows, item_rows()))


def test_search_of_repeated_and_overlapping_windows(spark):
    """Few different words, so that windows repeat within and between items and share their last blocks."""
    draw = random.Random(6)
    text = lambda n: " ".join(draw.choice("abc") for _ in range(n))
    items = [(i, text(draw.randrange(1, 40))) for i in range(40)] + [(40, "a b c " * 30), (41, "a b c " * 30)]
    rows = [row(i, text(draw.randrange(0, 300))) for i in range(60)] + [row(70, "a b c " * 50)]
    for window in (1, 2, 3, 10):
        given = spark.createDataFrame(items, "item_id long, text string")
        got = decontaminate.hits(frame(spark, rows), given, window=window).drop("items", "spans").collect()
        assert as_counts(got) == as_counts(plain_hits(rows, items, window))


def test_tables_of_many_items_stay_small():
    """5 MB of items within a worker's share of memory, measured in a process of its own."""
    import subprocess
    import sys

    code = """
import random, resource
from envspark.llm import decontaminate
draw = random.Random(1)
items = [" ".join(f"w{draw.randrange(60000)}" for _ in range(100)).encode() for _ in range(7500)]
assert sum(map(len, items)) > 4_900_000 and 100 * len(items) < decontaminate.BLOCK_TOKENS
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
decontaminate.Search(items)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    grown = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert grown < 600, grown


def test_a_search_is_built_once_per_process():
    built = []
    for _ in range(3):
        decontaminate.search_of("one block", lambda: built.append(1) or [("a", b"x y")], 10)
    assert built == [1]


def test_decontamination_keeps_columns_and_clean_documents(spark):
    docs = frame(spark, odd_rows())
    items = spark.createDataFrame(item_rows(), "item_id long, text string")
    kept = decontaminate.without_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r, h in zip(odd_rows(), plain_hits(odd_rows(), item_rows())) if not h[5]}
    assert decontaminate.without_contaminated(docs, items.limit(0)).count() == docs.count()
    assert decontaminate.hits(docs.limit(0), items).collect() == []
