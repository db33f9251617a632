"""Source mixing and the filter audit against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from cases import frame, odd_rows, row, split_words, words

from envspark.llm import filter_audit, mixing


def plain_targets(sizes: dict, weights=(3.0, 1.0, 2.0), share=1.5, limit=2):
    """Deal by weight, cut off, deal what was cut off to the others, until nothing is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = {s: share * sum(sizes.values()) * weight[s] / sum(weight.values()) for s in names}
    ended = set()
    while True:
        new = {s for s in names if s not in ended and target[s] > limit * sizes[s]}
        if not new:
            return target
        excess = sum(target[s] - limit * sizes[s] for s in new)
        target.update({s: limit * sizes[s] for s in new})
        ended |= new
        rest = [s for s in names if s not in ended]
        for s in rest:
            target[s] += excess * weight[s] / sum(weight[x] for x in rest)


def check_mix(spark, rows):
    got, (size, source_size, target, copies) = mixing.mixed(frame(spark, rows))
    assert set(frame(spark, []).columns) <= set(got.columns)
    got = got.collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(split_words(r[1]))
    wanted = plain_targets(sizes)
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter((r[0], r[1], r[3]) for r in rows)
    for r in got:
        assert r[size] == len(split_words(r.text)) and r[source_size] == sizes[r.source]
        assert r[target] == pytest.approx(wanted[r.source], rel=1e-9)
        rate = wanted[r.source] / sizes[r.source] if sizes[r.source] else 0
        inner = "null" if r.text is None else hashlib.md5(r.text.encode()).hexdigest()
        outer = hashlib.md5(f"42:{'null' if r.doc_id is None else r.doc_id}:{inner}".encode()).hexdigest()
        chance = int(outer[:13], 16) / 16 ** 13
        if abs(rate % 1 - chance) > 1e-9 and min(rate % 1, 1 - rate % 1) > 1e-9:
            assert r[copies] == int(rate) + (chance < rate % 1)
        assert 0 <= r[copies] <= 2
    return got, copies, wanted


def test_mix_of_odd_rows(spark):
    rows = odd_rows() + [row(300 + i, words(i, 30), "en", s) for i, s in enumerate(["", "é", "Z", None, "z", "日本", None, "empty"])]
    rows += [row(400, "", "en", "no words"), row(401, None, "en", "no words")]
    got, copies, _ = check_mix(spark, rows)
    out = mixing.emitted(frame(spark, rows))
    assert out.columns == frame(spark, []).columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == sum(
        (Counter({(r.doc_id, r.text): r[copies]}) for r in got), Counter())
    moved = mixing.mixed(frame(spark, rows).repartition(5))[0].collect()
    assert Counter(map(tuple, moved)) == Counter(map(tuple, got))
    assert mixing.emitted(frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        mixing.mixed(frame(spark, []), limit=1.5)


def test_mix_comes_near_its_targets(spark):
    draw = random.Random(3)
    rows = [row(i, words(i, draw.randrange(1, 60)), "en", f"s{min(i % 15, 6) if i % 3 else 0}") for i in range(3000)]
    got, copies, wanted = check_mix(spark, rows)
    taken = Counter()
    for r in got:
        taken[r.source] += r[copies] * len(split_words(r.text))
    for source, target in wanted.items():
        assert taken[source] == pytest.approx(target, rel=0.1)
    assert sum(taken.values()) == pytest.approx(1.5 * sum(len(split_words(r[1])) for r in rows), rel=0.03)


def plain_audit(rows, labels):
    texts = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            texts[r[1] or ""].append(r[0])
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    judged = []
    for r in rows:
        text, parts = r[1] or "", split_words(r[1])
        fails = {"A": len(parts) < 100, "B": 100 * len(set(parts)) < 80 * len(parts),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": r[0] is not None and any(d < r[0] for d in texts[text])}
        judged.append((r[2] or "", "".join(f for f in "ABCDE" if fails[f]),
                       r[0] is not None and r[0] in good, r[0] is not None and r[0] in toxic))
    out, shapley = {}, Counter()
    for part in {j[0] for j in judged}:
        own = Counter((f, g, t) for p, f, g, t in judged if p == part)
        for order in map("".join, permutations("ABCDE")):
            left = dict(own)
            for step, name in enumerate(order, 1):
                gone = {k: n for k, n in left.items() if name in k[0]}
                left = {k: n for k, n in left.items() if name not in k[0]}
                removed = sum(gone.values())
                shapley[part, name] += removed
                out[part, order, step] = [
                    sum(left.values()), removed, sum(n for k, n in own.items() if name in k[0]) - removed,
                    sum(n for k, n in own.items() if k[0] == name), sum(n for k, n in gone.items() if k[1]),
                    sum(n for k, n in gone.items() if k[2])]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


LABELS = "doc_id long, quality int, toxic int, n long, text string"


def check_audit(spark, rows, labels):
    given = spark.createDataFrame([(*x, 5, "y") for x in labels], LABELS)
    got = filter_audit.audited(frame(spark, rows), given).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got}
    assert len(found) == len(got)
    assert found == plain_audit(rows, labels)


def test_audit_of_odd_rows(spark):
    fine = " ".join(f"word{i}" for i in range(120))
    rows = odd_rows() + [row(500, fine), row(501, fine), row(502, fine + " $"), row(503, fine + " X" * 100, "fr"),
                         row(504, None, "de"), row(505, "", "de"), row(505, "", "de"), row(506, fine, ""), row(507, fine, None),
                         row(None, fine, "es"), row(508, fine.upper() + " |", "es"), row(509, "a b " * 60 + "#", "es")]
    labels = [(500, 1, 0), (501, 1, 1), (502, 0, 1), (502, 1, None), (503, None, None), (None, 1, 1), (506, 1, 0), (509, 1, 1),
              (17, 1, 1), (9, 1, 0), (77777, 1, 1)]
    check_audit(spark, rows, labels)
    check_audit(spark, rows[:9], [])
    check_audit(spark, [], labels)


def test_audit_of_many_copies(spark):
    """A third of all rows is one text, some with equal ids, besides pairs of copies."""
    draw = random.Random(5)
    rows = [row(draw.randrange(2000), "copied text " * 70, draw.choice(["en", "fr"])) for _ in range(400)]
    rows += [row(5000 + i, words(i // 2, 110)) for i in range(600)] + [row(None, None) for _ in range(200)]
    check_audit(spark, rows, [(r[0], draw.randrange(2), draw.randrange(2)) for r in rows[::3]])
