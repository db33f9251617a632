"""Token alignment against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
from cases import frame, odd_rows, row, words
from conftest import SMALL

from envspark.llm import alignment
from envspark.llm.common import stash
from envspark.llm.queries import queries, vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def byte_table() -> dict[str, int]:
    shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    table, extra = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def plain(texts):
    """Per text: (A ids, B ids, groups as text, list of linked id pairs)."""
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    table, out = byte_table(), []
    for text in texts:
        whole = (" " + text).encode() if text else b""
        ids_a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = second.encode(text) if text else []
        bytes_a = [bytes(table[c] for c in first.id_to_token(i)) for i in ids_a]
        names = [second.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(n[3:5], 16)]) if second.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(ids_b, names)]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            out.append(([], [], "", []))
            continue
        spans = []
        for ids, pieces in ((ids_a, bytes_a), (ids_b, bytes_b)):
            at, made = 0, []
            for i, p in zip(ids, pieces):
                made.append((at, at + len(p), i))
                at += len(p)
            spans.append(made)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= cut) for side in spans))
            low = cut
        links, j = [], 0
        for s, e, i in spans[0]:
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((i, spans[1][k][2]))
                k += 1
        out.append((ids_a, ids_b, ";".join(groups), links))
    return out


def expected(rows):
    found = plain([r[1] for r in rows])
    count = Counter(pair for *_, links in found for pair in set(links))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return Counter(
        (r[0], len(a), len(b), groups.count(";") + 1 if groups else 0, len(links),
         sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
         hashlib.sha256(groups.encode()).hexdigest() if groups else "", groups)
        for r, (a, b, groups, links) in zip(rows, found))


def check(spark, rows, parts):
    given = frame(spark, rows).repartition(parts) if parts else frame(spark, rows)
    got = alignment.weighed(stash(alignment.aligned(given, A, B))).collect()
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                    hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "", r.groups) for r in got) == expected(rows)


def test_alignment_of_odd_rows(spark):
    draw = random.Random(2)
    rows = odd_rows()
    rows[11] = row(12, words(2, 6000))
    rows += [row(600, "<s> a </s> <unk> <0x41> <|endoftext|> "), row(601, "a▁b"), row(602, "  two  blanks \n\n\t x "),
             row(603, "ｆｕｌｌ ﬁ é é"), row(604, " "), row(605, "▁"), row(606, "x" * 3000), row(607, "日本" * 200)]
    rows += [row(700 + i, "".join(draw.choice("ab é\n日<0x4>▁.,") for _ in range(draw.randrange(40)))) for i in range(300)]
    check(spark, rows, None)
    check(spark, rows, 5)
    check(spark, [], None)


def test_query_on_the_whole_table(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    got = queries()["op12_token_alignment"](spark, SMALL).collect()
    assert Counter(map(tuple, got)) == Counter({k[:8]: n for k, n in expected(rows).items()})


def test_long_texts_are_cut_without_a_trace():
    text = words(7, 100_000) + "  \n" + "no" * 1000 + " <s> " + words(8, 50)
    assert len(text) > 2 * alignment.pieces_of.__defaults__[0]
    coder = alignment.PieceEncoder(B)
    assert coder.by_word and coder.ids(text) == coder.model.encode(text)


def of_ends(end_a, end_b):
    at = [np.repeat(np.arange(len(e)), np.diff(e, prepend=0)) for e in (end_a, end_b)]
    return alignment.components(end_a, end_b, *at)


def test_pointers_reach_the_end_of_long_components():
    """Ends that never meet before the last one make a single chain."""
    n = 5000
    end_a, end_b = np.arange(1, n + 1) * 2, np.append(np.arange(n) * 2 + 1, 2 * n)
    assert set(of_ends(end_a, end_b)) == {n - 1}
    draw = np.random.default_rng(1)
    for _ in range(50):
        size = int(draw.integers(1, 200))
        a, b = (np.append(np.flatnonzero(draw.random(size - 1) < 0.5) + 1, size) for _ in range(2))
        cuts = np.intersect1d(a, b)
        assert np.array_equal(a[of_ends(a, b)], cuts[np.searchsorted(cuts, np.concatenate([a, b]))])


def test_many_blocks_give_the_same_counts(spark):
    rows = [row(i, words(i % 30, 20)) for i in range(120)]
    check(spark, rows, 40)
