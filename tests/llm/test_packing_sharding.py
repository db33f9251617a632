"""Packing and sharding: every token once, sequences full, shards as small as can be."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

from cases import frame, odd_rows, row, words

from envspark.llm import packing, sharding
from envspark.llm.queries import vocabulary


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    rows = odd_rows() + [row(400, "<|endoftext|> it's  two   spaces\n\n 12ab's\t"), row(401, "x²½ ªº ×÷ naïve")]
    path = vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    got = packing.packed(frame(spark, rows), path).collect()
    wanted = Counter()
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        low, high, number = 0, len(ids) % 2048 or min(2048, len(ids)), 0
        while low < len(ids):
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[low:high]))
            wanted[r[0], number, low, high - low, crc] += 1
            low, high, number = high, high + 2048, number + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == wanted
    assert_gapless(got)
    assert packing.packed(frame(spark, []), path).collect() == []


def assert_gapless(rows):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE


def one_by_one(lengths, size):
    """Best fit, longest first, item by item."""
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= length
        else:
            room.append(size - length)
    return len(room)


def test_plan_equals_best_fit_of_single_items():
    for seed in range(30):
        draw = random.Random(seed)
        lengths = [draw.randint(1, 64) for _ in range(draw.randint(1, 300))]
        runs = packing.plan(Counter(lengths), 64)
        used = defaultdict(list)
        ranks = defaultdict(list)
        for length, first, count, sequence, offset in runs:
            for i in range(count):
                used[sequence + i].append((offset, length))
                ranks[length].append(first + i)
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in Counter(lengths).items()}
        for places in used.values():
            ends = [o + n for o, n in sorted(places)]
            assert [0, *ends[:-1]] == [o for o, _ in sorted(places)] and ends[-1] <= 64
        assert len(used) == one_by_one(lengths, 64)


def best_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, parts, filled = (low + high) // 2, 1, 0
        for s in sizes:
            if filled + s > middle:
                parts, filled = parts + 1, 0
            filled += s
        low, high = (low, middle) if parts <= shards else (middle + 1, high)
    return low


def check_shards(got, rows):
    groups, slots, sizes = {}, defaultdict(list), Counter()
    for r in got:
        groups.setdefault(r.text_crc32, set()).add(r.shard)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    return sizes


def test_sharding_is_minimax(spark):
    import hashlib

    rows = [row(i, words(i % 150, 5 + i % 40)) for i in range(200)]
    got = sharding.sharded(frame(spark, rows)).collect()
    sizes = check_shards(got, rows)
    groups = Counter()
    for r in rows:
        groups[hashlib.md5(r[1].encode()).hexdigest()] += len(r[1].encode()) + 1
    assert max(sizes.values()) == best_capacity([groups[g] for g in sorted(groups)], 8)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_sharding_of_odd_rows_and_hot_groups(spark):
    rows = odd_rows() + [row(500 + i, "copies " * 3000) for i in range(20)] + [row(600 + i, words(i, 2000)) for i in range(40)]
    got = sharding.sharded(frame(spark, rows)).collect()
    sizes = check_shards(got, rows)
    hot = 20 * (7 * 3000 + 1)
    assert max(sizes.values()) == hot and len(sizes) == 8
    rest = sum(sizes.values()) - hot
    assert all(s <= rest / 7 + 30_000 * 6 for s in sizes.values() if s != hot)
    few = [row(1, "a"), row(2, None)]
    check_shards(sharding.sharded(frame(spark, few)).collect(), few)
    assert sharding.sharded(frame(spark, [])).collect() == []


def test_fast_ids_equal_those_of_tokenizers(spark):
    """Every text of the test table, and texts that end pieces, runs without blanks and special tokens."""
    import pyarrow.parquet as pq
    from conftest import SMALL
    from tokenizers import Tokenizer

    from envspark.llm import byte_bpe

    path = vocabulary("byte_bpe_50k.json")
    draw = random.Random(1)
    alphabet = "abc \n\t.,'1é²ªµ×日😀  \x1c\x85"
    texts = [t or "" for t in pq.read_table(f"{SMALL}/documents.parquet")["text"].to_pylist()]
    texts += ["".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(2000)]
    texts += ["a" * 50_000, " " * 50_000, words(1, 2000), "it's we'LL 'd <|endoftext|> x", "don't  \n\n stop "]
    for plain in (False, True):
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = plain
        wanted = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        coder = byte_bpe.Encoder(path, plain)
        assert coder.fast is not None
        assert [coder.ids(t) for t in texts] == wanted
        for text, ids in zip(texts, wanted):
            assert [i for p in byte_bpe.pieces_of(text, 20) for i in coder.ids(p)] == ids or "<|endoftext|>" in text
            assert "".join(byte_bpe.pieces_of(text, 20)) == text
            assert b"".join(map(coder.bytes_of.__getitem__, ids)) == text.encode()
