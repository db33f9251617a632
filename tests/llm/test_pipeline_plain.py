"""The whole pipeline against plain Python, on documents with planted rows of every kind."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from cases import edited, words
from conftest import SMALL
from test_pipeline import FOREIGN
from test_pseudonyms_plain import plain as plain_pseudonyms
from test_text_dedup import plain_components, plain_hits

import corpus_pipeline
from envspark.llm.queries import KEY, vocabulary

PII = ["Write to jo.doe@mail.example.com or +49 30 123456789.", "Card 4111 1111 1111 1111, born 1984-02-29.",
       "Account DE89 3704 0044 0532 0130 00 and 192.168.0.1."]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Prose of four languages and, from id 10,000 on, planted rows."""
    docs = [r for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist() if r["text"] and r["n_chars"] > 400]
    items = pq.read_table(f"{SMALL}/benchmark.parquet").slice(0, 20)
    base = [r for r in docs if r["n_chars"] < 4000]
    draw, planted = random.Random(9), []

    def plant(text, lang="en"):
        planted.append({"doc_id": 10_000 + len(planted), "text": text, "lang": lang, "source": "src0",
                        "n_chars": None if text is None else len(text)})
        return planted[-1]["doc_id"]

    unknown = {plant(t, None) for t in [*FOREIGN.values(), "12 34 %%%", "", None, "\n \t"]}
    for r in base[:12]:
        plant(r["text"], r["lang"])
        plant(edited(r["text"], r["doc_id"], 1), r["lang"])
    passages = items["text"].to_pylist()
    for i, r in enumerate(base[12:20]):
        plant(f"{base[30 + i]['text'][:900]} {passages[i]} {r['text'][::-1][:40]}", r["lang"])
    for i, r in enumerate(base[20:32]):
        plant(" ".join([r["text"][:700], PII[i % 3], base[40 + i]["text"][-500:], words(i, 3)]), r["lang"])
    where = tmp_path_factory.mktemp("corpus")
    rows = docs + planted
    draw.shuffle(rows)
    schema = pq.read_schema(f"{SMALL}/documents.parquet").remove_metadata()
    pq.write_table(pa.Table.from_pylist(rows, schema=schema), where / "documents.parquet")
    pq.write_table(items, where / "benchmark.parquet")
    return str(where), rows, items.to_pylist(), unknown


def stages_in_plain(rows, items, unknown):
    """What is left after each of the four filtering stages, as {doc_id: text}."""
    kept = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] not in unknown}
    yield kept
    group = {r[0]: r[2] for r in plain_components([(d, t) for d, t in kept.items()], 5, 80)}
    kept = {d: t for d, t in kept.items() if group[d] == d}
    yield kept
    hit = {h[0] for h in plain_hits([(d, t) for d, t in kept.items()], [(i["item_id"], i["text"]) for i in items]) if h[5]}
    kept = {d: t for d, t in kept.items() if d not in hit}
    yield kept
    yield {d: plain_pseudonyms(t, KEY)[0] for d, t in kept.items()}


def test_stages_and_run_equal_plain_python(spark, folder):
    from tokenizers import Tokenizer

    where, rows, items, unknown = folder
    docs = spark.read.parquet(f"{where}/documents.parquet")
    before = len(rows)
    for (name, stage), wanted in zip(corpus_pipeline.STAGES, stages_in_plain(rows, items, unknown)):
        docs = spark.createDataFrame(stage(spark, docs, where).collect(), docs.schema)
        got = {r.doc_id: r.text for r in docs.collect()}
        assert got == wanted, name
        assert name == "pii" or len(got) < before  # every stage but this one had something to drop
        before = len(got)
    assert sum("@example.invalid" in t for t in got.values()) >= 4
    assert not any(p.split()[2] in t for t in got.values() for p in PII[:1])

    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    pieces = Counter()
    for doc_id, text in wanted.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        low, high, number = 0, len(ids) % 2048 or min(2048, len(ids)), 0
        while low < len(ids):
            pieces[doc_id, number, low, high - low, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[low:high]))] += 1
            low, high, number = high, high + 2048, number + 1
    packed = corpus_pipeline.run(spark, where).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == pieces
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        ends = [o + n for o, n in sorted(places)]
        assert [0, *ends[:-1]] == [o for o, _ in sorted(places)] and ends[-1] <= 2048
