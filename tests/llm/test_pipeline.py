"""The pipeline's stages: what they keep and what their decisions change."""

from __future__ import annotations

import random

import pytest
from cases import frame, odd_rows
from conftest import SMALL

import corpus_pipeline
from envspark.llm import decontaminate, language


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "pii", "packing"]


def test_run_packs_what_the_stages_keep(spark, documents):
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == documents.columns
        assert kept.join(docs, "doc_id", "left_anti").count() == 0
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    packed = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.collect()}
    assert decontaminate.hits(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).filter("contaminated").count() == 0


def test_stages_take_odd_rows_and_nothing(spark):
    for rows in (odd_rows(), []):
        docs = frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, SMALL)
            assert kept.columns == docs.columns
            docs = spark.createDataFrame(kept.collect(), docs.schema)
        corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()


def test_language_stage_rejects_texts_without_letters(spark, documents):
    docs = documents.unionByName(spark.createDataFrame([(10 ** 6, "12 34 %%%", None, None, 9), (10 ** 6 + 1, None, None, None, None)],
                                                       documents.schema))
    kept = corpus_pipeline.keep_known_languages(spark, docs, SMALL)
    assert kept.filter("doc_id >= 1000000").count() == 0 and kept.count() >= 0.99 * documents.count()
    assert language.UNKNOWN == "und"


FOREIGN = {
    "ja": "日本語の文章はこのように書かれています。今日は天気がとても良いので、公園を散歩しました。明日は雨が降るそうです。",
    "ru": "Сегодня утром мы пошли в парк и долго гуляли вдоль реки. Погода была хорошая, и дети играли на траве до вечера.",
    "pl": "Dzisiaj rano poszliśmy do parku i długo spacerowaliśmy wzdłuż rzeki. Pogoda była dobra, a dzieci bawiły się na trawie.",
    "fi": "Tänä aamuna menimme puistoon ja kävelimme pitkään joen rantaa. Sää oli hyvä ja lapset leikkivät nurmikolla iltaan asti.",
}


def test_language_stage_drops_what_no_language_claims(spark, documents):
    draw = random.Random(3)
    gibberish = [" ".join("".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 9))) for _ in range(n))
                 for n in (20, 200, 1500)]
    prose = {r.lang: r.text for r in documents.orderBy("n_chars").collect() if 1000 < r.n_chars < 3000}
    first, second = [prose[lang][:600] for lang in ("en", "de")]
    foreign = [*FOREIGN.values(), *[" ".join([t] * 40) for t in FOREIGN.values()], *gibberish, " ".join([first, *[FOREIGN["ja"]] * 40])]
    known = [first, second, f"{first} {second}", " ".join([first, second] * 5), first[:90], f"{first} {FOREIGN['ja']}"]
    # null labels: nothing is learned from them
    planted = [(10 ** 6 + i, t, None, None, len(t)) for i, t in enumerate(foreign + known)]
    kept = corpus_pipeline.keep_known_languages(spark, documents.unionByName(spark.createDataFrame(planted, documents.schema)), SMALL)
    found = {r.doc_id for r in kept.select("doc_id").collect()}
    assert {i for i in found if i >= 10 ** 6} == {10 ** 6 + len(foreign) + i for i in range(len(known))}
    assert len({i for i in found if i < 10 ** 6}) >= 0.99 * documents.count()
