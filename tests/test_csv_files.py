"""CSV files with bad rows and reordered headers."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from envspark.profiles import MEASURES
from envspark.sources import csv_files

NAMES = ["datetime", *MEASURES]


def line(time="2024-01-01 05:00:00", **values):
    return {"datetime": time, **{m: "1.5" for m in MEASURES}, **values}


def write(folder, name, names, rows):
    text = [",".join(names)] + [r if isinstance(r, str) else ",".join(str(r.get(n, "")) for n in names) for r in rows]
    (folder / name).write_text("\n".join(text) + "\n")


@pytest.fixture
def folder(tmp_path):
    where = tmp_path / "in"
    where.mkdir()
    write(where, "a.csv", NAMES, [line(), line(pm25="abc"), line(time="yesterday"), "bad,1", line(co=""), line() | {"rain": "1,2"}])
    write(where, "b.csv", NAMES[::-1], [line(pm25="7"), line(o3="x"), line(time="")])
    write(where, "c.csv", ["reading_id", "station", *NAMES],
          [line(reading_id="12", station='"two, words"'), line(reading_id="1.5", station="s"), line(reading_id="", station="s")])
    write(where, "empty.csv", NAMES, [])
    return str(where)


def test_every_row_is_accepted_or_rejected(spark, folder, tmp_path):
    for accepted, rejected in (csv_files.split(csv_files.routed(spark, folder)),
                               csv_files.ingest(spark, folder, str(tmp_path / "out"))):
        assert accepted.count() + rejected.count() == 12
        rows = rejected.collect()
        reasons = sorted((r.file.rsplit("/", 1)[-1], r.reason) for r in rows)
        assert reasons == [("a.csv", "12 fields instead of 11"), ("a.csv", "2 fields instead of 11"),
                           ("a.csv", "datetime is no timestamp"), ("a.csv", "pm25 is no double"),
                           ("b.csv", "o3 is no double"), ("c.csv", "reading_id is no bigint")]
        by_reason = {r.reason: r for r in rows}
        assert by_reason["pm25 is no double"].record.split(",")[1] == "abc"
        assert by_reason["pm25 is no double"].fields["pm25"] == "abc" and by_reason["o3 is no double"].fields["o3"] == "x"
        assert by_reason["datetime is no timestamp"].fields["datetime"] == "yesterday"
        good = accepted.collect()
        assert sorted(r.pm25 for r in good) == [1.5] * 5 + [7.0]
        assert {r.station for r in good} == {None, "two, words", "s"} and sum(r.datetime is None for r in good) == 1
        assert sum(r.co is None for r in good) == 1
        # a column that nobody asks for is checked as well
        assert accepted.select("datetime").count() == 6 and accepted.agg(F.count("rh").alias("n")).first().n == 6
    assert dict(accepted.dtypes)["pm25"] == "double" and dict(accepted.dtypes)["datetime"] == "timestamp_ntz"


def test_ids_do_not_depend_on_the_order_of_columns(spark, tmp_path):
    for name, names in (("x", NAMES), ("y", NAMES[::-1])):
        (tmp_path / name).mkdir()
        write(tmp_path / name, "f.csv", names, [line(), line(pm25="3")])
    one, two = (csv_files.split(csv_files.routed(spark, str(tmp_path / n)))[0] for n in "xy")
    assert sorted(r.reading_id for r in one.collect()) == sorted(r.reading_id for r in two.collect())


def test_no_files_and_too_many_headers(spark, tmp_path, monkeypatch):
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "blank.csv").write_text("")
    with pytest.raises(ValueError):
        csv_files.routed(spark, str(tmp_path / "none"))
    (tmp_path / "two").mkdir()
    for i in range(2):
        write(tmp_path / "two", f"{i}.csv", [f"c{i}", *NAMES], [])
    monkeypatch.setattr(csv_files, "MAX_HEADERS", 1)
    with pytest.raises(ValueError):
        csv_files.routed(spark, str(tmp_path / "two"))


def test_features_of_text_parse_each_line_once(spark, tmp_path):
    import __spark_entry__ as entry

    rows = [(i, datetime(2024, 1, 1 + i % 20, i % 24, 5, i % 60), "view, or\"not", i * 0.37) for i in range(400)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, value double").write.parquet(
        str(tmp_path / "events.parquet"))
    found = entry.csv_features(spark, str(tmp_path))
    assert "from_csv" not in found._jdf.queryExecution().optimizedPlan().toString()
    plain = entry.queries()["features_full"](spark, str(tmp_path))
    in_order = [[tuple(r) for r in df.select(*sorted(df.columns)).orderBy("reading_id").collect()] for df in (found, plain)]
    assert in_order[0] == in_order[1] and len(in_order[0]) > 300
