"""Tables written on the way: where they go and when they go away."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from envspark.sources import storage


def test_tables_are_read_back_from_the_shared_folder(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) AS `a.b`")
    again = storage.written(df)
    assert sorted(again.collect()) == sorted(df.collect()) and again.dtypes == df.dtypes
    assert storage.shared_folder(spark) == spark.conf.get(storage.SHARED)
    assert all(storage.shared_folder(spark) in f for f in again.inputFiles())


def test_a_cluster_has_to_name_its_folder(spark, monkeypatch):
    class Conf:
        @staticmethod
        def get(name, default=None):
            return default

    class Session:
        conf = Conf

        class sparkContext:
            master = "spark://somewhere"

    with pytest.raises(ValueError, match="share"):
        storage.shared_folder(Session)


def test_tables_go_with_the_application(tmp_path):
    code = """
import sys
from pyspark.sql import SparkSession
from envspark.sources import storage
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
assert storage.written(spark.range(5)).count() == 5
import os
assert len([f for f in os.listdir(sys.argv[1]) if f.startswith("table-")]) == 1
spark.stop()
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path)], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [f for f in os.listdir(tmp_path) if f.startswith("table-")] == []
