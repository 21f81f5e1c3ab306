"""Results do not depend on the session's settings."""

import pytest

from topicloom.plans.catalog import catalog
from topicloom.session import saved

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog()
NAMES = ["event_day", "window_bounds", "user_repo_star", "network_topics", "topic_user_day_parts"]
SETTINGS = [
    {"spark.sql.session.timeZone": "America/Sao_Paulo"},
    {"spark.sql.session.timeZone": "Asia/Kolkata"},
    {"spark.sql.adaptive.enabled": "false"},
    {"spark.sql.ansi.enabled": "false"},
    {"spark.sql.shuffle.partitions": "3"},
    {"spark.sql.autoBroadcastJoinThreshold": "-1"},
]


def rows(spark, name):
    return sorted(map(repr, QUERIES[name](spark, SF_DIR).collect()))


@pytest.fixture(scope="module")
def usual(spark):
    return {name: rows(spark, name) for name in NAMES}


@pytest.mark.parametrize("settings", SETTINGS, ids=lambda s: "=".join(*s.items()))
def test_same_rows(spark, usual, settings):
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert {name: rows(spark, name) for name in NAMES} == usual
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_scratch_files_use_zstandard(spark):
    files = saved(spark.range(10), "numbers").inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_scratch_files_leave_no_shuffle_behind(spark):
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup)
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for f in held.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}

    old = files()
    counts = saved(spark.range(100_000).selectExpr("id % 1000 AS k").groupBy("k").count(), "counts")
    assert not files() - old
    assert counts.count() == 1000 and spark.conf.get(cleanup) == before
