"""What the plans of all registered queries have and lack."""

import io
from contextlib import redirect_stdout

import pytest

from topicloom.operators.clean import clean_events, user_repo
from topicloom.operators.topics import user_topic_counts
from topicloom.plans.catalog import catalog
from topicloom.sources.testdata import raw_events, star_activity, star_topics

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog()


def explained(df, formatted=False):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted" if formatted else "simple")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    plan = explained(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert operator not in plan


def test_scan_reads_only_needed_columns(spark):
    activity, repo_topics = star_activity(spark, SF_DIR), star_topics(spark, SF_DIR, "p_type")
    plan = explained(user_topic_counts(activity, repo_topics, count_first=True))
    schemas = {line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line}
    assert schemas == {
        "struct<l_orderkey:bigint,l_partkey:bigint>",
        "struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>",
        "struct<p_partkey:bigint,p_type:string>",
    }


def test_filters_and_columns_reach_the_scan_of_stored_events(spark, tmp_path):
    raw_events(spark, SF_DIR).write.parquet(f"{tmp_path}/raw")
    stored = spark.read.parquet(f"{tmp_path}/raw")
    plan = explained(user_repo(clean_events(stored)).select("usr", "day"), formatted=True)
    assert "In(type, [CommitCommentEvent,ForkEvent])" in plan
    for column in ("actor.login", "repo.name", "created_at"):
        assert f"IsNotNull({column})" in plan
    assert "ReadSchema: struct<type:string,actor:struct<login:string>,repo:struct<name:string>" in plan


def test_rows_are_counted_on_the_map_side(spark):
    plan = explained(QUERIES["user_topic_counts_star"](spark, SF_DIR))
    assert "partial_count(1)" in plan and "partial_sum" in plan


def test_hot_keys_share_the_shuffle_of_the_main_branch(spark):
    """Counted activity is shuffled once for the join and for finding hot repositories."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = explained(QUERIES["user_topic_counts_star"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "ReusedExchange" in plan
    assert sum("FileScan" in line and "l_partkey" in line for line in plan.splitlines()) == 1


@pytest.mark.parametrize("name", ["topic_user_day_star", "user_repo_day_star"])
def test_lists_are_built_from_written_ranges(spark, name):
    """Nothing below a list's last steps runs twice: they read the rows as dealt."""
    plan = explained(QUERIES[name](spark, SF_DIR))
    assert "l_partkey" not in plan and "chunk" in plan
