"""Readers, writers, the daily job."""

import glob
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from topicloom.operators import topics
from topicloom.operators.clean import clean_events, flat_events, user_repo
from topicloom.operators.lists import unnest
from topicloom.plans import lookup
from topicloom.plans.daily import run_days
from topicloom.session import scratch_path, scratch_scope
from topicloom.sources import events as event_source
from topicloom.sources.events import judged_lines, read_events, staged_lines, stored_events
from topicloom.sources.tables import (
    bucket_of,
    compact,
    day_log,
    of_keys,
    publish_days,
    publish_latest,
    read_days,
    read_latest,
    read_runs,
    remove_merged,
    remove_replaced,
    table_or_none,
)
from topicloom.sources.testdata import raw_events

SF_DIR = "/root/testdata/sf0.001"
DAYS = [date(2018, 1, d) for d in range(1, 5)]


def rows(df):
    return sorted(tuple(r) for r in df.drop("bucket").collect())


def day_table(spark, *values):
    return spark.createDataFrame(values, "usr string, value string, day date")


def test_scratch_path_uses_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_table_or_none(spark, tmp_path):
    assert table_or_none(spark, str(tmp_path / "nothing")) is None


def test_publishing_replaces_whole_days_and_no_others(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_days(day_table(spark, ("a", "1", DAYS[0]), ("a", "1", DAYS[1]), ("b", "1", DAYS[1])), path, "usr")
    second = day_table(spark, ("a", "2", DAYS[1]), ("c", "2", DAYS[2]))
    expected = [("a", "1", DAYS[0]), ("a", "2", DAYS[1]), ("c", "2", DAYS[2])]
    for _ in range(2):
        publish_days(second, path, "usr")
        assert rows(read_days(spark, path)) == expected


def test_publishing_part_of_a_day_keeps_other_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    first = day_table(spark, ("a", "1", DAYS[0]), ("a", "1", DAYS[1]), ("b", "1", DAYS[1]))
    publish_days(first, path, "usr", whole_days=False)
    second = day_table(spark, ("a", "2", DAYS[1]), ("c", "2", DAYS[2]))
    for _ in range(2):
        publish_days(second, path, "usr", whole_days=False)
        assert rows(read_days(spark, path)) == [
            ("a", "1", DAYS[0]), ("a", "2", DAYS[1]), ("b", "1", DAYS[1]), ("c", "2", DAYS[2])
        ]


def test_hot_day_is_written_by_many_tasks(spark, tmp_path):
    usr = F.concat(F.lit("u"), F.col("id").cast("string"))
    day = F.when(F.col("id") % 3 == 0, F.lit(DAYS[0])).otherwise(F.date_add(F.lit(DAYS[0]), (F.col("id") % 40).cast("int")))
    table = spark.range(0, 300_000, 1, 8).select(usr.alias("usr"), F.md5(usr).alias("value"), day.alias("day"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        publish_days(table, str(tmp_path / "t"), "usr")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{tmp_path}/t/batch=*/day={DAYS[0]}/bucket=*/*.parquet")) > 4
    assert read_days(spark, str(tmp_path / "t")).count() == 300_000


def test_newest_run_wins_per_user(spark, tmp_path):
    path = str(tmp_path / "t")

    def lists(*values):
        return spark.createDataFrame(values, "usr string, part long, follows string")

    publish_latest(lists(("a", 0, "x"), ("b", 0, "x"), ("b", 1, "y")), path, "usr", 1)
    for _ in range(2):
        publish_latest(lists(("b", 0, "z"), ("c", 0, "z")), path, "usr", 2)
        assert rows(read_latest(spark, path)) == [("a", 0, "x"), ("b", 0, "z"), ("c", 0, "z")]
    publish_latest(lists(("a", 0, "w")), path, "usr", 3)
    assert rows(read_latest(spark, path)) == [("a", 0, "w"), ("b", 0, "z"), ("c", 0, "z")]


def test_read_events_with_archive_ids(spark, tmp_path):
    (tmp_path / "2018").mkdir()
    lines = [
        '{"id":"7044401123","type":"ForkEvent","actor":{"id":1,"login":"a"},"repo":{"id":2,"name":"r"},'
        '"payload":{"x":[1,2]},"created_at":"2018-01-01T00:00:00Z"}',
        '{"id":"7044401124","type":"PushEvent","actor":null,"created_at":"2018-01-01 00:00:01 UTC"}',
    ]
    for i, line in enumerate(lines):
        (tmp_path / "2018" / f"2018-01-0{i + 1}.json").write_text(line + "\n")
    events = read_events(spark, f"{tmp_path}/2018/2018-01-01*", f"{tmp_path}/2018/2018-01-02*", id_field="id")
    assert rows(flat_events(events).na.fill("-")) == [
        (7044401123, "ForkEvent", "a", "r", "2018-01-01T00:00:00Z"),
        (7044401124, "PushEvent", "-", "-", "2018-01-01 00:00:01 UTC"),
    ]


def test_events_without_ids_get_one(spark, tmp_path):
    lines = [f'{{"type":"ForkEvent","actor":{{"login":"{u}"}},"created_at":"2018-01-01"}}' for u in "aab"]
    (tmp_path / "e.json").write_text("\n".join(lines))
    ids = [r.event_id for r in read_events(spark, str(tmp_path / "e.json")).collect()]
    assert None not in ids and ids[0] == ids[1] != ids[2]


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("daily")
    raw = raw_events(spark, SF_DIR)
    raw.repartition(3).write.json(f"{base}/events", compression="gzip")
    first, last = date(2024, 1, 1), date(2024, 1, 20)
    for run in (1, 1):
        run_days(spark, [f"{base}/events/*.json.gz"], f"{base}/out", first, last, run, buckets=4)
    run_days(spark, [f"{base}/events/*.json.gz"], f"{base}/out", last, date(2024, 1, 31), 2)
    return raw, f"{base}/out"


def test_daily_job_covers_all_days(spark, daily):
    raw, out = daily
    activity = user_repo(clean_events(raw))
    landed = read_days(spark, f"{out}/activity").select("event_id", "usr", "repo", "day")
    assert rows(landed) == rows(activity)
    expected = rows(topics.user_topic_counts(activity, topics.repo_topic(activity)).select("usr", "day", "topic", "n"))
    by_user = unnest(read_days(spark, f"{out}/usertopic"), "topics", "topic")
    assert rows(by_user.select("usr", "day", "topic", "n")) == expected
    by_topic = unnest(read_days(spark, f"{out}/topicuser"), "users", "usr")
    assert rows(by_topic.select("usr", "day", "topic", "n")) == expected


def test_daily_job_publishes_follows(spark, daily):
    raw, out = daily
    late = user_repo(clean_events(raw)).where("day >= DATE '2024-01-20'")
    per_user = {r.usr: r.n for r in late.groupBy("usr").agg((F.count("*") * 5).alias("n")).collect()}
    lists = read_latest(spark, f"{out}/useruser")
    published = {r.usr: r.n for r in lists.groupBy("usr").agg(F.sum("n").alias("n")).collect()}
    assert set(published) == {r.usr for r in user_repo(clean_events(raw)).select("usr").distinct().collect()}
    assert all(published[usr] == n for usr, n in per_user.items())


def test_lookups_over_published_tables(spark, daily):
    _, out = daily
    window = ("Tue Jan 02 2024", "Sat Jan 20 2024")
    edges = unnest(read_latest(spark, f"{out}/useruser"), "follows", "follow")
    followed = {r.follow for r in edges.where("usr = 'u8'").collect()}
    counts = read_days(spark, f"{out}/counts").where("day > '2024-01-02' AND day < '2024-01-20'").collect()
    found = lookup.topics_of_network(spark, out, "u8", *window).collect()
    assert {r.topic for r in found} == {r.topic for r in counts if r.usr in followed}
    assert len(found) == len({r.topic for r in found}) > 0
    topic = Counter(r.topic for r in counts).most_common(1)[0][0]
    for user, allowed in ((None, None), ("u8", followed)):
        first = {}
        for r in counts:
            if r.topic == topic and (allowed is None or r.usr in allowed):
                first[r.usr] = min(r.day, first.get(r.usr, r.day))
        expected = sorted(first, key=lambda usr: (first[usr], usr))[:5]
        rows_found = lookup.users_of_topic(spark, out, topic, *window, user=user).collect()
        assert [r.usr for r in rows_found] == expected
        assert [r.link for r in rows_found] == [f"https://github.com/{usr}" for usr in expected]


def test_request_date(spark):
    assert lookup.request_day(spark, "Mon Jan 01 2018") == DAYS[0]
    with pytest.raises(ValueError):
        lookup.request_day(spark, "2024-01-02")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_of_a_key_reads_its_days_and_bucket(spark, daily):
    _, out = daily
    found = lookup.topic_rows(spark, out, "Perl 6", date(2024, 1, 2), date(2024, 1, 5))
    plan = plan_of(found)
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(topic,Perl 6)" in plan
    files = {f.rsplit("/", 2)[0].rsplit("day=")[1] for f in found.inputFiles()}
    assert files == {"2024-01-03", "2024-01-04"}


def test_lookup_of_a_network_reads_its_buckets_only(spark, daily):
    """The buckets to read are found at run time from the follow list."""
    _, out = daily
    found = lookup.network_rows(spark, out, "u8", date(2024, 1, 2), date(2024, 1, 20))
    scan = [line for line in plan_of(found).splitlines() if "usertopic" in line]
    assert len(scan) == 1 and "dynamicpruning" in scan[0] and "bucket" in scan[0]
    lists = read_days(spark, f"{out}/usertopic")
    one = of_keys(lists, spark.createDataFrame([("u8",)], "usr string"), "usr", 4)
    one.collect()
    metrics = one._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in metrics
    assert {r.bucket for r in one.select("bucket").distinct().collect()} == {
        spark.range(1).select(bucket_of(F.lit("u8"), 4)).first()[0]
    }


def test_scratch_ends_with_its_scope(spark, daily):
    _, out = daily
    before = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/topicloom-*"))
    with scratch_scope(spark) as folder:
        found = lookup.topics_of_network(spark, out, "u8", "Tue Jan 02 2024", "Sat Jan 06 2024").collect()
        assert found and glob.glob(f"{folder}/*")
    assert set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/topicloom-*")) == before


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    set_to = {"spark.checkpoint.dir": None, "spark.master": "spark://host:7077", "spark.sql.warehouse.dir": "/w/"}
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *default: set_to[key])
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(spark, "x")
    set_to["spark.master"] = "local[2]"
    assert scratch_path(spark, "x").startswith("/w/_scratch/topicloom-")


def test_files_of_a_bucket_have_disjoint_keys(spark, tmp_path):
    usr = F.concat(F.lit("u"), (F.col("id") % 20_000).cast("string"))
    table = spark.range(0, 100_000, 1, 8).select(usr.alias("usr"), F.lit(DAYS[0]).alias("day"), F.md5(usr).alias("x"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        publish_days(table, str(tmp_path / "t"), "usr", buckets=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    by_file = read_days(spark, str(tmp_path / "t")).groupBy("bucket", F.input_file_name().alias("file"))
    ranges = by_file.agg(F.min("usr").alias("low"), F.max("usr").alias("high")).orderBy("bucket", "low").collect()
    assert len(ranges) > 4
    for a, b in zip(ranges, ranges[1:]):
        assert a.bucket != b.bucket or a.high <= b.low


def test_covered_days_beside_others_are_kept(spark, tmp_path):
    """A run with days outside of the covered ones loses none of them."""
    path = str(tmp_path / "t")
    days = [date(2018, 2, d) for d in range(1, 7)]
    table = spark.createDataFrame([(f"u{k}", day) for k, day in enumerate(days)], "usr string, day date")
    publish_days(table, path, "usr")
    assert publish_days(table, path, "usr", covered=(days[2], days[2])) == days
    assert {r.day for r in read_days(spark, path).collect()} == set(days)


def test_reader_between_two_steps_sees_the_old_days(spark, tmp_path, monkeypatch):
    """Rows that are written but not yet in the log, as after a killed run, are not read."""
    from topicloom.sources import tables

    path = str(tmp_path / "t")
    old = day_table(spark, ("a", "1", DAYS[0]), ("b", "1", DAYS[1]))
    publish_days(old, path, "usr")
    begun = read_days(spark, path)
    seen = []
    plain = tables._append
    monkeypatch.setattr(tables, "_append", lambda *a: seen.append(rows(read_days(spark, path))) or plain(*a))
    new = day_table(spark, ("a", "2", DAYS[0]))
    publish_days(new, path, "usr", covered=(DAYS[0], DAYS[1]))
    assert seen == [rows(old)]
    assert rows(read_days(spark, path)) == rows(new)
    assert rows(begun) == rows(old)  # who began before goes on reading what was there
    monkeypatch.setattr(tables, "_append", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        publish_days(old, path, "usr")
    assert rows(read_days(spark, path)) == rows(new)
    assert remove_replaced(spark, path) == 4
    assert rows(read_days(spark, path)) == rows(new)


def test_touched_keys_without_rows_go(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_days(day_table(spark, ("a", "1", DAYS[0]), ("b", "1", DAYS[0]), ("a", "1", DAYS[1])), path, "usr")
    touched = day_table(spark, ("a", "", DAYS[0]), ("a", "", DAYS[1])).select("usr", "day")
    publish_days(day_table(spark, ("a", "2", DAYS[0])), path, "usr", whole_days=False, touched=touched)
    assert rows(read_days(spark, path)) == [("a", "2", DAYS[0]), ("b", "1", DAYS[0])]
    assert [r.day for r in day_log(spark, path).collect()] == [DAYS[0]]


def test_merged_runs(spark, tmp_path):
    path = str(tmp_path / "t")

    def lists(*values):
        return spark.createDataFrame(values, "usr string, part long, follows string")

    publish_latest(lists(("a", 0, "1"), ("b", 0, "1")), path, "usr", 1)
    publish_latest(lists(("b", 0, "4")), path, "usr", 4)
    before = rows(read_latest(spark, path))
    compact(spark, path)
    assert rows(read_latest(spark, path)) == before == [("a", 0, "1"), ("b", 0, "4")]
    assert len(glob.glob(f"{path}/batch=*")) == 3 and remove_merged(spark, path) == 2
    assert len({f.split("batch=")[1][:8] for f in read_runs(spark, path).inputFiles()}) == 1
    publish_latest(lists(("a", 0, "2"), ("b", 0, "2")), path, "usr", 2)  # late, after the merge
    assert rows(read_latest(spark, path)) == [("a", 0, "2"), ("b", 0, "4")]
    publish_latest(lists(("c", 0, "5")), path, "usr", 4)  # a merged run once more
    assert rows(read_latest(spark, path)) == [("a", 0, "2"), ("b", 0, "2"), ("c", 0, "5")]
    assert rows(read_latest(spark, path, value="a")) == [("a", 0, "2")]


def test_late_run_is_kept(spark, tmp_path):
    path = str(tmp_path / "t")

    def lists(*values):
        return spark.createDataFrame(values, "usr string, part long, follows string")

    for run, usr in ((1, "a"), (5, "b"), (3, "c")):
        publish_latest(lists((usr, 0, "x")), path, "usr", run)
    assert [r.usr for r in read_latest(spark, path).orderBy("usr").collect()] == ["a", "b", "c"]


def test_emptied_day_goes(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.createDataFrame([("a", DAYS[0]), ("b", DAYS[1])], "usr string, day date")
    publish_days(days, path, "usr")
    publish_days(days.where("usr = 'a'"), path, "usr", covered=(DAYS[0], DAYS[1]))
    assert [r.usr for r in read_days(spark, path).collect()] == ["a"]


def test_lines_are_judged(spark, tmp_path):
    day = '"created_at":"2018-01-02 00:00:00 UTC"'
    who, what = '"actor":{"login":"a"}', '"repo":{"name":"r"}'
    lines = {
        "clean": f'{{"type":"ForkEvent","event_id":1,{who},{what},{day}}}',
        "broken": '{"type":"ForkEvent","event_id":2',
        "other_type": f'{{"type":"PushEvent","event_id":3,{who},{what},{day}}}',
        "no_user": f'{{"type":"ForkEvent","event_id":4,"actor":{{}},{what},{day}}}',
        "no_repo": f'{{"type":"CommitCommentEvent","event_id":5,{who},{day}}}',
        "no_time": f'{{"type":"ForkEvent","event_id":6,{who},{what}}}',
        "bad_time": f'{{"type":"ForkEvent","event_id":7,{who},{what},"created_at":"soon"}}',
        "other_day": f'{{"type":"ForkEvent","event_id":8,{who},{what},"created_at":"2018-01-09 00:00:00 UTC"}}',
    }
    (tmp_path / "e.json").write_text("\n".join([*lines.values(), "no json"]) + "\n")
    stored = stored_events(spark, str(tmp_path / "e.json"), str(tmp_path / "none*"))
    staged, counts = staged_lines(judged_lines(stored, "event_id", DAYS[0], DAYS[2]))
    assert counts == {name: 1 + (name == "broken") for name in lines}
    found = {(r.outcome, r.event_id) for r in staged.collect()}
    assert found == {(o, None if o == "broken" else k + 1) for k, o in enumerate(lines) if o != "other_type"}
    assert {r.line for r in staged.where("outcome = 'broken'").collect()} == {lines["broken"], "no json"}
    assert all(r.file.endswith("e.json") for r in staged.collect())
    assert read_events(spark, str(tmp_path / "e.json")).count() == 7


def test_files_are_parsed_once(spark, tmp_path, monkeypatch):
    """The daily job still ends if the files are gone once the lines are staged, and leaves no scratch."""
    import shutil

    from topicloom.plans import daily as job

    files, out = tmp_path / "events", str(tmp_path / "out")
    raw_events(spark, SF_DIR).write.json(str(files))
    plain = event_source.staged_lines

    def staged_then_gone(lines):
        found = plain(lines)
        shutil.rmtree(files)
        return found

    monkeypatch.setattr(job, "staged_lines", staged_then_gone)
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{base}/topicloom-*"))
    account = run_days(spark, [str(files)], out, date(2024, 1, 1), date(2024, 1, 20), 1, buckets=2)
    assert set(glob.glob(f"{base}/topicloom-*")) == before
    rejects = read_runs(spark, f"{out}/rejects")
    assert sum(account.values()) == raw_events(spark, SF_DIR).count()
    assert read_days(spark, f"{out}/activity").count() == account["clean"] > 0
    by_outcome = {r.outcome: r["count"] for r in rejects.groupBy("outcome").count().collect()}
    assert by_outcome == {k: n for k, n in account.items() if n and k not in ("clean", "other_type")}


def test_too_many_broken_lines_publish_nothing(spark, tmp_path):
    (tmp_path / "e.json").write_text("no json\n" * 3)
    with pytest.raises(ValueError, match="3 of 3 lines"):
        run_days(spark, [str(tmp_path / "e.json")], str(tmp_path / "out"), DAYS[0], DAYS[1], 1)
    assert not (tmp_path / "out").exists()


def test_given_follows_and_repos_are_published(spark, daily, tmp_path):
    raw, _ = daily
    raw.write.json(str(tmp_path / "events"))
    given = spark.createDataFrame([("u8", "u1"), ("u8", "u1"), ("u8", "u2"), (None, "u3")], "usr string, follow string")
    out = str(tmp_path / "out")
    account = run_days(
        spark, [str(tmp_path / "events")], out, date(2024, 1, 1), date(2024, 1, 20), 1, follows_of=given, buckets=2
    )
    assert account["broken"] == 0 and account["other_day"] > 0
    assert [tuple(r.follows) for r in read_latest(spark, f"{out}/useruser").collect()] == [("u1", "u2")]
    repos = lookup.repos_of_user(spark, out, "u8", "Tue Jan 02 2024", "Sat Jan 20 2024")
    activity = read_days(spark, f"{out}/activity").where("usr = 'u8' AND day > '2024-01-02' AND day < '2024-01-20'")
    assert {r.repo for r in repos.collect()} == {r.repo for r in activity.collect()} != set()
