"""Published tables: Parquet folders and a small log that says which of them count.

A day table at ``path`` has its rows in ``path/batch=<id>/day=<day>/bucket=<b>/`` and its log in
``path_days``. A run writes a new batch, which no reader looks at, and then one small file to the log: for each
day the batch that has it from now on, or none for a day that is empty now. The newest row of a day
counts. So a reader sees the old days or the new ones, a run that is killed leaves the old ones, publishing
twice changes nothing, and no folder is ever removed under a reader. One run at a time may write to a table.

``bucket`` is a hash of the key. A lookup of few keys reads their buckets only, also when the keys are known
at run time only. Within a bucket the files have disjoint ranges of keys, and rows are sorted.
"""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.session import remove, saved

# Folders of a day. A published table keeps the number that it began with.
BUCKETS = 16
LOG = "day date, batch string, buckets int"


def _new_batch() -> str:
    return f"b{uuid.uuid4().hex}"  # a letter first, so that it is never read as a number


def table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def bucket_of(key: Column, buckets: int | Column = BUCKETS) -> Column:
    """The bucket of a key."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def day_log(spark: SparkSession, path: str) -> DataFrame:
    """The batch that counts for each day, ``day, batch, buckets``; days emptied since are left out."""
    log = table_or_none(spark, f"{path}_days")
    if log is None:
        return spark.createDataFrame([], LOG)
    newest = F.max_by(F.struct("batch", "buckets"), F.col("version")).alias("now")
    live = log.groupBy("day").agg(newest).select("day", "now.*")
    return live.where(F.col("batch").isNotNull())


def _append(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """A log's next version: one file, so that it is there whole or not at all."""
    log = table_or_none(spark, path)
    last = log.agg(F.max("version")).first()[0] if log is not None else None
    version = F.lit(0 if last is None else last + 1).cast("bigint").alias("version")
    rows.select(version, "*").coalesce(1).write.mode("append").parquet(path)


def read_days(
    spark: SparkSession, path: str, after: date | None = None, before: date | None = None
) -> DataFrame:
    """The published rows, with ``day`` and ``bucket``; strictly between two days where given.

    Only the folders of those days are listed. The log has a row per day and run; its days, of which
    there are a few thousand in ten years, are what reaches the driver. A table of which nothing was
    published is an error, as a missing path is; without any of the days asked for there are no rows.
    """
    live = day_log(spark, path)
    if after is not None:
        live = live.where(F.col("day") > F.lit(after))
    if before is not None:
        live = live.where(F.col("day") < F.lit(before))
    folders = [f"{path}/batch={r.batch}/day={r.day.isoformat()}" for r in live.collect()]
    if folders:
        return spark.read.option("basePath", path).parquet(*folders).drop("batch")
    return spark.read.parquet(path).drop("batch").limit(0)


def buckets_of(spark: SparkSession, path: str) -> int:
    """The table's number of buckets."""
    first = day_log(spark, path).select("buckets").first()
    return first.buckets if first else BUCKETS


def of_key(rows: DataFrame, key: str, value, buckets: int = BUCKETS) -> DataFrame:
    """The rows of one key: of its bucket, and the key itself reaches the scan."""
    return rows.where((F.col("bucket") == bucket_of(F.lit(value), buckets)) & (F.col(key) == F.lit(value)))


def of_keys(rows: DataFrame, keys: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows of the keys in a relation ``key``, read from the buckets that these keys have.

    The relation is written first, so that Spark knows its size: the usual short list is broadcast, and its
    buckets then restrict the folders that are read before any of them is opened. The comparison
    with zero is always true; Spark looks for such run-time filters only where the list has a condition.
    """
    wanted = keys.select(F.col(keys.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct()
    wanted = saved(wanted.withColumn("bucket", bucket_of(F.col(key), buckets)), "keys")
    return rows.join(wanted.where("bucket >= 0"), ["bucket", key], "left_semi")


def publish_days(
    df: DataFrame,
    path: str,
    key: str,
    whole_days: bool = True,
    covered: tuple[date, date] | None = None,
    touched: DataFrame | None = None,
    by: list[str] | None = None,
    buckets: int = BUCKETS,
) -> list[date]:
    """Write a day table, replacing the days it covers and leaving all others; returns the days written.

    ``covered`` are the first and last day of the run: a stored day between them that the run has
    no rows of is emptied. ``df`` may have other days as well; those it has are replaced.

    ``whole_days=False`` is for a run that covers only part of its days: stored rows of those
    days whose (key, day) the run does not bring are kept. ``touched`` names the (key, day) that the run
    decides, in place of those it has rows of: one without rows is gone. ``by`` names other columns than the
    key that decide which rows are the same, such as an id.

    Rows are dealt into ranges, for which Spark runs the last stage of the plan of ``df`` once more to draw a
    sample. ``buckets`` counts for a new table only.
    """
    spark = df.sparkSession
    log = day_log(spark, path)
    stored_buckets = log.select("buckets").first()
    buckets = stored_buckets.buckets if stored_buckets else buckets
    names = [c for c in df.columns if c != "bucket"]
    df = df.select(*names)
    if not whole_days:
        df = saved(df, "run")  # read several times below
        by = by or [key]
        decided = saved((df if touched is None else touched).select(*by, "day").distinct(), "touched")
        days = [r.day for r in decided.select("day").distinct().collect()]  # a row per day
        live = log.where(F.col("day").isin(days)).collect() if days else []
        folders = [f"{path}/batch={r.batch}/day={r.day.isoformat()}" for r in live]
        if folders:
            stored = spark.read.option("basePath", path).parquet(*folders).select(*names)
            df = df.unionByName(stored.join(decided, [*by, "day"], "left_anti"))
    batch = _new_batch()
    # Ranges of day, bucket and key: a day with much of the data has many files, none of two buckets
    # but at the border, and a key lookup skips files and row groups.
    (
        df.withColumn("bucket", bucket_of(F.col(key), buckets))
        .repartitionByRange("day", "bucket", key)
        .sortWithinPartitions("day", "bucket", key)
        .write.partitionBy("day", "bucket")
        .parquet(f"{path}/batch={batch}")
    )
    written = table_or_none(spark, f"{path}/batch={batch}")  # None without rows
    have = set()
    if written is not None:
        have = {r.day for r in written.select("day").distinct().collect()}  # a row per folder
    gone: set[date] = set()
    if covered is not None:
        first, last = covered
        gone = {first + timedelta(days=k) for k in range((last - first).days + 1)} - have
    elif not whole_days:
        gone = set(days) - have
    rows = [(day, batch, buckets) for day in have] + [(day, None, buckets) for day in gone]
    if rows:
        _append(spark, f"{path}_days", spark.createDataFrame(rows, LOG))
    return sorted(have)


def remove_replaced(spark: SparkSession, path: str) -> int:
    """Remove the folders of days that newer batches have replaced; returns how many.

    For quiet hours: a reader that began before the newest publish may still be reading them.
    """
    live = {(r.batch, r.day) for r in day_log(spark, path).collect()}
    written = spark.read.parquet(path).select("batch", "day").distinct().collect()  # a row per folder
    dead = [(r.batch, r.day) for r in written if (r.batch, r.day) not in live]
    for batch, day in dead:
        remove(spark, f"{path}/batch={batch}/day={day.isoformat()}")
    return len(dead)


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """The batches that count, ``run, batch, compacted``: the last merged one and each later run's newest."""
    log = spark.read.parquet(f"{path}_runs")
    begin = log.where("compacted").agg(F.max("version")).first()[0]
    since = log if begin is None else log.where(F.col("version") >= begin)
    return since.groupBy("run", "compacted").agg(F.max_by("batch", "version").alias("batch"))


def _write_run(df: DataFrame, path: str, key: str, run: Column, compacted: bool) -> None:
    spark, batch = df.sparkSession, _new_batch()
    (
        df.withColumn("bucket", bucket_of(F.col(key)))
        .repartitionByRange("bucket", key)
        .sortWithinPartitions("bucket", key)
        .write.partitionBy("bucket")
        .parquet(f"{path}/batch={batch}")
    )
    row = spark.range(1).select(
        run.cast("bigint").alias("run"), F.lit(batch).alias("batch"), F.lit(compacted).alias("compacted")
    )
    _append(spark, f"{path}_runs", row)


def publish_latest(df: DataFrame, path: str, key: str, run: int) -> None:
    """Write one run of a table without days.

    A run is a batch with its own rows; the log ``path_runs`` lists the runs that are complete.
    Publishing a run again replaces it, in whatever order runs come.
    """
    _write_run(df.withColumn("run", F.lit(run).cast("bigint")), path, key, F.lit(run), False)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all complete runs, with ``run`` and ``bucket``.

    The log has a row per run since the last compaction; these are what reaches the driver.
    """
    log = run_log(spark, path).collect()
    folders = [f"{path}/batch={r.batch}" for r in log]
    rows = spark.read.option("basePath", path).parquet(*folders)
    later = [r.run for r in log if not r.compacted]
    for merged in (r.batch for r in log if r.compacted and later):
        rows = rows.where((F.col("batch") != merged) | ~F.col("run").isin(later))
    return rows.drop("batch")


def _newest(runs: DataFrame, key: str) -> DataFrame:
    newest = runs.groupBy("bucket", key).agg(F.max("run").alias("run"))
    return runs.join(newest, ["bucket", key, "run"], "left_semi")


def read_latest(spark: SparkSession, path: str, key: str = "usr", value=None) -> DataFrame:
    """The rows of each key's newest complete run; of one key where a value is given."""
    runs = read_runs(spark, path)
    if value is not None:
        runs = of_key(runs, key, value)
    return _newest(runs, key).drop("run", "bucket")


def compact(spark: SparkSession, path: str, key: str = "usr") -> None:
    """Merge the complete runs into one batch, so that readers open one folder.

    Each row keeps the number of its run, so a late run still loses against newer ones, and a merged run that
    is published again takes the place of its rows. Readers go over to the merged batch when it is in the
    log; ``remove_merged`` removes the others.
    """
    last = run_log(spark, path).agg(F.max("run")).first()[0]
    _write_run(_newest(read_runs(spark, path), key).drop("bucket"), path, key, F.lit(last), True)


def remove_merged(spark: SparkSession, path: str) -> int:
    """Remove the batches that no longer count; returns how many. For quiet hours, as above."""
    live = {r.batch for r in run_log(spark, path).collect()}
    written = spark.read.parquet(path).select("batch").distinct().collect()  # a row per batch
    dead = [r.batch for r in written if r.batch not in live]
    for batch in dead:
        remove(spark, f"{path}/batch={batch}")
    return len(dead)
