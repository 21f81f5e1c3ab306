"""Raw activity events: schema, reader, and the landed copy."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.functions.text import event_day
from topicloom.operators.clean import ACTIVITY_TYPES
from topicloom.session import scratch_path

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("actor", T.StructType([T.StructField("login", T.StringType())])),
        T.StructField("repo", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("created_at", T.StringType()),
    ]
)


BROKEN = "_corrupt_record"


def stored_events(spark: SparkSession, *globs: str, id_field: str = "event_id") -> DataFrame:
    """The lines as stored, those that are no JSON with their text in ``_corrupt_record``.

    A glob that no file matches is an empty period; it is an error only if none matches any.
    """
    as_stored = T.StructType(
        [
            T.StructField(id_field, T.StringType()),
            *EVENT_SCHEMA.fields[1:],
            T.StructField(BROKEN, T.StringType()),
        ]
    )
    found, missing = [], None
    for one in globs:
        try:
            found.append(spark.read.schema(as_stored).json(one))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing = error
    if not found and missing is not None:
        raise missing
    return reduce(DataFrame.unionByName, found)


def event_ids(id_field: str) -> Column:
    """The unique id in a field, as number or as digits; without one, a hash of the event stands in."""
    fallback = F.xxhash64("type", "actor.login", "repo.name", "created_at")
    return F.coalesce(F.col(id_field).try_cast("bigint"), fallback)


def read_events(spark: SparkSession, *globs: str, id_field: str = "event_id") -> DataFrame:
    """Events from (gzipped) JSON files; several globs give the union of several periods.

    The schema is given, so no file is read twice to infer it. Gzip cannot be split: each file
    is one task, which is why the daily job lands the events as Parquet and reads that.
    ``id_field`` names the unique id in the files (see ``event_ids``). Lines that are no JSON are left out;
    ``judged_lines`` has them.
    """
    # Spark refuses a plan that reads nothing but the broken lines, so the type is named as well.
    whole = F.concat_ws("", F.col(BROKEN), F.substring("type", 1, 0)) == ""
    events = stored_events(spark, *globs, id_field=id_field).where(whole)
    return events.select(event_ids(id_field).alias("event_id"), "type", "actor", "repo", "created_at")


# What a line can be, in the order in which it is asked; the last is kept.
OUTCOMES = ("broken", "other_type", "no_user", "no_repo", "no_time", "bad_time", "other_day", "clean")


def judged_lines(stored: DataFrame, id_field: str, first: date, last: date) -> DataFrame:
    """Every stored line with its ``outcome``, one of ``OUTCOMES``, and the ``file`` it is from.

    Columns ``event_id, usr, repo, day`` as in the activity, ``created_at`` as stored, and ``line``, the text
    of a broken line. Lines of other event types are not activity at all; the others that are not clean are
    rejects. ``first`` and ``last`` are the days that the files are read for.
    """
    day = event_day(F.col("created_at"))
    checks = (
        F.col(BROKEN).isNotNull(),
        ~F.coalesce(F.col("type").isin(*ACTIVITY_TYPES), F.lit(False)),
        F.col("actor.login").isNull(),
        F.col("repo.name").isNull(),
        F.col("created_at").isNull(),
        day.isNull(),
        ~day.between(F.lit(first), F.lit(last)),
    )
    found = [F.when(check, F.lit(name)) for check, name in zip(checks, OUTCOMES, strict=False)]
    return stored.select(
        F.when(F.col(BROKEN).isNull(), event_ids(id_field)).alias("event_id"),
        F.col("actor.login").alias("usr"),
        F.col("repo.name").alias("repo"),
        day.alias("day"),
        "created_at",
        F.col(BROKEN).alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.coalesce(*found, F.lit(OUTCOMES[-1])).alias("outcome"),
    )


def staged_lines(lines: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Judged lines written to scratch in one pass, without those of other types, and lines per outcome.

    The files are parsed here and nowhere else. What follows reads the folder of the outcome it needs.
    """
    spark, counts = lines.sparkSession, Observation()
    path = scratch_path(spark, "lines")
    number = [F.count_if(F.col("outcome") == name).alias(name) for name in OUTCOMES]
    kept = lines.observe(counts, *number).where(F.col("outcome") != "other_type")
    kept.write.partitionBy("outcome").parquet(path)
    return spark.read.schema(lines.schema).parquet(path), counts.get
