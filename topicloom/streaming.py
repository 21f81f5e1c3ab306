"""Event files as they arrive: each file is loaded once, whatever is started again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.operators.clean import clean_events, user_repo
from topicloom.session import scratch_scope
from topicloom.sources.events import EVENT_SCHEMA
from topicloom.sources.tables import BUCKETS, publish_days


def load_new_files(
    spark: SparkSession, folder: str, out: str, checkpoint: str, files: int = 1000, buckets: int = BUCKETS
) -> None:
    """Load the files that came into a folder since the last call into the published activity, then end.

    ``checkpoint`` remembers which files were read. They are taken in steps of ``files``; a step is published
    by one switch-over, and a step that is run again after a failure brings the same events, which replace
    themselves. An event that comes twice, with the same ``event_id`` and day, is there once: as the last
    step brought it, and of several in one step the one with the smallest user, repository and day. Events that
    change their day are for ``plans.changes``.
    """

    def publish(step: DataFrame, number: int) -> None:
        with scratch_scope(step.sparkSession):
            rows = user_repo(clean_events(step))
            first = F.min(F.struct("usr", "repo", "day")).alias("first")
            rows = rows.groupBy("event_id").agg(first).select("event_id", "first.*")
            publish_days(
                rows, f"{out}/activity", "usr", whole_days=False, by=["event_id"], buckets=buckets
            )

    found = (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("maxFilesPerTrigger", files)
        .json(folder)
        .where(F.col("event_id").isNotNull())
    )
    query = (
        found.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
