"""One streaming job that lands micro-batches and publishes the marts after each of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from touchtrail.params import Params
from touchtrail.plans import pipeline, publish
from touchtrail.sources.landing import touched_days, read_delivery, read_landing
from touchtrail.streaming.ingest import start_ingest


def build_of(feed: str, batch: int) -> str:
    """The build that a micro-batch leads to; a replay leads to the same one."""
    return f"{feed}-{batch}"


def start_refresh(
    sent: DataFrame,
    nested: Callable[[SparkSession], DataFrame],
    landing: str,
    out: str,
    checkpoint: str,
    params: Params = Params(),
    once: bool = True,
    rejects: str | None = None,
    keep: int = 3,
) -> StreamingQuery:
    """Land each micro-batch, stage the days it touches, build the marts and publish them.

    ``nested`` reads the batch export anew for each build; days of shards that are new, changed or
    gone since the last one are staged as well. The build is named after the query and the
    batch, so a batch that is replayed after its build was published publishes nothing, and one
    that ended anywhere before is taken up again. A batch that changes nothing leaves the published
    build as it is. The last ``keep`` builds stay.
    """
    spark = sent.sparkSession
    staged = pipeline.staged_path(out)

    def publish_marts(feed: str, batch: int) -> None:
        build = build_of(feed, batch)
        if publish.is_committed(spark, out, build):
            return
        export = nested(spark)
        of_export, shards = pipeline.export_changes(spark, export, staged)
        days = None
        if pipeline.is_staged(spark, staged):
            of_batch = touched_days(read_delivery(spark, landing, feed, batch))
            days = [*of_batch, *(day for day in of_export if day not in of_batch)]
            if not days and publish.commits(spark, out):
                return
        # Landed rows of other days are of no use here, and their files are not opened.
        landed = read_landing(spark, landing, days)
        pipeline.refresh(spark, export, landed, out, days, params, build)
        pipeline.note_export(spark, staged, shards)
        publish.expire(spark, out, keep)

    return start_ingest(sent, landing, checkpoint, once, rejects, publish_marts)
