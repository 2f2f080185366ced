"""Micro-batch ingest: stream of raw rows to the landing table.

Delivery is at least once. A micro-batch that Spark replays lands once; a file that is delivered
again under a new checkpoint lands again, and staging removes the copies. Late rows are never
dropped: they are part of the next rebuild.

A line that is no JSON object, or has a value of another type than its column, is malformed. Such
lines go to a table of rejects with their text and the file they came from, or fail the batch;
no part of them lands.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from touchtrail.functions.columns import landing_key_id, utc_day
from touchtrail.operators.staging import EVENT_KEY
from touchtrail.schemas import FLAT_EVENTS, LANDING_COLUMNS
from touchtrail.sources import files
from touchtrail.sources.landing import append_delivery

# What a producer sends: the id, the day and the load time are set on arrival.
SENT_EVENTS = T.StructType([f for f in FLAT_EVENTS if f.name != "event_date"])

# The text of a malformed line, null for a sound one, and the file that a row came from.
BAD_LINE, SENT_FILE = "_bad_line", "_sent_file"
REJECTS = T.StructType(
    [
        T.StructField("line", T.StringType()),
        T.StructField("sent_file", T.StringType()),
        T.StructField("rejected_at", T.TimestampType()),
    ]
)

# State on local disks with a log of changes in the checkpoint: an hour of keys need not fit into the
# executors' heap, and a checkpoint writes what changed.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = SENT_EVENTS,
    file_format: str = "json",
    max_files_per_trigger: int | None = None,
    path_glob: str | None = None,
) -> DataFrame:
    """Files dropped into a folder, as a stream with a declared schema.

    A stream of JSON lines also has the text of malformed lines and the file of each line.
    """
    lines = file_format == "json"
    if lines:
        schema = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    reader = spark.readStream.schema(schema).format(file_format)
    if lines:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    rows = reader.load(path)
    return rows.withColumn(SENT_FILE, F.col("_metadata.file_path")) if lines else rows


def arriving_rows(sent: DataFrame) -> DataFrame:
    """Landing columns of sent rows: whole seconds, id, day."""
    return sent.withColumn("event_ts", F.date_trunc("second", "event_ts")).withColumns(
        {"event_id": landing_key_id(), "event_date": utc_day("event_ts")}
    )


def first_deliveries(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The stream without copies that arrive within ``delay`` of each other.

    The watermark runs on the arrival time, so no row is late however old its event is, and state
    still expires. The filter saves landing space only: the rebuild removes copies over all time.
    Malformed lines have no key to compare; each one stays, told apart by its text.
    """
    arriving = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    key = list(EVENT_KEY) + [c for c in (BAD_LINE,) if c in stream.columns]
    return arriving.dropDuplicatesWithinWatermark(key).drop("_arrived")


def start_ingest(
    sent: DataFrame,
    landing: str,
    checkpoint: str,
    once: bool = True,
    rejects: str | None = None,
    then: Callable[[str, int], None] | None = None,
) -> StreamingQuery:
    """Append the stream to the landing table; ``once`` stops after what is there now.

    A delivery is named by the id of the query, which lives in its checkpoint, and the number of the
    batch. So a replay is known and a fresh checkpoint is something else. Malformed lines go to
    ``rejects``; without that folder they fail their batch, and none of it lands. ``then`` runs after
    each batch has landed, with the id and the number, also when the batch is replayed.
    """
    spark = sent.sparkSession
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    checked = BAD_LINE in sent.columns

    def land(rows: DataFrame, batch: int) -> None:
        feed = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if feed is None:
            raise RuntimeError("a micro-batch without the id of its query cannot be replayed safely")
        if not checked:
            append_delivery(rows.select(*LANDING_COLUMNS), landing, feed, batch)
        elif rejects is None:
            append_delivery(_refusing(rows), landing, feed, batch)
        else:
            _land_sound_rows(rows, landing, rejects, feed, batch)
        if then:
            then(feed, batch)

    # The load time is the time of the micro-batch, which its checkpoint records: a replay gives
    # the same one.
    writer = (
        arriving_rows(sent)
        .withColumn("inserted_at", F.current_timestamp())
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def _refusing(rows: DataFrame) -> DataFrame:
    """Rows that cannot be written as long as one of them is malformed."""
    told = F.concat(
        F.lit("malformed line in "), SENT_FILE, F.lit("; name a folder for rejects: "), BAD_LINE
    )
    checked_id = F.when(F.col(BAD_LINE).isNotNull(), F.raise_error(told)).otherwise(F.col("event_id"))
    return rows.withColumn("event_id", checked_id.cast("string")).select(*LANDING_COLUMNS)


def _land_sound_rows(rows: DataFrame, landing: str, rejects: str, feed: str, batch: int) -> None:
    """Land what is sound, then write what is not; a batch without malformed lines is read once."""
    is_bad = F.col(BAD_LINE).isNotNull()
    counted = Observation()
    sound = rows.observe(counted, F.count_if(is_bad).alias("bad")).where(~is_bad)
    landed = append_delivery(sound.select(*LANDING_COLUMNS), landing, feed, batch)
    # A batch that had landed before may have ended before its rejects were written.
    if not landed or counted.get["bad"]:
        bad = rows.where(is_bad).select(
            F.col(BAD_LINE).alias("line"),
            F.col(SENT_FILE).alias("sent_file"),
            F.col("inserted_at").alias("rejected_at"),
        )
        bad.write.mode("overwrite").parquet(f"{rejects.rstrip('/')}/feed={feed}/delivery={batch}")


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """Malformed lines with their file, the time of their batch, its feed and number."""
    stored = T.StructType(
        [*REJECTS.fields, T.StructField("feed", T.StringType()), T.StructField("delivery", T.LongType())]
    )
    if not files.exists(spark, rejects):
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).parquet(rejects)


def ingest_available(
    sent: DataFrame, landing: str, checkpoint: str, rejects: str | None = None
) -> None:
    """Land everything available now and wait for it."""
    start_ingest(sent, landing, checkpoint, rejects=rejects).awaitTermination()
