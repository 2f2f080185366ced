"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from touchtrail.sources import files


def get_session(
    app_name: str = "touchtrail",
    master: str | None = None,
    conf: dict[str, object] | None = None,
) -> SparkSession:
    """A session with UTC days and adaptive execution."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, str(value))
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on: a day is a UTC day and 30 days are 720 hours.

    Times are written as numbers with statistics, so that readers can skip what is out of range.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


# The scratch folder of this driver below each base that it used.
_roots: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for written intermediate tables, under the shared folder of the cluster.

    ``spark.checkpoint.dir`` names that folder. Only a local master may fall back to a
    folder of this machine, since there every task runs on it. All of them are removed when the
    driver ends; until then, results may be read as often as wanted.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _roots.get("") or tempfile.mkdtemp(prefix="touchtrail-")
        _roots[""] = base
    if base not in _roots:
        _roots[base] = f"{base.rstrip('/')}/touchtrail-{uuid.uuid4().hex}"
    if not files.exists(spark, _roots[base]):
        files.make_folder(spark, _roots[base])
        files.remove_at_exit(spark, _roots[base])
    return f"{_roots[base]}/{label}-{uuid.uuid4().hex}"
