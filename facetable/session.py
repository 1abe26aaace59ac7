"""Sessions, and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

# What the queries here lean on.  A cluster's own settings win; see build_session.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app_name: str = "facetable",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution on and times in UTC.

    ``conf`` is applied last, so a cluster can size partitions, name catalogs or
    turn any of the settings off.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# What this process has made in shared folders, by application.
_scratch: dict[str, dict[str, list[str]]] = {}


def _made(spark: SparkSession, kind: str) -> list[str]:
    mine = _scratch.setdefault(spark.sparkContext.applicationId, {})
    return mine.setdefault(kind, [])


def drop_scratch(spark: SparkSession) -> None:
    """Drop the scratch databases and folders this session has made so far.

    Call it after reading: frames that queries returned read what they wrote.
    """
    for name in _made(spark, "databases"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in map(hadoop, _made(spark, "paths")):
        path.getFileSystem(conf).delete(path, True)
    _scratch.pop(spark.sparkContext.applicationId, None)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder stands in only in local mode, where there is a single
    machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="facetable-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call was given."""
    path = f"{shared_folder(spark)}/facetable/{label}-{uuid.uuid4().hex}"
    _made(spark, "paths").append(path)
    return path


def scratch_database(spark: SparkSession, label: str) -> str:
    """A new database whose tables are kept in the shared folder."""
    name = f"facetable_{label}_{uuid.uuid4().hex}"
    location = scratch_path(spark, label).replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
    _made(spark, "databases").append(name)
    return name
