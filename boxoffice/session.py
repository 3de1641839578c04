"""Session defaults and the shared folder used for written intermediates."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, app: str = "boxoffice") -> SparkSession:
    """A single-machine session for tests and the benchmark.

    A cluster brings its own session; nothing in the library builds one.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Test files hold one block each: only a shuffle join spreads them over all cores.
        .config("spark.sql.autoBroadcastJoinThreshold", "1MB")
        .config("spark.driver.memory", os.environ.get("BOXOFFICE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session without that setting, as in a plain local test, gets a
    folder of its own; on a cluster, or where the master is not known, that would be
    machine-local and is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="boxoffice-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in one subfolder per application.

    Nothing is removed here: whoever owns the shared folder can drop the subfolder once
    the application has ended.
    """
    return f"{shared_dir(spark)}/boxoffice/{_application(spark)}/{name}-{uuid.uuid4().hex}"


def _application(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # a remote session has no context of its own
        return "session"


def stable(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where two branches of a plan must see the very same row placement, even
    after an executor is lost and its tasks are run again. Long texts may name a stronger
    ``compression`` than the session's.
    """
    path = scratch_path(df.sparkSession, "stable")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
