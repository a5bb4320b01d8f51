"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def create_session(app: str = "lodgegrid", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on; pass ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # the JVM does not compile methods over 8000 bytes, so let Spark split them
        "spark.sql.codegen.hugeMethodLimit": str(HUGE_METHOD_BYTES),
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


HUGE_METHOD_BYTES = 8000


def small_methods(df: DataFrame) -> DataFrame:
    """``df``, with the session's generated methods kept to what the JVM compiles.

    A stage with many computed columns becomes one method that is interpreted for every row
    where it is longer; Spark then runs the stage by operators instead, whose code it splits.
    The setting stays, since ``df`` is only run later; it changes no result.
    """
    setting = "spark.sql.codegen.hugeMethodLimit"
    if int(df.sparkSession.conf.get(setting)) > HUGE_METHOD_BYTES:
        df.sparkSession.conf.set(setting, str(HUGE_METHOD_BYTES))
    return df


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Removes a query's shuffle files once it has ended, for what is written within.

    Else they stay until the driver's JVM happens to collect the plan, and a job of several
    writes holds the shuffles of all of them on disk. Nothing that is written is read from them again.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    usual = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if usual is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, usual)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Where the session names none, a local run gets a temporary folder; a cluster run
    is refused, since a folder on one machine would not survive its loss.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lodgegrid-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Everything downstream then sees one fixed set of rows, also after executors are lost.
    """
    path = scratch_path(df.sparkSession, label)
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
