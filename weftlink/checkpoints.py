"""Frames written down between the steps of a query."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, its lineage cut.

    The folder is the session's ``spark.checkpoint.dir``; one is made only where none is set and
    all runs in one process (tests, a laptop).
    """
    checkpoint_folder(df.sparkSession)
    with _cleaned_up(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a new frame, so that the setting holds for it


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in a new folder of the checkpoint folder, read again: as ``checkpointed``, in a few times less space."""
    out = f"{checkpoint_folder(df.sparkSession)}/written-{uuid.uuid4().hex}"
    with _cleaned_up(df.sparkSession):
        df.select("*").write.parquet(out, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(out)


def forget(df: DataFrame) -> None:
    """Removes the files of a frame that ``written`` returned."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/written-" in folder:
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def checkpoint_folder(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="weftlink-checkpoint-"))
    return sc.getCheckpointDir()


@contextlib.contextmanager
def _cleaned_up(spark: SparkSession):
    """Frames made meanwhile drop their shuffle files when an action on them ends: what was checkpointed doesn't need them."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
