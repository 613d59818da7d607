"""Where jobs put hand-off tables, stream outputs and stream checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Where none is set, a session in one process gets a scratch folder of its own; on a cluster that is an error.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that all executors of {master} share")
        folder = tempfile.mkdtemp(prefix="run-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared folder. Nothing is created yet."""
    return f"{shared_folder(spark)}/sessionflow/{name}-{uuid.uuid4().hex}"


def hand_off(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the written table.

    For results that several later steps read: they are computed once, and a lost executor sends nobody back beyond
    this point.
    """
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def hand_off_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The same, with the number of rows, which are counted while they are written."""
    seen = Observation()
    written = hand_off(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return written, seen.get["n"]
