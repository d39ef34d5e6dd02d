"""Measured size checks that stand before every broadcast, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BROADCAST_LIMIT_BYTES = 64 << 20
# Bytes of a batch that a task sends to Python.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row written out as text."""
    return F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows: one pass, one number to the driver."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def is_small(df: DataFrame, limit: int | None = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether ``df`` measures within ``limit``.

    A caller that has measured already passes the answer on: ``None`` is yes, 0 is no.
    """
    if limit is None:
        return True
    return limit > 0 and measured_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, limit: int | None = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``df`` marked for broadcast when it measures within ``limit``; else left to a shuffle join."""
    return F.broadcast(df) if is_small(df, limit) else df


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in Arrow batches of :data:`BATCH_BYTES`, unless the session has a size of its own.

    Spark's 64 MB are held several times by each running task, in the executor and in its worker: as
    the vectors being filled, their copy twice as large while they grow, and what the worker reads.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def work_folder(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder serves a local master only: on a cluster, every
    executor would write to its own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="sieveline-")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, kept if executors are lost."""
    path = f"{work_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
