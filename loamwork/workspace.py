"""Shared scratch space, lineage cuts and bounded caching."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A machine-local folder is used only when nothing is configured and the master is local.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="loamwork-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/loamwork/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that a lost executor cannot change it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def held(*frames: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep frames cached for the duration of a block that reads them several times."""
    for frame in frames:
        frame.persist(level)
    try:
        yield frames if len(frames) > 1 else frames[0]
    finally:
        for frame in frames:
            frame.unpersist()


#: Partitions of a training frame unless the caller says otherwise: part of what a seeded learner's result depends on.
TRAINING_PARTITIONS = 16
#: Rows of a training partition, about; frames that have more for each of theirs get more partitions.
PARTITION_ROWS = 200_000
#: Equal rows that are dealt together.
EQUAL_ROWS = 20_000


def dealt(df: DataFrame, parts: int | None = None, least: int = TRAINING_PARTITIONS) -> DataFrame:
    """The frame in ``parts`` partitions by a hash of its rows, each sorted by that hash.

    Seeded learners draw per partition. Dealt this way the same rows, seed and ``parts`` give the same model on any cluster. Without
    ``parts`` they follow from the number of rows, ``least`` of them at least, so that a partition is of about the same size whatever the input. Rows that
    are there more often than ``EQUAL_ROWS`` are counted, and dealt in runs of that many, so that none fills a partition.
    """
    total = df.count()
    if parts is None:
        parts = max(least, -(-total // PARTITION_ROWS))
    names = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.withColumn("_deal", F.xxhash64(*names))
    if total > EQUAL_ROWS:
        # At most total / EQUAL_ROWS hashes.
        often = keyed.groupBy("_deal").count().where(F.col("count") > EQUAL_ROWS).select("_deal").collect()
        if often:
            hot = F.broadcast(df.sparkSession.createDataFrame(often, "_deal bigint"))
            counted = keyed.join(hot, "_deal").groupBy("_deal", *names).agg(F.count(F.lit(1)).alias("_n"))
            runs = counted.withColumn("_run", F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {EQUAL_ROWS}"))))
            # A few rows cross the shuffle for each hot one, and are repeated where they arrive.
            size = F.least(F.lit(EQUAL_ROWS), F.col("_n") - F.col("_run") * EQUAL_ROWS)
            lone = runs.withColumn("_size", size.cast("int")).withColumn("_deal", F.when(F.col("_run") == 0, F.col("_deal")).otherwise(F.xxhash64("_deal", "_run")))
            cold = keyed.join(hot, "_deal", "left_anti").withColumn("_size", F.lit(1))
            both = cold.select("_deal", *names, "_size").unionByName(lone.select("_deal", *names, "_size"))
            placed = both.repartition(parts, "_deal").sortWithinPartitions("_deal")
            return placed.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_size")))).select(*names)
    return keyed.repartition(parts, "_deal").sortWithinPartitions("_deal").drop("_deal")


@contextmanager
def spread(df: DataFrame, parts: int | None = None, least: int = TRAINING_PARTITIONS):
    """A cached frame, dealt to ``parts`` partitions, for learners that pass over it many times.

    Without ``parts`` there are more of them for more rows; pass a number to repeat a model on other rows' partitions.
    """
    with held(dealt(df, parts, least)) as rows:
        yield rows
