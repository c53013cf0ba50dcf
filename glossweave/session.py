"""Session defaults and the shared scratch area used to cut lineage between stages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: str | None = None
_STAGES: list[str] = []
#: Stages named in the block of ``stages_passing`` that runs here; other threads have their own.
_PASSING: ContextVar[list[str] | None] = ContextVar("_PASSING", default=None)

#: Stages are written and read once or twice, and hold mostly text.
STAGE_CODEC = "zstd"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "glossweave", **conf: str) -> SparkSession:
    """A session with the settings the library relies on; pass more as keyword pairs."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # A second copy of a task would make its paid calls again.
        .config("spark.speculation", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a local folder only under a local master."""
    global _LOCAL_ROOT
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="glossweave-")
    return _LOCAL_ROOT


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh directory below the scratch root."""
    path = f"{scratch_root(spark)}/glossweave/{label}-{uuid.uuid4().hex}"
    _STAGES.append(path)
    if (passing := _PASSING.get()) is not None:
        passing.append(path)
    return path


def _delete(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))


def remove_stages(spark: SparkSession) -> int:
    """Delete the stage folders this process has named; for the end of a run, when its results are written elsewhere."""
    removed = 0
    while _STAGES:
        removed += _delete(spark, _STAGES.pop())
    return removed


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes in this block go as soon as each is done: only the written table is read again."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def drop_stages(spark: SparkSession, *folders: str) -> None:
    """Delete stages, or parts of them, that nothing reads again."""
    for folder in folders:
        _delete(spark, folder)
        if folder in _STAGES:
            _STAGES.remove(folder)


def materialise(df: DataFrame, label: str, path: str | None = None, partition: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and continue from the written table.

    Lost executors re-read files instead of recomputing the plan above this point, which matters
    for paid inference calls and for row positions that must not change between two jobs.
    """
    spark = df.sparkSession
    target = path or stage_path(spark, label)
    with shuffles_dropped(spark):
        writer = df.write.mode("overwrite").option("compression", STAGE_CODEC)
        (writer.partitionBy(*partition) if partition else writer).parquet(target)
    return spark.read.schema(df.schema).parquet(target)


@contextmanager
def stages_passing(spark: SparkSession) -> Iterator[None]:
    """Stages that are named in this block go at its end, also those of operators that it calls.

    What shall last is written to a ``path`` that was named before the block, and may not read them.
    """
    token = _PASSING.set([])
    try:
        yield
    finally:
        passing = _PASSING.get()
        _PASSING.reset(token)
        drop_stages(spark, *passing)


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Deal out a scan that arrives in fewer splits than there are cores; leave any larger one alone.

    Text rules are worth a small shuffle when one file would keep them in one task. A table of
    ordinary size has far more splits than cores and is not touched. With ``rows`` no task gets many more rows than that:
    a file of short repeated texts packs millions of them into one split.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    if rows:
        least = max(least, -(-df.count() // rows))
    return df.repartition(least) if df._jdf.queryExecution().toRdd().getNumPartitions() < least else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
