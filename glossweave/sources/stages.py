"""Stage tables of a run, so that a run that was broken off goes on where it stopped and pays for no call twice."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossweave.session import STAGE_CODEC, shuffles_dropped

#: Calls whose answers are committed together; what a broken run loses at most.
CALLS_PER_COMMIT = 10_000

ANSWERS = (
    "request_id string, raw string, error string, prompt_tokens bigint, completion_tokens bigint, api_calls bigint, sent_at timestamp_ntz"
)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def content_fingerprint(df: DataFrame, settings: Iterable[object]) -> str:
    """A digest of the rows of ``df``, in any order, its schema and ``settings``."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    other = F.hash(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    sums = df.agg(F.count(F.lit(1)), F.sum(row), F.sum(other)).first()
    return hashlib.sha256(repr((tuple(sums), df.schema.simpleString(), list(settings))).encode()).hexdigest()[:32]


class AnswerLog:
    """Raw answers by request below ``path``, added in commits and never replaced."""

    def __init__(self, spark: SparkSession, path: str, calls_per_commit: int = CALLS_PER_COMMIT):
        self.spark, self.path, self.calls_per_commit = spark, path, calls_per_commit

    def rows(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], ANSWERS)
        return self.spark.read.schema(ANSWERS).parquet(self.path)

    def answered(self) -> DataFrame:
        """Requests that a call has answered, whatever the answer is worth."""
        return self.rows().where("error IS NULL").select("request_id").distinct()

    def latest(self) -> DataFrame:
        """One row per request: an answer before an error, then the latest."""
        rank = F.struct(F.col("error").isNull(), "sent_at", "raw")
        rest = F.struct("raw", "error", "prompt_tokens", "completion_tokens", "api_calls")
        return self.rows().groupBy("request_id").agg(F.max_by(rest, rank).alias("_row")).select("request_id", "_row.*")

    def append(self, answers: DataFrame) -> None:
        answers.withColumn("sent_at", F.localtimestamp()).select(*_names(ANSWERS)).write.mode("append").parquet(self.path)


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


class RunStages:
    """Stage tables below ``root``; a stage with a committed table is read, not computed again."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @classmethod
    def of_run(cls, root: str, df: DataFrame, settings: Iterable[object]) -> RunStages:
        """The stages of runs over this input with these settings; any other input or setting has stages of its own."""
        return cls(df.sparkSession, f"{root.rstrip('/')}/{content_fingerprint(df, settings)}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def done(self, name: str) -> bool:
        return exists(self.spark, f"{self.path(name)}/_SUCCESS")

    def get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if not self.done(name):
            with shuffles_dropped(self.spark):
                build().write.mode("overwrite").option("compression", STAGE_CODEC).parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))

    def once(self, name: str, act: Callable[[], None]) -> None:
        """Act unless an earlier run has finished doing so."""
        if not self.done(name):
            act()
            self.spark.range(1).write.mode("overwrite").parquet(self.path(name))

    def answers(self, calls_per_commit: int = CALLS_PER_COMMIT) -> AnswerLog:
        return AnswerLog(self.spark, self.path("answers"), calls_per_commit)
