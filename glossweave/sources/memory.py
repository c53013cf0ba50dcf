"""Translation memory: an append-only Parquet log, read through a latest-wins view."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossweave.functions.text import memory_key
from glossweave.operators.pool import language_fanout
from glossweave.session import STAGE_CODEC, shuffles_dropped

SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("rules_id", T.StringType()),
        T.StructField("text_norm", T.StringType()),
        T.StructField("translation", T.StringType()),
        T.StructField("is_fallback", T.BooleanType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("lang", T.StringType()),
        T.StructField("batch_id", T.StringType()),
    ]
)


def latest_translation(log: DataFrame) -> DataFrame:
    """One row per key: real answers before fallbacks, then the highest attempt, then the latest. ``tried`` is the highest
    attempt of all.

    An aggregate rather than a ranked window, so rewritten keys shrink before the shuffle. The row is the greatest one by
    itself, its rank in front: a row beside its rank would move the translation twice.
    """
    rank = ["attempt", "updated_at", "translation", "batch_id"]
    rest = [c for c in log.columns if c not in ("key", "is_fallback", *rank)]
    row = F.struct((~F.col("is_fallback")).alias("_real"), *rank, *rest)
    newest = log.groupBy("key").agg(F.max(row).alias("_row"), F.max("attempt").alias("tried"))
    columns = [(~F.col("_row._real") if c == "is_fallback" else F.col("_row")[c]).alias(c) for c in log.columns if c != "key"]
    return newest.select("key", *columns, "tried")


def with_memory_key(pool: DataFrame, langs: Iterable[str], model: str, rules_id: str) -> DataFrame:
    """Pool × languages with the memory key of each pair."""
    fanned = language_fanout(pool, langs)
    return fanned.withColumn("key", memory_key(F.col("lang"), F.lit(model), F.lit(rules_id), F.col("text_norm")))


def usable(memory: DataFrame) -> DataFrame:
    """Rows that count as hits; a source text stored for want of an answer does not."""
    return memory.where(~F.col("is_fallback"))


def memory_hits(keyed_pool: DataFrame, memory: DataFrame) -> DataFrame:
    return keyed_pool.join(usable(memory).select("key", "translation"), "key")


def memory_misses(keyed_pool: DataFrame, memory: DataFrame) -> DataFrame:
    return keyed_pool.join(usable(memory).select("key"), "key", "left_anti")


class TranslationMemory:
    """The log at ``path``, partitioned by language and batch.

    Nothing in it is ever replaced: a batch id that comes again adds files to its directory, and readers take the
    latest row of each key. A language filter prunes to its directories.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def log(self) -> DataFrame:
        reader = self.spark.read.schema(SCHEMA)
        return reader.parquet(self.path) if self.exists() else self.spark.createDataFrame([], SCHEMA)

    def rows(self, langs: Iterable[str] | None = None, model: str | None = None, rules_id: str | None = None) -> DataFrame:
        """Log rows of some languages and one generation; enough to tell hits from misses."""
        rows = self.log()
        if langs is not None:
            rows = rows.where(F.col("lang").isin(*langs))
        if model is not None:
            rows = rows.where(F.col("model") == model)
        if rules_id is not None:
            rows = rows.where(F.col("rules_id") == rules_id)
        return rows

    def current(
        self, langs: Iterable[str] | None = None, model: str | None = None, rules_id: str | None = None, keys: DataFrame | None = None
    ) -> DataFrame:
        """Latest row per key, of all keys or of those in column ``key`` of ``keys``, which are picked before ranking."""
        rows = self.rows(langs, model, rules_id)
        return latest_translation(rows if keys is None else rows.join(keys.select("key"), "key", "left_semi"))

    def append(self, rows: DataFrame, batch_id: str) -> None:
        """Add one batch: ``lang, model, rules_id, text_norm, translation, is_fallback, attempt, updated_at``."""
        key = memory_key(F.col("lang"), F.col("model"), F.col("rules_id"), F.col("text_norm"))
        full = rows.withColumns({"key": F.lit(""), "batch_id": F.lit(batch_id)})
        # Rebalancing gives each language files of the advisory size and splits a dominant language; keys, which hardly
        # compress, are made behind it.
        with shuffles_dropped(self.spark):
            (
                full.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMA.fields])
                .hint("rebalance", "lang")
                .withColumn("key", key)
                .write.mode("append")
                .option("compression", STAGE_CODEC)
                .partitionBy("lang", "batch_id")
                .parquet(self.path)
            )

    def compact(self, path: str) -> "TranslationMemory":
        """The current view as a new log at ``path``, one batch per language."""
        target = TranslationMemory(self.spark, path)
        target.append(self.current(), "compacted")
        return target

    def exists(self) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)
