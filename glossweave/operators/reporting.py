"""Work estimates, progress and the run statistics behind the protocol."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.functions.report import duration_text
from glossweave.operators.ordering import null_safe_join, ordered_positions


def elapsed_seconds(start: str, end: str) -> Column:
    """Seconds between two zone-less time stamps, independent of the session time zone."""
    gap = F.col(end) - F.col(start)
    days, hours, minutes = (F.extract(F.lit(part), gap) for part in ("DAY", "HOUR", "MINUTE"))
    whole = (days.cast("bigint") * 24 + hours) * 3600 + minutes * 60
    return (whole * 1_000_000 + (F.extract(F.lit("SECOND"), gap) * 1_000_000).cast("bigint")) / 1e6


def work_estimate(df: DataFrame, keys: Sequence[str], batch: int, n_langs: int) -> DataFrame:
    """Batches per language and in all."""
    per_language = F.ceil(F.count(F.lit(1)) / batch).cast("bigint")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), per_language.alias("n_batches")).withColumn(
        "n_calls", F.col("n_batches") * n_langs
    )


def progress_eta(batches: DataFrame, keys: Sequence[str], ts: str, tie: str, rows: str) -> DataFrame:
    """Per batch of a log: rows done, percent, seconds since the first batch and remaining time."""
    starts = batches.groupBy(*keys).agg(F.min(ts).alias("_start"))
    placed = ordered_positions(batches, keys, [ts, tie], running={"done": rows}, totals={"total": rows})
    elapsed = elapsed_seconds("_start", ts)
    eta = F.when(F.col("done") > 0, (F.col("total") - F.col("done")) * (F.col("elapsed") / F.col("done")))
    return (
        null_safe_join(placed, starts, keys)
        .withColumn("elapsed", elapsed)
        .withColumn("pct", F.when(F.col("total") > 0, F.col("done") / F.col("total") * 100).otherwise(F.lit(100.0)))
        .withColumn("eta_seconds", eta)
        .withColumn("eta", F.coalesce(F.concat(F.lit("~"), duration_text(F.col("eta_seconds"))), F.lit("?")))
        .drop("_start")
    )
