"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.session import materialise


#: Parts that the links of one vertex are dealt to.
PARTS = 64


def _with_nearest(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pairs`` (``u``, ``v``) with ``m``, the smallest of ``u`` and its neighbours, and the table of ``u`` and ``m``.

    A vertex's links are dealt to parts by their other end and meet ``m`` part by part, so a hub is no single join key.
    Only parts that hold links are asked for: a vertex with one link stays one row.
    """
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(PARTS)))
    least = dealt.groupBy("u", "part").agg(F.min("v").alias("v"))
    near = least.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.collect_list("part").alias("parts"))
    told = near.select("u", "m", F.explode("parts").alias("part"))
    return dealt.join(told, ["u", "part"]).select("u", "v", "m"), near.select("u", "m")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_nearest(both)[0].filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down, near = _with_nearest(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    moved = down.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(near.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v")).distinct()


def _open_ends(links: DataFrame) -> int:
    """Vertices with two links to smaller ones, or with links to smaller and to larger ones: none if all links are stars."""
    down = links.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = down.unionByName(links.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up")).filter("down > 1 OR down = 1 AND up = 1").count()


def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(``u``, ``root``) for every vertex with a smaller one in its component; roots themselves have no row.

    ``links`` has columns ``u`` and ``v`` of one orderable type. Rounds are joins and partial aggregations, each written
    once below the shared folder; a vertex with very many links is split into parts. The end is reached when all links are
    stars, which one aggregation shows.
    """
    links = materialise(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    for _ in range(max_rounds):
        if not _open_ends(links):
            return links.withColumnRenamed("v", "root")
        links = materialise(_small_star(_large_star(links)), "links")
    raise RuntimeError("connected components did not settle")
