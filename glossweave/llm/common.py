"""Helpers that several operators of this folder share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of the public vocabulary files; every operator that reads one takes a path as a parameter.
TOKENIZERS = os.path.dirname(public_tokenizers.path("word_bpe_49k.json"))

_EVEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filled(text: Column) -> Column:
    """A text in which NULL counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def smallest_hashes(share: float, *key: Column) -> Column:
    """Whether a row's key is among the ``share`` of all 64-bit hashes that are smallest, however small that share is."""
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(*key) < F.lit(int(share * 2**64) - 2**63)


def text_bytes(array: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text of an Arrow column, without decoding; NULL is empty."""
    return [value or b"" for value in array.cast(pa.large_binary()).to_pylist()]


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def mix64(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser on an unsigned array; another seed gives an independent function."""
    with np.errstate(over="ignore"):
        x = values + _EVEN * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * _MIX_1
        x = (x ^ (x >> np.uint64(27))) * _MIX_2
        return x ^ (x >> np.uint64(31))


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each index's connected component, for links a[i] - b[i] among 0..n-1."""
    label = np.arange(n)
    while True:
        left, right = label[a], label[b]
        differ = left != right
        if not differ.any():
            return label
        low, high = np.minimum(left, right)[differ], np.maximum(left, right)[differ]
        np.minimum.at(label, high, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
