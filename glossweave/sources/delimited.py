"""Delimited text tables: separator detection, all-string scan, one output per language."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossweave.operators.schema import normalise_header, ordered_projection

# Fixed value: how much of a file decides on the separator.
HEAD_CHARS = 4096


def sniff_separator(text: Column) -> Column:
    """``;`` when the head of the file has at least as many of them as of ``,``."""
    head = F.left(text, F.lit(HEAD_CHARS))

    def count(sep: str) -> Column:
        return F.length(head) - F.length(F.replace(head, F.lit(sep), F.lit("")))

    return F.when(count(";") >= count(","), ";").otherwise(",")


def file_heads(spark: SparkSession, path: str) -> DataFrame:
    """``path, head`` of every file under ``path``, through Spark's own reader and its credentials.

    The head is made of a file's first lines: a line is short, and only the rows of each file's first split are grouped, of
    which a task keeps the first characters.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    placed = lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"), F.left("value", F.lit(HEAD_CHARS)).alias("value")
    ).where("_start = 0")
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("head", T.StringType())])

    def first_lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, size = None, [], 0
        for pdf in frames:
            for name, value in zip(pdf["path"], pdf["value"]):
                if name != now:
                    if now is not None:
                        yield pd.DataFrame({"path": [now], "head": ["\n".join(held)[:HEAD_CHARS]]})
                    now, held, size = name, [], 0
                if size < HEAD_CHARS:
                    held.append(value)
                    size += len(value) + 1
        if now is not None:
            yield pd.DataFrame({"path": [now], "head": ["\n".join(held)[:HEAD_CHARS]]})

    return placed.select("path", "value").mapInPandas(first_lines, schema)


def sniff_files(spark: SparkSession, path: str) -> DataFrame:
    return file_heads(spark, path).select("path", sniff_separator(F.col("head")).alias("separator"))


def _reader(spark: SparkSession, sep: str, encoding: str, multi_line: bool):
    return (
        spark.read.option("sep", sep)
        .option("encoding", {"utf-8-sig": "utf-8"}.get(encoding, encoding))
        .option("multiLine", str(multi_line).lower())
        # A row is judged by all its fields, whichever are read later.
        .option("columnPruning", "false")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
    )


def _texts(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


#: Holds the raw text of a row that does not fit the header.
REJECTED = "_rejected"


def header_names(spark: SparkSession, path: str | Sequence[str], sep: str, encoding: str = "utf-8", multi_line: bool = True) -> list[str]:
    """The column names of the first file, of which only the first record is read."""
    return _reader(spark, sep, encoding, multi_line).option("header", "true").csv(path).columns


def scan_with_rejects(
    spark: SparkSession, path: str | Sequence[str], sep: str, encoding: str = "utf-8", multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Good rows, every column as text, and rejected rows as ``(row)``: nothing is cut off, padded or swapped.

    A row with more or fewer fields than the header is rejected whole. A file whose header differs from that of the first
    file stops the read with an error; use ``scan_folder`` for files of several layouts.
    """
    header = header_names(spark, path, sep, encoding, multi_line)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, REJECTED]])
    raw = _reader(spark, sep, encoding, multi_line).option("header", "true").option("enforceSchema", "false")
    raw = raw.option("columnNameOfCorruptRecord", REJECTED).schema(schema).csv(path)
    # Spark does not answer a query on the reject column alone, so the filters read another one as well.
    other = F.length(F.coalesce(F.col(f"`{header[0]}`"), F.lit(""))) >= 0
    good = raw.where(F.col(REJECTED).isNull() & other).drop(REJECTED)
    bad = raw.where(F.col(REJECTED).isNotNull() & other).select(F.col(REJECTED).alias("row"))
    return _texts(normalise_header(good)), bad


def scan_folder(spark: SparkSession, path: str, encoding: str = "utf-8", multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Good and rejected rows of all files under ``path``, each read with its own separator and header.

    Files of one layout (separator and header line) are read together, so there are as many reads as layouts; columns
    are matched by name, and one that a file lacks is empty. Which layouts there are comes to the driver, the rows do not.
    """
    first = F.regexp_replace(F.element_at(F.split("head", "\\r?\\n"), 1), "^\ufeff", "")
    heads = file_heads(spark, path).select("path", sniff_separator(F.col("head")).alias("sep"), first.alias("header"))
    layouts = heads.groupBy("sep", "header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header", "sep").collect()
    read = [scan_with_rejects(spark, row["paths"], row["sep"], encoding, multi_line) for row in layouts]
    if not read:
        raise ValueError(f"no files below {path}")
    good = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [g for g, _ in read])
    return _texts(good), reduce(DataFrame.unionByName, [b for _, b in read])


def scan_delimited(
    spark: SparkSession, path: str, sep: str, encoding: str = "utf-8", multi_line: bool = True
) -> DataFrame:
    """Every column as text, empty fields as ``""``, nothing taken for missing; a row that does not fit stops the read.

    Quoted line breaks need ``multi_line``, which keeps each file in one task. For large files use ``scan_split``, which reads
    quoted line breaks in splits, or switch it off where there are no such fields.
    """
    good, _ = scan_with_rejects(spark, path, sep, encoding, multi_line)
    return _strict(spark, path, sep, encoding, multi_line, good.columns)


def _strict(spark: SparkSession, path: str, sep: str, encoding: str, multi_line: bool, names: Sequence[str]) -> DataFrame:
    reader = _reader(spark, sep, encoding, multi_line).option("header", "true").option("mode", "FAILFAST")
    return _texts(reader.csv(path).toDF(*names))


def csv_options(sep: str) -> dict[str, str]:
    """Writer options under which ``scan_delimited`` gives back the same texts."""
    return {
        "header": "true",
        "sep": sep,
        "quote": '"',
        "escape": '"',
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def write_by_language(
    df: DataFrame, path: str, lang: str = "lang", order: Sequence[str] | None = None, fmt: str = "csv", sep: str = ";"
) -> None:
    """One directory per target language; a run replaces only the languages it holds."""
    chosen = df if order is None else ordered_projection(df, [*[c for c in order if c != lang], lang])
    writer = chosen.hint("rebalance", lang).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(lang)
    if fmt == "csv":
        for name, value in csv_options(sep).items():
            writer = writer.option(name, value)
    writer.format(fmt).save(path)
