"""Delimited files with quoted line breaks, read in parallel.

Whether a line break ends a record depends on all quotes before it, so Spark reads such a file in one task. Here each split
of a file is read for both possibilities, starting inside a quoted field and outside one; what that leads to is a function
of two states. Composed from the start of the file on, the functions tell in which state each split really starts, and the
splits are then cut into records independently. Records that cross splits are put together from the pieces. Fields are
parsed by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossweave.operators.ordering import broadcast_if_small
from glossweave.operators.schema import normalise_header
from glossweave.session import materialise
from glossweave.sources.delimited import REJECTED, header_names

#: Encodings in which a line feed, a quote and a separator are single bytes that occur in no other character.
ENCODINGS = ("utf-8", "utf-8-sig", "iso-8859-1", "windows-1252")
#: Splits that start inside a field are broadcast up to this many, about 200 bytes each, and joined by a shuffle beyond.
BROADCAST_SPLITS = 200_000

# The rest of a quoted field and the quote that ends it; a doubled quote stands for one.
_REST = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether the end of a line is inside a quoted field. A quote opens a field only where the field starts."""
    at = 0
    while True:
        if inside:
            rest = _REST.match(line, at)
            if not rest:
                return True
            at, inside = rest.end(), False
        at = line.find('"', at)
        if at < 0:
            return False
        inside = at == 0 or line.startswith(sep, at - len(sep))
        at += 1


def lines_of(spark: SparkSession, path: str | Sequence[str], encoding: str) -> DataFrame:
    """``file, start, line``: the lines of each split in order, ``start`` being the first byte of the split."""
    if encoding.lower() not in ENCODINGS:
        raise ValueError(f"{encoding} cannot be cut into lines by bytes; use scan_delimited with multi_line")
    raw = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    value = F.col("value") if encoding.lower().startswith("utf-8") else F.decode(F.col("value").cast("binary"), encoding)
    return raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), value.alias("line")
    )


class _Outcome:
    """What a split gives if it starts ``inside`` a field or not: the end of the record before, and the open one at its end."""

    def __init__(self, inside: bool):
        self.inside, self.closed = inside, not inside
        self.head: list[str] = []
        self.tail: list[str] = []
        self.number, self.first = 0, None

    def add(self, line: str, sep: str) -> None:
        """Take the next line; records that are whole in the split are only counted, but for the first."""
        self.inside = ends_inside(line, self.inside, sep)
        if not self.closed:
            self.head.append(line)
            self.closed = not self.inside
            return
        self.tail.append(line)
        if not self.inside:
            record = _record(self.tail)
            self.tail = []
            if record:
                self.first = record if self.first is None else self.first
                self.number += 1


def _record(lines: list[str]) -> str:
    """The text of a record: line breaks are line feeds, and the last one is not part of it."""
    return "\n".join(line.removesuffix("\r") for line in lines)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """The lines of a batch by (file, start), in order."""
    files, starts, lines = (batch.column(c).to_pylist() for c in ("file", "start", "line"))
    first = 0
    for i in range(1, len(lines) + 1):
        if i == len(lines) or (files[i], starts[i]) != (files[first], starts[first]):
            yield (files[first], starts[first]), lines[first:i]
            first = i


def split_outcomes(lines: DataFrame, sep: str) -> DataFrame:
    """One row per split: where it leads from either state, and the pieces of records that cross its ends."""
    piece = "struct<inside: boolean, head: string, tail: string, number: long>"
    schema = f"file string, start long, first string, out {piece}, inn {piece}"
    arrow = pa.struct([("inside", pa.bool_()), ("head", pa.string()), ("tail", pa.string()), ("number", pa.int64())])

    def told(outcome: _Outcome) -> dict:
        head, tail = ("\n".join(held) if held else None for held in (outcome.head, outcome.tail))
        return {"inside": outcome.inside, "head": head, "tail": tail, "number": outcome.number}

    def row(key: tuple[str, int], both: tuple[_Outcome, _Outcome]) -> pa.RecordBatch:
        first = both[0].first if key[1] == 0 else None
        sides = [pa.array([told(o)], arrow) for o in both]
        known = [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([first], pa.string())]
        return pa.RecordBatch.from_arrays([*known, *sides], ["file", "start", "first", "out", "inn"])

    def outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, both = None, None
        for batch in batches:
            for key, held in _runs(batch):
                if key != now:
                    if now is not None:
                        yield row(now, both)
                    now, both = key, (_Outcome(False), _Outcome(True))
                for line in held:
                    for outcome in both:
                        outcome.add(line, sep)
        if now is not None:
            yield row(now, both)

    return lines.mapInArrow(outcomes, schema)


def split_states(outcomes: DataFrame) -> DataFrame:
    """The outcomes with ``entered``: whether the split starts inside a field.

    A split keeps the state, turns it, or fixes it; the state at a split is that of the last fixing one before it, turned
    as often as splits between turn it. The start of a file counts as one that fixes "outside".
    """
    fixes = F.when(F.col("out.inside") == F.col("inn.inside"), F.col("out.inside"))
    turns = (F.col("out.inside") & ~F.col("inn.inside")).cast("int")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    placed = outcomes.withColumns({"fixes": fixes, "turns": turns})
    placed = placed.withColumn("turned", F.coalesce(F.sum("turns").over(before), F.lit(0)))
    # A fixing split turns nothing, so the count at it is also the one after it.
    fixed = F.last(F.when(F.col("fixes").isNotNull(), F.struct("fixes", "turned")), ignorenulls=True).over(before)
    placed = placed.withColumn("fixed", fixed)
    since = F.col("turned") - F.coalesce("fixed.turned", F.lit(0))
    odd = F.pmod(since, F.lit(2)) == 1
    return placed.withColumn("entered", F.coalesce("fixed.fixes", F.lit(False)) != odd).drop("fixes", "turns", "turned", "fixed")


def crossing_records(states: DataFrame) -> DataFrame:
    """``file, start, no, record``: records that cross splits, placed at the end of the split in which they start."""
    was = F.when(F.col("entered"), F.col("inn")).otherwise(F.col("out"))
    end = F.struct(F.lit(False).alias("opens"), F.col("was.head").alias("text"), F.lit(None).cast("bigint").alias("no"))
    begin = F.struct(F.lit(True).alias("opens"), F.col("was.tail").alias("text"), F.col("was.number").alias("no"))
    pieces = states.select("file", "start", was.alias("was")).select("file", "start", F.inline(F.array(end, begin))).where(F.col("text").isNotNull())
    order = Window.partitionBy("file").orderBy("start", "opens").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("crossing", F.sum(F.col("opens").cast("int")).over(order))
    grouped = numbered.groupBy("file", "crossing").agg(
        F.min("start").alias("start"), F.max("no").alias("no"), F.array_sort(F.collect_list(F.struct("start", "opens", "text"))).alias("parts")
    )
    # A line feed between two pieces belongs to a field, the last carriage return does not.
    record = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    record = F.regexp_replace(F.replace(record, F.lit("\r\n"), F.lit("\n")), "\r$", "")
    return grouped.select("file", "start", "no", record.alias("record"))


def inner_records(lines: DataFrame, states: DataFrame, sep: str) -> DataFrame:
    """``file, start, no, record``: the records that lie in one split."""
    inside = states.where("entered").select("file", "start", F.lit(True).alias("entered"))
    number = inside.count()
    numbered = lines.withColumn("at", F.monotonically_increasing_id())
    placed = numbered.join(broadcast_if_small(inside, number, BROADCAST_SPLITS), ["file", "start"], "left")
    if number > BROADCAST_SPLITS:
        placed = placed.repartition("file", "start").sortWithinPartitions("file", "start", "at")
    schema = "file string, start long, no long, record string"

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number, inside, skip, held = None, 0, False, False, []
        for batch in batches:
            entered, at = batch.column("entered"), 0
            for key, lines in _runs(batch):
                if key != now:
                    inside = skip = bool(entered[at].as_py())
                    now, number, held = key, 0, []
                at += len(lines)
                found = []
                for line in lines:
                    inside = ends_inside(line, inside, sep)
                    if skip:
                        skip = inside
                        continue
                    held.append(line)
                    if not inside:
                        record, held = _record(held), []
                        if record:
                            found.append(record)
                numbers = pa.array(range(number, number + len(found)), pa.int64())
                number += len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key[0]] * len(found), pa.string()), pa.array([key[1]] * len(found), pa.int64()), numbers, pa.array(found, pa.string())],
                    ["file", "start", "no", "record"],
                )

    return placed.select("file", "start", "line", "entered").mapInArrow(records, schema)


def scan_split(
    spark: SparkSession, path: str | Sequence[str], sep: str, encoding: str = "utf-8", place: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Good rows, every column as text, and rejected rows as ``(row)``, as ``scan_with_rejects`` reads them, in splits.

    Records end at a line feed outside quotes; ``\\r\\n`` becomes ``\\n``, also inside a field. Empty lines are no records,
    and a field that no quote ends takes the rest of its file. All files must have the same header. With ``place`` good
    rows also get a column of this name (file, split, number) that sorts them as they are in the files; without it they
    come in no certain order.

    The text is read twice: once for the outcome of each split, of which one row is written, and once for the records. A
    record larger than a split is put together in one task.
    """
    names = header_names(spark, path, sep, encoding)
    lines = lines_of(spark, path, encoding)
    states = materialise(split_states(materialise(split_outcomes(lines, sep), "split-outcomes")), "split-states")
    crossing = crossing_records(states)
    first = (F.col("start") == 0) & (F.col("no") == 0)
    headers = states.where("first IS NOT NULL").select("first").unionByName(crossing.where(first).select(F.col("record").alias("first")))
    if headers.select(F.regexp_replace("first", "^\ufeff", "")).distinct().limit(2).count() > 1:
        raise ValueError(f"files below {path} have different headers; use scan_folder")

    records = inner_records(lines, states, sep).unionByName(crossing).where(~first)
    quoted = [f"`{c.replace('`', '``')}`" for c in [*names, REJECTED]]
    options = {"sep": sep, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    row = F.from_csv("record", ", ".join(f"{c} string" for c in quoted), {**options, "columnNameOfCorruptRecord": REJECTED})
    parsed = records.select(row.alias("row"), F.struct("file", F.col("start").alias("split"), F.col("no").alias("number")).alias("at"))
    fields = [F.coalesce(F.col("row")[c], F.lit("")).alias(c) for c in names]
    good = parsed.where(F.col("row")[REJECTED].isNull()).select(*fields, *([F.col("at").alias(place)] if place else []))
    return normalise_header(good), parsed.where(F.col("row")[REJECTED].isNotNull()).select(F.col("row")[REJECTED].alias("row"))
