"""Quoted line breaks read in splits give what one task a file gives."""

import random

import pytest

from glossweave.sources.delimited import csv_options, scan_with_rejects
from glossweave.sources.split_scan import ends_inside, scan_split

SPLITS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


@pytest.fixture
def cut(spark):
    """Sets the size of a split, and restores it."""
    before = {c: spark.conf.get(c) for c in SPLITS}

    def to(size):
        for c in SPLITS:
            spark.conf.set(c, str(size))

    yield to
    for c, value in before.items():
        spark.conf.set(c, value)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size", [20, 300])
def test_split_reads_what_one_task_reads(spark, tmp_path, cut, size):
    draw = random.Random(size)
    piece = ["a", "ä", '"', "\n", ";", " ", "x" * 30, '""', "\n\n", "word"]
    made = [(str(i), "".join(draw.choices(piece, k=draw.randint(0, 12))), draw.choice(["", "t", '"', "q;"])) for i in range(size // 2 + 15)]
    path = str(tmp_path / "table")
    spark.createDataFrame(made, "` id ` string, text string, `tag;` string").repartition(2).write.options(**csv_options(";")).csv(path)
    want, _ = scan_with_rejects(spark, path, ";")
    cut(size)
    got, bad = scan_split(spark, path, ";")
    assert got.columns == ["id", "text", "tag;"] and rows(got) == rows(want) == sorted(made) and bad.count() == 0
    assert got.rdd.getNumPartitions() > 8


@pytest.mark.parametrize("size", [5, 4096])
def test_rejects_headers_and_odd_files(spark, tmp_path, cut, size):
    path = tmp_path / "odd.csv"
    path.write_bytes('﻿"na\r\nme";b\r\n1;"x\r\n\r\ny"\r\n\r\n2\r\n3;4;5\r\n6;in"side\r\n"7""";"";\r\n;\r\n8;"open\r\nto the end'.encode())
    cut(size)
    good, bad = scan_split(spark, str(path), ";", place="at")
    found = good.orderBy("at").drop("at").collect()
    assert good.columns == ["na\nme", "b", "at"]
    assert [tuple(r) for r in found] == [("1", "x\n\ny"), ("6", 'in"side'), ("", ""), ("8", "open\nto the end")]
    assert rows(bad) == [('"7""";"";',), ("2",), ("3;4;5",)]


def test_header_larger_than_a_split_and_several_files(spark, tmp_path, cut):
    for n in (1, 2):
        (tmp_path / f"f{n}.csv").write_text(f'"a\nvery\nlong\nname",b\n{n},"two\nlines"\n')
    cut(4)
    good, _ = scan_split(spark, str(tmp_path), ",")
    assert rows(good) == [("1", "two\nlines"), ("2", "two\nlines")]
    (tmp_path / "f3.csv").write_text("other,b\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        scan_split(spark, str(tmp_path), ",")


def test_encodings(spark, tmp_path, cut):
    (tmp_path / "latin.csv").write_bytes('k;v\n1;"ü\nö"\n'.encode("latin-1"))
    cut(6)
    assert rows(scan_split(spark, str(tmp_path), ";", "iso-8859-1")[0]) == [("1", "ü\nö")]
    with pytest.raises(ValueError, match="multi_line"):
        scan_split(spark, str(tmp_path), ";", "utf-16")


def test_state_at_the_end_of_a_line():
    for line, outside, inside in [
        ("a;b", False, True), ('"a;b', True, False), ('a";b', False, False), ('""', False, True), ('"""', True, False), ('x;"";"y', True, False),
        ('";"', False, True), ("", False, True),
    ]:
        assert (ends_inside(line, False, ";"), ends_inside(line, True, ";")) == (outside, inside), line
