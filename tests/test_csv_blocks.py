"""Quoted CSV cut into blocks of any size gives the records of a reader that sees the whole file."""

import csv
import io
import random

import numpy as np
import pytest
from pyspark.sql.types import StructType
from shoplens.sources import csv_blocks

SCHEMA = StructType().add("a", "integer").add("b", "string").add("c", "double")


def content(rows, end="\n", last=True):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["a", "b", "c"])
    writer.writerows(rows)
    text = out.getvalue()
    return text if last else text[: -len(end)]


def made(count, seed):
    draw = random.Random(seed)
    pieces = ["plain", 'say ""', '"', "\n", ",", "é中", "line\nend", "\n\n", " ", "x,y"]
    return [(i, "".join(draw.choices(pieces, k=draw.randint(1, 5))) + "z", i / 4) for i in range(count)]


@pytest.mark.parametrize("block", [1, 7, 64, 10_000])
@pytest.mark.parametrize("end, last", [("\n", True), ("\r\n", True), ("\n", False)])
def test_blocks_hold_every_record_once(tmp_path, monkeypatch, block, end, last):
    monkeypatch.setattr(csv_blocks, "MORE", 5)
    text = content(made(60, block), end, last)
    path = tmp_path / "t.csv"
    path.write_bytes(text.encode())
    raw, size = text.encode(), len(text.encode())
    found = []
    with csv_blocks.opened(f"file:{path}") as file:
        for start in range(0, size, block):
            inside = bool(raw[:start].count(b'"') & 1)
            found += csv_blocks.block_records(file, start, min(start + block, size), size, inside).to_pylist()
    whole = [next(csv.reader(io.StringIO(r, newline=""))) for r in found]
    assert whole == list(csv.reader(io.StringIO(text, newline="")))


@pytest.mark.parametrize("block", [50, 1 << 20])
def test_rows_equal_the_whole_file_reader(spark, tmp_path, block):
    rows = made(400, 3) + [(400, None, None), (401, "", 1.0)]
    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / "in" / f"p{i}.csv").write_text(content(rows[i::2]), newline="")
    (tmp_path / "in" / "_SUCCESS").write_text("")
    options = {"escape": '"', "mode": "FAILFAST"}
    files = csv_blocks.files_of(spark, str(tmp_path / "in"))
    assert [name.rsplit("/", 1)[1] for name, _ in files] == ["p0.csv", "p1.csv"]
    mine = csv_blocks.read_csv(spark, files, SCHEMA, options, block)
    theirs = spark.read.schema(SCHEMA).options(header=True, multiLine=True, **options).csv(str(tmp_path / "in"))
    assert sorted(map(tuple, mine.collect()), key=repr) == sorted(map(tuple, theirs.collect()), key=repr)
    assert mine.rdd.getNumPartitions() >= (2 if block > 50 else 20)


def test_empty_missing_and_compressed_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "h.csv").write_text("a,b,c\n")
    files = csv_blocks.files_of(spark, str(tmp_path))
    assert csv_blocks.read_csv(spark, files, SCHEMA, {}).count() == 0
    assert not csv_blocks.can_be_cut([("x.csv.gz", 3)])
    with pytest.raises(FileNotFoundError):
        csv_blocks.files_of(spark, str(tmp_path / "none"))


def test_a_broken_value_ends_the_read(spark, tmp_path):
    (tmp_path / "b.csv").write_text("a,b,c\n1,x,not a number\n")
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        csv_blocks.read_csv(spark, csv_blocks.files_of(spark, str(tmp_path / "b.csv")), SCHEMA, {"mode": "FAILFAST"}).collect()
    assert np.array_equal(csv_blocks.record_starts(np.frombuffer(b'a\n"\n"\n', np.uint8), False), [2, 6])
