"""CSV cut at any byte gives the rows of a reader that sees whole files."""

import csv
import io
import os
import random

import pytest

from reviewloom.sources.csv_records import read_csv_split
from reviewloom.sources.formats import read_csv

FIELDS = ["plain", "two\nlines", 'a "quoted" word', "\n\n\n", "comma, here", '"', '""\n"', "ü ß 漢字", " padded ", "x" * 90, "a\r\nb", "\n" * 70, ""]


@pytest.fixture
def small_splits(spark):
    """Splits of some 40 bytes, so that records cross one or several of them."""
    keys = {"spark.sql.files.maxPartitionBytes": "41", "spark.sql.files.openCostInBytes": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "3"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _expected(rows):
    """Empty fields are read as null."""
    return [(i, t or None, n or None) for i, t, n in rows]


def _sorted(rows):
    return sorted(rows, key=str)


def _write(folder, name, rows, end="\n", header=("id", "text", "note")):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(header)
    writer.writerows(rows)
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(out.getvalue().encode())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_across_splits(spark, tmp_path, small_splits, end):
    draw = random.Random(5)
    rows = {f: [(1000 * f + i, draw.choice(FIELDS), draw.choice(FIELDS)) for i in range(20)] for f in range(2)}
    for f, some in rows.items():
        _write(tmp_path / "in", f"{f}.csv", some, end)
    got = read_csv_split(spark, str(tmp_path / "in"), "id int, text string, note string")
    assert _sorted(map(tuple, got.collect())) == _sorted(_expected(sum(rows.values(), [])))
    # More tasks than files, so the files were really cut.
    assert spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > 10


def test_same_as_whole_files(spark, tmp_path, small_splits):
    draw = random.Random(9)
    rows = [(i, draw.choice(FIELDS), draw.choice(FIELDS)) for i in range(25)]
    _write(tmp_path / "in", "a.csv", rows)
    path = str(tmp_path / "in")
    ours, theirs = read_csv_split(spark, path), read_csv(spark, path)
    assert ours.columns == theirs.columns == ["id", "text", "note"]
    assert _sorted(map(tuple, ours.collect())) == _sorted(map(tuple, theirs.collect()))


def test_header_over_several_splits(spark, tmp_path, small_splits):
    header = ("id", "long\n" * 30, "b")
    _write(tmp_path / "in", "a.csv", [(1, "x", "y")], header=header)
    _write(tmp_path / "in", "b.csv", [(2, "x", "y\ny")], header=header)
    got = read_csv_split(spark, str(tmp_path / "in"), "id int, a string, b string")
    assert _rows(got) == [(1, "x", "y"), (2, "x", "y\ny")]


def test_many_lines_in_one_record(spark, tmp_path):
    """One record over many batches, in one split and over several."""
    rows = [(1, "line\n" * 30_000, "n"), (2, "b", "c")]
    _write(tmp_path / "in", "a.csv", rows)
    path = str(tmp_path / "in")
    assert _rows(read_csv_split(spark, path, "id int, text string, note string")) == rows
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert _rows(read_csv_split(spark, path, "id int, text string, note string")) == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_odd_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = str(tmp_path / "in")
    (tmp_path / "in" / "empty.csv").write_bytes(b"")
    assert read_csv_split(spark, path, "a int, b string").collect() == []
    (tmp_path / "in" / "head.csv").write_bytes(b"a,b")
    assert read_csv_split(spark, path, "a int, b string").collect() == []
    (tmp_path / "in" / "rows.csv").write_bytes(b'a,b\n\n1,x\n\n2,"y\n\nz"\nbad,\n3')
    got = read_csv_split(spark, path, "a int, b string").collect()
    assert _sorted(map(tuple, got)) == _sorted([(1, "x"), (2, "y\n\nz"), (None, None), (3, None)])
    (tmp_path / "in" / "other.csv").write_bytes(b"a,c\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        read_csv_split(spark, path)
    os.remove(tmp_path / "in" / "other.csv")
    (tmp_path / "in" / "torn.csv").write_bytes(b'a,b\n1,"x\n')
    with pytest.raises(ValueError, match="inside quotes"):
        read_csv_split(spark, path)
