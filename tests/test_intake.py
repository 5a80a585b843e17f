"""A stream of submissions with resent ones, restarts and repeated batches."""

import os
import pathlib

import pytest
from pyspark.sql import functions as F

from reviewloom.sources.registry import Registry
from reviewloom.streaming import intake

SCHEMA = "id long, text string"


class Feed:
    """A folder that files are dropped into, and the dataset that the stream fills."""

    def __init__(self, spark, home):
        self.spark, self.home, self.files = spark, pathlib.Path(home), 0
        (self.home / "in").mkdir()
        self.registry = Registry(spark, f"{home}/registry")

    def send(self, rows, at=None):
        part = self.home / f"part{self.files}"
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(part))
        target = self.home / "in" / f"{self.files}.parquet"
        next(part.glob("*.parquet")).rename(target)
        when = 1_700_000_000 + (self.files if at is None else at)
        os.utime(target, (when, when))
        self.files += 1

    def run(self, within="7 days"):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        # One byte a batch: one file each.
        stream = intake.first_arrivals(intake.read_arrivals(self.spark, f"{self.home}/in", schema, max_bytes=1), "id", within)
        intake.keep_versions(stream, self.registry, "s", f"{self.home}/cp", available_now=True).awaitTermination()

    def forget_last_commit(self):
        folder = self.home / "cp" / "commits"
        last = max(int(p.name) for p in folder.glob("[0-9]*"))
        os.remove(folder / str(last))
        os.remove(folder / f".{last}.crc")

    def rows(self):
        kept = self.registry.read_versions("s", self.registry.versions("s"))
        return sorted((tuple(r) for r in kept.select("id", "text").collect()), key=str)


@pytest.fixture
def feed(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield Feed(spark, tmp_path)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_resent_rows_appear_once(feed):
    feed.send([(1, "a"), (2, "b"), (2, "b"), (None, "x"), (None, "x"), (None, "y"), (3, None)])
    feed.send([(2, "changed"), (4, "d"), (None, "x")])
    feed.run()
    first = [(1, "a"), (2, "b"), (3, None), (4, "d"), (None, "x"), (None, "y")]
    assert feed.rows() == first
    # After a restart the state is still there.
    feed.send([(1, "a"), (4, "d"), (5, "e"), (None, "y"), (None, None)])
    feed.run()
    assert feed.rows() == sorted(first + [(5, "e"), (None, None)], key=str)
    feed.run()
    assert len(feed.rows()) == 8


def test_forgotten_after_a_while(feed):
    feed.send([(1, "a")], at=0)
    feed.send([(2, "b")], at=3600)
    feed.send([(3, "c")], at=3700)
    feed.send([(1, "again"), (3, "c")], at=3800)
    feed.run(within="10 minutes")
    assert feed.rows() == [(1, "a"), (1, "again"), (2, "b"), (3, "c")]


def test_batches_run_again(feed):
    """A driver that dies before a batch is committed writes it once, whether its version was finished or not."""
    feed.send([(1, "a")])
    feed.send([(2, "b")])
    feed.run()
    expected, versions = feed.rows(), feed.registry.versions("s")
    feed.forget_last_commit()
    feed.run()
    assert feed.rows() == expected and feed.registry.versions("s")[: len(versions)] == versions
    feed.forget_last_commit()
    last = feed.registry.versions("s")[-1]
    os.remove(feed.home / "registry" / "s" / f"version={last}" / "_SUCCESS")
    assert last not in feed.registry.versions("s")
    feed.run()
    assert feed.rows() == expected and last in feed.registry.versions("s")


def test_batch_is_noted_once(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    df = spark.range(3)
    assert registry.write_dataset(df, "d") == 1
    assert registry.write_batch(df, "d", "q", 0) == 2
    assert registry.write_batch(df.limit(1), "d", "q", 0) == 2
    assert registry.write_batch(df.limit(0), "d", "r", 0) == 3
    assert registry.read_versions("d", [2, 3]).agg(F.count("id")).first()[0] == 3
