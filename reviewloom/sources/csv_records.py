"""CSV with quoted newlines, read by many tasks per file.

A newline ends a record where an even number of quotes stands before it in its file. Quotes are counted per split,
where the lines lie, and summed over the splits of a file; a split that knows whether it begins inside quotes cuts
its own records. Only what crosses from one split into the next, at most two pieces per split, meets elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.plans.session import cut_lineage

#: Splits that may begin inside quotes; each is one row of a broadcast table.
MAX_OPEN_SPLITS = 500_000

OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}

_SPLIT = ["file", "block"]
# `whole`: a record of its own; `opens`: a piece that begins a record, without it a piece that goes on with one.
_PIECES = "file string, block bigint, opens boolean, whole boolean, heads boolean, record binary"
_ARROW = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("opens", pa.bool_()), ("whole", pa.bool_()), ("heads", pa.bool_()), ("record", pa.binary())]
)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return spark.read.option("lineSep", "\n").text(path).select(*place, "value")


def _open_splits(lines: DataFrame) -> DataFrame:
    """``(file, block, odd)`` per split, stored: does it begin inside quotes? A file that ends inside some is refused."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    counted = cut_lineage(lines.groupBy(*_SPLIT).agg(F.sum(quotes).alias("quotes")), "quotes")
    torn = counted.groupBy("file").agg((F.sum("quotes") % 2).alias("odd")).filter("odd = 1").select("file").first()
    if torn:
        raise ValueError(f"{torn['file']} ends inside quotes")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = counted.select(*_SPLIT, (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("odd"))
    return cut_lineage(splits, "splits")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Stretches of one split within a batch; lines of a split come in their order."""
    n = batch.num_rows
    if not n:
        return
    file, block = batch.column("file"), batch.column("block")
    change = pc.or_(pc.not_equal(file.slice(1), file.slice(0, n - 1)), pc.not_equal(block.slice(1), block.slice(0, n - 1)))
    edges = [0, *(np.flatnonzero(change.to_numpy(zero_copy_only=False)) + 1).tolist(), n]
    yield from zip(edges, edges[1:])


def _cut(want_whole: bool):
    """Lines in, records out (or the pieces that cross splits, and headers); holds one unfinished record at a time."""

    def piece(split, opens, first, parts, whole=False):
        row = [split[0], split[1], opens, whole, first and split[1] == 0, b"\n".join(parts)]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the split at hand: lines of an unfinished record, whether it began here, records begun so far.
        split, held, began, begun, odd = None, [], False, 0, False
        for batch in batches:
            for low, high in _runs(batch):
                here = (batch.column("file")[low].as_py(), batch.column("block")[low].as_py())
                if here != split:
                    if held and not want_whole:
                        yield piece(split, began, began and begun == 1, held)
                    odd = batch.column("odd")[low].as_py()
                    split, held, began, begun = here, [], False, 0
                lines = batch.column("value").slice(low, high - low)
                quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
                after = (np.cumsum(quotes) + odd) % 2 == 1
                before = np.concatenate(([odd], after[:-1]))
                odd = bool(after[-1])
                starts = np.flatnonzero(~before)
                # What goes on with an unfinished record, up to the first line that begins a new one.
                lead = int(starts[0]) if len(starts) else len(lines)
                if lead:
                    held += lines.slice(0, lead).to_pylist()
                if not len(starts):
                    continue
                if held:
                    if began and (want_whole or (begun == 1 and split[1] == 0)):
                        yield piece(split, True, begun == 1, held, whole=True)
                    elif not began and not want_whole:
                        yield piece(split, False, False, held)
                    held = []
                ends = np.append(starts[1:], len(lines))
                last = len(starts) - 1 if odd else len(starts)
                if last and not want_whole and begun == 0 and split[1] == 0:
                    yield piece(split, True, True, lines.slice(0, int(ends[0])).to_pylist(), whole=True)
                if last and want_whole:
                    offsets = pa.array(np.append(starts[:last], ends[last - 1]).astype(np.int32))
                    records = pc.binary_join(pa.ListArray.from_arrays(offsets, lines), pa.scalar(b"\n", pa.binary()))
                    heads = np.zeros(last, dtype=bool)
                    heads[0] = begun == 0 and split[1] == 0
                    yes = pa.array(np.ones(last, dtype=bool))
                    place = [pa.repeat(pa.scalar(split[0], pa.string()), last), pa.repeat(pa.scalar(split[1], pa.int64()), last)]
                    yield pa.RecordBatch.from_arrays([*place, yes, yes, pa.array(heads), records], schema=_ARROW)
                begun += len(starts)
                began = odd
                if odd:
                    held = lines.slice(int(starts[-1])).to_pylist()
        if held and not want_whole:
            yield piece(split, began, began and begun == 1, held)

    return work


def _crossing(pieces: DataFrame) -> DataFrame:
    """Records put together from the pieces that lie in several splits."""
    order = Window.partitionBy("file").orderBy("block", "opens")
    origin = F.last(F.when(F.col("opens"), F.col("block")), ignorenulls=True).over(order)
    parts = F.array_sort(F.collect_list(F.struct("block", F.col("record").cast("string").alias("text"))))
    joined = pieces.withColumn("_origin", origin).groupBy("file", "_origin").agg(parts.alias("parts"), F.bool_or("heads").alias("heads"))
    return joined.select("heads", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("record"))


def _plain(records: DataFrame) -> DataFrame:
    return records.select("heads", F.regexp_replace("record", r"\r\z", "").alias("record"))


def csv_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    r"""Records of CSV files and the distinct headers, each a ``record`` column with the text.

    Records end at ``\n`` or ``\r\n`` outside quotes; inside quotes a quote is doubled and newlines stay as they are.
    Empty lines behind the header are left out. Quotes may stand around whole fields only: one inside a plain field
    would shift everything behind it, and a file that ends inside quotes is refused. The files are read twice here
    (quotes, pieces across splits) and once per use of the result. Compressed files cannot be split and are one task
    each.
    """
    lines = _lines(spark, path)
    splits = _open_splits(lines)
    if splits.count() > MAX_OPEN_SPLITS:
        raise ValueError(f"more than {MAX_OPEN_SPLITS} splits: raise spark.sql.files.maxPartitionBytes")
    # A split without a match was cut differently in the meantime: stop rather than cut records at the wrong place.
    odd = F.coalesce("odd", F.raise_error(F.lit("the files or their splits have changed")).cast("boolean")).alias("odd")
    known = lines.join(F.broadcast(splits), _SPLIT, "left").select(*_SPLIT, F.col("value").cast("binary").alias("value"), odd)
    pieces = cut_lineage(known.mapInArrow(_cut(False), _PIECES), "pieces")
    text = F.col("record").cast("string").alias("record")
    crossing = _plain(_crossing(pieces.filter("not whole")))
    headers = _plain(pieces.filter("whole").select("heads", text)).unionByName(crossing.filter("heads"))
    whole = _plain(known.mapInArrow(_cut(True), _PIECES).select("heads", text))
    body = whole.unionByName(crossing).filter("not heads and record <> ''")
    return body.select("record"), headers.select("record").distinct()


def read_csv_split(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The rows of ``formats.read_csv`` with many tasks per file; see ``csv_records``.

    All files must have one header, in their first record. Columns follow it in order; without a schema every column
    is text, named as there. Files without any line give no rows, and without a schema no columns.
    """
    records, found = csv_records(spark, path)
    headers = [r["record"] for r in found.limit(2).collect()]
    if len(headers) > 1:
        raise ValueError("files with different headers")
    if schema is None:
        names = _names(spark, headers[0].removeprefix("\ufeff")) if headers else []
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        if not names:
            return spark.createDataFrame([], schema)
    return records.select(F.from_csv("record", _ddl(schema), OPTIONS).alias("_row")).select("_row.*")


def _names(spark: SparkSession, header: str) -> list[str]:
    """Fields of a header line."""
    many = ", ".join(f"c{i} string" for i in range(header.count(",") + 1))
    row = spark.range(1).select(F.from_csv(F.lit(header), many, OPTIONS).alias("r")).first()["r"]
    fields = [v for v in row if v is not None]
    if len(set(fields)) < len(fields):
        raise ValueError(f"repeated column names: {header}")
    return fields


def _ddl(schema: T.StructType | str) -> str:
    if isinstance(schema, str):
        return schema
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
