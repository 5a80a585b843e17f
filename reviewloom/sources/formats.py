"""Files other than Parquet: generated reviews, CSV and plain lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.scores import decode_json_string, json_string


def read_generated(spark: SparkSession, path: str, text_col: str = "text", label_col: str | None = None) -> DataFrame:
    """Generated reviews, one JSON string literal per line, optionally labelled positive.

    Blank lines are skipped. A line that is not a string literal gives a null text and keeps its content in
    ``bad_line``, for quarantine.
    """
    text = decode_json_string("value")
    out = (
        spark.read.text(path)
        .filter(F.trim("value") != "")
        .select(text.alias(text_col), F.when(text.isNull(), F.col("value")).alias("bad_line"))
    )
    return out.withColumn(label_col, F.lit(1)) if label_col else out


def write_generated(df: DataFrame, path: str, text_col: str = "text") -> None:
    """Texts as one JSON string literal per line."""
    df.select(json_string(text_col).alias("value")).write.text(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header, quoted newlines and doubled quotes. Without a schema every column is text."""
    reader = spark.read.options(header=True, multiLine=True, quote='"', escape='"')
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    options = {"header": True, "quote": '"', "escape": '"', "quoteAll": True, "emptyValue": '""'}
    options.update(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    df.write.options(**options).csv(path)


def write_lines(df: DataFrame, col: str, path: str) -> None:
    r"""One text per line; backslashes, newlines and carriage returns inside a text become escapes."""
    c = F.col(col)
    for plain, escape in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(plain), F.lit(escape))
    df.filter(F.col(col).isNotNull()).select(c.alias("value")).write.text(path)


def read_lines(spark: SparkSession, path: str, col: str = "text") -> DataFrame:
    """Texts written by ``write_lines``."""
    # Between escaped backslashes every remaining backslash starts an escape.
    def plain(piece):
        return F.replace(F.replace(piece, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    c = F.array_join(F.transform(F.split("value", r"\\\\"), plain), "\\")
    return spark.read.text(path).select(c.alias(col))
