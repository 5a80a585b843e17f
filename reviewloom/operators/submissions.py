"""Raw submissions: a JSON payload per row, with dates and an array of ratings."""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.operators.tables import fix_timeline

# The questions whose ratings become columns.
RATING_QUESTIONS = ("10001", "10002", "10003", "10004", "10005")

RATINGS_TYPE = "array<struct<Question:string,Rating:string>>"


def infer_payload_schema(df: DataFrame, col: str) -> str:
    """DDL of a JSON column, merged over all payloads by one aggregate. Pass a schema to save this pass."""
    shape = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(col)))).first()[0]
    shape = re.sub(r"(^|: |ARRAY<)OBJECT<", r"\1STRUCT<", shape)
    return re.sub(r"(: |ARRAY<)VOID(?=[,>])", r"\1STRING", shape)


def unpack_json(df: DataFrame, col: str, schema: T.StructType | str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Columns of a JSON payload next to the ``keep`` columns; an unreadable payload gives nulls."""
    schema = schema if schema is not None else infer_payload_schema(df, col)
    return df.select(*keep, F.from_json(col, schema).alias("_payload")).select(*keep, "_payload.*")


def rating_of(ratings: Column | str, question: str) -> Column:
    """Last rating given to a question, null when it was not answered."""
    c = F.col(ratings) if isinstance(ratings, str) else ratings
    answers = F.filter(c, lambda r: r["Question"].cast("string") == question)
    return F.try_element_at(answers, F.lit(-1))["Rating"]


def pivot_ratings(df: DataFrame, col: str = "Ratings", questions: Sequence[str] = RATING_QUESTIONS) -> DataFrame:
    """One ``Q_<question>`` column per question, worked out in place without a shuffle."""
    return df.withColumns({f"Q_{q}": rating_of(col, q) for q in questions})


def load_submissions(
    df: DataFrame,
    payload: str = "Data",
    schema: T.StructType | str | None = None,
    keep: Sequence[str] = (),
    sort: bool = True,
) -> DataFrame:
    """Unpack, drop removed submissions, fix the dates (newest first) and unpack the ratings.

    Submissions without a status stay, unreadable payloads as rows of nulls. A payload is parsed once: removed ones go
    before they are laid out as rows, where a filter on a column would be pushed below the parse and repeat it.
    """
    schema = schema if schema is not None else infer_payload_schema(df, payload)
    staying = F.filter(F.array(F.from_json(payload, schema)), lambda p: ~p["Status"].eqNullSafe(F.lit("Removed")))
    out = df.select(*keep, F.inline(staying))
    out = pivot_ratings(out, "Ratings")
    return fix_timeline(out, "DateSubmitted", sort=sort)
