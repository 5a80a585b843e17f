"""Score responses: JSON in and out, class names and severity."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names of the three-way safeguarding rule and their severity.
SEVERITY = {"No safeguarding": 0, "Possibly Concerning": 1, "Strongly Concerning": 2}


def json_string(text: Column | str) -> Column:
    """A JSON string literal holding the text."""
    wrapped = F.to_json(F.struct(F.col(text).alias("v") if isinstance(text, str) else text.alias("v")))
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)  # what {"v":...} holds


def decode_json_string(literal: Column | str) -> Column:
    """Text of a JSON string literal; null when the line is not one."""
    c = F.col(literal) if isinstance(literal, str) else literal
    stripped = F.btrim(c, F.lit(" \t\r\n"))
    is_literal = stripped.startswith('"') & stripped.endswith('"') & (F.length(stripped) > 1)
    return F.when(is_literal, F.get_json_object(F.concat(F.lit('{"v":'), stripped, F.lit("}")), "$.v"))


def encode_score(label: Column | str, probability: Column | str, double_encoded: bool = False) -> Column:
    """``{"0": class, "1": probability}`` with both values as strings, optionally quoted once more."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    payload = F.to_json(
        F.struct(as_col(label).cast("string").alias("0"), as_col(probability).cast("string").alias("1"))
    )
    return json_string(payload) if double_encoded else payload


def decode_score(payload: Column | str) -> Column:
    """``struct(label, probability)`` from a response that was JSON-encoded once or twice."""
    c = F.col(payload) if isinstance(payload, str) else payload
    once = F.coalesce(decode_json_string(c), c)
    parsed = F.from_json(once, "`0` string, `1` string")
    return F.struct(
        parsed["0"].alias("label"), parsed["1"].try_cast("double").alias("probability")
    )


def lookup(value: Column | str, mapping: Mapping) -> Column:
    """Literal dictionary lookup; null for a value that is not in the dictionary."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    c = F.col(value) if isinstance(value, str) else value
    return F.try_element_at(F.create_map(*pairs), c)


def severity(class_name: Column | str) -> Column:
    """2 for strongly concerning, 1 for possibly concerning, 0 for anything else."""
    c = F.col(class_name) if isinstance(class_name, str) else class_name
    return F.coalesce(lookup(c, SEVERITY), F.lit(0))
