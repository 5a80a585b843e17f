"""Text cleaning, counting, templating and parsing as column expressions."""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that Python's str.strip / str.split recognise. Spelled out because `\s`
# covers fewer characters in the JVM. Once as characters, once as the body of a regex class, and once as a
# class that decides on most characters with one table look-up and one range test.
WHITESPACE_CHARS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
WHITESPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_WORD_GAP = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0\x{1680}\x{2000}-\x{3000}"
    r"&&[^\x{200b}-\x{2027}\x{202a}-\x{202e}\x{2030}-\x{205e}\x{2060}-\x{2fff}]]"
)

# Fixed value: the instruction prefix one embedding model family expects.
QUERY_PREFIX_MODELS = {"intfloat/e5-large-v2": "query: "}


def clean_text(text: Column | str) -> Column:
    """Strip, shorten runs of spaces, drop newlines and lower the case.

    The order matters: pairs of spaces are halved first, left-over triples collapse second, and a
    newline vanishes without leaving a space behind.
    """
    c = strip(text)
    for run in ("  ", "   "):
        c = F.replace(c, F.lit(run), F.lit(" "))
    return F.lower(F.replace(c, F.lit("\n"), F.lit("")))


def strip(text: Column | str) -> Column:
    """Text without white space at either end."""
    return F.btrim(F.col(text) if isinstance(text, str) else text, F.lit(WHITESPACE_CHARS))


def word_count(text: Column | str) -> Column:
    """Number of white-space separated words."""
    return F.size(F.array_remove(F.split(text, _WORD_GAP), ""))


def char_len(text: Column | str) -> Column:
    return F.length(text)


def sentences(text: Column | str) -> Column:
    """Pieces between full stops that hold more than white space, untrimmed."""
    return F.filter(F.split(text, "[.]"), lambda s: strip(s) != "")


def tokens(text: Column | str, stopwords: Iterable[str] = ()) -> Column:
    """Lower-case runs of letters, in order, without stop-words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    stop = sorted(set(stopwords))
    return F.filter(words, lambda w: ~w.isin(stop)) if stop else words


def neighbours(words: str, n: int, names: Sequence[str], whole: bool = True) -> Column:
    """Array of structs of ``n`` neighbouring entries, one per start; fields are called ``names``.

    ``whole`` leaves out starts with fewer than ``n`` entries ahead; otherwise their last fields are null.
    """
    size = F.size(words)
    length = F.greatest(size - F.lit(n - 1), F.lit(0)) if whole else size
    columns = [F.slice(words, F.lit(i + 1), length).alias(name) for i, name in enumerate(names)]
    return F.arrays_zip(*columns)


def ngrams(words: str, n: int) -> Column:
    """Space-joined runs of ``n`` neighbouring entries; empty when there are fewer than ``n``."""
    names = [f"_{i}" for i in range(n)]
    return F.transform(neighbours(words, n, names), lambda g: F.concat_ws(" ", *[g[x] for x in names]))


def fill_template(template: str, params: Mapping[str, Column | str]) -> Column:
    """``str.format`` with column values; the template is parsed once, here.

    Raises KeyError for a placeholder without a parameter.
    """
    parts: list[Column] = []
    for literal, field, _spec, _conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            if field not in params:
                raise KeyError(field)
            value = params[field]
            parts.append((F.col(value) if isinstance(value, str) else value).cast("string"))
    return F.concat(*parts) if parts else F.lit("")


def prefix_text(text: Column | str, model: str) -> Column:
    """Text as the named embedding model wants to see it."""
    c = F.col(text) if isinstance(text, str) else text
    prefix = QUERY_PREFIX_MODELS.get(model, "")
    return F.concat(F.lit(prefix), c) if prefix else c


def parse_reply(reply: Column | str, mode: str = "chat") -> Column:
    """Class number out of a language model's reply.

    ``chat``: the highest ``Label k`` mentioned, 3 when none is. ``general``: the character four
    places from the end. Anything that is not a number becomes null.
    """
    c = F.col(reply) if isinstance(reply, str) else reply
    if mode == "chat":
        found = F.when(c.isNull(), F.lit(None).cast("int"))
        for k in (2, 1, 0):
            found = found.when(c.contains(f"Label {k}"), F.lit(k))
        return found.otherwise(F.lit(3))
    if mode == "general":
        return F.when(F.length(c) >= 4, F.substring(c, -4, 1)).try_cast("int")
    raise ValueError(f"unknown reply mode: {mode}")


def word_pattern(words: Iterable[str]) -> str:
    """Regex that finds any of the words or phrases as whole words, in any script."""
    alternatives = "|".join(re.escape(w) for w in words)
    return rf"(^|[^\p{{L}}])({alternatives})([^\p{{L}}]|$)"


def has_word(text: Column | str, words: Iterable[str]) -> Column:
    """Does any of the words or phrases occur as a whole word?

    A plain substring search goes first: texts without the letters never reach the regex.
    """
    c = F.col(text) if isinstance(text, str) else text
    words = list(words)
    letters = reduce(lambda a, b: a | b, [c.contains(w) for w in words])
    return letters & c.rlike(word_pattern(words))
