"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode-aware strip removes.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0        "
    "        　"
)
_WORD_BREAK = "\u0001 "


def col(name: str) -> Column:
    """Column by exact name, hyphens and dots included."""
    return F.col(f"`{name}`")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the other letters.

    ``initcap`` starts a word only after a space, so a marked space is put after each
    non-letter and taken out again: no lambda, the whole expression stays in generated code.
    """
    marked = F.regexp_replace(c, r"([^\p{Lu}\p{Ll}\p{Lt}])", "$1" + _WORD_BREAK)
    return F.replace(F.initcap(marked), F.lit(_WORD_BREAK), F.lit(""))


def bin_column(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin that holds the value; null outside the edges."""
    out = F.when(c <= edges[0], F.lit(None).cast("string"))
    for high, label in zip(edges[1:], labels, strict=True):
        out = out.when(c <= high, label)
    return out


def label_rank(c: Column, labels: Sequence[str]) -> Column:
    """Position of a bin label in its declared order, for sorting; null goes last."""
    out = F.when(c.isNull(), len(labels))
    for i, label in enumerate(labels):
        out = out.when(c == label, i)
    return out


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0, null included."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def to_number(c: Column) -> Column:
    """Numeric value or null; text that is no number, or spells NaN, is null."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def normalise_nulls(c: Column, tokens: Sequence[str]) -> Column:
    return F.when(~c.isin(list(tokens)), c)


def percent(part: Column, whole: Column, scale: float, digits: int) -> Column:
    """``part * scale / whole`` rounded half up; null when ``whole`` is 0."""
    return F.round(F.try_divide(part.cast("double") * F.lit(float(scale)), whole.cast("double")), digits)


def hash_unit(key: Column, seed: int) -> Column:
    """Repeatable number in [0, 1) from a key: 52 bits of an MD5, the same on every engine."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
