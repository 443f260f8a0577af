"""Scalar functions of the format as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zigzag(v: Column) -> Column:
    return F.when(v >= 0, v * 2).otherwise(v * -2 - 1)


def unzigzag(z: Column) -> Column:
    return F.shiftrightunsigned(z, 1).bitwiseXOR(-z.bitwiseAND(F.lit(1).cast("long")))


def unscaled(v: Column, scale: int) -> Column:
    """A double as an integer at a scale; rounded first, since casts truncate."""
    return F.round(v * 10**scale).cast("long")


def fixed_text(v: Column, scale: int) -> Column:
    """Fixed-point text of an unscaled integer; the point is always printed."""
    digits = F.lpad(F.abs(v).cast("string"), F.greatest(F.length(F.abs(v).cast("string")), F.lit(scale + 1)), F.lit("0"))
    cut = F.length(digits) - scale
    return F.concat(F.when(v < 0, "-").otherwise(""), F.substring(digits, F.lit(1), cut), F.lit("."), F.substring(digits, cut + 1, F.lit(scale)))


def byte_plane(v: Column, plane: int) -> Column:
    return F.shiftright(v, 8 * plane).bitwiseAND(F.lit(255).cast("long"))


def coordinate_text(v: Column) -> Column:
    """Ten-millionths of a degree as the shortest text."""
    return F.regexp_replace(F.regexp_replace(fixed_text(v, 7), "0+$", ""), r"\.$", "")


def epoch_text(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def quoted(v: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))


def template_of(v: Column, hole: str = "<*>") -> Column:
    return F.regexp_replace(v, "[0-9]+", hole)


def holes_of(v: Column) -> Column:
    return F.regexp_extract_all(v, F.lit("[0-9]+"), 0)


def filled(template: Column, values: Column, hole: str = "<*>") -> Column:
    """A template with its holes filled from left to right; values that lack are empty."""
    parts = F.split(template, hole.replace("*", r"\*"), -1)
    return F.array_join(F.transform(parts, lambda p, i: F.concat(F.when(i > 0, F.coalesce(F.get(values, i - 1), F.lit(""))).otherwise(""), p)), "")


def safe_path(name: Column) -> Column:
    return ~name.rlike(r"^$|^/|\\|:|(^|/)(\.\.)?(/|$)")
