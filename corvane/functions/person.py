"""Row-level steps on person tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pseudonym(c: Column, prefix: str, suffix: str) -> Column:
    """SHA-1 hex of the value without blanks between two salts."""
    return F.sha1(F.concat(F.lit(prefix), F.regexp_replace(c, " ", ""), F.lit(suffix)))


def floor_bucket(c: Column, width: float) -> Column:
    """Lower bound of the bucket that holds the value; negative values round down."""
    return (F.floor(c / F.lit(float(width))) * F.lit(width)).cast("bigint")


def date_part(c: Column, index: int = 1, separator: str = "/") -> Column:
    """One part of a date kept as text, as an integer."""
    return F.get(F.split(c, separator), index).cast("int")


def merge_on_token(c: Column, token: str) -> Column:
    """Replace every category that contains the word by the word itself."""
    return F.when(F.array_contains(F.split(c, " "), token), F.lit(token)).otherwise(c)


def override_unless(condition: Column, value: Column, replacement) -> Column:
    """Keep the value where the condition holds, else use the replacement."""
    return F.when(condition, value).otherwise(F.lit(replacement))


def recode_binary(c: Column, zero_value) -> Column:
    """0 for one value, 1 for everything else."""
    return F.when(c == F.lit(zero_value), 0).otherwise(1)


def inverted(label: Column) -> Column:
    return F.lit(1) - label


def thresholded(score: Column, at: float = 0.5) -> Column:
    return (score >= F.lit(at)).cast("int")
