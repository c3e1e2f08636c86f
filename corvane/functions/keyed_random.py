"""Seeded draws computed from keys, so that a rerun or a lost task gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def uniform(seed: int, *keys: Column | str) -> Column:
    """A draw in [0, 1) fixed by the seed and the keys."""
    parts = [F.lit(str(seed))] + [F.col(k) if isinstance(k, str) else k for k in keys]
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def uniform_sql(seed: int, *keys: str) -> str:
    """The same draw as SQL text."""
    joined = ", ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"(CAST('0x' || substr(md5(concat_ws(':', {joined})), 1, 8) AS BIGINT) / 4294967296.0)"
