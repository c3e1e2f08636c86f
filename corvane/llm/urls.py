"""Captures judged by dated list entries, by DataFrame functions alone.

An entry puts a pattern on a list from its date on: ``block`` or ``allow``, or takes it off: ``remove``.  A
pattern is a domain, which covers all hosts below it, or a host followed by the first part of the path.  Entries of
a pattern become validity intervals, each ending where the next begins; of several on one date the strictest
counts (block, allow, remove).  Intervals are cut at the ends of months, so a capture meets only the entries of its
own pattern and month, and the as-of join is an equality join that adaptive execution splits where a host is hot.
Of the patterns that cover a capture at its time, the longest decides.

Defined cases: a capture without a url, host or time, or without an active entry, has verdict ``none``; entries
without pattern, date or a known action are ignored; rows that repeat a key column are judged alike and returned as
often; other columns play no part; empty tables give an empty table or verdicts ``none``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
FIRST_PART = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)"
STRENGTH = {"block": 3, "allow": 2, "remove": 1}


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def part_of(url: Column) -> Column:
    return F.regexp_extract(url, FIRST_PART, 1)


def patterns_of(host: str, part: str) -> Column:
    """The host, each domain above it with two labels or more, and the host with the first part of the path."""
    above = f"transform(sequence(1, greatest(size(split({host}, '[.]')) - 1, 1)), i -> array_join(slice(split({host}, '[.]'), i, 1000), '.'))"
    return F.expr(f"case when {host} = '' then array() when {part} = '' then {above} else concat({above}, array(concat({host}, '/', {part}))) end")


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, action, since, until): until is null for the last entry."""
    strength = F.coalesce(*[F.when(F.col("action") == a, F.lit(n)) for a, n in STRENGTH.items()])
    daily = (
        entries.select("pattern", "on", strength.alias("n")).where("pattern is not null and on is not null and n is not null")
        .groupBy("pattern", "on").agg(F.max("n").alias("n"))
    )
    later = F.lead("on").over(Window.partitionBy("pattern").orderBy("on"))
    action = F.coalesce(*[F.when(F.col("n") == n, F.lit(a)) for a, n in STRENGTH.items()])
    return daily.select("pattern", action.alias("action"), F.col("on").alias("since"), later.alias("until")).where("action <> 'remove'")


def verdicts(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (capture_id, url, on) with host, verdict, pattern and the date of the entry that decides."""
    rows = captures.select("capture_id", "on", host_of(F.col("url")).alias("host"), part_of(F.col("url")).alias("part"))
    last = captures.agg(F.max("on").alias("last"))
    month = lambda c: F.trunc(c, "month")
    monthly = (
        intervals(entries).crossJoin(F.broadcast(last))  # one row
        .where(F.col("since") <= F.col("last"))
        .select("*", F.explode(F.expr("sequence(trunc(since, 'month'), trunc(least(coalesce(until, last), last), 'month'), interval 1 month)")).alias("month"))
        .select("pattern", "action", "since", "until", "month")
    )
    asked = (
        rows.where("on is not null and host <> ''").select("host", "part", "on").distinct()
        .select("host", "part", "on", month("on").alias("month"), F.explode(patterns_of("host", "part")).alias("pattern"))
    )
    active = asked.join(monthly, ["pattern", "month"]).where("since <= on and (until is null or on < until)")
    best = active.groupBy("host", "part", "on").agg(F.max_by(F.struct("action", "pattern", "since"), F.length("pattern")).alias("b"))
    return rows.join(best, ["host", "part", "on"], "left").select(
        "capture_id", "on", "host", F.coalesce("b.action", F.lit("none")).alias("verdict"), F.col("b.pattern").alias("pattern"),
        F.col("b.since").alias("listed_on"),
    )
