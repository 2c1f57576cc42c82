"""Constraints over any DataFrame, and the roll-up of their findings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row for each key: the first in input order."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("row")).select(*keys, "row.*").select(*df.columns)


def ordered_union(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """``keys, values``: the different values of each key, in order of first appearance."""
    first = df.groupBy(*keys, value).agg(F.min(F.struct(*order)).alias("at"))
    return first.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", value))), lambda x: x[value]).alias("values"))


def conflicting_values(df: DataFrame, keys: Sequence[str], value: str, position: str) -> DataFrame:
    """Keys with more than one value of what should be single: the values, how many rows, and the first and last position."""
    sums = df.groupBy(*keys).agg(F.sort_array(F.collect_set(value)).alias("values"), F.count(F.lit(1)).alias("n_rows"), F.min(position).alias("first_at"), F.max(position).alias("last_at"))
    return sums.where(F.size("values") > 1)


def unequal_sets(df: DataFrame, key: str, member: str, value: str) -> DataFrame:
    """Keys whose members have different sets of values: how many members and how many different sets."""
    sets = df.groupBy(key, member).agg(F.array_join(F.array_sort(F.collect_set(value)), ",").alias("set"))
    return sets.groupBy(key).agg(F.count(F.lit(1)).alias("n_members"), F.countDistinct("set").alias("n_sets")).where("n_sets > 1")


def repeated_names(df: DataFrame, name: str, position: str) -> DataFrame:
    """Names that occur more than once, with the positions of the first and last; nulls do not count."""
    counts = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("times"), F.min(position).alias("first_at"), F.max(position).alias("last_at"))
    return counts.where("times > 1")


def unreadable(wanted: DataFrame, readable: DataFrame, on: Sequence[str]) -> DataFrame:
    """Wanted columns that the source's catalogue does not list."""
    return wanted.join(readable, list(on), "left_anti")


def alignment(diff: DataFrame, owners: DataFrame, ordered: Column, overlaps: DataFrame | None = None) -> DataFrame:
    """``owner, status, detail`` from :func:`tidemark.operators.schema.column_diff` for every owner.

    Missing and extra columns and overlaps with constants fail; so does order, for owners where ``ordered`` holds; casing warns.
    """
    found = diff.select("owner", "issue", "name")
    if overlaps is not None:
        found = found.union(overlaps.select("owner", F.lit("overlap"), "name"))
    found = owners.join(found, "owner", "left")
    rank = F.when(F.col("issue").isin("missing", "extra", "overlap") | ((F.col("issue") == "order") & ordered), 2).when(F.col("issue") == "casing", 1).otherwise(0)
    detail = F.when(rank > 0, F.concat_ws(": ", "issue", "name"))
    sums = found.groupBy("owner").agg(F.max(rank).alias("rank"), F.array_join(F.array_sort(F.collect_set(detail)), "; ").alias("detail"))
    return sums.select("owner", F.element_at(F.array(F.lit("pass"), F.lit("warn"), F.lit("fail")), F.col("rank") + 1).alias("status"), "detail")


def roll_up(checks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Only a failure fails; a warning passes. A check without a status failed to run, which is a failure."""
    failed = F.coalesce(~F.col("status").isin("pass", "warn"), F.lit(True))
    return checks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_checks"), F.count_if(failed).alias("n_failed"), F.when(F.count_if(failed) > 0, "fail").otherwise("pass").alias("status"))


def target_ready(targets: DataFrame, completed: DataFrame, key: str = "target_key") -> DataFrame:
    """``key, status, detail``: a target with a completed load passes; one without is a warning, as a run will create it."""
    there = completed.select(key, F.lit(True).alias("there")).distinct()
    joined = targets.select(key).distinct().join(there, key, "left")
    return joined.select(key, F.when(F.col("there"), "pass").otherwise("warn").alias("status"), F.when(F.col("there").isNull(), "will be created").alias("detail"))


def counters(lines: DataFrame, key: str, line: str, source: str, part: str | None = None) -> DataFrame:
    """What each target received: rows, bytes with one for each line end, source units and, where rows are packed, parts."""
    parts = [F.countDistinct(part).alias("n_parts")] if part else []
    size = F.sum(F.octet_length(line).cast("long") + 1)
    return lines.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), size.alias("n_bytes"), F.countDistinct(source).alias("n_units"), *parts)
