"""Planning over a table of entries: keys, marks, warnings, row counts and the plan report, for any number of entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.scratch import written
from tidemark.functions.times import as_instant, bounds_class, first_run_class, utc_text
from tidemark.plans.keys import mark_key_column


def target_key() -> Column:
    org = F.when(F.col("target_org") == "", F.raise_error(F.lit("target_org must not be empty")).cast("string")).otherwise(F.col("target_org"))
    return F.when(org.isNotNull(), F.concat_ws(":", F.lit("org"), org, "target_dataset")).otherwise(F.concat(F.lit("file:"), F.col("target_file")))


def watermark_key() -> Column:
    """The key of an entry's mark, as runs derive it."""
    return mark_key_column()


def with_marks(entries: DataFrame, state: DataFrame) -> DataFrame:
    """Each entry with its stored mark, if any."""
    return entries.join(state.select("watermark_key", "watermark_raw", "watermark_ts"), "watermark_key", "left")


def classified(entries: DataFrame) -> DataFrame:
    """Add ``warning`` to entries with ``start_ts, end_ts, watermark_ts, kind, operation``."""
    first = first_run_class(F.col("start_ts"), F.col("end_ts"), F.col("watermark_ts"), F.col("kind"))
    met = bounds_class(F.col("start_ts"), F.col("end_ts"), F.col("watermark_ts"), F.col("operation") == "Append")
    return entries.withColumn("warning", F.coalesce(F.when(F.col("kind") != "csv", met), first))


def cumulative(rows: DataFrame, points: DataFrame) -> DataFrame:
    """``key, at, below, upto``: for each of ``points(key, at)`` how many of ``rows(key, at)`` of its key lie before it, and up to it.

    Rows are counted by key and date before anything moves. Counts and points are then dealt to slices by ranges of both, summed within a slice
    and moved on by the sums of the slices before, so neither many points nor a key that holds most rows costs more than one pass.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy("key", "at").agg(F.count(F.lit(1)).alias("n")).withColumn("asked", F.lit(0))
    both = counts.union(points.distinct().select("key", "at", F.lit(0).cast("long"), F.lit(1)))
    both = both.groupBy("key", "at").agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))
    dealt = written(both.repartitionByRange(n, "key", "at").withColumn("slice", F.spark_partition_id()))
    inside = Window.partitionBy("key", "slice").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("key", "slice").agg(F.sum("n").alias("total")).select("key", "slice", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    summed = dealt.withColumn("own", F.sum("n").over(inside)).where("asked = 1").join(bases, ["key", "slice"])
    return summed.select("key", "at", (F.col("base") + F.col("own") - F.col("n")).alias("below"), (F.col("base") + F.col("own")).alias("upto"))


def row_counts(rows: DataFrame, entries: DataFrame, key: str, date: str) -> DataFrame:
    """For each entry: rows to load, loaded again, left in the gap, and on the boundary.

    ``rows`` meet entries on ``key``; any number of entries may share one, for rows are counted at the ends of their windows, once for all
    entries, and what lies between two ends is a difference. Rows without a date are loaded by entries without bounds and mark. Entries
    without rows count 0.
    """
    micros = lambda c: F.unix_micros(c).alias(c)
    e = written(entries.select("watermark_key", F.col(key).alias("key"), *map(micros, ("start_ts", "end_ts", "watermark_ts"))))
    never = F.lit(2**63 - 1)  # where rows without a date are counted
    at = F.coalesce(F.unix_micros(as_instant(F.col(date), rows.schema[date].dataType)), never).alias("at")
    own = rows.select(F.col(key).alias("key"), at).join(e.select("key").distinct(), "key", "left_semi")
    points = e.select("key", F.explode(F.array("start_ts", "end_ts", "watermark_ts", never)).alias("at")).where("at is not null and key is not null")
    ends = written(cumulative(own, points))
    found = e.join(ends.where(F.col("at") == never).select("key", F.col("below").alias("dated"), (F.col("upto") - F.col("below")).alias("undated")), "key", "left")
    for name, column in (("s", "start_ts"), ("t", "end_ts"), ("m", "watermark_ts")):
        found = found.join(ends.select("key", F.col("at").alias(column), F.col("below").alias(f"{name}_below"), F.col("upto").alias(f"{name}_upto")), ["key", column], "left")
    s, t, m = (F.col(c).isNotNull() for c in ("start_ts", "end_ts", "watermark_ts"))
    every, zero = F.coalesce("dated", F.lit(0)), F.lit(0)
    first = F.when(s, F.col("s_below")).when(m, F.col("m_upto")).otherwise(zero)
    load = F.greatest(zero, F.when(t, F.col("t_upto")).otherwise(every) - first) + F.when(s | t | m, zero).otherwise(F.coalesce("undated", zero))
    again = F.when(s & m, F.greatest(zero, F.least("m_upto", "t_upto") - F.col("s_below")))  # a missing end does not bound
    gap = F.when(s & m, F.greatest(zero, F.col("s_below") - F.col("m_upto")))
    sums = {"n_load": load, "n_again": again, "n_gap": gap, "n_boundary": F.col("m_upto") - F.col("m_below")}
    return found.groupBy("watermark_key").agg(*[F.coalesce(F.sum(c), zero).cast("long").alias(n) for n, c in sums.items()])


def plan_report(entries: DataFrame, state: DataFrame, existing: DataFrame) -> DataFrame:
    """What a run would do, one row for each entry: ``idx, target_key, mark, effective, note, warning``.

    ``existing(target_key)`` are the targets with a completed load. A target without one is to be created; one whose metadata is to be
    overridden is to be replaced.
    """
    e = with_marks(entries.withColumn("target_key", target_key()).withColumn("watermark_key", watermark_key()), state)
    e = classified(e).join(existing.select("target_key", F.lit(True).alias("there")).distinct(), "target_key", "left")
    date = F.when(F.col("kind") == "elf", "LogDate").otherwise(F.col("date_field"))
    lower = F.when(F.col("start_ts").isNotNull(), F.concat(date, F.lit(" >= "), utc_text(F.col("start_ts")))).when(
        F.col("watermark_ts").isNotNull(), F.concat(date, F.lit(" > "), F.col("watermark_raw"))
    )
    upper = F.when(F.col("end_ts").isNotNull(), F.concat(date, F.lit(" <= "), utc_text(F.col("end_ts"))))
    table = F.col("kind") != "csv"
    note = F.when(F.col("target_org").isNull(), None).when(F.col("there").isNull(), "BOOTSTRAP").when(F.col("override_metadata"), "OVERRIDE")
    return e.select(
        "idx", "target_key",
        F.when(table, F.coalesce("watermark_raw", F.lit("(none)"))).otherwise("n/a").alias("mark"),
        F.when(table, F.nullif(F.concat_ws(" AND ", lower, upper), F.lit(""))).alias("effective"),
        note.alias("note"), "warning",
    )


def outcomes(results: DataFrame) -> DataFrame:
    """``target_key, status, n_entries, n_rows`` from one row for each entry with ``target_key, status, rows``.

    One failed entry fails its target; else one processed entry makes it processed; else it was skipped. Skipped entries do not count.
    """
    failed, processed = F.count_if(F.col("status") == "failed"), F.count_if(F.col("status") == "processed")
    return results.groupBy("target_key").agg(
        F.when(failed > 0, "failed").when(processed > 0, "processed").otherwise("skipped").alias("status"),
        F.count_if(F.col("status") != "skipped").alias("n_entries"),
        F.when(failed > 0, F.lit(0)).otherwise(F.coalesce(F.sum(F.when(F.col("status") == "processed", F.col("rows"))), F.lit(0))).cast("long").alias("n_rows"),
    )


def exit_status(targets: DataFrame) -> DataFrame:
    """One row: entries processed and failed, targets written, and 0 for no failure, 1 for some, 2 for nothing but failures."""
    processed = F.coalesce(F.sum(F.when(F.col("status") == "processed", F.col("n_entries"))), F.lit(0))
    failed = F.coalesce(F.sum(F.when(F.col("status") == "failed", F.col("n_entries"))), F.lit(0))
    return targets.agg(
        processed.alias("processed"), failed.alias("failed"), F.count_if(F.col("status") == "processed").alias("targets_written"),
        F.when(failed == 0, 0).when(processed > 0, 1).otherwise(2).alias("exit_status"),
    )


def high_water_marks(rows: DataFrame, keys: Sequence[str], date: str, size: Column) -> DataFrame:
    """``keys, mark, n_rows, n_bytes``: the newest date of each key, and its counters."""
    return rows.groupBy(*keys).agg(F.max(date).alias("mark"), F.count(F.lit(1)).alias("n_rows"), F.sum(size.cast("long")).alias("n_bytes"))


def without_effect(entries: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Whether bounds are set for entries that are all CSV files, which are always read in full: one row in all, or for each of ``keys``."""
    bounded = F.max((F.col("start_ts").isNotNull() | F.col("end_ts").isNotNull()).cast("int")) == 1
    return entries.groupBy(*keys).agg(F.coalesce(bounded & F.every(F.col("kind") == "csv"), F.lit(False)).alias("without_effect"))
