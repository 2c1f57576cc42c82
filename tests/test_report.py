import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks
from tidemark.plans import catalogue, report

ENTRY = "idx int, name string, kind string, source_org string, object string, event_type string, interval string, csv_path string, date_field string, target_org string, target_dataset string, target_file string, operation string, override_metadata boolean, start string, end string"


def entries(spark, *rows):
    df = spark.createDataFrame(list(rows), ENTRY)
    return df.withColumns({"start_ts": F.col("start").cast("timestamp"), "end_ts": F.col("end").cast("timestamp")}).drop("start", "end")


def state(spark, *rows):
    return spark.createDataFrame(list(rows), "watermark_key string, watermark_raw string").withColumn("watermark_ts", F.col("watermark_raw").cast("timestamp"))


def test_plan_report(spark):
    day = lambda d: f"2024-01-{d:02d}T00:00:00Z"
    rows = entries(
        spark,
        (0, None, "elf", "a", None, "Login", "Daily", None, None, "hub", "one", None, "Append", False, None, None),
        (1, "mine", "sobject", "a", "Account", None, None, None, "At", "hub", "two", None, "Append", True, day(5), day(9)),
        (2, None, "csv", None, None, None, None, "/x.csv", None, None, None, "/out.csv", "Append", False, day(5), None),
        (3, None, "sobject", "b", "Account", None, None, None, "At", "hub", "two", None, "Append", False, None, None),
    )
    got = {r.idx: r for r in report.plan_report(rows, state(spark, ("mine", day(7)), ("b:sobject:Account", day(3))), spark.createDataFrame([("org:hub:two",)], "target_key string")).collect()}
    assert (got[0].target_key, got[0].mark, got[0].effective, got[0].note, got[0].warning) == ("org:hub:one", "(none)", None, "BOOTSTRAP", "FIRST_RUN_ELF")
    assert (got[1].mark, got[1].effective, got[1].note, got[1].warning) == (day(7), f"At >= {day(5)} AND At <= {day(9)}", "OVERRIDE", "REWIND")
    assert (got[2].target_key, got[2].mark, got[2].effective, got[2].note, got[2].warning) == ("file:/out.csv", "n/a", None, None, None)
    assert (got[3].mark, got[3].effective, got[3].note, got[3].warning) == (day(3), f"At > {day(3)}", None, None)
    assert not report.without_effect(rows).first()[0] and report.without_effect(rows.where("kind = 'csv'")).first()[0]
    with pytest.raises(Exception, match="must not be empty"):
        rows.withColumn("target_org", F.lit("")).select(report.target_key()).collect()


def test_row_counts(spark):
    rows = spark.createDataFrame([("a", d) for d in range(1, 11)] + [("b", 1)], "object string, d int").withColumn("At", F.expr("timestamp_seconds(1700000000 + d * 60)"))
    at = lambda d: F.expr(f"timestamp_seconds(1700000000 + {d} * 60)")
    none = F.lit(None).cast("timestamp")
    one = lambda key, obj, s, e, m: spark.range(1).select(F.lit(key).alias("watermark_key"), F.lit(obj).alias("object"), s.alias("start_ts"), e.alias("end_ts"), m.alias("watermark_ts"))
    plans = one("mark", "a", none, none, at(4)).union(one("rewind", "a", at(3), at(8), at(5))).union(one("gap", "a", at(8), none, at(5))).union(one("empty", "c", none, none, none)).union(one("all", "b", none, none, none))
    got = {r.watermark_key: tuple(r)[1:] for r in report.row_counts(rows, plans, "object", "At").collect()}
    assert got == {"mark": (6, 0, 0, 1), "rewind": (6, 3, 0, 1), "gap": (3, 0, 2, 1), "empty": (0, 0, 0, 0), "all": (1, 0, 0, 0)}


@pytest.mark.parametrize(
    ("statuses", "want"),
    [
        (["processed", "processed"], ("processed", 2, 20)), (["processed", "failed"], ("failed", 2, 0)), (["failed", "skipped"], ("failed", 1, 0)), (["processed", "skipped"], ("processed", 1, 10)),
        (["skipped"], ("skipped", 0, 0)), (["failed", "failed"], ("failed", 2, 0)),
    ],
)
def test_outcomes(spark, statuses, want):
    rows = spark.createDataFrame([("t", s, 10) for s in statuses], "target_key string, status string, rows long")
    got = report.outcomes(rows)
    assert tuple(got.first())[1:] == want
    status = report.exit_status(got).first().exit_status
    assert status == (0 if "failed" not in statuses else 2)


def test_counters_and_readiness(spark):
    lines = spark.createDataFrame([("t", "ab", "f1", 0), ("t", "é", "f2", 1), ("u", "", "f1", 0)], "target string, line string, file string, part int")
    assert sorted(tuple(r) for r in checks.counters(lines, "target", "line", "file", "part").collect()) == [("t", 2, 6, 2, 2), ("u", 1, 1, 1, 1)]
    got = checks.target_ready(lines, lines.where("target = 'u'"), "target")
    assert sorted((r.target, r.status) for r in got.collect()) == [("t", "warn"), ("u", "pass")]


def test_a_missing_org_is_an_error(spark, tmp_path):
    spark.createDataFrame([(1, "FRANCE")], "n_nationkey int, n_name string").write.parquet(str(tmp_path / "nation.parquet"))
    spark.createDataFrame([(7, 1), (8, 2)], "s_suppkey int, s_nationkey int").write.parquet(str(tmp_path / "supplier.parquet"))
    with pytest.raises(Exception, match="missing org: 2"):
        catalogue.augment_lookup(spark, str(tmp_path)).collect()


def test_counts_of_many_entries_over_one_key(spark):
    """A thousand windows over one source, whose dates tie, against a count of each; rows without dates and keys, and entries without rows."""
    rng = random.Random(2)
    dates = [rng.choice([None, *range(50)]) for _ in range(3000)]
    rows = spark.createDataFrame([("a", d, 1) for d in dates] + [("b", 3, 1), (None, 4, 1), ("c", None, 1)], "key string, n int, at int").withColumn("When", F.timestamp_seconds("n")).drop("n").repartition(6)
    pick = lambda: rng.choice([None, rng.randrange(-2, 53)])
    windows = [(f"k{i}", rng.choice("aaaaabcd"), pick(), pick(), pick()) for i in range(1000)] + [("none", None, 1, 2, 3)]
    entries = spark.createDataFrame(windows, "watermark_key string, key string, s int, t int, m int")
    entries = entries.select("watermark_key", "key", *[F.timestamp_seconds(c).alias(n) for c, n in (("s", "start_ts"), ("t", "end_ts"), ("m", "watermark_ts"))])
    held = {"a": dates, "b": [3], "c": [None]}
    want = set()
    for name, key, s, t, m in windows:
        own = held.get(key, [])
        inside = lambda d: (d >= s if s is not None else d > m if m is not None else True) and (t is None or d <= t)  # noqa: B023, E731
        load = sum(inside(d) if d is not None else s is None and t is None and m is None for d in own)
        known = [d for d in own if d is not None]
        again = sum(s <= d <= m and (t is None or d <= t) for d in known) if s is not None and m is not None else 0
        gap = sum(m < d < s for d in known) if s is not None and m is not None else 0
        want.add((name, load, again, gap, known.count(m) if m is not None else 0))
    assert {tuple(r) for r in report.row_counts(rows, entries, "key", "When").collect()} == want
