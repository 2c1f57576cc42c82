import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks
from tidemark.operators.sinks import Store
from tidemark.plans.audit import Check, audit
from tidemark.plans.run import csv_entry, log_entry, run, table_entry


@pytest.fixture
def events(spark):
    return spark.range(6).select(F.col("id").alias("Id"), (F.col("id") % 2).alias("kind"), F.timestamp_seconds(1_700_000_000 + F.col("id")).alias("At"))


def found(frame):
    return {(r.target_key, r.idx, r.check): (r.status, r.detail) for r in frame.collect()}


def test_every_kind_of_finding(spark, events, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    run(spark, [table_entry(events, "e", ["Id", "kind"], "At", "a", "first")], store)
    (tmp_path / "x.csv").write_text('"kind","Id"\n1,2\n')
    (tmp_path / "mixed").mkdir()
    (tmp_path / "mixed" / "1.csv").write_text("a\n")
    (tmp_path / "mixed" / "2.csv").write_text("b\n")
    catalog = spark.createDataFrame([("T", "Daily", 0, f"{tmp_path}/x.csv", ["kind", "Id"])], "event_type string, interval string, log_date long, path string, field_names array<string>")
    catalog = catalog.withColumn("log_date", F.timestamp_seconds("log_date"))

    def thrown():
        raise OSError

    entries = [
        table_entry(events, "e", ["Id", "kind"], "At", "a", "same"),
        table_entry(events, "e", ["kind", "Id"], "At", "a", "moved"),
        csv_entry(spark, f"{tmp_path}/x.csv", ["kind", "Id"], "a", "file moved"),
        table_entry(events.withColumnRenamed("kind", "KIND"), "e", ["Id", "KIND"], "At", "a", "case"),
        table_entry(events, "e", ["Id"], "At", "a", "short", constants={"more": "1"}),
        table_entry(events, "e", ["Id", "none"], "At", "b"),
        csv_entry(spark, f"{tmp_path}/mixed", ["a"], "b"),
        log_entry(spark, catalog, "o", "U", "Daily", "c"),
        log_entry(spark, catalog, "o", "T", "Daily", "d", constants={"ID": "x"}),
    ]
    got = found(audit(spark, entries, store, more=[Check("z", "own", thrown)]))
    align = {i: got.get((e.target, i, "columns align")) for i, e in enumerate(entries)}
    assert align[0] == align[1] == ("pass", None)
    assert align[2][0] == "fail" and "order" in align[2][1]
    assert align[3][0] == "warn" and "casing" in align[3][1]
    assert align[4] == ("fail", "extra: more; missing: kind")
    assert align[5] is align[6] is align[7] is None and align[8] == ("fail", "overlap: Id")
    assert got["b", 5, "source readable"][0] == "fail" and "none" in got["b", 5, "source readable"][1]
    assert got["b", 6, "source readable"] == ("fail", f"{tmp_path}/mixed has 2 different headers")
    assert got["c", 7, "source readable"] == ("warn", "nothing to read yet")
    assert got["a", None, "target ready"] == ("pass", None) and got["d", None, "target ready"] == ("warn", "will be created")
    assert got["z", None, "own"] == ("fail", "OSError")
    rolled = {r.target_key: r.status for r in checks.roll_up(audit(spark, entries[7:8], store), ["target_key"]).collect()}
    assert rolled == {"c": "pass"}


def test_marks_of_two_sources_and_no_entries(spark, events, tmp_path):
    store = Store(spark, f"{tmp_path}/store")
    got = found(audit(spark, [table_entry(events, "e", ["Id"], "At", "a"), table_entry(events.where("Id > 2"), "e", ["Id"], "At", "b")], store))
    assert got["a", 0, "mark of one source"][0] == got["b", 1, "mark of one source"][0] == "fail"
    assert audit(spark, [], store).count() == 0
