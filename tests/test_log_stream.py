"""The data source of event logs, against the files that it reads."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.times import Bounds
from tidemark.operators.sinks import Store, read_state
from tidemark.plans.run import log_source_entry, run
from tidemark.sources import log_stream, logs, tables

CATALOG = "event_type string, interval string, log_date string, path string, field_names array<string>"
DAYS = [f"2024-01-0{n}T00:00:00Z" for n in range(1, 10)]


@pytest.fixture
def files(tmp_path):
    texts = {"a": 'X,Y\r\n1,"two\nlines ""q"""\r\n\r\n3,\r\n4,""\r\n', "b": "﻿Y,X,Z\nq,p,z\n", "c": "X,Y\n", "d": "", "e": '"X"\n5\n', "f": "Other\nx\n"}
    names = {"a": ["X", "Y"], "b": ["Y", "X", "Z"], "c": ["X", "Y"], "d": ["X"], "e": ["X"], "f": ["Other"]}
    for name, text in texts.items():
        (tmp_path / f"{name} %20é.csv").write_bytes(text.encode())
    return [("Login", "Daily", DAYS[n], f"{tmp_path}/{name} %20é.csv", names[name]) for n, name in enumerate(texts)]


def _catalog(spark, rows, path, kind="timestamp", mode="append"):
    spark.createDataFrame(rows, CATALOG).withColumn("log_date", F.col("log_date").cast(kind)).coalesce(2).write.mode(mode).parquet(path)
    return path


def _read(df):
    return sorted((r.X or "-", "-" if r.Y is None else r.Y, r.Z or "-", r.day) for r in df.withColumn("day", F.dayofmonth(tables.MARK)).collect())


ALL = [("-", "-", "-", 6), ("1", 'two\nlines "q"', "-", 1), ("3", "-", "-", 1), ("4", "-", "-", 1), ("5", "-", "-", 5), ("p", "q", "z", 2)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_dates_of_any_kind_in_any_zone(spark, tmp_path, files, kind, zone):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = _catalog(spark, files, f"{tmp_path}/catalog", kind)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = log_stream.log_frame(spark, path, "Login", "Daily", ["X", "Y"], Bounds(end=DAYS[4]), mark=DAYS[0])
        assert sorted((r.X, r.t) for r in got.select("X", F.unix_seconds(tables.MARK).alias("t")).collect()) == [(x, int(datetime(2024, 1, n, tzinfo=UTC).timestamp())) for x, n in (("5", 5), ("p", 2))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_files_come_once_each_whatever_the_tasks(spark, tmp_path, files):
    others = [("Login", "Hourly", DAYS[0], "none", ["X"]), ("Other", "Daily", DAYS[0], "none", ["X"]), ("Login", "Daily", None, "none", ["X"]), (None, None, DAYS[0], "none", ["X"])]
    path = _catalog(spark, [*files, *others], f"{tmp_path}/catalog")
    for per_task in (1, 2, 64):
        got = log_stream.log_frame(spark, path, "Login", "Daily", ["X", "Y", "Z"], files_per_task=per_task)
        assert _read(got) == ALL
    assert log_stream.log_frame(spark, path, "None", "Daily", ["X"]).collect() == []
    twice = _catalog(spark, [files[4], files[4][:2] + (DAYS[6],) + files[4][3:]], f"{tmp_path}/twice", mode="overwrite")
    found = log_stream.log_frame(spark, twice, "Login", "Daily", ["X"]).select(F.dayofmonth(tables.MARK)).collect()
    assert len(found) in (1, 2) and max(found)[0] == 7
    empty = _catalog(spark, [], f"{tmp_path}/empty")
    assert log_stream.log_frame(spark, empty, "Login", "Daily", ["X"]).collect() == []


def test_starts_are_included_and_marks_are_not(spark, tmp_path, files):
    path = _catalog(spark, files, f"{tmp_path}/catalog")
    days = lambda **window: [r[3] for r in _read(log_stream.log_frame(spark, path, "Login", "Daily", ["X", "Y", "Z"], **window))]
    assert sorted(days(bounds=Bounds(start=DAYS[1]))) == [2, 5, 6]
    assert sorted(days(mark=DAYS[1])) == [5, 6]
    assert sorted(days(bounds=Bounds(start=DAYS[0], end=DAYS[1]), mark=DAYS[4])) == [1, 1, 1, 2]


def test_what_a_catalog_does_not_say_fails(spark, tmp_path, files):
    wrong = _catalog(spark, [files[0][:4] + (["X", "Z"],)], f"{tmp_path}/wrong")
    with pytest.raises(Exception, match="its catalog"):
        log_stream.log_frame(spark, wrong, "Login", "Daily", ["X"]).collect()
    (tmp_path / "ragged.csv").write_text("X,Y\n1\n")
    ragged = _catalog(spark, [("Login", "Daily", DAYS[0], f"{tmp_path}/ragged.csv", ["X", "Y"])], f"{tmp_path}/ragged")
    with pytest.raises(Exception, match="columns"):
        log_stream.log_frame(spark, ragged, "Login", "Daily", ["X"]).collect()
    with pytest.raises(Exception, match="needs the options"):
        spark.read.format(log_stream.FORMAT).load()


def test_agrees_with_the_scan_by_the_driver(spark, tmp_path, files):
    path = _catalog(spark, files[:3], f"{tmp_path}/catalog")
    theirs = logs.scan_log_files(spark, spark.read.parquet(path), "Login", "Daily")
    assert _read(log_stream.log_frame(spark, path, "Login", "Daily", ["X", "Y", "Z"])) == _read(theirs)


def test_runs_load_listed_files_once(spark, tmp_path, files):
    catalog, store = f"{tmp_path}/catalog", Store(spark, f"{tmp_path}/store")
    late = "2024-01-06T00:00:00.000007Z"

    def load(*rows, **window):
        _catalog(spark, rows, catalog)
        got = run(spark, [log_source_entry(spark, catalog, "o", "Login", "Daily", ["X", "Y"], "t")], store, Bounds(**window)).first()
        return got.status, got.rows, got.units, got.mark and got.mark[:10]

    assert load() == ("skipped", 0, None, None)
    assert log_source_entry(spark, catalog, "o", "Login", "Daily", ["X", "Y"], "t").names() is None
    assert load(*files[:3], end=DAYS[1]) == ("processed", 4, 2, "2024-01-02")
    assert load() == ("processed", 0, 1, "2024-01-03")
    assert load(*files[3:5], files[5][:2] + (late,) + files[5][3:]) == ("processed", 2, 3, "2024-01-06")
    assert load() == ("skipped", 0, None, None)
    assert sorted((r.X or "-") for r in store.read("t").collect()) == ["-", "1", "3", "4", "5", "p"]
    assert read_state(store).first().watermark_raw == late
    assert log_source_entry(spark, catalog, "o", "Login", "Daily", ["X", "Y"], "t").names() == ["X", "Y"]


def test_a_stream_goes_on_from_its_mark(spark, tmp_path, files):
    catalog, out, checkpoint = (f"{tmp_path}/{n}" for n in ("catalog", "out", "checkpoint"))

    def batch(*rows):
        _catalog(spark, rows, catalog)
        stream = log_stream.log_stream(spark, catalog, "Login", "Daily", ["X", "Y", "Z"])
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
        return _read(spark.read.schema(stream.schema).parquet(out))

    assert batch() == []
    assert batch(*files[:2]) == ALL[1:4] + ALL[5:]
    assert batch() == ALL[1:4] + ALL[5:]
    assert batch(files[0], *files[3:]) == ALL  # the first listed again, not after the mark
    newest = sorted((tmp_path / "checkpoint" / "offsets").iterdir(), key=lambda p: int(p.name) if p.name.isdigit() else -1)[-1]
    assert json.loads(newest.read_text().splitlines()[-1])["micros"] == int(datetime(2024, 1, 6, tzinfo=UTC).timestamp()) * 1_000_000
