from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.times import Bounds
from tidemark.operators.schema import document_fields
from tidemark.operators.sinks import Store, _Files, read_state, write_state
from tidemark.plans import report
from tidemark.plans import run as runs
from tidemark.plans.run import Entry, csv_entry, log_entry, run, table_entry
from tidemark.sources.tables import MARK
from tidemark.streaming.tail import StoreTarget, TailTarget, read_target, tail, tail_into


@pytest.fixture
def events(spark):
    return spark.range(40).select(F.col("id").cast("int").alias("Id"), (F.col("id") % 4).alias("kind"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 3600).alias("At"))


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"{tmp_path}/store")


def marks(store):
    return {r.watermark_key: r.watermark_raw for r in read_state(store).collect()}


def outcomes(results):
    return {(r.target_key, r.watermark_key): (r.status, r.rows) for r in results.collect()}


def test_second_run_loads_only_what_is_new(spark, events, store):
    entry = lambda df: [table_entry(df, "events", ["Id", "At"], "At", "t")]
    assert outcomes(run(spark, entry(events.where("Id < 10")), store)) == {("t", "sobject:events"): ("processed", 10)}
    first = marks(store)
    assert outcomes(run(spark, entry(events.where("Id < 10")), store)) == {("t", "sobject:events"): ("skipped", 0)}
    assert marks(store) == first and store.version("t")[0] == 1
    assert outcomes(run(spark, entry(events), store)) == {("t", "sobject:events"): ("processed", 30)}
    assert sorted(r.Id for r in store.read("t").collect()) == list(range(40))


def test_a_full_load_is_the_union_of_windows(spark, events, store):
    at = lambda n: f"2023-11-{14 + (22 * 3600 + 800 + n * 3600) // 86400:02d}T{(22 * 3600 + 800 + n * 3600) % 86400 // 3600:02d}:13:20Z"
    for lo, hi in ((0, 9), (10, 24), (25, 60)):
        run(spark, [table_entry(events, "events", ["Id"], "At", "t")], store, Bounds(at(lo), at(hi)))
    assert sorted(r.Id for r in store.read("t").collect()) == list(range(40))


def test_a_failed_entry_fails_its_target_alone(spark, events, store):
    bad = events.withColumn("Id", F.when(F.col("Id") == 7, F.raise_error(F.lit("broken row")).cast("int")).otherwise(F.col("Id")))
    entries = [
        table_entry(events, "good", ["Id"], "At", "both", "a"), table_entry(bad, "bad", ["Id"], "At", "both", "b"),
        table_entry(events, "good", ["Id"], "At", "own", "c"), table_entry(events, "gone", ["Nope"], "At", "none", "d"),
    ]
    results = run(spark, entries, store)
    assert {k: v[0] for k, v in outcomes(results).items()} == {("both", "a"): "failed", ("both", "b"): "failed", ("own", "c"): "processed", ("none", "d"): "failed"}
    assert store.read("both") is None and store.read("own").count() == 40 and set(marks(store)) == {"c"}
    targets = report.outcomes(results)
    assert {r.target_key: (r.status, r.n_entries, r.n_rows) for r in targets.collect()} == {"both": ("failed", 2, 0), "own": ("processed", 1, 40), "none": ("failed", 1, 0)}
    assert tuple(report.exit_status(targets).first()) == (1, 3, 1, 1)


def test_targets_keep_their_order_and_can_be_replaced(spark, events, store):
    run(spark, [table_entry(events, "e", ["Id", "kind"], "At", "t", constants={"Org": "a"})], store)
    run(spark, [table_entry(events, "e", ["KIND", "id"], "At", "t", "again", constants={"ORG": "b"}, operation="Overwrite")], store)
    assert store.read("t").columns == ["Id", "kind", "Org"] and {r.Org for r in store.read("t").collect()} == {"b"}
    got = run(spark, [table_entry(events, "e", ["Id"], "At", "t", "third")], store)
    assert got.first().status == "failed" and "missing" in got.first().problem
    run(spark, [table_entry(events, "e", ["Id"], "At", "t", "third", operation="Overwrite", override_metadata=True)], store)
    assert store.read("t").columns == ["Id"]


def test_shared_scans_and_source_units(spark, events, store):
    calls = []

    def scan(bounds, mark):
        calls.append(mark)
        return events.where("kind = 9").select("Id", F.col("At").alias(MARK))

    entries = [Entry(t, f"k{t}", scan, ("one",)) for t in "abc"] + [Entry("d", "kd", lambda b, m: None, kind="elf"), Entry("e", "ke", lambda b, m: events.where("Id < 0").select("Id", F.col("At").alias(MARK)), kind="csv")]
    got = outcomes(run(spark, entries, store))
    assert len(calls) == 1 and [got[t, f"k{t}"][0] for t in "abcde"] == ["skipped"] * 4 + ["processed"]
    assert set(marks(store)) == {"ke"}


def test_logs_without_rows_move_the_mark(spark, store, tmp_path):
    (tmp_path / "a b.csv").write_text("X,Y\n1,2\n")
    (tmp_path / "h%20.csv").write_text("X,Y\n")
    catalog = lambda *days: spark.createDataFrame(
        [("Login", "Daily", f"2024-01-0{d}T00:00:00Z", f"{tmp_path}/{name}", ["X", "Y"]) for d, name in days], "event_type string, interval string, log_date string, path string, field_names array<string>"
    ).withColumn("log_date", F.col("log_date").cast("timestamp"))
    entry = lambda c: [log_entry(spark, c, "o", "Login", "Daily", "t")]
    first = run(spark, entry(catalog((1, "a b.csv"))), store).first()
    assert (first.status, first.rows, first.units, first.mark) == ("processed", 1, 1, "2024-01-01T00:00:00.000000Z")
    both = catalog((1, "a b.csv"), (2, "h%20.csv"))
    second = run(spark, entry(both), store).first()
    assert (second.status, second.rows, second.units, second.mark) == ("processed", 0, 1, "2024-01-02T00:00:00.000000Z")
    assert run(spark, entry(both), store).first().status == "skipped" and store.read("t").count() == 1


def test_csv_files_are_read_in_full_each_time(spark, store, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,2\n\n3,4\n")
    entries = [csv_entry(spark, f"{tmp_path}/in.csv", ["a", "b"], "t")]
    for n in (2, 4):
        assert run(spark, entries, store, Bounds(end="2000-01-01T00:00:00Z")).first().status == "processed" and store.read("t").count() == n


def test_oldest_rows_of_a_run_can_take_ties(spark, events, store):
    same = events.withColumn("At", F.date_trunc("day", "At"))
    n = same.where(F.col("At") == same.agg(F.min("At")).first()[0]).count()
    assert run(spark, [table_entry(same, "e", ["Id"], "At", "t", limit=1, with_ties=True)], store).first().rows == n


def test_targets_with_like_names_are_apart_and_types_stay(spark, events, store):
    for target, ids in (("org:x:größe", "Id < 3"), ("org:x:grüße", "Id >= 3"), ("org:x~C3", "Id < 1")):
        run(spark, [table_entry(events.where(ids), "e", ["Id"], "At", target, target)], store)
    assert [store.read(t).count() for t in ("org:x:größe", "org:x:grüße", "org:x~C3")] == [3, 37, 1]
    text = events.withColumn("Id", F.col("Id").cast("string"))
    got = run(spark, [table_entry(text, "e", ["Id"], "At", "org:x:größe", "other")], store).first()
    assert got.status == "failed" and "Id is string, not int" in got.problem and store.read("org:x:größe").count() == 3
    run(spark, [table_entry(text, "e", ["Id"], "At", "org:x:größe", "more", operation="Overwrite")], store)
    assert dict(store.read("org:x:größe").dtypes) == {"Id": "string"}


def test_rows_without_dates_fail(spark, events, store):
    undated = events.withColumn("At", F.lit(None).cast("timestamp"))
    assert run(spark, [table_entry(undated, "e", ["Id"], "At", "t")], store).first().status == "failed" and store.read("t") is None


def test_tail_loads_each_file_once(spark, tmp_path):
    target = TailTarget(f"{tmp_path}/out", ["b", "Org", "A"], {"Org": "o"})
    other = TailTarget(f"{tmp_path}/other", ["a"])
    (tmp_path / "in").mkdir()
    for n, text in enumerate(("a,b\n1,x\n2,y\n", "a,b\n3,z\n", None)):
        if text:
            (tmp_path / "in" / f"{n}.csv").write_text(text)
        tail(spark, f"{tmp_path}/in", ["a", "b"], [target, other], f"{tmp_path}/offsets")
    assert sorted(tuple(r) for r in read_target(spark, target).collect()) == [("x", "o", "1"), ("y", "o", "2"), ("z", "o", "3")]
    assert sorted(r.a for r in read_target(spark, other).collect()) == ["1", "2", "3"]


def test_entries_of_two_orgs_are_apart(spark, events, store):
    other = events.withColumn("Id", F.col("Id") + 100)
    entries = [table_entry(df, "events", ["Id"], "At", "t", org=org, constants={"Org": org}) for org, df in (("a", events), ("b", other))]
    for n in (40, 0):
        got = outcomes(run(spark, entries, store))
        assert got == {("t", f"{o}:sobject:events"): ("processed" if n else "skipped", n) for o in "ab"}
    assert sorted((r.Org, r.Id) for r in store.read("t").collect()) == [("a", i) for i in range(40)] + [("b", i + 100) for i in range(40)]
    assert set(marks(store)) == {"a:sobject:events", "b:sobject:events"}


def test_one_mark_for_two_sources_is_refused(spark, events, store):
    other = events.where("Id > 3")
    for more in ({}, {"name": "both"}):
        with pytest.raises(ValueError, match="different sources"):
            run(spark, [table_entry(df, "events", ["Id"], "At", "t", **more) for df in (events, other)], store)
    same = [table_entry(df, "events", ["Id"], "At", "t", where=w) for df, w in ((events, "kind = 0"), (events, "kind = 1"))]
    assert [r.status for r in run(spark, same, store).collect()] == ["processed"] * 2 and store.read("t").count() == 20


@pytest.fixture(params=["UTC", "Asia/Tokyo", "America/New_York"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string"])
def test_marks_are_instants_in_any_zone(spark, store, zone, kind):
    """Two runs, the second with newer rows: each row once, and marks that do not depend on the zone. Hours around a change of New York's clocks."""
    hours = ["2024-11-03T04:30:00", "2024-11-03T05:30:00", "2024-11-03T06:30:00", "2024-11-03T13:00:00", "2024-11-04T15:00:00"]
    rows = [(n, h if kind != "date" else f"2024-11-0{n + 1}T00:00:00") for n, h in enumerate(hours)]
    text = spark.createDataFrame(rows, "Id int, text string")
    at = {
        "timestamp": F.concat("text", F.lit("Z")).cast("timestamp"), "timestamp_ntz": F.col("text").cast("timestamp_ntz"),
        "date": F.col("text").substr(1, 10).cast("date"), "string": F.concat("text", F.lit("+00:00")),
    }[kind]
    df = text.select("Id", at.alias("At"))
    for upto, want in ((2, 3), (4, 2), (4, 0)):
        assert run(spark, [table_entry(df.where(F.col("Id") <= upto), "e", ["Id"], "At", "t")], store).first().rows == want
    assert sorted(r.Id for r in store.read("t").collect()) == [0, 1, 2, 3, 4]
    assert marks(store) == {"sobject:e": rows[-1][1] + ".000000Z"}
    windowed = run(spark, [table_entry(df, "e", ["Id"], "At", "w", "w")], store, Bounds(rows[1][1] + "Z", rows[3][1] + "Z")).first()
    assert (windowed.rows, windowed.mark) == (3, rows[3][1] + ".000000Z")


class Crash(BaseException):
    pass


def test_a_crash_between_rows_and_state_repeats_nothing(spark, events, store, monkeypatch):
    """A run dies when its targets are committed and the state is not: the next one goes on from the marks in the targets."""
    entries = lambda df: [table_entry(df, "e", ["Id"], "At", t) for t in ("one", "two")]

    def die(*_):
        raise Crash

    kept = store.commit
    with monkeypatch.context() as m:  # dies before the state is written
        m.setattr(runs, "write_state", die)
        with pytest.raises(Crash):
            run(spark, entries(events.where("Id < 10")), store)
    assert marks(store) == {} and store.read("one").count() == store.read("two").count() == 10
    with monkeypatch.context() as m:  # dies when one of the targets is committed
        m.setattr(store, "commit", lambda target, *a, **b: die() if target == "two" else kept(target, *a, **b))
        with pytest.raises(Crash):
            run(spark, entries(events.where("Id < 20")), store)
    assert marks(store) == {} and (store.read("one").count(), store.read("two").count()) == (20, 10)
    got = outcomes(run(spark, entries(events), store))
    assert {t: rows for (t, _), (_, rows) in got.items()} == {"one": 20, "two": 30}
    for t in ("one", "two"):
        assert sorted(r.Id for r in store.read(t).collect()) == list(range(40)) and store.pending(t) == {}
    assert [r.status for r in run(spark, entries(events), store).collect()] == ["skipped"] * 2


def test_a_failed_target_does_not_lose_rows_of_a_shared_mark(spark, events, store):
    run(spark, [table_entry(events.where("Id < 5"), "e", ["Id"], "At", t) for t in ("one", "two")], store)
    bad = table_entry(events, "e", ["Id"], "At", "two", constants={"More": "x"})
    got = outcomes(run(spark, [table_entry(events, "e", ["Id"], "At", "one"), bad], store))
    assert {t: v for (t, _), v in got.items()} == {"one": ("processed", 35), "two": ("failed", 0)}
    got = outcomes(run(spark, [table_entry(events, "e", ["Id"], "At", t) for t in ("one", "two")], store))
    assert {t: v for (t, _), v in got.items()} == {"one": ("skipped", 0), "two": ("processed", 35)}
    write_state(store, spark.createDataFrame([("sobject:e", "2020-01-01T00:00:00Z", None)], "watermark_key string, watermark_raw string, watermark_ts timestamp"))
    assert run(spark, [table_entry(events, "e", ["Id"], "At", "one")], store).first().rows == 40  # a mark that was moved back holds


def test_versions_are_not_replaced(spark, events, store, tmp_path):
    files = _Files(spark)
    files.create(f"{tmp_path}/v/1.json", "first")
    with pytest.raises(FileExistsError):
        files.create(f"{tmp_path}/v/1.json", "second")
    assert files.read(f"{tmp_path}/v/1.json") == "first" and files.names(f"{tmp_path}/v") == ["1.json"]
    staged = [store.stage("t", events.select("Id")) for _ in range(3)]
    for n, want in ((4, 1), (4, 1), (5, 2)):
        assert store.commit("t", staged.pop(), "Append", ["Id"], transaction=("s", n)) == want
    assert store.read("t").count() == 80 and store.transaction("t", "s") == 5 and store.transaction("t", "other") is None


def test_late_rows_and_rows_at_the_mark_are_loaded_once(spark, store):
    at = lambda *rows: spark.createDataFrame(list(rows), "Id int, part string, text string").select("Id", "part", F.col("text").cast("timestamp").alias("At"))
    first = [(1, "a", "2024-01-01T00:00:00Z"), (2, "a", "2024-01-05T00:00:00Z"), (3, None, "2024-01-10T00:00:00Z")]
    late = [(4, "a", "2024-01-10T00:00:00Z"), (5, "b", "2024-01-06T00:00:00Z"), (2, "b", "2024-01-05T00:00:00Z"), (6, "a", "2024-01-02T00:00:00Z")]
    new = [(2, "a", "2024-01-12T00:00:00Z"), (7, "a", "2024-01-11T00:00:00Z")]
    entry = lambda rows: [table_entry(at(*rows), "e", ["Id"], "At", "t", overlap=timedelta(days=6), key=["Id", "part"])]
    rows = lambda r: (r.status, r.rows, r.mark and r.mark[:10])
    assert rows(run(spark, entry(first), store).first()) == ("processed", 3, "2024-01-10")
    assert rows(run(spark, entry(first), store).first()) == ("skipped", 0, None)
    assert rows(run(spark, entry(first + late), store).first()) == ("processed", 3, "2024-01-10")  # 6 is older than the overlap
    assert rows(run(spark, entry(first + late), store).first()) == ("skipped", 0, None)
    assert rows(run(spark, entry(first + late + new), store).first()) == ("processed", 2, "2024-01-12")
    assert sorted(r.Id for r in store.read("t").collect()) == [1, 2, 2, 2, 3, 4, 5, 7] and store.read("t").columns == ["Id"]
    plain = table_entry(at((9, "a", "2024-02-01T00:00:00Z")), "other", ["Id"], "At", "t")
    assert run(spark, [*entry(first + late + new), plain], store).collect()[1].rows == 1 and store.read("t").count() == 9
    for wrong in ({"key": []}, {"limit": 3}, {"operation": "Overwrite"}):
        with pytest.raises(ValueError, match="overlap"):
            table_entry(at(*first), "e", ["Id"], "At", "t", overlap=timedelta(days=1), **{"key": ["Id"], **wrong})


def test_a_replayed_batch_changes_nothing(spark, store, tmp_path, monkeypatch):
    """A batch reaches the first of two targets and dies; its replay goes into the second alone. Later runs use the tail's marks and targets."""
    (tmp_path / "in").mkdir()
    targets = [StoreTarget("one", "k1", constants={"Org": "o"}), StoreTarget("two", "k2", ["b"])]
    go = lambda: sorted(tuple(r)[:5] for r in tail_into(spark, f"{tmp_path}/in", ["a", "b"], targets, store, f"{tmp_path}/offsets").collect())
    (tmp_path / "in" / "0.csv").write_text("a,b\n1,x\n2,y\n")
    kept = store.commit

    def commit(target, *a, **b):
        if target == "two":
            raise RuntimeError("lost")
        return kept(target, *a, **b)

    with monkeypatch.context() as m:
        m.setattr(store, "commit", commit)
        with pytest.raises(Exception, match="lost"):
            go()
    assert store.version("one")[0] == 1 and store.version("two") is None and marks(store) == {}
    assert go() == [("two", 0, "processed", 2, 1)]
    (tmp_path / "in" / "1.csv").write_text("a,b\n3,z\n")
    (tmp_path / "in" / "2.csv").write_text("a,b\n")
    assert go() == [("one", 1, "processed", 1, 1), ("two", 1, "processed", 1, 1)]
    assert go() == []
    assert sorted(tuple(r) for r in store.read("one").collect()) == [("1", "x", "o"), ("2", "y", "o"), ("3", "z", "o")]
    assert sorted(r.b for r in store.read("two").collect()) == ["x", "y", "z"]
    assert set(marks(store)) == {"k1", "k2"} and store.pending("one") == store.pending("two") == {}
    targets[1] = StoreTarget("two", "k2", ["a", "b"])
    (tmp_path / "in" / "3.csv").write_text("a,b\n4,w\n")
    with pytest.raises(Exception, match="extra"):
        go()
    assert store.read("one").count() == 4 and store.read("two").count() == 3


def test_metadata_is_made_kept_and_made_anew(spark, events, store):
    run(spark, [table_entry(events, "e", ["Id"], "At", "t", "a", constants={"Org": "x"})], store)
    first = store.metadata("t")
    assert [(f["name"], f["type"]) for f in document_fields(first)] == [("Id", "Numeric"), ("Org", "Text")]
    assert {k: document_fields(first)[0][k] for k in ("precision", "scale", "defaultValue")} == {"precision": 18, "scale": 0, "defaultValue": "0"}
    run(spark, [table_entry(events, "e", ["id"], "At", "t", "b", constants={"org": "y"})], store)
    assert store.metadata("t") == first
    wide = events.select(F.col("Id").cast("long").alias("Id"), F.col("kind").alias("Kind"), "At")
    run(spark, [table_entry(wide, "w", ["Id", "Kind"], "At", "t", "c", override_metadata=True)], store)
    assert [f["name"] for f in document_fields(store.metadata("t"))] == store.read("t").columns == ["Id", "Kind"]
    rows = store.read("t")
    assert rows.count() == 120 and rows.where("Kind is null").count() == 80 and rows.schema["Id"].dataType.simpleString() == "bigint"
    run(spark, [table_entry(wide, "w", ["Id", "Kind"], "At", "t", "d")], store)
    assert store.read("t").count() == 160 and store.read("t").where("Kind is null").count() == 80


def test_names_that_metadata_cannot_hold_fail(spark, events, store):
    bad = events.withColumnRenamed("Id", "no name")
    got = run(spark, [table_entry(bad, "e", ["`no name`"], "At", "t")], store).first()
    assert got.status == "failed" and "no name" in got.problem and store.version("t") is None


def test_declared_types(spark, store, tmp_path):
    (tmp_path / "x.csv").write_text("n,d,s\n1.50,2024-02-01,a\n,,\n")
    path = f"{tmp_path}/x.csv"
    document = {"objects": [{"fields": [
        {"fullyQualifiedName": "N", "type": "Numeric", "precision": 5, "scale": 2}, {"fullyQualifiedName": "D", "type": "Date", "format": "yyyy-MM-dd"}, {"fullyQualifiedName": "S", "type": "Text"},
    ]}]}
    store.declare("t", document)
    assert store.read("t").count() == 0 and store.read("t").columns == ["N", "D", "S"]
    assert run(spark, [csv_entry(spark, path, ["n", "d", "s"], "t")], store).first().status == "processed"
    assert sorted(store.read("t").collect(), key=str)[0].N == "1.50" and store.metadata("t") == document
    rows = store.described("t").orderBy("N").collect()
    assert [(float(r.N), str(r.D), r.S or "") for r in rows] == [(0.0, "None", ""), (1.5, "2024-02-01", "a")]
    (tmp_path / "y.csv").write_text("n,d,s\nodd,,\n")
    run(spark, [csv_entry(spark, f"{tmp_path}/y.csv", ["n", "d", "s"], "t")], store)
    with pytest.raises(Exception, match="odd"):
        store.described("t").collect()
    text = {"objects": [{"fields": [{"fullyQualifiedName": n, "type": "Text"} for n in ("N", "D", "S")]}]}
    store.declare("t", text)
    assert store.described("t").count() == 3
    for wrong in ({"objects": [{"fields": [{"fullyQualifiedName": "N", "type": "Text"}]}]}, {"objects": []}, {}):
        with pytest.raises(ValueError, match="document does not name|metadata without fields"):
            store.declare("t", wrong)
