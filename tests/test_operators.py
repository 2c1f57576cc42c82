import gzip
import io
import json
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks, schema, sinks
from tidemark.sources import logs, tables


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_scan_with_hidden_date_nested_field_and_predicate(spark):
    df = spark.createDataFrame(
        [(1, ("Ann",), "2024-01-01T00:00:00Z"), (2, None, "2024-01-02T00:00:00Z"), (3, (None,), "2024-01-03T00:00:00Z")], "Id int, Owner struct<Name:string>, At string"
    ).withColumn("At", F.col("At").cast("timestamp"))
    got = tables.scan_table(df, ["Id", "owner.name"], "At", "Id = 1 OR Id = 2 OR Id = 3", mark="2024-01-01T00:00:00Z")
    assert got.columns == ["Id", "owner_name", tables.MARK] and values(got, "Id", "owner_name") == [(2, None), (3, None)]
    with pytest.raises(ValueError, match="no column"):
        tables.scan_table(df, ["Nope"], "At")


def test_the_bound_reaches_the_scan(spark, tmp_path):
    spark.range(10).withColumn("ts", F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz")).write.parquet(f"{tmp_path}/t")
    plan = tables.scan_table(spark.read.parquet(f"{tmp_path}/t"), ["id"], "ts", mark="1970-01-05T00:00:00Z")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,1970-01-05T00:00)" in plan


def test_oldest_rows_and_ties(spark):
    df = spark.createDataFrame([(i, f"2024-01-0{1 + i // 2}") for i in range(8)], "id int, d string").withColumn("d", F.col("d").cast("timestamp"))
    assert tables.scan_table(df, ["id"], "d", limit=3).count() == 3
    assert values(tables.scan_table(df, ["id"], "d", limit=3, with_ties=True), "id") == [(0,), (1,), (2,), (3,)]


def test_paths_share_hops(spark):
    users = spark.createDataFrame([(1, "Ann", 10, None), (2, "Bo", None, 1)], "Id int, Name string, ProfileId int, ManagerId int")
    profiles = spark.createDataFrame([(10, "Admin")], "Id int, Name string")
    rows = spark.createDataFrame([(100, 1), (101, 2), (102, None), (103, 9)], "Id int, OwnerId int")
    relations = {("Row", "Owner"): tables.Relation("OwnerId", "User", "Id"), ("User", "Profile"): tables.Relation("ProfileId", "Profile", "Id"), ("User", "Manager"): tables.Relation("ManagerId", "User", "Id")}
    got = tables.with_paths(rows, {"User": users, "Profile": profiles}, relations, "Row", ["Owner.Name", "Owner.Profile.Name", "Owner.Manager.Name"])
    assert values(got, "Id", "Owner_Name", "Owner_Profile_Name", "Owner_Manager_Name") == [(100, "Ann", "Admin", None), (101, "Bo", None, "Ann"), (102, None, None, None), (103, None, None, None)]
    assert got.columns == ["Id", "OwnerId", "Owner_Name", "Owner_Profile_Name", "Owner_Manager_Name"]


def test_log_files_with_awkward_names(spark, tmp_path):
    names = ["p.csv", "a b.csv", "h%20.csv", "ü+=&.csv"]
    for n, name in enumerate(names):
        (tmp_path / name).write_text(f"X\n{n}\n")
    rows = [("Login", "Daily", f"2024-01-0{n + 1}", ("file://" if n % 2 else "") + f"{tmp_path}/{name}", ["X"]) for n, name in enumerate(names)]
    catalog = spark.createDataFrame([*rows, rows[0]], "event_type string, interval string, log_date string, path string, field_names array<string>").withColumn("log_date", F.col("log_date").cast("timestamp"))
    got = logs.scan_log_files(spark, catalog, "Login", "Daily").select("X", F.dayofmonth(tables.MARK).alias("day"))
    assert values(got, "X", "day") == [(str(n), n + 1) for n in range(4)]


def test_overwriting_a_csv_folder_keeps_the_old_one_until_the_end(spark, tmp_path):
    path = f"{tmp_path}/out"
    sinks.export_csv(spark.range(3), path, "Overwrite")
    with pytest.raises(Exception, match="broken"):
        sinks.export_csv(spark.range(3).withColumn("x", F.raise_error(F.lit("broken"))), path, "Overwrite")
    assert logs.read_csv(spark, path, ["id"]).count() == 3
    sinks.export_csv(spark.range(5), path, "Overwrite")
    assert logs.read_csv(spark, path, ["id"]).count() == 5 and len([p for p in tmp_path.iterdir() if p.name.startswith("out__")]) <= 1


def test_log_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('X,Y\r\n1,"two\nlines"\r\n\r\n3,4\r\n')
    (tmp_path / "b.csv").write_text("Y,X,Z\nq,p,z\n")
    (tmp_path / "c.csv").write_text("X,Y\n")
    day = lambda n: f"2024-01-0{n}T00:00:00Z"
    catalog = spark.createDataFrame(
        [("Login", "Daily", day(1), f"{tmp_path}/a.csv", ["X", "Y"]), ("Login", "Daily", day(2), f"{tmp_path}/b.csv", ["Y", "X", "Z"]), ("Login", "Daily", day(3), f"{tmp_path}/c.csv", ["X", "Y"]),
         ("Login", "Hourly", day(1), "none", ["X"]), ("Other", "Daily", day(1), "none", ["X"])],
        "event_type string, interval string, log_date string, path string, field_names array<string>",
    ).withColumn("log_date", F.col("log_date").cast("timestamp"))
    got = logs.scan_log_files(spark, catalog, "Login", "Daily")
    assert sorted((r.X, r.Y, r.Z or "") for r in got.collect()) == [("1", "two\nlines", ""), ("3", "4", ""), ("p", "q", "z")]
    assert logs.scan_log_files(spark, catalog, "Login", "Daily", mark=day(3)) is None
    with pytest.raises(ValueError, match="different headers"):
        logs.scan_log_files(spark, catalog, "Login", "Daily", strict=True)
    with pytest.raises(ValueError):
        logs.text_schema(["a", ""])


class Counting(io.BytesIO):
    def read(self, size=-1):
        self.asked = getattr(self, "asked", 0) + size
        return super().read(size)


@pytest.mark.parametrize("sep", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("chunk", [1, 2, 3, 64])
def test_first_lines_read_no_further(sep, chunk):
    stream = Counting(f"{sep}  {sep}a,b{sep}".encode() + b"x" * 100_000)
    assert logs.first_line(stream, chunk) == "a,b" and stream.asked <= 16 + 2 * chunk
    assert logs.first_line(io.BytesIO(b" \n"), chunk) is None and logs.first_line(io.BytesIO(b"a"), chunk) == "a"


def test_headers_of_a_catalog_and_of_packed_files(spark, tmp_path):
    with gzip.open(tmp_path / "a b%20.csv.gz", "wt") as f:
        f.write("\ufeffa,b\n" + "1,2\n" * 1000)
    (tmp_path / "empty.csv").write_text("")
    paths = spark.createDataFrame([(f"{tmp_path}/{n}",) for n in ("a b%20.csv.gz", "empty.csv")], "path string")
    for source in (paths, str(tmp_path)):
        assert [r.names for r in logs.headers(spark, source).collect()] == [["a", "b"]]


def test_parts_are_cut_where_rows_are(spark):
    lines = spark.range(1000).select(F.col("id").cast("string").alias("line")).repartition(3)
    cut = sinks.cut_parts(lines, 100)
    assert "Exchange" not in sinks.cut_parts(spark.range(9, numPartitions=2).select(F.col("id").cast("string").alias("line")), 100)._jdf.queryExecution().executedPlan().toString()
    sums = cut.groupBy("part").agg(F.sum(F.length("line") + 1).alias("n"), F.count("line").alias("rows")).collect()
    assert sum(r.rows for r in sums) == 1000 and max(r.n for r in sums) <= 104 and min(r.part for r in sums) == 0


@pytest.mark.parametrize(
    ("line", "names"),
    [("a,b", ["a", "b"]), ("﻿a,b\r", ["a", "b"]), (' a , "b" ', ["a", '"b"']), ('"a,x","b""q"', ["a,x", 'b"q']), ("a,,b,", ["a", "b"]), ('﻿"a", b ,,"c,d"\r', ["a", "b", "c,d"])],
)
def test_headers(spark, tmp_path, line, names):
    (tmp_path / "f.csv").write_bytes(("\n" + line + "\n1,2\n").encode())
    got = logs.headers(spark, str(tmp_path)).collect()
    assert len(got) == 1 and (got[0].names == names or line.startswith(" "))


def test_projection(spark):
    df = spark.createDataFrame([(1, "x", "y")], "`Owner.Name` int, b string, C string")
    assert schema.project(df, ["c", "OWNER_NAME", "B"]).columns == ["c", "OWNER_NAME", "B"]
    assert schema.project(schema.augment(df, {"Org": "o"}), ["Org", "b", "c", "owner_name"]).first()[0] == "o"
    for target in (["b", "c"], ["b", "c", "owner_name", "more"]):
        with pytest.raises(ValueError, match="missing|extra"):
            schema.project(df, target)
    with pytest.raises(ValueError, match="overlap"):
        schema.augment(df, {"OWNER_NAME": "x"})


def test_column_diffs_and_alignment(spark):
    form = "owner string, position int, name string"
    expected = spark.createDataFrame([(o, i, n) for o, ns in (("same", "ab"), ("moved", "ab"), ("cased", "ab"), ("less", "ab"), ("more", "a")) for i, n in enumerate(ns)], form)
    provided = spark.createDataFrame([(o, i, n) for o, ns in (("same", "ab"), ("moved", "ba"), ("cased", "aB"), ("less", "a"), ("more", "ab")) for i, n in enumerate(ns)], form)
    diff = schema.column_diff(provided, expected)
    assert values(diff, "owner", "issue", "name") == [("cased", "casing", "b"), ("less", "missing", "b"), ("more", "extra", "b"), ("moved", "order", "a"), ("moved", "order", "b")]
    owners = expected.select("owner").distinct()
    got = dict(values(checks.alignment(diff, owners, F.lit(True)), "owner", "status"))
    assert got == {"same": "pass", "moved": "fail", "cased": "warn", "less": "fail", "more": "fail"}
    assert dict(values(checks.alignment(diff, owners, F.lit(False)), "owner", "status"))["moved"] == "pass"


@pytest.mark.parametrize(("source", "target"), [(t, "Numeric") for t in schema.NUMERIC_TYPES] + [("date", "Date"), ("datetime", "Date")] + [(t, "Text") for t in ("string", "boolean", "id", "time", "base64", "address", "new")])
def test_type_map(spark, source, target):
    assert spark.range(1).select(schema.target_type(F.lit(source))).first()[0] == target


def test_metadata(spark):
    rows = [("t", 0, "Id", "Id", "Text", None, None, None), ("t", 1, "n", "N", "Numeric", 0, None, None), ("t", 2, "m", "M", "Numeric", 4, 9, None), ("t", 3, "d", "D", "Date", None, None, None), ("t", 4, "ID", "x", "Text", None, None, None), ("t", 5, "a.b", "x", "Text", None, None, None)]
    fields = schema.synthesised_fields(spark.createDataFrame(rows, "target string, position int, name string, label string, type string, precision int, scale int, format string"))
    got = {r.name: r for r in fields.collect()}
    assert (got["n"].precision, got["n"].scale, got["n"].default_value) == (18, 0, "0") and (got["m"].precision, got["m"].scale) == (4, 4)
    assert got["d"].format == schema.DATETIME_FORMAT and got["Id"].problem == got["ID"].problem == "duplicate" and got["a.b"].problem == "bad name" and got["n"].problem is None
    text = schema.metadata_json(fields.where("problem is null"))
    document = json.loads(text.first().metadata)
    assert [f["name"] for f in document["objects"][0]["fields"]] == ["n", "m", "d"] and document["fileFormat"]["numberOfLinesToIgnore"] == 0
    assert text.select(schema.metadata_columns(F.col("metadata")).alias("c")).first().c == ["n", "m", "d"]
    for broken in ("{}", '{"objects":[]}', '{"objects":[{"fields":[]}]}', '{"objects":[{"fields":[{"name":"x"}]}]}'):
        with pytest.raises(Exception, match="metadata without fields|INVALID_ARRAY_INDEX"):
            spark.range(1).select(schema.metadata_columns(F.lit(broken))).collect()


def test_typed_load_and_bad_cells(spark):
    fields = [{"name": "n", "type": "Numeric", "precision": 6, "scale": 2}, {"name": "d", "type": "Date", "format": "yyyy-MM-dd"}, {"name": "t", "type": "Date"}, {"name": "s", "type": "Text"}]
    form = "n string, d string, t string, s string"
    good = spark.createDataFrame([("1.5", "2024-01-01", "2024-01-01T00:00:00.000+0000", "x"), ("", "", "", ""), (None, None, None, None)], form)
    got = schema.typed_load(good, fields)
    assert [str(r.n) for r in got.collect()] == ["1.50", "0.00", "0.00"] and [r.d is None for r in got.collect()] == [False, True, True]
    bad = spark.createDataFrame([("x", "2024-02-30", "noon", "x"), ("1", "", "", "")], form)
    assert tuple(schema.bad_cells(bad, fields).first()) == (1, 1, 1, 0)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE_TIMESTAMP|cannot be cast"):
        schema.typed_load(bad, fields).collect()


def test_constraints(spark):
    df = spark.createDataFrame([(0, "t", "Append", "a"), (1, "t", "Overwrite", "a"), (2, "u", "Append", "b"), (3, "u", "Append", None)], "idx int, target string, op string, name string")
    assert [(r.target, r["values"], r.first_at, r.last_at) for r in checks.conflicting_values(df, ["target"], "op", "idx").collect()] == [("t", ["Append", "Overwrite"], 0, 1)]
    assert values(checks.repeated_names(df, "name", "idx"), "name", "times", "first_at", "last_at") == [("a", 2, 0, 1)]
    assert values(checks.unequal_sets(df, "target", "idx", "op"), "target") == [("t",)]
    assert values(checks.first_wins(df, ["target"], "idx"), "idx") == [(0,), (2,)]
    assert checks.ordered_union(df, ["target"], "op", ["idx"]).where("target = 't'").first()["values"] == ["Append", "Overwrite"]
    assert checks.roll_up(spark.createDataFrame([("pass",), ("warn",)], "status string")).first().status == "pass"
    assert checks.roll_up(spark.createDataFrame([("pass",), (None,)], "status string")).first().status == "fail"


def test_parts_keep_order_and_budget(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 3).withColumn("size", 1 + F.col("id") % 17).repartition(5)
    rows = sorted(sinks.pack_parts(df, F.col("size").cast("long"), ["id"], 100, ["g"], slices=7).collect())
    for g in range(3):
        upto = 0
        for r in (r for r in rows if r.g == g):
            assert r.part == upto // 100
            upto += r.size


def test_gzip_export_round_trip(spark, tmp_path):
    rows = [(i, "=x" if i % 3 else 'say "hi"', None) for i in range(300)]
    sinks.export_gzip(spark.createDataFrame(rows, "a int, b string, c string").repartition(3), f"{tmp_path}/out", 1000)
    back = spark.read.text(f"{tmp_path}/out")
    want = sorted('"%d","%s",""' % (i, "\t=x" if i % 3 else 'say ""hi""') for i in range(300))
    assert sorted(r.value for r in back.collect()) == want
    assert back.groupBy("part").agg(F.sum(F.octet_length("value") + 1).alias("n")).agg(F.max("n")).first()[0] <= 1000 + 20
    assert list(tmp_path.glob("out/part=*/*.gz"))


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame([(" a ", "-5", None), ('q"', "x\ny", "")], "a string, b string, c string")
    for mode, count in (("Append", 2), ("Append", 4), ("Overwrite", 2)):
        sinks.export_csv(df, f"{tmp_path}/csv", mode)
        back = logs.read_csv(spark, f"{tmp_path}/csv", ["a", "b", "c"])
        assert back.count() == count
    assert values(back, "a", "b") == [(" a ", "\t-5"), ('q"', "x\ny")]


ODD = [None, "", " ", '"', "a\x00b", '\x00"', 'a\x00"\x00b', "x\x00", "a\r\nb", "\r", "\n", "\ufeffx", "#x", "=1", "\t=1", "-2", "null", 'q" ,\n"']


def test_csv_export_keeps_nulls_apart(spark, tmp_path):
    df = spark.createDataFrame([(a, i, b) for i, (a, b) in enumerate(zip(ODD, ODD[::-1], strict=True))] + [(None, None, None)], "a string, b int, c string")
    sinks.export_csv(df, f"{tmp_path}/csv", guarded=[], nulls=True)
    texts = df.withColumn("b", F.col("b").cast("string"))
    assert Counter(logs.read_csv(spark, f"{tmp_path}/csv", df.columns, nulls=True).collect()) == Counter(texts.collect())
    sinks.export_csv(df.select("a").where("a is not null"), f"{tmp_path}/lone", guarded=[], nulls=True)
    assert Counter(r.a for r in logs.read_csv(spark, f"{tmp_path}/lone", ["a"], nulls=True).collect()) == Counter(ODD[1:])
    with pytest.raises(Exception, match="lone column"):
        sinks.export_csv(df.select("a"), f"{tmp_path}/lone", nulls=True)


def test_csv_round_trip_agrees_with_sql(spark, tmp_path):
    from tidemark.plans.catalogue import ORACLES, QUERIES

    ids = [*range(1, len(ODD)), None]
    pq.write_table(pa.table({"doc_id": pa.array([*ids, *[i and -i for i in ids]], pa.int64()), "text": [*ODD, *["t"] * len(ODD)], "source": [*["s"] * len(ODD), *ODD]}), f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet'")
    got = QUERIES["csv_export_roundtrip"](spark, str(tmp_path)).select("doc_id", "text", "source")
    assert Counter(map(tuple, got.collect())) == Counter(con.sql(ORACLES["csv_export_roundtrip"]).fetchall())


def test_store_versions(spark, tmp_path):
    store, df = sinks.Store(spark, f"{tmp_path}/store"), spark.range(3)
    assert store.read("t") is None
    store.commit("t", store.stage("t", df), "Append", ["id"])
    store.commit("t", store.stage("t", df), "Append", ["id"])
    assert store.read("t").count() == 6
    store.abort(store.stage("t", df))
    store.commit("t", store.stage("t", store.read("t").limit(1)), "Overwrite", ["id"])
    assert store.read("t").count() == 1 and store.version("t")[0] == 3
    with pytest.raises(FileExistsError):
        store.files.create(f"{tmp_path}/store/t/versions/3.json", "{}")


def test_state(spark, tmp_path):
    store = sinks.Store(spark, f"{tmp_path}/state")
    marks = lambda *rows: spark.createDataFrame(rows, "watermark_key string, watermark_raw string").withColumn("watermark_ts", F.col("watermark_raw").cast("timestamp"))
    assert sinks.read_state(store).count() == 0
    sinks.write_state(store, marks(("a", "2024-01-02T00:00:00Z"), ("b", "2024-01-02T00:00:00Z")))
    sinks.write_state(store, marks(("a", "2024-01-01T00:00:00Z")))
    assert values(sinks.read_state(store), "watermark_key", "watermark_raw") == [("a", "2024-01-01T00:00:00Z"), ("b", "2024-01-02T00:00:00Z")]
