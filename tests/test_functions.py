import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import as_text, csv_quote, interpolate
from tidemark.functions.times import Bounds, bounds_class, first_run_class, instant, is_iso, lower_bound, upper_bound


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize(
    ("text", "good"),
    [
        ("2024-02-29T00:00:00Z", True), ("2023-02-30T00:00:00Z", False), ("2024-13-01T00:00:00Z", False), ("2024-01-32T00:00:00Z", False), ("2024-01-01T10:00:00.123+0200", True),
        ("2024-01-01T10:00:00+02:00", True), ("2024-01-01T10:00:00", False), ("2024-01-01", False), ("2024-01-01T10:00Z", False), ("", False), (None, False), (" 2024-01-01T00:00:00Z", False),
    ],
)
def test_iso_strings(spark, text, good):
    assert one(spark, is_iso(F.lit(text).cast("string")))[0] is good


def test_instants_compare_across_offsets(spark):
    a, b = F.lit("2024-01-01T02:00:00+02:00"), F.lit("2024-01-01T00:00:00Z")
    assert one(spark, instant(a) == instant(b))[0]


def test_bounds():
    assert Bounds("2024-01-01T00:00:00Z", "2024-01-01T02:00:00+02:00").window() == "[2024-01-01T00:00:00Z, 2024-01-01T02:00:00+02:00]"
    assert Bounds().window() == "[-∞, +∞]" and not Bounds()
    for start, end in (("2024-01-02T00:00:00Z", "2024-01-01T00:00:00Z"), ("2024-02-30T00:00:00Z", None), ("soon", None)):
        with pytest.raises(ValueError):
            Bounds(start, end)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string"])
def test_bounds_are_strict_only_above_marks(spark, kind):
    ends = ["2024-01-01T00:00:00.000Z", "2024-01-01T00:00:00.001Z", "2024-01-01T00:00:00.002Z"]
    rows = spark.createDataFrame([(e,) for e in ends], "t string")
    d = F.col("t") if kind == "string" else instant(F.col("t")).cast(kind)
    rows, type_ = rows.select("t", d.alias("d")), {"string": T.StringType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType()}[kind]
    keep = lambda c: [r.t for r in rows.where(c).collect()]
    assert keep(lower_bound(F.col("d"), type_, Bounds(), ends[1])) == ends[2:]
    assert keep(lower_bound(F.col("d"), type_, Bounds(ends[1]), ends[2])) == ends[1:]
    assert keep(upper_bound(F.col("d"), type_, Bounds(end=ends[1]))) == ends[:2]
    assert lower_bound(F.col("d"), type_, Bounds(), None) is None and upper_bound(F.col("d"), type_, Bounds()) is None


@pytest.mark.parametrize(
    ("start", "end", "mark", "appends", "want"),
    [
        ("09", None, "10", True, "REWIND"), ("11", None, "10", True, "HOLE"), ("10", None, "10", True, "BOUNDARY"), ("10", None, "10", False, None), (None, "09", "10", True, "EMPTY"),
        ("09", "09", "10", True, "REWIND"), (None, "10", "10", True, None), ("10", None, None, True, None),
    ],
)
def test_bounds_against_marks(spark, start, end, mark, appends, want):
    at = lambda d: F.lit(d and f"2024-01-{d}T00:00:00Z").cast("timestamp")
    assert one(spark, bounds_class(at(start), at(end), at(mark), F.lit(appends)))[0] == want


def test_first_runs(spark):
    some, none = F.lit("2024-01-01T00:00:00Z").cast("timestamp"), F.lit(None).cast("timestamp")
    case = lambda s, e, m, k: one(spark, first_run_class(s, e, m, F.lit(k)))[0]
    assert case(none, none, none, "elf") == "FIRST_RUN_ELF" and case(none, some, none, "sobject") == "FRESH_END_ONLY"
    assert case(none, none, none, "sobject") is None and case(none, some, none, "csv") is None and case(some, none, none, "elf") is None and case(none, some, some, "elf") is None


@pytest.mark.parametrize(
    ("text", "cell"),
    [
        ("plain", '"plain"'), ('a "b"', '"a ""b"""'), ("=HYPERLINK(1)", '"\t=HYPERLINK(1)"'), ("+1", '"\t+1"'), ("-2+3", '"\t-2+3"'), ("@x", '"\t@x"'), ("|cmd", '"\t|cmd"'),
        ("\tx", '"\t\tx"'), ("\rx", '"\t\rx"'), ("a\n=1", '"a\n=1"'), ("", '""'), (None, '""'), ('"=1', '"""=1"'),
    ],
)
def test_csv_cells(spark, text, cell):
    assert one(spark, csv_quote(as_text(F.lit(text).cast("string"), T.StringType())))[0] == cell


@pytest.mark.parametrize(("value", "text"), [(100.0, "100"), (1e7, "10000000"), (-0.0, "0"), (1.5, "1.5"), (None, "")])
def test_numbers_as_text(spark, value, text):
    assert one(spark, as_text(F.lit(value).cast("double"), T.DoubleType()))[0] == text
    assert one(spark, as_text(F.lit(True), T.BooleanType()))[0] == "true"


def test_quoted_numbers_agree_with_sql(spark, tmp_path):
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    from tidemark.plans.catalogue import ORACLES, QUERIES

    values = [-0.0, 0.0, None, -0.01, 12345678.9, -4e7, 1e15, 1e16, 0.0001, 0.00001, 5e-324, 2e23, float("nan"), float("inf"), float("-inf")]
    pq.write_table(pa.table({"c_custkey": range(len(values)), "c_acctbal": pa.array(values, pa.float64())}), f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW customer AS FROM '{tmp_path}/customer.parquet'")
    assert sorted(map(tuple, QUERIES["csv_quoted_numbers"](spark, str(tmp_path)).collect())) == sorted(con.sql(ORACLES["csv_quoted_numbers"]).fetchall())


@pytest.mark.parametrize(("value", "text"), [(12345678.9, "12345678.9"), (0.0005, "0.0005"), (1e15, "1000000000000000"), (float("inf"), "Infinity"), (float("nan"), "NaN")])
def test_doubles_as_plain_text(spark, value, text):
    assert one(spark, as_text(F.lit(value), T.DoubleType()))[0] == text


def test_templates(spark):
    tokens = {"sourceOrg.Id": F.lit("00D"), "sourceOrg.Name": F.lit("Acme")}
    fill = lambda t: one(spark, interpolate(F.lit(t), tokens))[0]
    assert fill("{{sourceOrg.Name}}-{{sourceOrg.Id}} {{ sourceOrg.Id }}") == "Acme-00D {{ sourceOrg.Id }}" and fill("") == ""
    with pytest.raises(Exception, match="unknown template token: other.Id"):
        fill("{{other.Id}}")
