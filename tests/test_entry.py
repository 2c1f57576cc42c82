"""The driver's contract, with and without the subpackage of training-data operators."""

import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from tidemark.plans import catalogue

SF, REPO = "/root/testdata/sf0.001", Path(__file__).resolve().parent.parent
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are not here")


@needs_tables
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


@needs_tables
@pytest.mark.parametrize("name", ["plan_report", "entry_warnings", "bounds_classification", "two_org_load", "crash_recovery"])
@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_marks_do_not_follow_the_zone(spark, name, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        compared(spark, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@needs_tables
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_queries_match_their_sql(spark, name):
    compared(spark, name)


def compared(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    result = con.execute(catalogue.ORACLES[name])
    names = [d[0] for d in result.description]
    df = catalogue.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    form = lambda rows: Counter(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    assert form(df.select(*names).collect()) == form(result.fetchall())


def test_the_library_stands_without_the_subpackage(tmp_path):
    shutil.copytree(REPO, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; assert len(e.queries()) > 30 and not any(n.startswith('op') for n in e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True)
