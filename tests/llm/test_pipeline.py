"""The registered queries and the corpus pipeline on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from tidemark.llm import mixing, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are not here")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    result = con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    form = lambda rows: Counter(tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r) for r in rows)
    assert form(df.select(*names).collect()) == form(result.fetchall())


def test_pipeline_stages(spark):
    docs = queries.table(spark, SF, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns, name
        path = queries.new_path(spark, "stage")
        after.write.parquet(path)
        after = spark.read.parquet(path)
        ids, kept = Counter(r[0] for r in before.select("doc_id").collect()), Counter(r[0] for r in after.select("doc_id").collect())
        assert set(kept) <= set(ids), name
        if name in ("toxicity", "near_duplicates"):
            assert all(n == 1 for n in kept.values()) and len(kept) <= len(ids)
        if name == "repeated_passages":
            assert kept == ids and all(r.n_chars == len(r.text) for r in after.collect())
        if name == "mixing":
            assert kept == Counter({r.doc_id: r.times for r in mixing.mixture(before).collect() if r.times})
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert pieces.where("piece = 0").count() == before.count()


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{n}" for n in range(1, 11)}
    assert set(__spark_entry__.oracle_sql()) <= names
