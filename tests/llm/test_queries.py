"""Queries against their DuckDB twins, and the pipeline against plain Python, on the given tables."""

import brute
import duckdb
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from indicata.llm import quality_knn
from indicata.llm.oracle import LLM_ORACLE
from indicata.llm.queries import LLM_REGISTRY
from tools.check import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, twin = LLM_REGISTRY[name](spark, SF), con.sql(LLM_ORACLE[name])
    assert sorted(df.columns) == sorted(twin.columns)
    one, two = digest(df.columns, [tuple(r) for r in df.collect()]), digest(twin.columns, twin.fetchall())
    assert one[1] == two[1]


@pytest.mark.parametrize("name", sorted(LLM_REGISTRY))
def test_every_document_has_a_row(spark, name):
    if name in ("op4_warc_fixity", "op5_preference_format", "op12_conversation_repair", "op13_lexical_search"):
        pytest.skip("rows of pages, conversations and items")
    df = LLM_REGISTRY[name](spark, SF)
    ids = [r["doc_id"] for r in df.select("doc_id").collect()]
    assert sorted(ids) == sorted(pq.read_table(f"{SF}/documents.parquet")["doc_id"].to_pylist())


def test_pipeline_equals_brute_force(spark):
    """Every stage on what the one before it kept. The classifier's score comes from its own model."""
    source = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    docs = {r["doc_id"]: r for r in source.collect()}

    kept = stages["quality classifier"](spark, source, SF).cache()
    assert kept.columns == source.columns
    model = quality_knn.fit(source, spark.read.parquet(f"{SF}/labels.parquet"), "quality", lambda _: corpus_pipeline.F.lit(True))
    shapes = quality_knn.Shapes()
    want = {i for i, r in docs.items() if model.scores([quality_knn.term_counts(r["text"].encode(), shapes)])[0] >= 0.3}
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert set(rows) == want and 0 < len(want) < len(docs) and all(rows[i] == docs[i] for i in want)

    single = stages["n-gram Jaccard join"](spark, kept, SF).cache()
    parts = brute.components([(i, r["text"]) for i, r in rows.items()], 5, 80, 100)
    rows = {r["doc_id"]: r for r in single.collect()}
    assert set(rows) == {i for i, (_, c) in parts.items() if c == i} and all(rows[i] == docs[i] for i in rows)

    thin = stages["substring dedup"](spark, single, SF).cache()
    removed = {r[0]: r for r in brute.without_repeats(sorted((i, r["text"]) for i, r in rows.items()))}
    rows = {r["doc_id"]: r for r in thin.collect()}
    assert set(rows) == set(removed) and any(r[2] for r in removed.values())
    for i, r in rows.items():
        if removed[i][2]:
            assert len(brute.SPACE.findall(r["text"])) == removed[i][1] - removed[i][2] and r["n_chars"] == len(r["text"])
        else:
            assert r == docs[i]

    clean = stages["benchmark decontamination"](spark, thin, SF).cache()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {r[0] for r in brute.contamination([(i, r["text"]) for i, r in rows.items()], items) if r[5]}
    assert {r["doc_id"]: r for r in clean.collect()} == {i: r for i, r in rows.items() if i not in bad}

    mix = stages["mixing sources to target weights"](spark, clean, SF).collect()
    assert {r["doc_id"] for r in mix} <= set(rows) - bad and all(r["copies"] in (1, 2) for r in mix)
    ran = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, ran), key=str) == sorted(map(tuple, mix), key=str)


def test_pipeline_on_odd_tables(spark, table, tmp_path):
    """Null and repeated rows, clashing columns, tables without rows."""
    import data
    from pyspark.sql import functions as F

    for name, rows in (("odd", data.ODD), ("none", [])):
        sf = str(tmp_path / name)
        docs = table(rows).withColumns({"lang": F.lit("en"), "n_chars": F.char_length("text").cast("long")})
        docs.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        out = corpus_pipeline.run(spark, sf).collect()
        assert {r["doc_id"] for r in out} <= {i for i, _ in rows}
        assert bool(out) == bool(rows)


def test_nothing_else_imports_the_subpackage():
    import pathlib
    import re

    root = pathlib.Path(corpus_pipeline.__file__).parent
    for path in [*root.glob("*.py"), *(root / "indicata").rglob("*.py"), *(root / "tools").rglob("*.py")]:
        if "llm" in path.parts or path.name in ("corpus_pipeline.py", "__spark_entry__.py"):
            continue
        assert not re.search(r"import.*\bllm\b|indicata\.llm|corpus_pipeline", path.read_text()), path
