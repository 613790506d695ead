"""Every stage of the pipeline against a plain version of it."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salesloom.llm import queries
from salesloom.llm.common import stage

from tests.llm.conftest import EDGE_ROWS
from tests.llm.test_ngram_join import brute
from tests.llm.test_other_operators import contaminated, words
from tests.llm.test_spans_pii_secrets import base_pii

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The documents before each stage, and the pipeline's rows."""
    docs = [queries.table(spark, sf_dir, "documents")]
    for name, function in corpus_pipeline.STAGES:
        docs.append(stage(function(spark, docs[-1], sf_dir), f"test-{name}"))
    return docs


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_are_the_dealt_ones_and_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "ngram_jaccard", "decontamination", "personal_data", "packing"]
    assert all(df.columns == COLUMNS for df in stages[:-1])
    for before, after in zip(stages, stages[1:-1]):
        assert [f.dataType for f in before.schema] == [f.dataType for f in after.schema]


def test_language_drops_only_texts_without_letters(stages):
    want = [(d, t) for d, t in rows(stages[0]) if t and any(c.isalpha() for c in t)]
    assert rows(stages[1]) == want


def test_language_keeps_a_corpus_without_labels(spark, sf_dir, documents):
    docs = documents([(1, "some words", None), (2, "12 !", None), (3, None, None), (4, "日本", None)])
    kept = corpus_pipeline.language_id(spark, docs, sf_dir).collect()
    assert sorted((r["doc_id"], r["lang"]) for r in kept) == [(1, None), (4, None)]


def test_one_of_each_group_stays(stages):
    before = rows(stages[1])
    keep = {d for d, _, root in brute(before, 5, 80, 100) if d == root}
    assert rows(stages[2]) == [(d, t) for d, t in before if d in keep]


def test_benchmark_passages_go_and_clean_texts_stay(spark, sf_dir, stages):
    items = [tuple(r) for r in queries.table(spark, sf_dir, "benchmark").collect()]
    before, after = rows(stages[2]), dict(rows(stages[3]))
    found = contaminated(before, items, 10)
    assert any(hit for _, hit, _ in found.values())
    for doc, text in before:
        n, hit, _ = found[doc]
        if not hit:
            assert after[doc] == text
        elif len(hit) < n:
            assert words(after[doc]) == [w for i, w in enumerate(words(text)) if i not in hit]
        else:
            assert doc not in after


def test_personal_data_goes_and_other_texts_stay(stages):
    before, after = rows(stages[3]), dict(rows(stages[4]))
    assert set(after) == {d for d, _ in before}
    assert any(base_pii(t) for _, t in before)
    for doc, text in before:
        if not base_pii(text) and "[" not in after[doc]:
            assert after[doc] == text
        assert not base_pii(after[doc])


def test_run_packs_every_kept_document(spark, sf_dir, stages):
    packed = corpus_pipeline.run(spark, sf_dir)
    own = sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed.collect())
    assert own == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in stages[5].collect())
    assert {d for d, _, _ in own} == {d for d, _ in rows(stages[4])}
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    assert fill.agg(F.max("fill")).first()[0] <= 1024


def test_edge_rows_and_empty_tables_pass_every_stage(spark, sf_dir, edge, empty):
    for docs, some in ((edge, True), (empty, False)):
        for name, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, sf_dir), f"edge-{name}")
            assert bool(docs.take(1)) == some, name
    assert len(EDGE_ROWS) > docs.count()


def test_user_columns_come_out_as_they_were(spark, sf_dir, documents):
    """Columns with the names that operators and stages use for their own, values told by the id."""
    names = ["n_words", "spans", "items", "base", "added", "_found", "_row", "_kept", "_rows", "_at",
             "digest", "at", "u", "v", "part", "payload"]
    docs = documents([(i, t, l) for i, t, l in EDGE_ROWS if i not in (None, 6)])
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in names})
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"own-{name}")
        assert docs.columns == columns, name
        found = docs.select("doc_id", *names).collect()
        assert found and all(r[c] == f"{c} of {r['doc_id']}" for r in found for c in names), name


def test_library_works_without_the_folder():
    """The entry module imports, with fewer queries, where the corpus operators are absent."""
    code = (
        "import importlib.util as u; find = u.find_spec\n"
        "u.find_spec = lambda n, *a: None if n.startswith(('salesloom.llm', 'corpus_pipeline')) else find(n, *a)\n"
        "import __spark_entry__ as e\n"
        "assert 'fact_sales' in e.queries() and not any(q.startswith('op') for q in e.queries())\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_sql_agrees(spark, sf_dir):
    import duckdb

    connection = duckdb.connect()
    for name in ("documents", "benchmark", "pages"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        mine = queries.QUERIES[name](spark, sf_dir)
        columns = sorted(mine.columns)
        theirs = connection.sql(f"SELECT {', '.join(map(chr(34).__add__, (c + chr(34) for c in columns)))} FROM ({sql})")
        want = sorted(theirs.fetchall(), key=repr)
        assert sorted(map(tuple, mine.select(*columns).collect()), key=repr) == want, name
