"""Tables bucketed, partitioned and packed; rejects of the reader and the parsers."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F, types as T

from salesloom import registry, schema
from salesloom.operators.keys import packed, shown
from salesloom.operators.lookup import lookup
from salesloom.plans import quality, star
from salesloom.sources.csv_feed import read_csv_feed, read_csv_with_rejects
from salesloom.sources.tables import CatalogStore, FileStore


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("single", [False, True])
def test_a_bucketed_dimension_is_not_shuffled(spark, tmp_path, no_broadcast, single):
    store = CatalogStore()
    dimension = spark.range(500).selectExpr("string(id) AS a", "string(id % 7) AS b", "id AS v")
    store.write_bucketed(dimension, "lies_bucketed", ["a", "b"], 4, str(tmp_path / "d"))
    assert len([f for f in os.listdir(tmp_path / "d") if f.endswith(".parquet")]) == 4
    rows = spark.range(1000).selectExpr(
        "if(id % 4 = 0, null, string(id % 600)) AS x", "string(id % 600 % 7) AS y"
    )
    found = lookup(rows, store.read(spark, "lies_bucketed"), {"x": "a", "y": "b"}, ["v"], single=single)
    text = plan(found)
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
    expected = {(r["x"], r["y"]): None if r["x"] is None or int(r["x"]) >= 500 else int(r["x"]) for r in rows.collect()}
    assert {(r["x"], r["y"]): r["v"] for r in found.collect()} == expected and found.count() == 1000


def test_orphans_of_a_bucketed_parent_shuffle_only_the_child(spark, tmp_path, no_broadcast):
    store = CatalogStore()
    store.write_bucketed(
        spark.range(100).selectExpr("string(id) AS id"), "parents_bucketed", ["id"], 8, str(tmp_path / "p")
    )
    child = spark.range(300).selectExpr("string(id % 120) AS child_id")
    report = quality.orphans(child, "c", "child_id", store.read(spark, "parents_bucketed"), "p", "id")
    shuffled = [line for line in plan(report).splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and all("hashpartitioning(child_id#" in line for line in shuffled)
    assert "Bucketed: true" in plan(report)
    assert report.first()["orphan_rows"] == 40


def test_replacing_a_month_touches_its_files_only(spark, sf_dir, tmp_path):
    feed = registry.staging(spark, sf_dir)
    store, fact = FileStore(str(tmp_path)), star.fact_by_month(feed)
    store.write_partitioned(fact, "fact_sales", star.MONTH)

    def state() -> dict[str, float]:
        found = {}
        for folder, _, names in os.walk(tmp_path / "fact_sales"):
            for name in names:
                if name.endswith(".parquet"):
                    found[os.path.join(folder, name)] = os.path.getmtime(os.path.join(folder, name))
        return found

    before = state()
    month = fact.where("sale_year = 1996 AND sale_month = 5")
    assert month.count() > 0
    store.replace_partitions(month.withColumn("sale_quantity", F.lit(1)), "fact_sales", star.MONTH)
    after = state()
    changed = set(before.items()) ^ set(after.items())
    assert changed and all("sale_year=1996/sale_month=5/" in path for path, _ in changed)
    table = store.read(spark, "fact_sales")
    assert table.count() == fact.count()
    assert table.where("sale_year IS NULL").count() == fact.where("sale_year IS NULL").count() > 0

    trend = star.sales_per_month(table, (1996, 4), (1996, 6))
    assert sorted((r["year"], r["month"]) for r in trend.collect()) == [(1996, 4), (1996, 5), (1996, 6)]
    text = plan(trend)
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "sale_year" in filters and "sale_month" in filters
    assert "ReadSchema: struct<sale_total_price:double>" in text


def test_months_are_dealt_with_packed_ids_and_written_as_text(spark, sf_dir, tmp_path):
    fact, ids = star.fact_by_month(registry.staging(spark, sf_dir)), list(schema.STAR_REFERENCES)
    store = FileStore(str(tmp_path))
    store.write_partitioned(fact, "fact_sales", star.MONTH, ids)
    found = store.read(spark, "fact_sales").select(*fact.columns)
    assert found.exceptAll(fact).isEmpty() and fact.exceptAll(found).isEmpty()
    dealt = store._partitioned(fact, star.MONTH, ids)._df
    assert dealt.schema["customer_id"].dataType == T.StringType()
    before_exchange = dealt._jdf.queryExecution().optimizedPlan().toString().split("Rebalance")[1]
    assert all(f"unhex({c}" in before_exchange or f") AS {c}" in before_exchange for c in ids)
    assert "unhex(" in before_exchange


def test_packed_ids_take_half_the_width_and_come_back(spark, sf_dir, tmp_path):
    fact, ids = star.fact(registry.staging(spark, sf_dir)), list(schema.STAR_REFERENCES)
    narrow = packed(fact, ids)
    assert {narrow.schema[c].dataType for c in ids} == {T.BinaryType()}
    assert narrow.agg(F.max(F.length("customer_id"))).first()[0] == 16
    assert shown(narrow, ids).exceptAll(fact).isEmpty()
    sizes = []
    for name, df in (("wide", fact), ("narrow", narrow)):
        df.write.parquet(str(tmp_path / name))
        sizes.append(sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet")))
    assert sizes[1] < 0.85 * sizes[0]  # few different ids, mostly held by dictionaries


# --- rejects -----------------------------------------------------------------------

THREE = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])


def test_broken_records_are_rejected_with_their_place(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b,c\n1,2,3\nshort,2\n"x\ny",2,3\n\n4,5,6,7\n8,"",\n')
    (tmp_path / "two.csv").write_text('a,b,c\r\n5,6,7\r\n"two\nlines",2\n')
    good, bad = read_csv_with_rejects(spark, str(tmp_path), THREE)

    def place(r):
        return os.path.basename(r["file"]), r["record"]

    assert {(*place(r), r["a"], r["b"], r["c"]) for r in good.collect()} == {
        ("one.csv", 2, "1", "2", "3"), ("one.csv", 4, "x\ny", "2", "3"), ("one.csv", 7, "8", "", None),
        ("two.csv", 2, "5", "6", "7"),
    }
    assert {(*place(r), r["line"], r["reason"], r["text"]) for r in bad.collect()} == {
        ("one.csv", 3, 1, "number of fields", "short,2"),
        ("one.csv", 6, 1, "number of fields", "4,5,6,7"),
        ("two.csv", 3, 1, "number of fields", '"two\nlines",2'),
    }
    with pytest.raises(Exception, match="[Mm]alformed"):
        read_csv_feed(spark, str(tmp_path), THREE).collect()


@pytest.mark.parametrize("split_bytes", ["64", "128m"])
def test_a_quote_that_is_never_closed_rejects_its_lines_one_by_one(spark, tmp_path, split_bytes):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, split_bytes)
    try:
        lost = [f"line {i},with,some text" for i in range(40)]
        (tmp_path / "open.csv").write_text('a,b,c\n1,2,3\n4,"5,6\n' + "\n".join(lost) + "\n")
        (tmp_path / "fine.csv").write_text("a,b,c\n7,8,9\n")
        good, bad = read_csv_with_rejects(spark, str(tmp_path), THREE)
        assert sorted(r["a"] for r in good.collect()) == ["1", "7"]
        rows = sorted((r["record"], r["line"], r["text"]) for r in bad.collect())
        assert rows == [(3, i + 1, text) for i, text in enumerate(['4,"5,6', *lost])]
        with pytest.raises(Exception, match="unterminated quote"):
            read_csv_feed(spark, str(tmp_path), THREE).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_parse_rejects_agree_with_the_counts(spark, sf_dir):
    feed = registry.broken_staging(spark, sf_dir)
    counts = {
        (r["rule"], r["column_name"]): (r["unreadable"], r["raises"])
        for r in quality.parse_failures(feed).collect() if r["unreadable"] or r["raises"]
    }
    found = quality.parse_rejects(feed, "id").groupBy("rule", "column_name").agg(
        F.count_if(~F.col("raises")).alias("unreadable"), F.count_if("raises").alias("raises")
    )
    assert {(r[0], r[1]): (r[2], r[3]) for r in found.collect()} == counts and len(counts) > 5
