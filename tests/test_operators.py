from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesloom.operators.contract import conform, contract_report
from salesloom.operators.dedup import one_row_per_key
from salesloom.operators.keys import (
    content_key, content_key_if_complete, dense_key, dense_key_of_copies,
)
from salesloom.operators.lookup import lookup
from salesloom.session import shared_directory


def test_one_row_per_key_is_smallest_nulls_first(spark):
    rows = [("a", "2", "x"), ("a", None, "z"), ("a", None, "y"), (None, "1", "p"), (None, "0", "q")]
    df = spark.createDataFrame(rows, "k string, p string, q string")
    kept = {tuple(r) for r in one_row_per_key(df, ["k"], ["p", "q"]).collect()}
    assert kept == {("a", None, "y"), (None, "0", "q")}


def test_one_row_per_key_ignores_order_and_partitions(spark):
    df = spark.range(5000).selectExpr(
        "cast(id % 37 as string) k", "cast(id * 7919 % 101 as string) p",
        "cast(id * 104729 % 11 as string) q",
    )
    expected = sorted(one_row_per_key(df, ["k"], ["p", "q"]).collect())
    for shuffled in (df.orderBy(F.rand(1)), df.repartition(1), df.repartition(13, "q")):
        for partitions in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert sorted(one_row_per_key(shuffled, ["k"], ["p", "q"]).collect()) == expected
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_content_keys_tell_any_two_tuples_apart(spark):
    rows = [
        ("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), ("n", "ab"), (None, None),
        ("1:a", "b"), ("a|1:b", ""), ("a", "b|"), ("a|", "b"), ("n|n", None), ("0:", ""), ("", ""),
    ]
    df = spark.createDataFrame(rows, "x string, y string")
    keys = df.select(
        content_key(F.col("x"), F.col("y")).alias("k"),
        content_key_if_complete(F.col("x"), F.col("y")).alias("c"),
    ).collect()
    assert len({r.k for r in keys}) == len(rows)
    assert [r.c for r in keys] == [r.k if None not in row else None for r, row in zip(keys, rows)]


def test_dense_key_is_1_to_n_and_repeatable(spark):
    df = spark.range(3000).selectExpr("cast(id as string) k", "id % 3 as v")
    first = dense_key(df, "n", ["k"])
    assert first.columns == ["n", "k", "v"]
    rows = first.collect()
    assert sorted(r.n for r in rows) == list(range(1, 3001))
    again = dense_key(df.orderBy(F.rand(3)).repartition(5), "n", ["k"], bucket_digits=4).collect()
    assert sorted(rows) == sorted(again)


@pytest.mark.parametrize("chunk", [1, 7, 100_000])
def test_dense_key_of_copies(spark, chunk):
    """A third of the rows are copies of one row; every copy gets its own number."""
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) k", "null as v")
    rows = dense_key_of_copies(df, "n", chunk=chunk).collect()
    assert sorted(r.n for r in rows) == list(range(1, 3001))
    assert Counter(r.k for r in rows)["hot"] == 1000


def test_dense_key_of_nothing(spark):
    empty = spark.createDataFrame([], "k string")
    assert dense_key(empty, "n", ["k"]).collect() == []
    assert dense_key_of_copies(empty, "n").collect() == []


def test_lookup_kinds(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (4, "b")], "i int, k string")
    table = spark.createDataFrame(
        [("a", "A"), ("b", "B1"), ("b", "B2"), (None, "N")], "key string, v string"
    )

    def joined(how, null_safe=()):
        found = lookup(rows, table, {"k": "key"}, ["v"], how, null_safe)
        return Counter((r.i, r.v) for r in found.collect())

    assert joined("left") == Counter([(1, "A"), (2, None), (3, None), (4, "B1"), (4, "B2")])
    assert joined("inner") == Counter([(1, "A"), (4, "B1"), (4, "B2")])
    assert joined("inner", ["k"]) == Counter([(1, "A"), (2, "N"), (4, "B1"), (4, "B2")])


def test_hot_and_null_keys_are_split(spark):
    """A key with a third of the rows, and as many NULL keys, through a shuffled left join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(0, 300_000, 1, 8).selectExpr(
            "id", "sha2(cast(id as string), 256) payload", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null "
            "else cast(id % 5000 as string) end k",
        )
        table = spark.range(5000).selectExpr("cast(id as string) key", "id v").union(
            spark.sql("select 'hot', -1L")
        )
        found = lookup(rows, table, {"k": "key"}, ["v"], "left")
        counts = found.agg(
            F.count(F.lit(1)), F.count_if(F.col("v") == -1), F.count_if(F.col("v").isNull()),
            F.countDistinct("id"),
        )
        assert tuple(counts.first()) == (300_000, 100_000, 100_000, 300_000)

        per_task = found.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
            F.count(F.lit(1)).alias("rows"), F.max("payload")
        )
        assert max(r.rows for r in per_task.collect()) < 60_000
        executed = found._jdf.queryExecution().executedPlan()
        found.collect()
        assert "skew=true" in executed.toString()
        assert "hashpartitioning(_spread#" in executed.toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


DECLARED = {"id": "key", "name": "varchar(3)", "amount": "decimal(4,2)", "n": "int"}


def table(spark, *rows):
    return spark.createDataFrame(rows, "id string, name string, amount string, n int").withColumn(
        "amount", F.col("amount").cast("decimal(38,18)")
    )


def test_conform_rounds_half_away_and_cuts_blanks(spark):
    df = table(spark, ("1", "abc  ", "1.005", 1), ("2", None, "-1.005", None), ("3", "", "4.554", 2))
    rows = {r.id: (r.name, None if r.amount is None else str(r.amount), r.n)
            for r in conform(df, DECLARED).collect()}
    assert rows == {"1": ("abc", "1.01", 1), "2": (None, "-1.01", None), "3": ("", "4.55", 2)}


@pytest.mark.parametrize("row", [("1", "abcd", "1", 1), ("1", "a", "100", 1)])
def test_conform_raises(spark, row):
    with pytest.raises(Exception, match="does not fit"):
        conform(table(spark, row), DECLARED).collect()


def test_contract_report(spark):
    df = table(
        spark, ("1", "abcd", "100", 1), ("2", "abc  ", "1.005", None), ("3", None, "1.25", 2)
    )
    rows = {r.column_name: (r.values_present, r.not_storable, r.rounded)
            for r in contract_report(df, "t", DECLARED).collect()}
    assert rows == {"name": (2, 1, 0), "amount": (3, 1, 1), "n": (2, 0, 0)}


def test_shared_directory_is_the_configured_one(spark):
    assert shared_directory(spark) == spark.conf.get("spark.checkpoint.dir")


def test_numbers_of_copies_do_not_depend_on_the_piece_size(spark):
    df = spark.createDataFrame([("a",)] * 7 + [("b",)] * 3 + [(None,)], "k string")
    small = dense_key_of_copies(df, "n", chunk=2).collect()
    assert sorted(map(tuple, small), key=str) == sorted(
        map(tuple, dense_key_of_copies(df, "n").collect()), key=str)


@pytest.mark.parametrize("digits", [0, 5])
def test_too_many_ranges_are_refused(spark, digits):
    with pytest.raises(ValueError):
        dense_key(spark.createDataFrame([("a",)], "k string"), "n", ["k"], bucket_digits=digits)


def test_numbering_by_value_shuffles_wide_rows_once(spark):
    """Rows of ranges that are not hot go straight to their range, content keys as 16 bytes, and
    get the numbers they get when every range is hot."""
    sales = spark.range(4000).select(
        F.md5((F.col("id") % 700).cast("string")).alias("a_id"),
        F.when(F.col("id") % 5 > 0, F.md5((F.col("id") % 3).cast("string"))).alias("b_id"),
        (F.col("id") % 2).alias("n"),
    )
    columns = ["sale_id", "a_id", "b_id", "n"]
    few = dense_key_of_copies(sales, "sale_id", 2, pack=["a_id", "b_id"])
    rows = sorted(map(tuple, few.select(*columns).collect()))
    assert [r[0] for r in rows] == list(range(1, 4001))
    hot = dense_key_of_copies(sales, "sale_id", 2, chunk=2)
    assert sorted(map(tuple, hot.select(*columns).collect())) == rows
    # Whole rows are grouped only in hot ranges; the others are ordered where they arrive.
    text = few._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex(a_id" in text and "row_number()" in text
    assert text.count("Window [sum(_n") == 1 and text.count("Window [row_number()") == 1


def test_written_tuples_are_ordered_as_their_columns_and_come_back(spark):
    """Bytes that end or mark a value may be part of one; NULL, '' and prefixes stay apart."""
    import random

    from salesloom.operators.dedup import read_back, written

    rng = random.Random(4)
    texts = [None, "", "\x00", "\x01", "\x02", "\x01\x02", "\x01\x01", "\x00\x02", "a", "ab", "ä|", "a\x00"]
    texts += ["".join(rng.choice("\x00\x01\x02a") for _ in range(rng.randint(1, 6))) for _ in range(40)]
    rows = [(rng.choice(texts), rng.choice(texts), rng.choice(texts)) for _ in range(400)]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    told = df.select("*", written("x", "y", "z").alias("w"))
    found = [tuple(r) for r in told.select("x", "y", "z", *[
        c.alias(f"{n}_") for n, c in zip("xyz", read_back("w", "x", "y", "z"))
    ], "w").collect()]
    assert all(r[:3] == r[3:6] for r in found)

    def order(row):
        return [(t is not None, (t or "").encode()) for t in row[:3]]

    assert [order(r) for r in sorted(found, key=lambda r: r[6].encode())] == sorted(map(order, rows))
    assert len({r[6] for r in found}) == len(set(rows))
    kept = {tuple(r) for r in one_row_per_key(df, ["x"], ["y", "z"]).collect()}
    best = {}
    for row in sorted(rows, key=order):
        best.setdefault(row[0], row)
    assert kept == set(best.values())


def test_descriptions_are_shuffled_as_two_columns(spark):
    df = spark.createDataFrame([("a", "b", "c", "d")], "k string, l string, p string, q string")
    plan = one_row_per_key(df, ["k", "l"], ["p", "q"])._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 2 and "(_key#" in dealt[0] and "(_key#" in dealt[1] and "_payload#" in dealt[1]
    # Numbers are compared as numbers.
    numbers = spark.createDataFrame([("a", 10), ("a", 9)], "k string, n int")
    assert [tuple(r) for r in one_row_per_key(numbers, ["k"], ["n"]).collect()] == [("a", 9)]
