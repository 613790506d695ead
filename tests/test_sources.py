from __future__ import annotations

import random
import time
from collections import Counter

import pytest
from pyspark.sql import types as T

from salesloom import schema
from salesloom.sources.csv_feed import read_csv_feed, write_csv_feed
from salesloom.sources.tables import CatalogStore, FileStore, JdbcStore, write_counted

THREE = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])


def write(folder, text, name="FEED DATA (1).csv"):
    (folder / name).write_text(text, encoding="utf-8", newline="")
    return str(folder)


def test_null_empty_quotes_and_newlines(spark, tmp_path):
    path = write(tmp_path, 'a,b,c\n1,,"x ""q"" y"\n\n2,"","a\nb"\n 3 ,é,z\n')
    rows = {r.a: (r.b, r.c) for r in read_csv_feed(spark, path, THREE).collect()}
    assert rows == {"1": (None, 'x "q" y'), "2": ("", "a\nb"), " 3 ": ("é", "z")}


def test_columns_by_position_over_many_files(spark, tmp_path):
    write(tmp_path, "x,y,z\n1,2,3\n")
    write(tmp_path, "z,y,x\r\n4,5,6\r\n", "FEED DATA.csv")
    df = read_csv_feed(spark, str(tmp_path / "FEED DATA*.csv"), THREE)
    assert sorted(map(tuple, df.collect())) == [("1", "2", "3"), ("4", "5", "6")]


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "64")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


FIELDS = [
    "", '""', "plain", " blanks ", '"quoted"', '"a ""q"" b"', '"line\nbreak"', '"\n"', '"a\n\nb"',
    '"comma, ""and\n""both"', '"""start"', '"end"""', '"crlf\r\nbreak"', '"' + "long\n" * 40 + '"', "é",
]


def whole_file_parse(folder):
    """Every file of a folder read at once by Python's csv, NULL and '' told apart by hand."""
    rows = []
    for path in sorted(folder.glob("*.csv")):
        with path.open(encoding="utf-8", newline="") as file:
            text = file.read()
        record, field, quoted, was_quoted, i = [], "", False, False, 0
        done = []

        def close():
            record.append(field if field or was_quoted else None)

        while i < len(text):
            c = text[i]
            if quoted:
                if text[i : i + 2] == '""':
                    field, i = field + '"', i + 1
                elif c == '"':
                    quoted = False
                else:
                    field += c
            elif c == '"':
                quoted = was_quoted = True
            elif c in ",\n":
                if c == "\n" and i and text[i - 1] == "\r":
                    field = field[:-1]
                close()
                field, was_quoted = "", False
                if c == "\n":
                    done.append(tuple(record))
                    record = []
            else:
                field += c
            i += 1
        if field or was_quoted or record:
            close()
            done.append(tuple(record))
        rows += [r for r in done[1:] if r != (None,)]
    return Counter(rows)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_files_are_read_in_splits_like_whole_ones(spark, tmp_path, small_splits, end):
    """Every mix of fields, cut into splits of 64 bytes, inside and outside of quotes."""
    pick = random.Random(5)
    for name in ("FEED.csv", "FEED (1).csv"):
        rows = [",".join(pick.choice(FIELDS) for _ in range(3)) for _ in range(150)]
        rows += ["", ",".join(["x"] * 3)]
        write(tmp_path, end.join(["a,b,c", *rows]) + (end if name == "FEED.csv" else ""), name)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
    found = read_csv_feed(spark, str(tmp_path), THREE)
    # A row of three unquoted empty fields still has two commas, so it is not a blank line.
    assert Counter(map(tuple, found.collect())) == whole_file_parse(tmp_path)
    assert found.count() == 302


def test_files_are_read_twice(spark, tmp_path):
    df = read_csv_feed(spark, write(tmp_path, "a,b,c\n1,2,3\n"), THREE)
    assert df.collect() == [("1", "2", "3")]
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("FileScan text") == 2


def test_written_feed_reads_back(spark, tmp_path):
    rows = [(None, "", " a "), ('"q"', "x,y", "l1\r\nl2\n"), ("é", "\\", None)]
    df = spark.createDataFrame(rows, THREE)
    write_csv_feed(df, str(tmp_path / "out"))
    assert Counter(map(tuple, read_csv_feed(spark, str(tmp_path / "out"), THREE).collect())) == Counter(rows)


@pytest.mark.parametrize("bad", ["1,2", "1,2,3,4", '1,"x,3'])
def test_malformed_rows_raise(spark, tmp_path, bad):
    path = write(tmp_path, f"a,b,c\n1,2,3\n{bad}\n")
    with pytest.raises(Exception):
        read_csv_feed(spark, path, THREE).collect()


def test_staging_schema():
    assert len(schema.STAGING_SCHEMA) == 50 == len(set(schema.STAGING_COLUMNS))
    assert all(f.nullable and f.dataType == T.StringType() for f in schema.STAGING_SCHEMA)


def test_file_store_overwrites(spark, tmp_path):
    store = FileStore(str(tmp_path))
    for n in (5, 3):
        assert write_counted(store, spark.range(n), "t") == n
    assert store.read(spark, "t").count() == 3


def test_catalog_store(spark):
    store = CatalogStore()
    columns = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    store.create_if_absent(spark, "kept", columns)
    store.append(spark.createDataFrame([("x", 1)], "b string, a int"), "kept")
    store.create_if_absent(spark, "kept", columns)
    assert [tuple(r) for r in store.read(spark, "kept").collect()] == [(1, "x")]
    assert write_counted(store, spark.createDataFrame([(2, "y")], "a int, b string"), "kept") == 1
    assert [tuple(r) for r in store.read(spark, "kept").collect()] == [(2, "y")]


def test_jdbc_options():
    """No database here: only what is handed to Spark's reader and writer is checked."""
    store = JdbcStore(
        "jdbc:x://h/d", {"user": "u", "driver": "d"},
        {"t": {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}},
        connections=4, write_options={"truncate": "true"},
    )
    assert store.reader_options("t") == {
        "user": "u", "driver": "d", "url": "jdbc:x://h/d", "dbtable": "t",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3",
    }
    assert store.writer_options("other") == {
        "user": "u", "driver": "d", "url": "jdbc:x://h/d", "dbtable": "other",
        "truncate": "true", "numPartitions": "4",
    }


def test_csv_text_is_read_without_a_shuffle_of_its_lines(spark, tmp_path):
    """Lines are joined to records where they lie, whatever the splits and the compression."""
    rows = [(str(i), f'x "{i}"\n\r\n,{"y" * (i % 50)}', None if i % 3 else "") for i in range(500)]
    df = spark.createDataFrame(rows, THREE).repartition(2)
    write_csv_feed(df, str(tmp_path / "plain"))
    write_csv_feed(df, str(tmp_path / "packed"), "gzip", 100)
    assert len(list((tmp_path / "packed").glob("*.csv.gz"))) >= 5
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for size in ("400", "128m"):
        for name in names:
            spark.conf.set(name, size)
        try:
            for kind in ("plain", "packed"):
                found = read_csv_feed(spark, str(tmp_path / kind), THREE)
                assert Counter(map(tuple, found.collect())) == Counter(rows)
        finally:
            for name in names:
                spark.conf.set(name, before[name])
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in text
    # Only counts of splits and parts of records that several splits share are grouped or ordered.
    for node in text.splitlines():
        if "Window [" in node:
            assert "value" not in node


def test_orders_meet_their_customers_before_line_items(spark, sf_dir):
    from salesloom.sources.retail import staging_feed

    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = staging_feed(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    # No line item is dealt by customer: what lies under that shuffle is the scan of orders.
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "hashpartitioning(o_custkey" in line)
    scanned = next(line for line in lines[at:] if "FileScan" in line)
    assert "o_orderkey" in scanned and "l_orderkey" not in scanned


def test_tables_are_written_with_small_methods_in_any_session(spark):
    from salesloom.session import METHODS, small_methods

    held = spark.conf.get(METHODS)
    spark.conf.set(METHODS, "65535")
    try:
        with small_methods(spark):
            assert spark.conf.get(METHODS) == "8000"
        assert spark.conf.get(METHODS) == "65535"
    finally:
        spark.conf.set(METHODS, held)


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from salesloom.session import WHILE_WRITING, materialize, writing

    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup)
    with writing(spark):
        with writing(spark):
            assert all(spark.conf.get(n) == v for n, v in WHILE_WRITING.items())
        assert spark.conf.get(cleanup) == "true"  # another thread is still writing
    assert spark.conf.get(cleanup) == before

    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles() -> set[str]:
        blocks = local.getAllBlocks().iterator()
        found = set()
        while blocks.hasNext():
            found.add(blocks.next().name())
        return {name for name in found if name.startswith("shuffle_")}

    spark.sparkContext._jvm.System.gc()
    held = shuffles()
    table = materialize(
        spark.range(20000).groupBy((F.col("id") % 5000).alias("k")).agg(F.count("id").alias("n")), "t"
    )
    for _ in range(50):
        left = shuffles() - held
        if not left:
            break
        time.sleep(0.1)
    assert not left and table.count() == 5000


def test_parts_are_described_once_and_prices_raise_only_where_sold(spark, sf_dir, tmp_path):
    from pyspark.sql import functions as F

    from salesloom import registry
    from salesloom.sources.retail import staging_feed

    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = staging_feed(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "hashpartitioning(p_partkey" in line)
    assert "split_part" in lines[at + 1] or "_product_color" in lines[at + 1]

    for table in registry.SOURCES:
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        if table == "part":
            dear = rows.limit(1).withColumn("p_retailprice", F.lit(1e300))
            rows = rows.unionByName(dear.withColumn("p_partkey", F.lit(-5).cast("bigint")))
        if table == "lineitem":
            sold = rows.limit(1).withColumn("l_partkey", F.lit(-5).cast("bigint"))
            rows.unionByName(sold).write.parquet(str(tmp_path / "sold" / f"{table}.parquet"))
        else:
            rows.write.parquet(str(tmp_path / "sold" / f"{table}.parquet"))
        rows.write.parquet(str(tmp_path / "unsold" / f"{table}.parquet"))
    expected = staging_feed(spark, sf_dir)
    found = staging_feed(spark, str(tmp_path / "unsold"))
    assert found.exceptAll(expected).isEmpty() and found.count() == expected.count()
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|out of range|cannot be represented"):
        staging_feed(spark, str(tmp_path / "sold")).select("product_price").collect()


def test_text_is_read_again_only_for_records_that_lie_in_several_splits(spark, tmp_path, monkeypatch):
    """Whole files hold whole records: no line reaches the tasks that would gather parts."""
    from salesloom.sources import csv_feed

    lines_joined, join = spark.sparkContext.accumulator(0), csv_feed._join_lines()

    def counting(batches):
        def counted():
            for batch in batches:
                lines_joined.add(batch.num_rows)
                yield batch

        return join(counted())

    monkeypatch.setattr(csv_feed, "_join_lines", lambda: counting)
    folder = tmp_path / "feed"
    folder.mkdir()
    for n in range(3):
        lines = [f'{n},"ü ""{i}""\nsecond",{i}' for i in range(200)]
        (folder / f"{n}.csv").write_text("a,b,c\n" + "\n".join(lines) + "\n", encoding="utf-8")
    settings = {
        "small": {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"},
        "whole": {"spark.sql.files.maxPartitionBytes": "128m", "spark.sql.files.openCostInBytes": "4m"},
    }
    joined = {}
    for name, conf in settings.items():
        before = {k: spark.conf.get(k) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            found = read_csv_feed(spark, str(folder), THREE)
            rows = sorted(map(tuple, found.collect()))
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        joined[name], lines_joined.value = lines_joined.value, 0
        assert rows == sorted(
            (str(n), f'ü "{i}"\nsecond', str(i)) for n in range(3) for i in range(200)
        )
    assert joined["whole"] == 3 * 401 and joined["small"] > 3 * 401, joined
