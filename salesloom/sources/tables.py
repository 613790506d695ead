"""Tables between the stages: files, catalog tables or any JDBC database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from salesloom.operators.keys import packed, shown


@dataclass(frozen=True)
class FileStore:
    """One folder per table."""

    root: str
    format: str = "parquet"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format(self.format).load(self.path(table))

    def write(self, df: DataFrame, table: str, mode: str = "overwrite") -> None:
        df.write.format(self.format).mode(mode).save(self.path(table))

    def write_partitioned(
        self, df: DataFrame, table: str, by: Sequence[str], keys: Sequence[str] = ()
    ) -> None:
        """A table with a folder per value of ``by``; filters on these columns skip folders.

        Content keys named in ``keys`` are shuffled as 16 bytes, and written as they are.
        """
        self._partitioned(df, by, keys).mode("overwrite").save(self.path(table))

    def replace_partitions(
        self, df: DataFrame, table: str, by: Sequence[str], keys: Sequence[str] = ()
    ) -> None:
        """Replace the partitions that ``df`` has rows of, whole; the others are not touched."""
        self._partitioned(df, by, keys).option("partitionOverwriteMode", "dynamic").mode(
            "overwrite"
        ).save(self.path(table))

    def _partitioned(self, df: DataFrame, by: Sequence[str], keys: Sequence[str]):
        # Few files per partition; adaptive execution splits one that is large.
        dealt = shown(packed(df, keys).hint("rebalance", *[F.col(c) for c in by]), keys)
        return dealt.write.format(self.format).partitionBy(*by)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


@dataclass(frozen=True)
class CatalogStore:
    """Tables of the session's catalog, in one schema."""

    schema: str = "default"
    format: str = "parquet"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.table(self.name(table))

    def write(self, df: DataFrame, table: str, mode: str = "overwrite") -> None:
        df.write.format(self.format).mode(mode).saveAsTable(self.name(table))

    def write_bucketed(
        self, df: DataFrame, table: str, by: Sequence[str], buckets: int, path: str | None = None
    ) -> None:
        """A table dealt by a hash of ``by`` into sorted files, one per bucket: what joins or
        groups it by these columns reads it without a shuffle. Choose buckets of some 100 MB."""
        writer = df.repartition(buckets, *by).write.format(self.format).bucketBy(
            buckets, *by
        ).sortBy(*by).mode("overwrite")
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(self.name(table))

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def create_if_absent(self, spark: SparkSession, table: str, columns: T.StructType) -> None:
        """An empty table, unless one of that name exists."""
        declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({declared}) USING {self.format}"
        )

    def append(self, df: DataFrame, table: str) -> None:
        """Add rows to an existing table, columns matched by name."""
        columns = df.sparkSession.read.table(self.name(table)).columns
        df.select(*columns).write.insertInto(self.name(table))


@dataclass(frozen=True)
class JdbcStore:
    """Tables of a database; the driver jar and the credentials are the user's.

    ``partitioning`` gives the reader ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` per table, for a column of numbers or dates.
    ``predicates`` gives it one condition per connection instead: the rows must fall under
    exactly one each. A table with neither is read over ``splits`` connections that share its
    rows by the ends of the text column ``split_by`` (its last character's code, as every
    database has ``ASCII`` and ``RIGHT``), if it has that column; else over one. Writing opens
    one connection per partition, at most ``connections``.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    partitioning: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    connections: int = 32
    write_options: Mapping[str, str] = field(default_factory=dict)
    predicates: Mapping[str, Sequence[str]] = field(default_factory=dict)
    splits: int = 1
    split_by: str = "id"

    def reader_options(self, table: str) -> dict[str, str]:
        return {
            **self.properties, **self.partitioning.get(table, {}),
            "url": self.url, "dbtable": table,
        }

    def writer_options(self, table: str) -> dict[str, str]:
        return {
            **self.properties, **self.write_options, "url": self.url, "dbtable": table,
            "numPartitions": str(self.connections),
        }

    def conditions(self, table: str, columns: Sequence[str]) -> list[str]:
        """One condition per connection, empty for a read over one."""
        if table in self.predicates:
            return list(self.predicates[table])
        if self.splits < 2 or self.split_by not in columns or table in self.partitioning:
            return []
        code = f"MOD(ASCII(RIGHT({self.split_by}, 1)), {self.splits})"
        rest = [f"{code} = {k}" for k in range(1, self.splits)]
        return [f"({code} = 0 OR {self.split_by} IS NULL OR {self.split_by} = '')", *rest]

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        whole = spark.read.format("jdbc").options(**self.reader_options(table)).load()
        conditions = self.conditions(table, whole.columns)
        if not conditions:
            return whole
        return spark.read.jdbc(
            self.url, table, predicates=conditions, properties=dict(self.properties)
        )

    def write(self, df: DataFrame, table: str, mode: str = "overwrite") -> None:
        df.write.format("jdbc").options(**self.writer_options(table)).mode(mode).save()


Store = FileStore | CatalogStore | JdbcStore


def write_counted(store: Store, df: DataFrame, table: str, mode: str = "overwrite") -> int:
    """Write a table and return its row count, taken while the rows pass by."""
    seen = Observation(f"write {table}")
    store.write(df.observe(seen, F.count(F.lit(1)).alias("rows")), table, mode)
    return seen.get["rows"]
