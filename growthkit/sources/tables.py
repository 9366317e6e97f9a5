"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthkit.functions.columns import names


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    sep: str = ",",
    bad_rows: str = "_corrupt",
    encoding: str = "UTF-8",
    multiline: bool = False,
) -> DataFrame:
    """CSV with a declared schema. Rows that do not fit keep their text in `bad_rows`.

    Columns are found by the names in the header, in any order; a missing or unknown name is an error, and
    so is a file whose header differs from the first one's. `multiline` allows line breaks in quoted
    values, at the price that a file is read by one task. Reading the header runs a small Spark job.

    Values are read as text and converted here, not by the CSV reader: that one converts only
    the columns a query uses, so the number of bad rows would depend on the query. A value that cannot be
    converted is NULL; the rest of its row is kept.
    """
    options = {"header": True, "sep": sep, "encoding": encoding, "multiLine": multiline}
    header = spark.read.options(**options).csv(path).columns
    if sorted(header) != sorted(schema.names):
        raise ValueError(f"header {header} does not name the columns {schema.names}")
    text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    raw = (
        spark.read.schema(text.add(bad_rows, T.StringType()))
        .options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=bad_rows, columnPruning=False)
        .option("enforceSchema", False)
        .csv(path)
    )
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    unread = [F.col(c).isNotNull() & value.isNull() for c, value in typed.items()]
    as_text = F.to_csv(F.struct(*schema.names), {"sep": sep})
    bad = F.coalesce(F.col(bad_rows), F.when(reduce(or_, unread), as_text))
    return raw.select(*[value.alias(c) for c, value in typed.items()], bad.alias(bad_rows))


def load_tables(
    spark: SparkSession, directory: str, tables: Iterable[str], *, views: bool = False
) -> dict[str, DataFrame]:
    """Open `<directory>/<name>.parquet` for each name; with `views` also name them for SQL."""
    found = {name: spark.read.parquet(f"{directory}/{name}.parquet") for name in tables}
    if views:
        for name, df in found.items():
            df.createOrReplaceTempView(name)
    return found


def load_database(
    spark: SparkSession,
    url: str,
    tables: Iterable[str],
    *,
    split_on: dict[str, tuple[str, int, int, int]] | None = None,
    properties: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Open related database tables over JDBC.

    `split_on[table] = (column, lower, upper, parts)` reads a table in parallel ranges;
    without it Spark reads a table through one connection, fit only for small tables.
    """
    split_on = split_on or {}
    found = {}
    for name in tables:
        reader = spark.read.format("jdbc").options(url=url, dbtable=name, **(properties or {}))
        if name in split_on:
            column, lower, upper, parts = split_on[name]
            reader = reader.options(
                partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts
            )
        found[name] = reader.load()
    return found


def write_slice(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None) -> None:
    """Write a slice as Parquet; an existing path is an error, not overwritten.

    With `partition_by` rows are first brought together by its values, so that a value makes few files; adaptive
    execution splits a value with very many rows over several tasks.
    """
    if not partition_by:
        df.write.mode("errorifexists").parquet(path)
        return
    keys = names(partition_by)
    df.hint("rebalance", *keys).write.mode("errorifexists").partitionBy(*keys).parquet(path)


def write_bucketed(df: DataFrame, table: str, by: str | Sequence[str], buckets: int, sort_by: str | Sequence[str] = ()) -> DataFrame:
    """Store `df` as a table whose rows lie in `buckets` by the hash of `by`, sorted inside them, and open it.

    Joins and aggregates on `by` then need no exchange of its rows. The table must not exist yet. Rows are dealt to their buckets
    before they are written, so that a bucket is one file. Every row of a key is in one bucket: choose another layout for
    a table in which one key has a large part of the rows.
    """
    keys = names(by)
    dealt = df.repartition(buckets, *keys)
    dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*(names(sort_by) or keys)).saveAsTable(table)
    return df.sparkSession.table(table)
