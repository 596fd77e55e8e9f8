"""Reading and writing tables: files, catalogs, rejects, reports and SQL scripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.plans.durable import exists


def read(spark: SparkSession, path: str, kind: str = "parquet", schema: str | T.StructType | None = None, **options: str) -> DataFrame:
    """Parquet, ORC, CSV, JSON or text; a schema spares the reader a pass over the data."""
    reader = spark.read.format(kind).options(**({"header": "true"} if kind == "csv" else {}) | options)
    return (reader.schema(schema) if schema else reader).load(path)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, bounds: tuple[int, int], parts: int = 16, **options: str) -> DataFrame:
    """A database table read in parallel ranges of a numeric column."""
    settings = {"url": url, "dbtable": table, "partitionColumn": column, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(**settings | options).load()


def sql_query(spark: SparkSession, text: str, tables: dict[str, DataFrame], **parameters) -> DataFrame:
    """A query with named parameters over data frames; {name} stands for a table, :name for a parameter."""
    return spark.sql(text, args=parameters, **tables)


def columns_of(spark: SparkSession) -> DataFrame:
    """(table, column, type, nullable) of every table and view of the session's catalog."""
    rows = [
        (t.name, c.name, c.dataType, c.nullable) for t in spark.catalog.listTables() for c in spark.catalog.listColumns(t.name)
    ]
    return spark.createDataFrame(rows, "table string, column string, type string, nullable boolean")


def missing_tables(spark: SparkSession, wanted: list[str]) -> list[str]:
    return sorted(set(wanted) - {t.name for t in spark.catalog.listTables()})


def append_distinct(rows: DataFrame, path: str, key: str) -> None:
    """Append those rows, once each, whose key the table at path lacks."""
    fresh = rows.dropDuplicates([key])
    if exists(rows.sparkSession, path):
        fresh = fresh.join(rows.sparkSession.read.parquet(path).select(key), key, "left_anti")
    fresh.write.mode("append").parquet(path)


def write_json_lines(rows: DataFrame, path: str, append: bool = True) -> None:
    rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("append" if append else "overwrite").text(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", "true").csv(path)


def write_by_month(rows: DataFrame, path: str, ts: str) -> None:
    """Monthly partitions, so that time filters prune files."""
    parts = rows.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))
    parts.repartition("year", "month").write.mode("overwrite").partitionBy("year", "month").parquet(path)


def retryable(reason: Column, words: tuple[str, ...] = ("timeout", "network", "temporar")) -> Column:
    """Whether a rejected record is worth another try."""
    hits = F.lit(False)
    for w in words:
        hits = hits | F.lower(reason).contains(w)
    return hits


def sql_literal(column: Column, kind: T.DataType) -> Column:
    """A value as SQL text: quoted and escaped strings, arrays of them, plain numbers, NULL."""
    if isinstance(kind, T.StringType):
        text = F.concat(F.lit("'"), F.replace(column, F.lit("'"), F.lit("''")), F.lit("'"))
    elif isinstance(kind, T.ArrayType):
        text = F.concat(F.lit("ARRAY["), F.array_join(F.transform(column, lambda c: sql_literal(c.cast("string"), T.StringType())), ", "), F.lit("]"))
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("NULL"))


def insert_statements(rows: DataFrame, table: str) -> DataFrame:
    """One INSERT statement per row, to be written as text."""
    values = [sql_literal(F.col(f.name), f.dataType) for f in rows.schema.fields]
    head = f"INSERT INTO {table} ({', '.join(rows.columns)}) VALUES ("
    return rows.select(F.concat(F.lit(head), F.concat_ws(", ", *values), F.lit(") ON CONFLICT DO NOTHING;")).alias("value"))
