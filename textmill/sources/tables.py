"""Table scans: parquet folders and SQL queries over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def sql_query(spark: SparkSession, query: str, args: dict | None = None, **views: DataFrame) -> DataFrame:
    """Run a parameterised query over the given tables."""
    return spark.sql(query, args=args or {}, **views)


def jdbc_options(
    url: str,
    query: str | None = None,
    table_name: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read. A parallel read needs a table, a numeric column, its bounds and a count."""
    if (query is None) == (table_name is None):
        raise ValueError("give either a query or a table")
    options = {"url": url, "fetchsize": str(fetch_size)}
    if user is not None:
        options |= {"user": user, "password": password or ""}
    if partition_column is None:
        return options | ({"query": query} if query else {"dbtable": table_name})
    if bounds is None or partitions is None:
        raise ValueError("a parallel read needs bounds and a number of partitions")
    return options | {
        "dbtable": table_name or f"({query}) AS source",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, **settings) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**settings)).load()
