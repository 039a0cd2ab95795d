"""Relational databases over JDBC.

Reads split into ``num_partitions`` range queries on a numeric, date or
timestamp column when bounds are given; otherwise a single partition (fine
for small dimension tables, wrong for big ones).  The database driver jar
must be on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str | None = None, query: str | None = None,
                 properties: dict | None = None, partition_column: str | None = None,
                 lower_bound=None, upper_bound=None, num_partitions: int | None = None,
                 fetch_size: int | None = 10_000) -> dict:
    """The reader options for a table or query scan (exactly one of the two)."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table= or query=")
    opts = {"url": url, **(properties or {})}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound, num_partitions")
        if query is not None:
            # Spark does not allow partitionColumn together with `query`.
            opts.pop("query")
            opts["dbtable"] = f"({query}) q"
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              properties: dict | None = None, partition_column: str | None = None,
              lower_bound=None, upper_bound=None, num_partitions: int | None = None) -> DataFrame:
    """Scan a whole table or the result of a query."""
    opts = jdbc_options(url, table, query, properties, partition_column, lower_bound,
                        upper_bound, num_partitions)
    return spark.read.format("jdbc").options(**opts).load()


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "errorifexists", batch_size: int = 10_000) -> None:
    """Create ``table`` from ``df`` (an existing table is an error by default)."""
    (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
     .option("batchsize", str(batch_size)).options(**(properties or {})).save())
