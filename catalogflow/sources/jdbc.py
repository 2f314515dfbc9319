"""Database tables over JDBC. The driver jar comes with the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options for ``format('jdbc')``.

    With ``partition_column`` the scan is cut into ``partitions`` key ranges; without
    it one task reads everything, which suits small dimensions only.
    """
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    options = {"url": url, "fetchsize": str(fetch_size)} | extra
    if partition_column:
        if bounds is None:
            raise ValueError("partition_column needs bounds")
        # Spark takes no partition column together with "query".
        options["dbtable"] = table or f"({query}) AS q"
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    elif table:
        options["dbtable"] = table
    else:
        options["query"] = query
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()
