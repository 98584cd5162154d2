"""Tables for SQL cases: files become temporary views, other databases come in through JDBC."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

Connector = Callable[..., DataFrame]


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def jdbc_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A table or query of an external database. Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` to read it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


_CONNECTORS: dict[str, Connector] = {"parquet": parquet_table, "jdbc": jdbc_table}


def add_connector(kind: str, connector: Connector) -> None:
    """Register another source of tables."""
    _CONNECTORS[kind] = connector


def connect(spark: SparkSession, kind: str, *args, **kwargs) -> DataFrame:
    if kind not in _CONNECTORS:
        raise ValueError(f"unknown table source {kind!r}; known: {sorted(_CONNECTORS)}")
    return _CONNECTORS[kind](spark, *args, **kwargs)


def register(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def execute_query(spark: SparkSession, query: str) -> DataFrame:
    return spark.sql(query.strip().rstrip(";"))
