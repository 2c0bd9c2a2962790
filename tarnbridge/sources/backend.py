"""Readers behind one small interface: a relation as a DataFrame, from Parquet, CSV or JDBC.

They use Spark's own relations, so columns and filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..conninfo import BridgeError, ConnectionInfo
from ..plans.partition import predicate, ranges
from .dictionary import Relation


class ParquetBackend:
    """Parquet files. A relation's schema is read once, from its files' footers; its files are listed at each read, so new ones are seen."""

    def __init__(self, spark: SparkSession, info: ConnectionInfo):
        self.spark, self.info, self.schemas = spark, info, {}

    def read(self, relation: Relation, bounds=None, partitions: int = 1) -> DataFrame:
        path = relation.path or f"{self.info.database}/{relation.name}.parquet"
        if path not in self.schemas:
            self.schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self.schemas[path]).parquet(path)


class CsvBackend(ParquetBackend):
    """CSV files with a header; ``schema`` has the columns of each relation as DDL, else all are text."""

    def __init__(self, spark: SparkSession, info: ConnectionInfo, schema: dict[str, str] | None = None, separator: str = ","):
        super().__init__(spark, info)
        self.schema, self.separator = schema or {}, separator

    def read(self, relation: Relation, bounds=None, partitions: int = 1) -> DataFrame:
        reader = self.spark.read.option("header", True).option("sep", self.separator).option("mode", "FAILFAST")
        if relation.name in self.schema:
            reader = reader.schema(self.schema[relation.name])
        return reader.csv(relation.path or f"{self.info.database}/{relation.name}.csv")


class JdbcBackend:
    """A database by JDBC: each task opens its own connection for its key range. The login should be one that may only read."""

    def __init__(self, spark: SparkSession, info: ConnectionInfo, url: str, driver: str):
        self.spark, self.info, self.url, self.driver = spark, info, url, driver

    def read(self, relation: Relation, bounds: tuple[str, int, int] | None = None, partitions: int = 1) -> DataFrame:
        properties = {"driver": self.driver, "user": self.info.user, "password": self.info.password, "isolationLevel": "READ_COMMITTED"}
        try:
            if bounds and partitions > 1:
                column, low, high = bounds
                return self.spark.read.jdbc(self.url, relation.name, predicates=[predicate(column, a, b) for a, b in ranges(low, high, partitions)], properties=properties)
            return self.spark.read.jdbc(self.url, relation.name, properties=properties)
        except Exception as e:
            if "ClassNotFound" in str(e):
                raise BridgeError(f"driver class {self.driver} is not on the classpath; set spark.jars") from e
            raise
