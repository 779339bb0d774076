"""Typed access to the two raw tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from authlytics.schemas import RAW_AUTH_EVENTS, RAW_USERS


def read_raw_users(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_USERS).parquet(path)


def read_raw_auth_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_AUTH_EVENTS).parquet(path)


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast the columns of a contract, e.g. ISO-8601 text to timestamps.

    Text that is not a value of the column's type raises, as a typed load would.
    """
    return rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
