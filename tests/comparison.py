"""Compare a Spark result with a DuckDB result, as sets of rows or in order."""

import glob
import os

import duckdb
import pyarrow as pa


def open_tables(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return connection


def type_names(schema: pa.Schema):
    def plain(kind):
        if pa.types.is_timestamp(kind):
            return f"timestamp zone={kind.tz}"
        return "string" if pa.types.is_large_string(kind) else str(kind)

    return [(field.name, plain(field.type)) for field in schema]


def rows(table: pa.Table, ordered: bool):
    columns = [table.column(name).to_pylist() for name in table.column_names]
    return list(zip(*columns)) if ordered else sorted(zip(*columns), key=repr)


def assert_same(spark_result, duckdb_result: pa.Table, ordered: bool = False):
    spark_table = spark_result.toArrow()
    assert type_names(spark_table.schema) == type_names(duckdb_result.schema)
    assert rows(spark_table, ordered) == rows(duckdb_result, ordered)
