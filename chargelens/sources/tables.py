"""Typed tables: reading, the full-refresh load, views, and result sinks."""

from pyspark.sql import types as T

from ..schemas import TABLES


class MissingColumns(ValueError):
    pass


def read_table(spark, path, schema, fmt="parquet", optional=()):
    """Read with a declared schema; no inference.

    CSV columns are matched by header name, in any order; the files of one folder must agree on it, a
    file with another header fails the job. Columns in `optional` may be absent, columns unknown to
    the schema are kept as text.
    """
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in schema.fields}
    missing = [n for n in known if n not in header and n not in optional]
    if missing:
        raise MissingColumns(f"{path} lacks {', '.join(missing)}")
    by_position = T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in header])
    return _checked_csv(spark, path, by_position)


def _checked_csv(spark, path, schema):
    """CSV files whose every header has the names of `schema` in its order."""
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("mode", "FAILFAST").csv(path))


def scan_transactions(spark, path, fmt="parquet", optional=("seconds_since_prev_txn", "is_fraud")):
    return read_table(spark, path, TABLES["transactions"], fmt, optional)


def scan_customers(spark, path, fmt="parquet"):
    return read_table(spark, path, TABLES["customers"], fmt)


def scan_merchants(spark, path, fmt="parquet"):
    return read_table(spark, path, TABLES["merchants"], fmt)


def conform(df, schema):
    """Cast to the declared columns, in the declared order."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def load_tables(frames, folder):
    """Full refresh: each frame replaces the parquet table of its name under `folder`."""
    for name, df in frames.items():
        conform(df, TABLES[name]).write.mode("overwrite").parquet(f"{folder}/{name}")


def open_tables(spark, folder):
    return {name: read_table(spark, f"{folder}/{name}", schema) for name, schema in TABLES.items()}


def register_views(tables):
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark, text):
    """One SQL statement over the registered views."""
    return spark.sql(text)


def load_counts(spark, tables):
    """One row with the row count of each table."""
    return spark.sql(
        "SELECT (SELECT count(*) FROM {customers}) AS customers, "
        "(SELECT count(*) FROM {merchants}) AS merchants, "
        "(SELECT count(*) FROM {transactions}) AS transactions", **tables)


def scan_wide(spark, path, order_key, label, fmt="parquet", key_type="bigint"):
    """The wide numeric table and a text saying where it came from.

    A Spark table has no row order of its own, so the time order needs a key column. In CSV it is read
    as `key_type`: a whole number unless told otherwise, such as double, date or timestamp. The
    label is an integer, all else is double.
    """
    if fmt == "csv":
        header = spark.read.option("header", True).csv(path).columns
        kinds = {order_key: T.StructType.fromDDL(f"k {key_type}")["k"].dataType, label: T.IntegerType()}
        schema = T.StructType([T.StructField(n, kinds.get(n, T.DoubleType())) for n in header])
        df = _checked_csv(spark, path, schema)
    else:
        df = spark.read.format(fmt).load(path)
    if order_key not in df.columns:
        raise MissingColumns(f"{path} lacks the order key {order_key}")
    return df, f"{fmt} {path} (split on {order_key})"


def write_csv(df, path):
    """CSV with a header; the part files follow the order of `df`."""
    (df.write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def write_json(df, path):
    df.write.mode("overwrite").json(path)
