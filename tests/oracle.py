"""Compare registered queries with their SQL in DuckDB.

    python tests/oracle.py /root/testdata/sf0.01 [query ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _family(name):
    name = str(name).lower()
    for family, words in {"int": ("int", "long", "short"), "float": ("double", "float"),
                          "time": ("timestamp",), "text": ("string", "varchar")}.items():
        if any(w in name for w in words):
            return family
    return name


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return repr(float(v)) if isinstance(v, float) else str(v)


def _rows(rows):
    return sorted((tuple(_value(v) for v in row) for row in rows), key=repr)


def compare(df, connection, sql):
    """None when column names, types, row count and all values agree, else what differs."""
    relation = connection.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} vs {sorted(relation.columns)}"
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    theirs = dict(zip(relation.columns, relation.types))
    types = [f"{n}: {ours[n]} vs {theirs[n]}" for n in names if _family(ours[n]) != _family(theirs[n])]
    if types:
        return f"types {types}"
    a = _rows(tuple(r) for r in df.select(*names).collect())
    b = _rows(relation.select(*[f'"{n}"' for n in names]).fetchall())
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    different = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(different)} rows differ, first {different[0]}" if different else None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from chargelens.session import local_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark, connection, sqls = local_session(8), connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        begin = time.time()
        try:
            df = query(spark, sf_dir)
            verdict = compare(df, connection, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as error:  # report and go on to the next query
            verdict = f"ERROR {str(error)[:600]}"
        bad += verdict is not None and not verdict.startswith("rows only")
        print(f"{name:32s} {time.time() - begin:6.2f}s  {verdict or 'ok'}", flush=True)
    print("failures:", bad)
