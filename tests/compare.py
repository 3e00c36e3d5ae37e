"""Run registered queries beside their SQL and report differences."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        return (type(v).__name__, v)

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}", len(rows)
    a, b = canonical(rows, df.columns), canonical(expected, names)
    if a == b:
        return None, len(rows)
    only_a = [x for x in a if x not in set(b)][:2]
    only_b = [x for x in b if x not in set(a)][:2]
    return f"{len(a)} / {len(b)} rows; spark only {only_a}; sql only {only_b}", len(rows)


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem, n = compare(spark, con, sf_dir, query, oracles[name])
            else:
                problem, n = "no SQL", query(spark, sf_dir).count()
        except Exception as error:  # noqa: BLE001
            problem, n = str(error)[:1500], -1
        print(f"{name:32s} {n:7d} rows {time.time() - start:6.2f} s  {problem or 'ok'}", flush=True)
