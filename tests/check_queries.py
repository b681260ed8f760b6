"""Run queries side by side in Spark and DuckDB and report differences.

    python tests/check_queries.py /root/testdata/sf0.01 [name ...]
"""

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def session(cpus: int = 8):
    from pyspark.sql import SparkSession
    return (SparkSession.builder.master(f"local[{cpus}]").appName("lakeledger-check")
            .config("spark.sql.shuffle.partitions", os.environ.get("CHECK_PARTITIONS", str(cpus))).config("spark.ui.enabled", "false")
            .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate())


def database(folder: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{folder}/{t}.parquet").exists():
            con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19].replace("T00:00:00", "")
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def differences(spark, con, folder, name, run, sql):
    df = run(spark, folder)
    a_cols, a = table(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    b_cols, b = table([d[0] for d in cur.description], cur.fetchall())
    if a_cols != b_cols:
        return f"columns {a_cols} vs {b_cols}"
    if a != b:
        sa, sb = set(a), set(b)
        only_a, only_b = [r for r in a if r not in sb], [r for r in b if r not in sa]
        return f"rows {len(a)} vs {len(b)}; {len(only_a)} only in spark {only_a[:3]}; {len(only_b)} only in sql {only_b[:3]}"
    return f"ok {len(a)} rows"


if __name__ == "__main__":
    import __spark_entry__ as e
    folder, names = sys.argv[1], sys.argv[2:]
    spark, con = session(), database(folder)
    spark.sparkContext.setLogLevel("OFF")
    queries, checks = e.queries(), e.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in checks:
                msg = differences(spark, con, folder, name, queries[name], checks[name])
            else:
                msg = f"ok (rows only) {queries[name](spark, folder).count()} rows"
        except Exception as err:
            msg = f"FAILED {type(err).__name__}: {str(err)[:700]}"
        bad += not msg.startswith("ok")
        print(f"{name:32s} {time.time() - start:6.2f}s  {msg}", flush=True)
    print("differing:", bad)
    spark.stop()
