"""Compare a registered Spark query with its DuckDB oracle SQL.

Mirrors the driver's gate: row count, column names / types, and the
order-insensitive multiset of row values (columns sorted by name).

    python -m tests.oracle_check [name ...] [--sf /root/testdata/sf0.01]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

_SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "smallint": "SMALLINT", "float": "FLOAT",
}


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_canon(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = True) -> dict:
    import __spark_entry__ as entry
    q = entry.queries()[name]
    sql = entry.oracle_sql().get(name)
    t0 = time.time()
    df = q(spark, sf_dir)
    s_cols = df.columns
    s_types = [f.dataType.simpleString() for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    con = con or duck_connect(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} oracle={d_cols}")
    else:
        st = dict(zip(s_cols, s_types))
        dtp = dict(zip(d_cols, d_types))
        for c in s_cols:
            if _SPARK_TO_DUCK.get(st[c], st[c].upper()) != dtp[c]:
                problems.append(f"type {c}: spark={st[c]} oracle={dtp[c]}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} oracle={len(d_rows)}")
    if not any(p.startswith("columns") for p in problems):
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        if a != b:
            sa, sb = set(a), set(b)
            only_s = [r for r in a if r not in sb][:3]
            only_d = [r for r in b if r not in sa][:3]
            problems.append(f"values differ; cols={sorted(s_cols)} spark-only={only_s} "
                            f"oracle-only={only_d}")
    res["status"] = "ok" if not problems else "FAIL"
    res["problems"] = problems
    if verbose:
        print(name, res["status"], res["spark_rows"], res.get("oracle_rows"),
              res["spark_sec"], *problems, sep=" | ", flush=True)
    return res


def main(argv: list[str]) -> int:
    sf = "/root/testdata/sf0.01"
    names = []
    it = iter(argv)
    for a in it:
        if a == "--sf":
            sf = next(it)
        else:
            names.append(a)
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tally.session import get_spark
    spark = get_spark("oracle-check", master="local[8]", shuffle_partitions=8)
    con = duck_connect(sf)
    names = names or list(entry.queries())
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
            bad += r["status"] == "FAIL"
        except Exception as e:  # report and continue
            bad += 1
            print(n, "ERROR", repr(e)[:2000], sep=" | ", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
