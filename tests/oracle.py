"""Side-by-side comparison of a registered query with its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import tempfile
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


FAMILY = {
    "tinyint": "int", "smallint": "int", "integer": "int", "int": "int", "bigint": "int", "hugeint": "int",
    "varchar": "string", "string": "string", "float": "double", "double": "double",
}


def family(t: str) -> str:
    t = str(t).lower()
    return FAMILY.get(t, t.split("(")[0])


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences in column names, types, row count and values; empty when equal."""
    rel = con.sql(sql)
    sc, srows = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    dc, drows = rows_of(rel.columns, rel.fetchall())
    if sc != dc:
        return [f"columns {sc} vs {dc}"]
    st = {c: family(t) for c, t in spark_df.dtypes}
    dtp = {c: family(t) for c, t in zip(rel.columns, rel.types)}
    out = [f"type of {c}: {st[c]} vs {dtp[c]}" for c in sc if st[c] != dtp[c]]
    if len(srows) != len(drows):
        out.append(f"rows {len(srows)} vs {len(drows)}")
    bad = [(a, b) for a, b in zip(srows, drows) if a != b]
    if bad:
        out.append(f"{len(bad)} rows differ of {len(srows)}, e.g. {sc}\n   spark {bad[0][0]}\n   sql   {bad[0][1]}")
    if not srows:
        out.append("EMPTY")
    return out


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from obslake.session import build_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="spark-", dir="/tmp"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    qs, sqls = e.queries(), e.oracle_sql()
    names = sys.argv[1:] or list(qs)
    failed = []
    for n in names:
        t0 = time.time()
        try:
            if n in sqls:
                diff = compare(qs[n](spark, folder), con, sqls[n])
            else:
                diff = [] if qs[n](spark, folder).count() else ["EMPTY"]
        except Exception as ex:  # report and go on
            diff = [str(ex)[:900] if "-v" not in os.environ.get("OPTS", "") else traceback.format_exc()]
        print(f"{'ok  ' if not diff else 'FAIL'} {n:28s} {time.time() - t0:6.2f}s {'' if n in sqls else '(rows only)'}")
        for d in diff:
            print("     ", d)
        if diff:
            failed.append(n)
    print(f"{len(names) - len(failed)}/{len(names)} ok; failed: {failed}")
