"""Run registered queries in Spark and their SQL in DuckDB; compare rows.

Compares like the driver: column names sorted, row multisets equal, no
float tolerance. Usage: python tests/oracle_check.py SF_DIR [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tablewise.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return 0.0 if v == 0 else v
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(norm(x) for x in r) for r in df.select(*cols).collect()], \
        {f.name: f.dataType.simpleString() for f in df.schema.fields}


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = list(rel.columns)
    types = dict(zip(cols, [str(t) for t in rel.types]))
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(norm(r[i]) for i in order) for r in rel.fetchall()]
    return [cols[i] for i in order], rows, types


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                 "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(t_spark, t_duck):
    out = {}
    for k, v in t_spark.items():
        want = SPARK_TO_DUCK.get(v, v)
        if t_duck.get(k) != want:
            out[k] = (v, t_duck.get(k))
    return out


def compare(df, con, sql):
    c1, r1, t1 = spark_rows(df)
    c2, r2, t2 = duck_rows(con, sql)
    a, b = Counter(r1), Counter(r2)
    return {
        "cols_match": c1 == c2, "spark_cols": c1, "duck_cols": c2,
        "rows_spark": len(r1), "rows_duck": len(r2),
        "values_match": a == b,
        "only_spark": list((a - b).elements())[:3],
        "only_duck": list((b - a).elements())[:3],
        "types": type_mismatches(t1, t2),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from tablewise.catalog import REGISTRY
    from tablewise.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.ui.showConsoleProgress": "false"})
    if os.environ.get("ORACLE_TZ"):  # check independence from the session zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
    con = duck(sf_dir)
    bad = 0
    for name, q in REGISTRY.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = q.build(spark, sf_dir)
        if q.sql is None:
            n = df.count()
            print(f"{q.survey_id} {name:32s} rows-only rows={n} {time.time()-t0:.1f}s")
            continue
        res = compare(df, con, q.sql)
        ok = res["cols_match"] and res["values_match"] and not res["types"]
        bad += not ok
        print(f"{q.survey_id} {name:32s} {'OK ' if ok else 'BAD'} rows={res['rows_spark']}/{res['rows_duck']} {time.time()-t0:.1f}s")
        if not ok:
            for k in ("spark_cols", "duck_cols", "only_spark", "only_duck", "types"):
                print("    ", k, res[k])
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
