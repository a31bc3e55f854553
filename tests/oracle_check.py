"""Local twin of the driver's correctness gate: run queries() and oracle_sql()
side by side on one scale factor and compare row count, column names and an
order-insensitive hash of rounded values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""
from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


TYPE_MAP = {"double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "float": "FLOAT", "string": "VARCHAR",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN", "smallint": "SMALLINT"}


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, 6)
        return repr(0.0 if r == 0 else r)
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main(argv):
    import duckdb
    from spreadlab.session import build_session
    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    if os.environ.get("PLAIN_SESSION"):
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            cols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"rows {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
        dtypes = {d[0]: str(d[1]) for d in cur.description}
        bad_types = {c: (stypes.get(c), dtypes.get(c)) for c in stypes
                     if TYPE_MAP.get(stypes[c]) != str(dtypes.get(c)).upper()}
        if bad_types:
            print(f"   types differ {name}: {bad_types}")
        h1, l1 = digest(cols, srows)
        h2, l2 = digest(dcols, drows)
        ok = len(srows) == len(drows) and sorted(cols) == sorted(dcols) and h1 == h2
        print(f"{'ok  ' if ok else 'FAIL'} {name}: spark {len(srows)} rows / duck {len(drows)} rows {ts:.1f}s")
        if not ok:
            bad += 1
            if sorted(cols) != sorted(dcols):
                print("   columns", sorted(cols), sorted(dcols))
            a, b = set(l1), set(l2)
            for x in sorted(a - b)[:3]:
                print("   spark only:", x[:300])
            for x in sorted(b - a)[:3]:
                print("   duck  only:", x[:300])
    print(f"{bad} failing")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
