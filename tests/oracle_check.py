"""Local twin of the driver's correctness gate.

Runs each registered query in Spark and its oracle SQL in DuckDB on the
same Parquet directory and compares row count, column names and an
order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from lodgeframe.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return "DEC:" + str(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from lodgeframe.session import get_spark
    import __spark_entry__ as E
    spark = get_spark("local[8]", 8)
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SPARK {name}: {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in os_:
            print(f"ROWS-ONLY  {name}: {len(rows)} rows ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(os_[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-ORACLE {name}: {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
        if ok:
            print(f"OK         {name}: {len(rows)} rows ({ts:.1f}s)")
        else:
            bad += 1
            print(f"MISMATCH   {name}: cols {sorted(cols)} vs {sorted(ocols)}; rows {len(rows)} vs {len(orows)}")
            diff1 = [x for x in l1 if x not in set(l2)][:3]
            diff2 = [x for x in l2 if x not in set(l1)][:3]
            print("   spark-only:", diff1)
            print("   oracle-only:", diff2)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
