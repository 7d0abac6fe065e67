"""Run a registered Spark query and its DuckDB oracle; compare the results.

Usable from tests and from the command line::

    python -m tests.oracle_compare /root/testdata/sf0.01 [query ...]

The comparison is order-insensitive: both sides are sorted on all columns
after normalising values (floats compared exactly and, as a fallback, to a
relative 1e-9; NaN equals NaN; timestamps as ISO text).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

RAW_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, v)
    if hasattr(v, "isoformat"):
        return (2, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    if isinstance(v, (int,)) and not isinstance(v, bool):
        return (1, float(v))
    return (3, str(v))


def _rows(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    out.sort(key=lambda t: tuple((k, str(x)) for k, x in t))
    return out


def _close(a, b) -> bool:
    if a == b:
        return True
    if a[0] == 1 and b[0] == 1:
        return math.isclose(a[1], b[1], rel_tol=1e-9, abs_tol=1e-12)
    return False


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as entry

    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    s_rows = [r.asDict() for r in sdf.collect()]
    t_spark = time.time() - t0
    con = con or duck(sf_dir)
    t0 = time.time()
    res = con.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = [dict(zip(d_cols, r)) for r in res.fetchall()]
    t_duck = time.time() - t0
    s_cols = sdf.columns
    out = {
        "query": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "spark_sec": round(t_spark, 2),
        "oracle_sec": round(t_duck, 2),
    }
    if not out["cols_match"]:
        out["spark_only"] = sorted(set(s_cols) - set(d_cols))
        out["oracle_only"] = sorted(set(d_cols) - set(s_cols))
        out["match"] = False
        return out
    cols = sorted(s_cols)
    a, b = _rows(s_rows, cols), _rows(d_rows, cols)
    exact = a == b
    close = len(a) == len(b) and all(all(_close(x, y) for x, y in zip(ra, rb)) for ra, rb in zip(a, b))
    out["exact"] = exact
    out["match"] = close
    if not close and len(a) == len(b):
        for ra, rb in zip(a, b):
            if not all(_close(x, y) for x, y in zip(ra, rb)):
                out["first_diff"] = {
                    c: (x[1], y[1]) for c, x, y in zip(cols, ra, rb) if not _close(x, y)
                }
                break
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from pitwise.plans.session import local_session
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(entry.oracle_sql())
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and continue
            r = {"query": n, "match": False, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += 0 if r.get("match") else 1
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
