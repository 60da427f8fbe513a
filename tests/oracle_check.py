"""Runs registered queries next to their SQL in DuckDB and compares the results."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter

import duckdb

from touchline.sources.adapter import INPUTS


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in INPUTS:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return float(f"{v:.12g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _kind(t: str) -> str:
    t = str(t)
    for k, names in {"int": ("int",), "float": ("double", "float", "decimal"), "str": ("string", "utf8"), "bool": ("bool",)}.items():
        if any(n in t for n in names):
            return k
    return t


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    ours, theirs = df.toArrow(), con.sql(sql).to_arrow_table()
    a, b = sorted(ours.column_names), sorted(theirs.column_names)
    if a != b:
        return f"columns differ: ours-only {set(a) - set(b)}, sql-only {set(b) - set(a)}"
    bad = [(c, str(ours.schema.field(c).type), str(theirs.schema.field(c).type)) for c in a
           if _kind(ours.schema.field(c).type) != _kind(theirs.schema.field(c).type) and str(ours.schema.field(c).type) != "null"]
    if bad:
        return f"types differ: {bad}"
    x = Counter(tuple(_plain(r[c]) for c in a) for r in ours.to_pylist())
    y = Counter(tuple(_plain(r[c]) for c in a) for r in theirs.to_pylist())
    if x == y:
        return None if ours.num_rows else "EMPTY"
    only_x, only_y = sorted((x - y), key=str), sorted((y - x), key=str)
    diff_cols = Counter()
    key = [c for c in a if c in ("combo_id", "team_id", "player_id", "pos", "row_id", "state_id", "seq_id", "period")]
    index = {tuple(r[a.index(c)] for c in key): r for r in only_y}
    sample = []
    for r in only_x:
        o = index.get(tuple(r[a.index(c)] for c in key))
        if o:
            for c, u, v in zip(a, r, o):
                if u != v:
                    diff_cols[c] += 1
                    if len(sample) < 4:
                        sample.append((c, u, v, [r[a.index(k)] for k in key]))
    return (f"rows {sum(x.values())} vs {sum(y.values())}, {len(only_x)} only ours, {len(only_y)} only sql; "
            f"columns {dict(diff_cols)}; {sample or (only_x[:1], only_y[:1])}")


if __name__ == "__main__":
    import __spark_entry__ as entry
    from touchline.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                result = compare(fn(spark, sf_dir), con, oracles[name])
            else:
                result = None if fn(spark, sf_dir).count() else "EMPTY"
                name += " (rows only)"
        except Exception as e:  # report and go on with the next query
            result = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        failed += result is not None
        print(f"{'ok  ' if result is None else 'FAIL'} {name} {time.time() - start:.1f}s {result or ''}", flush=True)
    print("failed:", failed)
