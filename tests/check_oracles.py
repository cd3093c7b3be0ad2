"""Run every query against its SQL in DuckDB: ``python tests/check_oracles.py [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def bag(table: pa.Table) -> tuple[list[str], Counter]:
    names = sorted(table.column_names)
    columns = [table[n].to_pylist() for n in names]
    return names, Counter(tuple(_value(v) for v in row) for row in zip(*columns))


def compare(spark, con, name: str, folder: str) -> str | None:
    """None if equal, else what differs."""
    got = entry.queries()[name](spark, folder).toArrow()
    want = con.execute(entry.oracle_sql()[name]).to_arrow_table()
    (gn, gb), (wn, wb) = bag(got), bag(want)
    if gn != wn:
        return f"columns {gn} != {wn}"
    kinds = {n: (got.schema.field(n).type, want.schema.field(n).type) for n in gn}
    odd = {n: k for n, k in kinds.items() if str(k[0]).replace("large_", "") != str(k[1]).replace("large_", "")}
    if gb != wb:
        return f"rows {sum(gb.values())} vs {sum(wb.values())}; only here {list((gb - wb).items())[:3]}; only SQL {list((wb - gb).items())[:3]} {odd}"
    if sum(gb.values()) == 0:
        return "no rows"
    print(f"    {sum(gb.values())} rows" + (f", types differ: {odd}" if odd else ""))
    return None


def main() -> None:
    from loadgauge.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = build_session("local[8]"), connect(folder)
    bad = []
    for name in names:
        start = time.time()
        try:
            if name in entry.oracle_sql():
                problem = compare(spark, con, name, folder)
            else:
                rows = entry.queries()[name](spark, folder).count()
                problem = None if rows else "no rows"
                print(f"    {rows} rows, no SQL")
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main()
