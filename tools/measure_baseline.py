"""

Usage: python tools/measure_baseline.py [sf_dir] [threads]
Every stage is computed from the driver tables with the stages before it (as
its SQL is written) except where the stage reads a table: ``clean`` reads the
raw table, reports read the clean table, as bench.py's stages do.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from civicspark import oracle  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
RUNS = 5


def _rest(name: str, table: str) -> str:
    """The query without the CTEs up to ``table``, which is a stored table here."""
    needs = [c for c in oracle._CTES if f"{c} AS (" in oracle.oracle_sql()[name]]
    keep = [c for c in needs if c != table and table in _closure(c)]
    body = oracle.oracle_sql()[name].rpartition(")\n")[2]
    return ("WITH " + ", ".join(f"{c} AS ({oracle._CTES[c][1]})" for c in keep) + " " if keep else "") + body


def _closure(name: str) -> set[str]:
    return {name}.union(*(_closure(d) for d in oracle._CTES[name][0]))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 4
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    sql = oracle.oracle_sql()
    stages = {"raw": f"CREATE OR REPLACE TABLE requests_raw_t AS {sql['requests_raw']}"}
    stages["clean"] = f"CREATE OR REPLACE TABLE clean_t AS {_rest('clean_requests', 'requests_raw')}"
    stages["checks"] = _rest("quality_report", "clean")
    for name in ("dim_agency", "dim_complaint", "dim_location", "dim_date"):
        stages[f"star_{name}"] = f"CREATE OR REPLACE TABLE {name}_t AS {_rest(name, 'clean')}"
    stages["star_fact"] = f"CREATE OR REPLACE TABLE fact_t AS {_rest('fact_requests', 'clean')}"
    for name in oracle._reports(""):
        stages[name] = _rest(name, "clean")
    seconds: dict[str, list[float]] = {k: [] for k in stages}
    for run in range(RUNS + 1):
        for name, text in stages.items():
            began = time.perf_counter()
            result = con.execute(text)
            result.fetchall()
            if run:
                seconds[name].append(time.perf_counter() - began)
            if name in ("raw", "clean"):
                con.execute(f"CREATE OR REPLACE VIEW {'requests_raw' if name == 'raw' else 'clean'} AS SELECT * FROM {'requests_raw_t' if name == 'raw' else 'clean_t'}")
    out = {k: round(statistics.median(v), 3) for k, v in seconds.items()}
    print(json.dumps({"seconds": out, "sum": round(sum(out.values()), 3), "threads": threads, "sf_dir": sf_dir, "duckdb": duckdb.__version__, "cpus": os.cpu_count()}))


if __name__ == "__main__":
    main()
