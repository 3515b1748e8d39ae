"""Compare registered queries with their SQL: python check_queries.py [sf_dir] [name part ...]."""

from __future__ import annotations

import sys
import time

from indicatorlake.session import build_session
from tests.compare import differences, duck
from workload import ORACLES, QUERIES


def main(sf_dir: str = "/root/testdata/sf0.001", *parts: str) -> int:
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                          "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    bad = 0
    for name in [n for n in QUERIES if not parts or any(p in n for p in parts)]:
        started = time.monotonic()
        try:
            problems = differences(QUERIES[name](spark, sf_dir), connection, ORACLES[name])
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.monotonic() - started:.2f}s", flush=True)
        for problem in problems:
            print("    ", problem, flush=True)
    print(f"{bad} of {len(QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(*sys.argv[1:])))
