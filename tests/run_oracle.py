"""Run all (or the named) queries against DuckDB: python tests/run_oracle.py [prefix ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.oracle import connect, differences  # noqa: E402
from tidewheel.plans import ORACLES, QUERIES  # noqa: E402
from tidewheel.session import build_session  # noqa: E402


def main() -> None:
    base = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(base), 0
    for name, fn in QUERIES.items():
        if sys.argv[1:] and not any(name.startswith(p) for p in sys.argv[1:]):
            continue
        start = time.time()
        try:
            df = fn(spark, base)
            if name in ORACLES:
                diff = differences(df, con, ORACLES[name])
            else:
                diff = None if df.count() > 0 else "no rows"
        except Exception as exc:  # report and go on with the next query
            diff = f"{type(exc).__name__}: {str(exc)[:1500]}"
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'BAD ' if diff else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {diff or ''}", flush=True)
        bad += bool(diff)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
