"""Run registered queries against their oracles: python tests/check_queries.py [sf] [name-prefix ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from compare import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tallywatch import build_session  # noqa: E402


def main() -> None:
    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",spark__ui__showConsoleProgress="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(folder), entry.oracle_sql(), []
    for name, build in entry.queries().items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in oracles:
                problems, n = compare(df, con, oracles[name])
            else:
                problems, n = [], len(df.collect())
        except Exception as error:  # noqa: BLE001
            problems, n = [str(error)[:1500] or traceback.format_exc()[-1500:]], -1
        flag = "ok " if not problems else "BAD"
        print(f"{flag} {name:45s} rows={n:6d} {time.time() - start:6.2f}s {'' if name in oracles else '(rows only)'}", flush=True)
        for problem in problems:
            print("    ", problem, flush=True)
        if problems:
            bad.append(name)
    print(f"{len(bad)} bad: {bad}")


if __name__ == "__main__":
    main()
