"""Run every query beside its SQL: python tests/compare_all.py [folder] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from comparing import differences, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from subtide.session import local_session  # noqa: E402
from subtide.sources import drop_written  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark, con = local_session("8"), duck(folder)
    bad = 0
    for name in names:
        began = time.time()
        try:
            result = queries[name](spark, folder)
            problems = differences(result, con, oracles[name]) if name in oracles else ["no SQL"]
            rows = con.execute(f"SELECT COUNT(*) FROM ({oracles[name]})").fetchone()[0]
        except Exception as error:  # noqa: BLE001
            problems, rows = [f"{type(error).__name__}: {str(error)[:500]}"], "-"
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {rows} {time.time() - began:.1f}s", *problems)
    drop_written(spark)
    print(f"{len(names) - bad} of {len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
