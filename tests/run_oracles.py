"""Compare all or the named queries with DuckDB: python tests/run_oracles.py [folder] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import connect, difference  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from stratalake.session import session  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session("oracles", spark__master="local[8]", spark__driver__memory="8g", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            found = difference(df, con, sqls[name]) if name in sqls else f"{df.count()} rows, no SQL"
            ok = found is None or name not in sqls
        except Exception as error:  # report every query, whatever one of them raises
            found, ok = f"{type(error).__name__}: {str(error)[:600]}", False
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {time.time() - start:6.2f}s {name} {found or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
