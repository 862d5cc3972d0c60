"""Compare every registered query with its SQL: python tests/run_oracles.py [sf_dir] [names...]"""

import os
import sys
import tempfile
import time
import traceback

sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)),
                os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

from compare import connect, difference  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    import __spark_entry__ as entry

    from herdcast.session import build_session
    spark = build_session("local[8]", "oracles", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="herdcast-oracles-")})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    qs, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args or qs:
        t = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in sql:
                problem = difference(df, con, sql[name])
                note = "ok" if problem is None else "DIFF " + problem
                n = df.count() if problem is None else -1
            else:
                problem, n = None, len(df.collect())
                note = "rows only"
        except Exception as e:  # noqa: BLE001
            problem, n = str(e), -1
            note = "ERROR " + "".join(traceback.format_exception_only(e))[:600]
        bad += problem is not None
        print(f"{name:28s} {time.time() - t:6.2f}s rows={n:<7d} {note[:900]}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
