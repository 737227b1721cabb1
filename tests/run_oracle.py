"""Run catalogue queries against their DuckDB oracle: python tests/run_oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

from oracle_compare import compare  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    from loadcast.session import build_session

    import __spark_entry__ as E

    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                res = compare(df, sqls[name], sf_dir)
                ok = res.get("values_equal") and res["types_equal"] and res["spark_rows"] == res["oracle_rows"]
            else:
                res = {"spark_rows": df.count(), "rows_only": True}
                ok = True
        except Exception as e:  # report and continue
            res, ok = {"error": f"{type(e).__name__}: {str(e)[:400]}"}, False
        bad += not ok
        print(json.dumps({"query": name, "ok": bool(ok), "sec": round(time.time() - t, 2), **res}, default=str))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
