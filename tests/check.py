"""python tests/check.py [sf_dir] [name ...]: run queries and compare with their SQL."""

import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.dirname(__file__))

from oracle import compare  # noqa: E402

import __spark_entry__ as driver  # noqa: E402
from valora.session import get_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = get_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
                        spark__ui__enabled="false",
                        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    oracles = driver.oracle_sql()
    for name, fn in driver.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                verdict = compare(spark, fn, oracles[name], sf) or "ok"
            else:
                verdict = f"rows {fn(spark, sf).count()}"
        except Exception as e:  # noqa: BLE001
            verdict = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        print(f"{time.time() - start:6.1f}s {name:24s} {verdict}", flush=True)
