"""Check registered queries by name: python tests/run_oracle.py [folder] [name ...]."""

import os
import sys
import tempfile
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_check import compare, connect  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402


def main():
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgerloom-oracle-")})
    spark.sparkContext.setLogLevel("OFF")
    con, queries, oracle = connect(folder), contract.queries(), contract.oracle_sql()
    failed = []
    for name, query in queries.items():
        if args and not any(name == a or (a.endswith("*") and name.startswith(a[:-1])) for a in args):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            n = compare(df, con, oracle[name]) if name in oracle else len(df.collect())
            print(f"ok   {name:24} {n:7} rows {time.time() - start:6.2f}s"
                  + ("" if name in oracle else "  (rows only)"), flush=True)
        except Exception as error:  # noqa: BLE001
            failed.append(name)
            print(f"FAIL {name}: {str(error).splitlines()[0][:900]}", flush=True)
            if not isinstance(error, AssertionError):
                print("".join(traceback.format_tb(error.__traceback__)[-4:-1])[:900], flush=True)
    print("failed:", failed)


main()
