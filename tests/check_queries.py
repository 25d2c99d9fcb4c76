"""Compare registered queries with their SQL: python -m tests.check_queries SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time
import traceback

from pyspark.sql import SparkSession

import __spark_entry__ as driver
from tests.compare import differences, duck, rows_of_duck, rows_of_spark


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = duck(sf_dir), driver.oracle_sql(), 0
    for name, fn in driver.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            ours = rows_of_spark(fn(spark, sf_dir))
            took = time.time() - start
            if name not in oracle:
                print(f"rows  {name} {len(ours[1])} rows {took:.1f}s", flush=True)
                continue
            mid = time.time()
            found = differences(ours, rows_of_duck(con, oracle[name]))
            print(f"{'FAIL' if found else 'ok  '}  {name} {len(ours[1])} rows {took:.1f}s (sql {time.time() - mid:.1f}s)", flush=True)
            for line in found:
                print("      ", line[:600])
            bad += bool(found)
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"ERROR {name}: {type(error).__name__} {str(error)[:900]}", flush=True)
            if "-v" in names:
                traceback.print_exc()
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
