"""Compare all or some registered queries: python -m tests.check_queries FOLDER [name ...]."""

import sys
import time
import traceback

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from tests.compare import connect, differences


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = entry.queries(), entry.oracle_sql()
    connection, bad = connect(folder), 0
    for name in names or queries:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            found = (
                differences(df, connection, oracle[name])
                if name in oracle
                else [] if df.count() else ["no rows"]
            )
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
            if len(names) == 1:
                traceback.print_exc()
        bad += bool(found)
        print(f"{'BAD ' if found else 'ok  '} {name} {time.time() - started:.1f}s", *found, sep="\n     ", flush=True)
    print("unregistered oracle:", sorted(set(oracle) - set(queries)), "bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
