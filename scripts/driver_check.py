"""Driver-style check: a plain session (not built by this package), the entry
module loaded by path, every query compared with its oracle.

usage: python scripts/driver_check.py [sf_dir] [--tz ZONE] [--ansi-off]
Run it from outside the repository to also check that executors can import
the package (it is shipped to them by ``plans.session.ship_package``).
"""
import importlib.util
import os
import sys
import time

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    args = sys.argv[1:]
    sf = next((a for a in args if not a.startswith("--") and "/" in a), "/root/testdata/sf0.01")
    tz = args[args.index("--tz") + 1] if "--tz" in args else "America/Los_Angeles"
    from pyspark.sql import SparkSession
    b = (SparkSession.builder.master("local[8]").appName("driver-check")
         .config("spark.sql.session.timeZone", tz).config("spark.ui.enabled", "false"))
    if "--ansi-off" in args:
        b = b.config("spark.sql.ansi.enabled", "false")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spec = importlib.util.spec_from_file_location("__spark_entry__", f"{REPO}/__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    df = entry.entry(spark)
    print("entry rows", len(df.collect()), df.schema.simpleString())
    from carelake.plans.compare import compare, duck_connection
    from carelake.sources.tables import DRIVER_TABLES
    con = duck_connection(sf, DRIVER_TABLES)
    qs, orc = entry.queries(), entry.oracle_sql()
    t, bad = time.time(), []
    for name, fn in qs.items():
        r = compare(fn(spark, sf), con, orc[name]) if name in orc else {"ok": True}
        if not r["ok"]:
            bad.append((name, r))
    print(f"{len(qs) - len(bad)} of {len(qs)} equal in {time.time() - t:.0f}s; bad: {bad[:3]}")


if __name__ == "__main__":
    main()
