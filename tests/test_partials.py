"""Partials refreshed by month equal the aggregate of the whole table."""
import tempfile

from pyspark.sql import functions as F

from carelake.operators import partials as P

def sums():
    return {"n": F.lit(1), "cents": F.col("c")}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def claims(spark, n, months, start=0):
    ids = spark.range(start, start + n)
    return ids.select(F.element_at(F.array(*map(F.lit, months)), (F.col("id") % len(months) + 1).cast("int")).alias("m"),
                      F.when(F.col("id") % 9 > 0, F.format_string("MBR-%03d", F.col("id") * 7 % 90)).alias("member"),
                      F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), (F.col("id") % 3).cast("string"))).alias("t"),
                      F.when(F.col("id") % 4 > 0, F.col("id")).alias("c"))


def whole(df, *by):
    return (df.withColumn("month", F.coalesce("m", F.lit(P.NO_MONTH))).groupBy(*by)
            .agg(F.countDistinct("member").alias("members"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("c"), F.lit(0)).alias("cents")))


def same(spark, table, parts):
    df = spark.read.parquet(table)
    for by in (["month"], ["t"], ["month", "t"], []):
        assert rows_of(P.combine(parts, by, ["n", "cents"], "members").select(*by, "members", "n", "cents")) == rows_of(whole(df, *by)), by
    ours = P.combine(parts, ["month", "t"], ["n", "cents"], "members", rollup=True).select("month", "t", "members", "n", "cents", "grouping_id")
    ref = (df.withColumn("month", F.coalesce("m", F.lit(P.NO_MONTH))).rollup("month", "t")
           .agg(F.countDistinct("member"), F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0)), F.grouping_id()))
    assert rows_of(ours) == rows_of(ref)


def test_partials_after_appended_replaced_and_removed_months(spark):
    root = tempfile.mkdtemp(prefix="carelake-partials-", dir="/tmp")
    table, path = f"{root}/claims", f"{root}/partials"

    def refreshed():
        spark.catalog.clearCache()
        return P.refresh(spark, table, "m", path, ["t"], sums(), "member")

    claims(spark, 900, ["2024-01", "2024-02", None]).write.partitionBy("m").parquet(table)
    first = refreshed()
    same(spark, table, first)
    assert refreshed().inputFiles() == first.inputFiles()  # nothing changed: nothing is written
    claims(spark, 200, ["2024-03"], 5000).write.partitionBy("m").mode("append").parquet(table)
    claims(spark, 50, ["2024-02"], 7000).write.partitionBy("m").mode("append").parquet(table)
    old = {r.month: r.version for r in first.select("month", "version").distinct().collect()}
    second = refreshed()
    same(spark, table, second)
    now = {r.month: r.version for r in second.select("month", "version").distinct().collect()}
    assert {m for m in now if old.get(m) != now[m]} == {"2024-02", "2024-03"}
    (claims(spark, 40, ["2024-01"], 9000).write.partitionBy("m").mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(table))
    same(spark, table, refreshed())
    # the same partials over a table without two of the months
    fewer = f"{root}/fewer"
    spark.read.parquet(table).where("m >= '2024-03' or m is null").write.partitionBy("m").parquet(fewer)
    third = P.refresh(spark, fewer, "m", path, ["t"], sums(), "member")
    same(spark, fewer, third)
    assert {r.month for r in third.select("month").collect()} == {"2024-03", P.NO_MONTH}


def test_only_changed_months_are_read(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="carelake-partials-", dir="/tmp")
    table, seen = f"{root}/claims", []
    claims(spark, 300, ["2024-01", "2024-02", "2024-03"]).write.partitionBy("m").parquet(table)
    whole_ = P.partials

    def watched(rows, *rest):
        seen.append({r.m for r in rows.select("m").distinct().collect()})
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
        return whole_(rows, *rest)
    monkeypatch.setattr(P, "partials", watched)
    P.refresh(spark, table, "m", f"{root}/partials", ["t"], sums(), "member")
    claims(spark, 30, ["2024-02"], 700).write.partitionBy("m").mode("append").parquet(table)
    P.refresh(spark, table, "m", f"{root}/partials", ["t"], sums(), "member")
    assert seen == [{"2024-01", "2024-02", "2024-03"}, {"2024-02"}]
