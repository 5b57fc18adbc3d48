"""Operators stay correct when one key holds a third or more of all rows."""
from pyspark.sql import functions as F

from carelake.operators import audits as A
from carelake.operators import evaluation as EV
from carelake.operators import lookups as L
from carelake.operators import responses as R


def test_audits_with_hot_key(spark):
    n = 30000
    claims = spark.range(n).select(
        F.format_string("C%06d", "id").alias("claim_id"),
        F.when(F.col("id") % 3 == 0, F.lit("M-HOT")).otherwise(F.format_string("M%05d", F.col("id") % 1000))
         .alias("member_id"))
    members = spark.range(1000).select(F.format_string("M%05d", "id").alias("member_id")) \
        .unionByName(spark.createDataFrame([("M-HOT",)], "member_id string"))
    t = {"claims": claims, "members": members}
    fks = [("claims", "member_id", "members", "member_id")]
    r = A.fk_audit(t, fks).collect()[0]
    assert (r.references, r.orphans) == (n, 0)
    orphaned = {"claims": claims, "members": members.where(F.col("member_id") != "M-HOT")}
    r2 = A.fk_audit(orphaned, fks).collect()[0]
    assert r2.orphans == n // 3
    d = A.duplicate_key_audit({"claims": claims}, {"claims": "member_id"}).collect()[0]
    assert d.row_count == n and d.duplicate_keys == 1001  # every cold member repeats, plus the hot one


def test_eligibility_lookup_hot_member(spark):
    n = 20000
    req = spark.range(n).select(F.format_string("C%06d", "id").alias("claim_id"),
                                F.when(F.col("id") % 2 == 0, F.lit("M-HOT")).otherwise(F.lit("M-1")).alias("member_id"),
                                F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int"))
                                .alias("service_date"))
    e = spark.createDataFrame([("M-HOT", "E1", "2020-01-01", "2020-12-31", True),
                               ("M-HOT", "E2", "2021-01-01", "2021-12-31", False),
                               ("M-1", "E3", "2020-06-01", "2020-06-30", True)],
                              "member_id string, eligibility_id string, coverage_start string, coverage_end string, "
                              "is_active boolean") \
        .withColumn("coverage_start", F.to_date("coverage_start")).withColumn("coverage_end", F.to_date("coverage_end"))
    got = L.eligibility_lookup(e, req).groupBy("eligibility_id").count()
    counts = {r.eligibility_id: r["count"] for r in got.collect()}
    want = {}
    for i in range(n):
        day = i % 700
        if i % 2 == 0:
            want["E1" if day <= 365 else "E2"] = want.get("E1" if day <= 365 else "E2", 0) + 1
        elif 152 <= day <= 181:
            want["E3"] = want.get("E3", 0) + 1
    assert counts == want


def test_long_conversation_traces_and_history(spark):
    turns = 9000
    conv = spark.range(turns).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                     F.when(F.col("id") % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
                                     .alias("role"), F.format_string("t%d", "id").alias("text"))
    tr = EV.traces_from(conv, conv)
    assert tr.count() == turns // 2
    assert tr.where(F.col("inputs") != F.format_string("t%d", F.col("turn") - 1)).count() == 0
    failed = conv.where((F.col("role") == "assistant") & (F.col("turn") % 10 == 1)).select("conv_id", "turn")
    kept = R.history(conv, failed).count()
    assert kept == turns - 2 * failed.count()
