"""Audits, key figures, ranking and helpers on hand-made rows."""
import random

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelake.functions import keyed as K
from carelake.functions import scalars as X
from carelake.operators import audits as A
from carelake.operators import dashboard as D
from carelake.operators import evaluation as EV
from carelake.operators import lookups as L
from carelake.operators.ranking import row_number_within


def test_fk_audit_finds_orphans_ignores_nulls(spark):
    parent = spark.createDataFrame([("P1",), ("P2",)], "pk string")
    child = spark.createDataFrame([("P1",), ("P1",), ("P9",), (None,), ("P9",)], "fk string")
    r = A.fk_orphans(child, "fk", parent, "pk", "c.fk").collect()[0]
    assert (r.references, r.orphans) == (4, 2)


def test_duplicate_key_audit(spark):
    t = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    r = A.duplicate_key_audit({"t": t}, {"t": "k"}).collect()[0]
    assert (r.row_count, r.distinct_keys, r.duplicate_keys, r.null_keys) == (4, 2, 1, 1)


def test_top_k_tie_break_and_blank(spark):
    rows = [("b",), ("b",), ("a",), ("a",), ("c",), ("",), ("",), ("",), (None,)]
    df = spark.createDataFrame(rows, "original_denial_reason string")
    got = [(r.reason, r["count"]) for r in D.top_denial_reasons(df, 2).collect()]
    assert got == [("a", 2), ("b", 2)]


def test_zero_denominators_and_absent_status(spark):
    empty = spark.createDataFrame([], "appeal_status string, is_overturned boolean")
    r = D.overturn_rate(empty).collect()[0]
    assert (r.appeals, r.overturn_rate_pct, r.overturn_rate_decided_pct) == (0, 0, 0)
    g = spark.createDataFrame([("Pending", 3)], "appeal_status string, count long")
    assert D.find_status_count(g, "appeal_status", "Denied").collect()[0][0] == 0
    assert D.find_status_count(g, "appeal_status", "Pending").collect()[0][0] == 3


def test_bool_text_predicate_on_text_and_boolean(spark):
    df = spark.createDataFrame([(True, "true"), (False, "TRUE"), (None, None)], "b boolean, s string")
    got = df.select(D._is_true(F.col("b")).alias("x"), D._is_true(F.col("s")).alias("y")).collect()
    assert [(r.x, r.y) for r in got] == [(True, True), (False, False), (None, None)]


def test_row_number_within_matches_window_with_hot_group(spark):
    random.seed(3)
    rows = [("hot" if random.random() < 0.6 else f"g{random.randint(0, 20)}", random.randint(0, 50), i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    order = [F.desc("v"), F.asc("id")]
    ours = row_number_within(df, ["g"], order, "rn", num_partitions=7)
    ref = df.withColumn("rn_ref", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    bad = ours.join(ref, ["g", "v", "id"]).where(F.col("rn") != F.col("rn_ref")).count()
    assert ours.count() == 3000 and bad == 0


def test_eligibility_range_is_inclusive(spark):
    e = spark.createDataFrame([("M1", "E1", "2020-01-01", "2020-12-31", True)],
                              "member_id string, eligibility_id string, coverage_start string, "
                              "coverage_end string, is_active boolean") \
        .withColumn("coverage_start", F.to_date("coverage_start")).withColumn("coverage_end", F.to_date("coverage_end"))
    req = spark.createDataFrame([("c1", "M1", "2020-01-01"), ("c2", "M1", "2020-12-31"), ("c3", "M1", "2021-01-01"),
                                 ("c4", "M2", "2020-06-01")], "claim_id string, member_id string, service_date string") \
        .withColumn("service_date", F.to_date("service_date"))
    got = sorted(r.claim_id for r in L.eligibility_lookup(e, req).collect())
    assert got == ["c1", "c2"]


def test_sample_k_is_without_replacement(spark):
    codes = [f"C{i}" for i in range(17)]
    df = spark.range(0, 5000).select(K.sample_k(F.col("id"), 3, 5, 7, codes).alias("s"))
    for r in df.collect():
        parts = [p for p in r.s.split(",") if p]
        assert len(parts) == len(set(parts)) <= 3


def test_format_id_does_not_truncate(spark):
    r = spark.range(1).select(X.format_id("PA", 5, F.lit(1234567)).alias("x")).collect()[0]
    assert r.x == "PA-1234567"


def test_weighted_choice_needs_full_weights():
    import pytest
    with pytest.raises(ValueError):
        K.weighted_choice(F.col("k"), 3, ["a", "b"], [50, 40])


def test_render_does_not_rescan_inserted_text(spark):
    df = spark.createDataFrame([("ask {{ outputs }}", "ans")], "inputs string, outputs string")
    r = df.select(EV.render("Q: {{ inputs }} A: {{ outputs }}", F.col("inputs"), F.col("outputs")).alias("p")) \
        .collect()[0]
    assert r.p == "Q: ask {{ outputs }} A: ans"


def test_sampling_rate_below_one_is_stable(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("trace_id"), F.lit("safety").alias("scorer"))
    a = df.where(EV.sampled(F.col("trace_id"), F.col("scorer"), 0.25))
    n1, n2 = a.count(), a.count()
    assert n1 == n2 and 4000 < n1 < 6000


def test_fk_audit_single_shuffle_equals_join_form(spark):
    members = spark.createDataFrame([("M1",), ("M2",)], "member_id string")
    claims = spark.createDataFrame([("C1", "M1"), ("C2", "M3"), ("C3", None), ("C4", "M3")],
                                   "claim_id string, member_id string")
    appeals = spark.createDataFrame([("A1", "C1", "M2"), ("A2", "C9", "M1"), ("A3", None, "M1")],
                                    "appeal_id string, claim_id string, member_id string")
    t = {"members": members, "claims": claims, "appeals": appeals}
    fks = [("claims", "member_id", "members", "member_id"), ("appeals", "member_id", "members", "member_id"),
           ("appeals", "claim_id", "claims", "claim_id")]
    a = sorted(tuple(r) for r in A.fk_audit(t, fks).collect())
    b = sorted(tuple(r) for r in A.fk_audit_by_join(t, fks).collect())
    assert a == b == [("appeals.claim_id", 2, 1), ("appeals.member_id", 3, 0), ("claims.member_id", 3, 2)]


def test_appeals_by_status_on_text_table(spark):
    typed = spark.createDataFrame([("Pending", True), ("Pending", False), ("Withdrawn", None)],
                                  "appeal_status string, is_overturned boolean")
    text = typed.select("appeal_status", F.col("is_overturned").cast("string").alias("is_overturned"))
    a = sorted(tuple(r) for r in D.appeals_by_status(typed).collect())
    b = sorted(tuple(r) for r in D.appeals_by_status(text).collect())
    assert a == b == [("Pending", 2, 1), ("Withdrawn", 1, 0)]


def test_sql_table_functions(spark):
    from carelake.sources.domain import Domain
    d = Domain(spark, "/root/testdata/sf0.001")
    made = L.register_sql_functions(spark, {t: d.table(t) for t in
                                            ["members", "claims", "appeals", "prior_authorizations", "eligibility",
                                             "providers"]})
    assert "member_lookup" in made and "eligibility_lookup" in made
    got = spark.sql("SELECT m.member_id FROM (SELECT DISTINCT member_id FROM appeals WHERE is_overturned) k, "
                    "LATERAL member_lookup(k.member_id) m").count()
    want = d.appeals.where("is_overturned").select("member_id").distinct().count()
    assert got == want > 0
    n = spark.sql("SELECT * FROM (SELECT member_id, service_date FROM claims) c, "
                  "LATERAL eligibility_lookup(c.member_id, c.service_date) e").count()
    assert n == L.eligibility_lookup(d.eligibility, d.claims.select("claim_id", "member_id", "service_date")).count()


def test_format_id_matches_format_string(spark):
    df = spark.createDataFrame([(0,), (7,), (99999,), (100000,), (123456789,), (-3,), (None,)], "k long")
    got = df.select(X.format_id("MBR", 5, F.col("k")).alias("a"),
                    F.format_string("MBR-%05d", F.col("k")).alias("b")).collect()
    assert all(r.a == r.b for r in got if r.b is not None)


def test_result_records_bounded_and_distributed_agree(spark):
    df = spark.range(0, 500).select((F.col("id") % 37).alias("g"), F.col("id").alias("id"))
    order = [F.desc("g"), F.asc("id")]
    a = sorted(tuple(r) for r in D.result_records(df, order).collect())
    b = sorted(tuple(r) for r in D.result_records(df, order, bounded=False).collect())
    assert a == b and len(a) == 500 and a[0][0] == 1


def test_write_summary_pack_isolates_runtime_failure(spark):
    import tempfile
    ok = spark.createDataFrame([("Pending", True), ("Withdrawn", False)], "appeal_status string, is_overturned boolean")
    bad = ok.select("appeal_status", F.when(F.col("appeal_status") == "Pending", F.raise_error(F.lit("boom")))
                    .otherwise(F.lit(True)).alias("is_overturned"))
    members = spark.createDataFrame([("M1", "Medicare"), ("M2", "Other")], "member_id string, plan_type string")
    path = tempfile.mkdtemp(prefix="carelake-pack-", dir="/tmp")
    out = D.write_summary_pack({"member_count": lambda: D.member_count(members),
                                "appeals_by_status": lambda: D.appeals_by_status(bad)}, path)
    rows = out.collect()
    good = [r for r in rows if r.query == "member_count"]
    failed = [r for r in rows if r.query == "appeals_by_status"]
    assert len(good) == 1 and good[0].error is None and '"members":"2"' in good[0].record
    assert len(failed) == 1 and failed[0].record is None and "boom" in failed[0].error


def test_slow_summary_query_times_out_alone(spark):
    """The slow query is interrupted at its limit; the others neither wait for it nor fail."""
    import tempfile
    import time
    members = spark.createDataFrame([("M1", "Medicare"), ("M2", "Other")], "member_id string, plan_type string")

    def slow(batches):
        import time as t
        for b in batches:
            t.sleep(45)
            yield b
    held = spark.range(1, numPartitions=1).mapInPandas(slow, "id long").select(
        F.lit("Pending").alias("appeal_status"), F.lit(True).alias("is_overturned"))
    path = tempfile.mkdtemp(prefix="carelake-pack-", dir="/tmp")
    begin = time.time()
    out = {r.query: r for r in D.write_summary_pack({
        "appeals_by_status": lambda: D.appeals_by_status(held), "member_count": lambda: D.member_count(members)}, path, limit=12).collect()}
    assert time.time() - begin < 40
    assert out["appeals_by_status"].error == "timed out after 12 s" and out["appeals_by_status"].record is None
    assert out["member_count"].error is None and '"members":"2"' in out["member_count"].record
    assert len(spark.sparkContext.getJobTags()) == 0


def test_eligibility_intervals_equal_the_plain_join(spark):
    """Spans from a day to thousands of years, a member with a third of everything, ends hit exactly, bad rows."""
    import datetime as dt
    import random
    rnd, day = random.Random(4), dt.date(1995, 1, 1)
    spans, asked = [], []
    for i in range(400):
        first = day + dt.timedelta(rnd.randrange(-9000, 4000))
        spans.append((f"M{rnd.randrange(9) if i % 3 else 0}", f"E{i}", first, first + dt.timedelta(rnd.choice([0, 0, 1, 2, 30, 364, 365, 9000])), True))
    spans += [("M1", "E-open", dt.date(1, 1, 1), dt.date(9999, 12, 31), True), ("M1", "E-bad", day, day - dt.timedelta(1), True),
              (None, "E-no", day, day, True), ("M1", "E-null", day, None, True), ("M1", "E-twice", day, day, True), ("M1", "E-twice", day, day, True)]
    for i in range(600):
        when = day + dt.timedelta(rnd.randrange(-9000, 5000)) if i % 2 else rnd.choice([s for s in spans if s[3]])[rnd.choice([2, 3])]
        asked.append((i, f"M{rnd.randrange(11) if i % 3 else 0}", when))
    asked += [(900, None, day), (901, "M1", None), (902, "M1", dt.date(1, 1, 1)), (903, "M1", dt.date(9999, 12, 31))]
    e = spark.createDataFrame(spans, "member_id string, eligibility_id string, coverage_start date, coverage_end date, is_active boolean")
    r = spark.createDataFrame(asked, "claim_id int, member_id string, service_date date")
    out = L.eligibility_lookup(e, r)
    got = sorted((x.claim_id, x.member_id, x.service_date, x.eligibility_id, x.coverage_start, x.coverage_end) for x in out.collect())
    want = sorted((c, m, d, s[1], s[2], s[3]) for c, m, d in asked for s in spans
                  if m is not None and m == s[0] and d and s[3] and s[2] <= d <= s[3])
    assert got == want and len(want) > 3000
    assert L.eligibility_lookup(e.limit(0), r).count() == 0 and L.eligibility_lookup(e, r.limit(0)).count() == 0
    # the member with a third of all rows meets in many keys, not in one
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_rl" in plan and "_rb" in plan


def test_benchmark_provider_filters_after_rank(spark):
    from carelake.operators import measures as M
    from carelake.sources.domain import Domain
    d = Domain.of(spark, "/root/testdata/sf0.01")
    full = {r.provider_id: r for r in M.provider_peer_benchmark(d.claims, d.providers).collect()}
    one = M.benchmark_provider(d.claims, d.providers, "PRV-0012").collect()
    assert len(one) == 1
    r = one[0]
    assert r.rank_in_specialty == full["PRV-0012"].rank_in_specialty
    peers = [x for x in full.values() if x.specialty == r.specialty and x.provider_id != "PRV-0012"]
    assert r.peer_claims == sum(x.claims for x in peers)
    assert r.peer_denied == sum(x.denied for x in peers)


def test_pick_parent_with_sparse_keys(spark):
    parents = spark.createDataFrame([(f"P{k:03d}",) for k in (3, 17, 42, 99, 500)], "pk string")
    child = spark.range(0, 1000).withColumnRenamed("id", "k")
    out = K.pick_parent(child, "k", parents, "pk", 31, alias="parent")
    rows = out.collect()
    assert len(rows) == 1000 and all(r.parent in {"P003", "P017", "P042", "P099", "P500"} for r in rows)
    want = {r.k: ["P003", "P017", "P042", "P099", "P500"][(r.k * 31) % 5] for r in rows}
    assert all(r.parent == want[r.k] for r in rows)


def test_recommended_settings_scale_with_input():
    from carelake.plans.session import recommended_settings
    small = recommended_settings(100 * 1024 ** 3, 10, 8)
    big = recommended_settings(100 * 1024 ** 4, 1000, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 240           # 3 x cores dominates
    assert int(big["spark.sql.shuffle.partitions"]) == int(100 * 1024 ** 4 * 0.3 / (200 * 1024 ** 2))
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_conform_reorders_drops_and_rejects(spark):
    import pytest
    from pyspark.errors import AnalysisException
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    from carelake.sources.builds import conform
    schema = StructType([StructField("a", StringType()), StructField("b", LongType())])
    df = spark.createDataFrame([(1, "x", 9)], "b int, a string, extra int")
    out = conform(df, schema)
    assert out.columns == ["a", "b"] and out.schema["b"].dataType == LongType()
    with pytest.raises(ValueError):
        conform(spark.createDataFrame([("x",)], "a string"), schema)          # missing column
    with pytest.raises(AnalysisException):
        conform(spark.createDataFrame([("x", "1")], "a string, b string"), schema)  # text to number


def test_validate_flags_invalid_values(spark):
    fb = spark.createDataFrame([(1, "safety", 0, "yes", "r"), (2, "routing_quality", 0, "great", "r"),
                                (3, "unknown_scorer", 0, "x", "r")],
                               "trace_id long, scorer string, guideline_no int, value string, rationale string")
    got = {r.trace_id: (r.valid, r.error) for r in EV.validate(fb).collect()}
    assert got[1] == (True, None)
    assert got[2][0] is False and "routing_quality: great" in got[2][1] and "correct_routing" in got[2][1]
    assert got[3][0] is False and "allowed: none" in got[3][1]


def test_denied_reference_audit_states(spark):
    appeals = spark.createDataFrame(
        [("A1", "C1", "P1"), ("A2", "C2", None), ("A3", "C9", "P2"), ("A4", None, "P9"), ("A5", "C1", None)],
        "appeal_id string, claim_id string, prior_auth_id string")
    claims = spark.createDataFrame([("C1", "Denied"), ("C2", "Approved")], "claim_id string, status string")
    pas = spark.createDataFrame([("P1", False), ("P2", True)], "prior_auth_id string, is_approved boolean")
    got = sorted(tuple(r) for r in A.denied_reference_audit(appeals, claims, pas).collect())
    assert got == [("A2", "claim", "C2", "Approved"), ("A3", "claim", "C9", "missing"),
                   ("A3", "prior_auth", "P2", "Approved"), ("A4", "prior_auth", "P9", "missing")]


def test_metric_view_other_dimensions(spark):
    from carelake.operators import measures as M
    from carelake.sources.domain import Domain
    a = Domain.of(spark, "/root/testdata/sf0.001").appeals
    by_month = M.metric_view(a, ["appeal_month"], ["appeals", "overturned", "documented"])
    assert by_month.agg(F.sum("appeals")).collect()[0][0] == a.count()
    months = {r.appeal_month for r in by_month.collect()}
    assert all(m.day == 1 for m in months)
    two = M.metric_view(a, ["appeal_status", "original_denial_reason"], ["appeals", "withdrawn", "pending"])
    w = two.where(F.col("appeal_status") == "Withdrawn").agg(F.sum("withdrawn"), F.sum("appeals")).collect()[0]
    assert w[0] == w[1]
    rates = {r.appeal_type: r for r in M.overturn_rates(a, "appeal_type").collect()}
    for t, r in rates.items():
        sub = a.where(F.col("appeal_type") == t)
        assert r.appeals == sub.count() and r.overturned == sub.where("is_overturned").count()


def test_fk_audit_by_bitmaps_equals_join_form(spark):
    """Keys of every form; words whose cited keys all, none or partly have a parent."""
    rng = random.Random(5)
    forms = ["MBR-%05d", "MBR-%d", "%d", "x%dy", "é-%03d", "A1%020d", "Z%019d", "-%d", "%d "]
    keys = [rng.choice(forms) % rng.choice([i, i * 64, i * 10**12]) for i in range(300)] + ["", "abc", "0", "00", "9" * 18, "9" * 19]
    parents = rng.sample(keys, 200) + ["AB-%06d" % i for i in range(640)]
    child = [(rng.choice(keys + [None]), rng.choice(parents)) for _ in range(2000)] + [("AB-000064", "AB-%06d" % i) for i in range(5000, 5100)]
    t = {"p": spark.createDataFrame([(k,) for k in parents * 2] + [(None,)], "pk string"),
         "c": spark.createDataFrame(child + [("abc", None)] * 500, "f string, g string").repartition(5),
         "e": spark.createDataFrame([], "f string"), "n": spark.createDataFrame([(1,), (2,), (2,), (700,)], "k long"),
         "m": spark.createDataFrame([(2,), (3,), (3,), (None,), (-1,)], "k long")}
    fks = [("c", "f", "p", "pk"), ("c", "g", "p", "pk"), ("e", "f", "p", "pk"), ("m", "k", "n", "k")]
    got = sorted(tuple(r) for r in A.fk_audit_bitmaps(t, fks).collect())
    assert got == sorted(tuple(r) for r in A.fk_audit_by_join(t, fks).collect())
    assert [r[2] > 0 for r in got] == [True, True, False, True]


def test_fk_audit_by_bitmaps_reads_each_column_for_itself(spark):
    """Two keys of one parent stay apart, and no row is multiplied before the words are made."""
    t = {"p": spark.createDataFrame([("A-1", "B-1"), ("A-2", "B-2")], "pk string, other string"),
         "c": spark.createDataFrame([("A-1", "A-1"), ("B-1", "B-2"), ("A-2", None), (None, "B-7")], "f string, g string")}
    fks = [("c", "f", "p", "pk"), ("c", "g", "p", "other")]
    got = sorted(tuple(r) for r in A.fk_audit_bitmaps(t, fks).collect())
    assert got == sorted(tuple(r) for r in A.fk_audit_by_join(t, fks).collect()) == [("c.f", 3, 1), ("c.g", 3, 2)]


def test_key_bits_are_exact(spark):
    keys = ["a1", "a01", "a", "a64", "a63", "", "1", "01", "b" + "7" * 18, "b" + "7" * 19, "0:a", "-5", "5-", "٣", "a\n1", "1\n"]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select(*A.key_bits(F.col("k")).values()).collect()
    assert len(set(map(tuple, got))) == len(keys)
    dense = spark.range(100_000).select(F.format_string("M%07d", "id").alias("k")).select(*A.key_bits(F.col("k")).values()).toDF("s", "w", "b")
    words = dense.groupBy("s", "w").agg(F.bit_or("b").alias("b"))
    assert words.count() == 1563 and words.agg(F.sum(F.bit_count("b"))).first()[0] == 100_000


def test_reconcile_keeps_what_does_not_fit(spark):
    from pyspark.sql import types as T

    from carelake.sources.builds import reconcile
    schema = T.StructType([T.StructField("d", T.DateType()), T.StructField("n", T.LongType()), T.StructField("gone", T.StringType())])
    df = spark.createDataFrame([("7", "x", "2024-02-30"), ("oops", "x", "2024-02-29"), (None, "x", None)], "n string, extra string, d string")
    out = reconcile(df, schema)
    assert out.schema.names == ["d", "n", "gone", "rescued"] and [f.dataType for f in out.schema.fields[:3]] == [f.dataType for f in schema.fields]
    got = {(str(r.d), r.n, r.gone, tuple(r.rescued)) for r in out.collect()}
    assert got == {("None", 7, None, ("d=2024-02-30",)), ("2024-02-29", None, None, ("n=oops",)), ("None", None, None, ())}
