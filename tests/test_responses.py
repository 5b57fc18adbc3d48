"""Extraction rules on hand-written response bodies (edge cases)."""
import json

import pytest
from pyspark.sql import functions as F

from carelake.operators import responses as R


def _msg(spark, bodies):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "request_id long, body string")
    return [r.message for r in R.messages(df, ["request_id"]).orderBy("request_id").collect()]


def test_message_shapes(spark):
    bodies = [
        json.dumps({"output": "plain"}),
        json.dumps({"output": [{"type": "message", "content": "first"}, {"type": "message", "content": "last"}]}),
        json.dumps({"output": [{"type": "message", "content": "kept"}, {"type": "message", "content": ""}]}),
        json.dumps({"output": [{"content": [{"type": "output_text", "text": "a"}, "b", 7, {"x": 1}]}]}),
        json.dumps({"choices": [{"message": {"content": "chat"}}]}),
        json.dumps({"output": {"choices": [{"message": {"content": "nested"}}]}}),
        json.dumps({"output": []}),
        json.dumps({"output": [{"type": "function_call", "name": "f"}]}),
        json.dumps({"output": {"other": 1}}),
        json.dumps({"no_output": True}),
        json.dumps({"output": [{"content": []}, "loose string", {"content": "ok"}]}),
    ]
    got = _msg(spark, bodies)
    assert got[0] == "plain"
    assert got[1] == "last"                      # walks from the end
    assert got[2] == "kept"                      # empty content is skipped
    assert got[3] == 'a\nb\n{"x":1}'             # blocks: text, string, own JSON; numbers skipped
    assert got[4] == "chat"                      # no output key: whole body has choices
    assert got[5] == "nested"
    assert got[6] == "[]"                        # empty list falls back to its text
    assert got[7] == '[{"name":"f","type":"function_call"}]'
    assert got[8] == '{"other":1}'               # object without choices falls back
    assert got[9] == '{"no_output":true}'
    assert got[10] == "ok"


def test_json_null_and_malformed(spark):
    got = _msg(spark, [json.dumps({"output": None}), "not json"])
    assert got[0] == "null"                      # key present with JSON null: fallback text
    assert got[1] == "not json"                  # a body that is not JSON is its own message


def test_steps_rules(spark):
    body = json.dumps({"output": [
        {"type": "function_call", "arguments": "{}"},          # name defaults to unknown
        {"type": "function_result", "name": "f", "output": "r"},
        {"role": "assistant", "content": [{"text": "t1"}, "t2"]},
        {"type": "message", "content": ""},                    # empty: dropped
        {"type": "other"},                                     # unknown type: dropped
        "bare string",                                         # not an object: skipped
        {"type": "message", "content": "final"},               # last item: never a step
    ]})
    one = json.dumps({"output": [{"type": "function_call", "name": "x"}]})  # fewer than 2 items
    df = spark.createDataFrame([(1, body), (2, one)], "request_id long, body string")
    rows = R.extract_steps(df, ["request_id"]).orderBy("pos").collect()
    assert [(r.request_id, r.pos, r.step_type) for r in rows] == [
        (1, 0, "tool_call"), (1, 1, "tool_result"), (1, 2, "thinking")]
    assert rows[0].name == "unknown" and rows[0].arguments == "{}"
    assert rows[1].name == "f" and rows[1].output == "r"
    assert rows[2].content == "t1\nt2"


def test_approvals_and_errors(spark):
    body = json.dumps({"output": [{"type": "mcp_approval_request", "id": "a1", "name": "partd", "arguments": "{}"},
                                  {"type": "message", "content": "x"}]})
    df = spark.createDataFrame([(1, body), (2, json.dumps({"output": "s"}))], "request_id long, body string")
    req = R.approval_requests(df, ["request_id"]).collect()
    assert [(r.request_id, r.approval_id, r.name) for r in req] == [(1, "a1", "partd")]
    resp = R.approval_responses(R.approval_requests(df, ["request_id"]), ["request_id"]).collect()[0]
    assert resp.id == "auto_approve_a1" and resp.approval_request_id == "a1" and resp.approve is True
    errs = spark.createDataFrame([(json.dumps({"message": "m", "error": "e"}),), (json.dumps({"error": "e"}),),
                                  (json.dumps({"detail": 1}),), ("Bad Gateway",),
                                  (json.dumps({"message": None, "error": "e"}),)], "body string")
    got = [r.e for r in errs.select(R.error_message(R.parsed(F.col("body")), F.col("body")).alias("e")).collect()]
    assert got == ["m", "e", '{"detail":1}', "Bad Gateway", "e"]


def test_round_summary_limit(spark):
    ask = json.dumps({"output": [{"type": "mcp_approval_request", "id": "a"}, {"type": "x"}]})
    rows = [(1, r, 200, ask) for r in range(10)] + [(2, 0, 200, ask), (2, 1, 200, json.dumps({"output": "done"}))]
    df = spark.createDataFrame(rows, "request_id long, round_no int, status int, body string")
    out = {r.request_id: r for r in R.round_summary(df).collect()}
    assert out[1].hit_round_limit and out[1].rounds == 10
    assert not out[2].hit_round_limit and out[2].last_asks_approval is False


def test_tool_use_summary_wording(spark):
    steps = spark.createDataFrame(
        [(1, 1, "tool_call", "a"), (1, 2, "tool_result", "a"), (1, 3, "tool_call", "b"),
         (2, 1, "thinking", None), (3, 1, "tool_call", "c"), (4, 1, "thinking", None), (4, 2, "thinking", None)],
        "request_id long, step_no long, step_type string, name string")
    got = {r.request_id: r.summary for r in R.tool_use_summary(steps).collect()}
    assert got == {1: "Used 2 tools: a, b", 2: "1 intermediate step", 3: "Used 1 tool: c",
                   4: "2 intermediate steps"}


def test_history_drops_failed_turns(spark):
    conv = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"),
                                  (1, 3, "user", "q2"), (1, 4, "assistant", "a2")],
                                 "conv_id long, turn long, role string, text string")
    failed = spark.createDataFrame([(1, 2)], "conv_id long, turn long")
    got = sorted((r.turn, r.role) for r in R.history(conv, failed).collect())
    assert got == [(0, "system"), (3, "user"), (4, "assistant")]
    failed0 = spark.createDataFrame([(1, 1)], "conv_id long, turn long")  # previous turn is not the user's
    got0 = sorted(r.turn for r in R.history(conv, failed0).collect())
    assert got0 == [0, 2, 3, 4]


@pytest.mark.parametrize("text", ["", "one line", "a\nb\n", "quote \" and \\ backslash"])
def test_fixture_bodies_roundtrip(spark, text):
    from carelake.sources.responses import body_for_shape
    df = spark.createDataFrame([(7, text)], "request_id long, text string")
    for shape in range(5):
        b = df.select("request_id", body_for_shape(F.lit(shape), F.col("text"), F.col("request_id"), F.col("request_id")).alias("body"))
        msg = R.messages(b, ["request_id"]).collect()[0].message
        if text == "" and shape in (1, 4):
            continue  # an empty message has no usable content: falls back (checked above)
        assert msg == text, (shape, msg)


def test_history_two_failures_in_a_row(spark):
    conv = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "assistant", "b"), (None, 5, "user", "n")],
                                 "conv_id long, turn long, role string, text string")
    failed = spark.createDataFrame([(1, 1), (1, 2)], "conv_id long, turn long")
    assert sorted(r.turn for r in R.history(conv, failed).collect()) == [5]


def test_json_null_name_is_null(spark):
    body = json.dumps({"output": [{"type": "function_call", "name": None, "arguments": None},
                                  {"type": "function_call"}, {"type": "message", "content": "end"}]})
    df = spark.createDataFrame([(1, body)], "request_id long, body string")
    rows = R.extract_steps(df, ["request_id"]).orderBy("pos").collect()
    assert [(r.name, r.arguments) for r in rows] == [(None, None), ("unknown", "")]


def test_new_conversations_get_ids_of_their_own(spark):
    df = spark.createDataFrame([(None, "r1", 0), (None, "r1", 1), (None, "r2", 0), (7, "r3", 0)],
                               "conv_id long, request string, turn long")
    got = {(r.request, r.turn): r.conversation_id for r in R.assign_conversation_id(df, ["request"]).collect()}
    assert got["r3", 0] == "conv-00000007"
    assert got["r1", 0] == got["r1", 1] != got["r2", 0] and got["r2", 0].startswith("conv-") and None not in got.values()


def test_new_conversations_are_not_merged_by_turn(spark, tmp_path):
    """Two interleaved new conversations: no id through the query, as no column tells them apart."""
    from carelake.plans.responses import q_assign_conversation_id
    conv = spark.createDataFrame([(None, 0, "user", "a"), (None, 0, "user", "b"), (None, 1, "assistant", "a"), (None, 1, "assistant", "b"),
                                  (7, 0, "user", "c")], "conv_id long, turn long, role string, text string")
    conv.write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in q_assign_conversation_id(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(7, 0, "conv-00000007"), (None, 0, None), (None, 0, None), (None, 1, None), (None, 1, None)], key=str)


def _long_conversations(spark, tmp_path, turns=200):
    rows = [(c, t, "assistant" if t % 2 else "user", f"text {c} {t}") for c in (1, 2, 3) for t in range(turns)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(
        f"{tmp_path}/conversations.parquet")
    return str(tmp_path), 3 * turns // 2


def test_conversations_of_many_turns_keep_their_requests_apart(spark, tmp_path):
    from carelake.operators import evaluation as EV
    from carelake.plans.registry import QUERIES, load_all
    load_all()
    d, n = _long_conversations(spark, tmp_path)
    assert QUERIES["extract_message"](spark, d).select("request_id").distinct().count() == n
    tr = EV.traces(spark, d)
    assert tr.select("trace_id").distinct().count() == n == tr.count()
    roll = QUERIES["guideline_rollup"](spark, d).collect()
    assert len(roll) == 2 * n and all(r.guidelines == 3 for r in roll)
    assert all(r.rounds <= 10 for r in QUERIES["round_limit_audit"](spark, d).collect())
    steps = QUERIES["merged_steps"](spark, d)
    assert steps.count() == steps.select("request_id", "step_no").distinct().count()
    assert QUERIES["chat_answers"](spark, d).count() == QUERIES["chat_answers"](spark, d).select("conv_id", "turn").distinct().count()
    chain = QUERIES["chain_rounds"](spark, d)
    assert chain.count() == chain.select("request_id", "seq").distinct().count() and chain.where("item is null").count() == 0


def test_live_scoring_reads_a_table_of_part_files(spark, tmp_path):
    from carelake.operators import evaluation as EV
    from carelake.streaming.live_scoring import start_live_scoring
    d, _ = _long_conversations(spark, tmp_path, 40)
    q = start_live_scoring(spark, d, spark.read.parquet(f"{d}/conversations.parquet"), f"{d}/fb", f"{d}/cp",
                           max_files_per_trigger=1)
    q.awaitTermination()
    cols = ["trace_id", "scorer", "guideline_no", "value"]
    got = sorted(map(tuple, spark.read.parquet(f"{d}/fb").select(*cols).collect()))
    assert got == sorted(map(tuple, EV.score(EV.expand_tasks(EV.traces(spark, d))).select(*cols).collect()))
    assert got == sorted(map(tuple, EV.score_traces(EV.traces(spark, d)).select(*cols).collect()))


def test_rates_are_honoured(spark):
    from carelake.operators import evaluation as EV
    df = spark.range(200_000).select(F.col("id").cast("string").alias("t"), F.lit("safety").alias("s"))
    for rate in (0.57, 0.0005):
        n = df.where(EV.sampled(F.col("t"), F.col("s"), rate)).count()
        assert abs(n - 200_000 * rate) < 5 * (200_000 * rate) ** 0.5
    assert df.where(EV.sampled(F.col("t"), F.col("s"), 0.0)).count() == 0


def test_appended_files_are_seen(spark, tmp_path):
    from carelake.plans.registry import QUERIES, load_all
    load_all()
    for t in ("orders", "supplier", "customer", "nation", "conversations"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    d = str(tmp_path)
    before = QUERIES["total_claims"](spark, d).first()[0], QUERIES["extract_message"](spark, d).count()
    for t in ("orders", "conversations"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.mode("append").parquet(f"{d}/{t}.parquet")
    after = QUERIES["total_claims"](spark, d).first()[0], QUERIES["extract_message"](spark, d).count()
    assert after == tuple(2 * x for x in before)


def test_other_doubles_keep_their_digits(spark):
    from carelake.sources.builds import bronze_text
    df = spark.createDataFrame([(0.256789, 12.5, float("nan"))], "share double, billed_amount double, x double")
    assert tuple(bronze_text(df).first()) == ("0.256789", "12.50", "NaN")


def test_null_keys_are_set_apart(spark):
    from carelake.operators import lookups as LK
    left = spark.createDataFrame([(i, None if i % 5 < 2 else f"k{i % 7}") for i in range(100)], "i long, claim_id string")
    right = spark.createDataFrame([(f"k{i}", f"s{i}") for i in range(5)], "claim_id string, status string")
    got = sorted(map(tuple, LK.left_join_known(left, right, "claim_id").select("i", "claim_id", "status").collect()), key=repr)
    assert got == sorted(map(tuple, left.join(right, "claim_id", "left").select("i", "claim_id", "status").collect()), key=repr)
    assert len(got) == 100


def test_denied_references_on_injected_rows(spark):
    from carelake.operators.audits import denied_reference_audit
    appeals = spark.createDataFrame([("a1", "c1", "p1"), ("a2", "c2", None), ("a3", None, "p2"), ("a4", "c9", None)],
                                    "appeal_id string, claim_id string, prior_auth_id string")
    claims = spark.createDataFrame([("c1", "Denied"), ("c2", "Approved")], "claim_id string, status string")
    pas = spark.createDataFrame([("p1", True), ("p2", False)], "prior_auth_id string, is_approved boolean")
    got = sorted(map(tuple, denied_reference_audit(appeals, claims, pas).collect()))
    assert got == [("a1", "prior_auth", "p1", "Approved"), ("a2", "claim", "c2", "Approved"), ("a4", "claim", "c9", "missing")]


def test_a_cluster_must_name_its_checkpoint_folder():
    from types import SimpleNamespace

    from carelake.plans.session import ensure_checkpoint_dir
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(fake)


def test_date_ranges_prune_written_months(spark):
    from carelake.sources.materialize import written
    plan = written(spark, "/root/testdata/sf0.001").between("claims", "1995-03-10", "1995-06-20")
    assert "PartitionFilters: [isnotnull(submitted_month" in plan._jdf.queryExecution().executedPlan().toString()


def test_history_lists_are_ordered_and_bounded(spark):
    """A null conversation, one with most turns, repeated turns and null texts."""
    from carelake.operators import responses as R
    rows = [(None, i, "user", f"n{i:03d}") for i in range(25)] + [(1, i, ["user", "assistant"][i % 2], f"t{i:04d}") for i in range(1000)]
    rows += [(2, 0, "user", None), (2, 0, "user", "b"), (2, None, "user", "first"), (2, 0, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, content string").repartition(5)
    got = R.history_lists(df, 10).collect()
    assert max(r.n_messages for r in got) == 10 and all(len(r.messages) == r.n_messages for r in got)
    whole = {}
    for r in sorted(got, key=lambda r: r.chunk):
        whole.setdefault(r.conv_id, []).extend(m.content for m in r.messages)
    assert whole[1] == [f"t{i:04d}" for i in range(1000)] and whole[None] == [f"n{i:03d}" for i in range(25)]
    assert whole[2] == ["first", "a", None, "b"]
    assert R.history_lists(df.limit(0)).count() == 0
