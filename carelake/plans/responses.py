"""Assistant response queries over the response tables derived from conversations."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as C
from ..operators import responses as R
from ..sources import responses as S
from .oracle_views import mix, pick
from .registry import register

RID = "request_id"
_TOOL = pick(mix("seed", 41, len(S.TOOL_NAMES)), S.TOOL_NAMES)
_T = f"""WITH t AS (
  SELECT conv_id || ':' || turn AS request_id, conv_id * 100 + turn AS seed, conv_id, turn, text,
         {mix('conv_id * 100 + turn', 37, S.N_SHAPES)} AS shape
  FROM conversations WHERE role = 'assistant')
"""
_FALLBACK = f"""'[{{"arguments":"{{}}","name":"' || {_TOOL} || '","type":"function_call"}}]'"""


def _resp(spark, sf_dir):
    return S.agent_responses(spark, sf_dir)


def _out(df):
    return R.response_output(R.parsed(F.col("body")))


@register("response_output", _T + """
SELECT request_id, CASE WHEN shape = 0 THEN 'STRING' WHEN shape = 3 THEN 'OBJECT' ELSE 'ARRAY' END AS output_kind
FROM t""")
def q_response_output(spark, sf_dir):
    r = _resp(spark, sf_dir)
    return r.select(RID, R.vkind(_out(r)).alias("output_kind"))


@register("extract_message", _T + f"""
SELECT request_id, CASE WHEN shape < 5 THEN text ELSE {_FALLBACK} END AS message FROM t""")
def q_extract_message(spark, sf_dir):
    return R.messages(_resp(spark, sf_dir), [RID])


@register("join_blocks", _T + "SELECT request_id, text AS joined FROM t WHERE shape = 2")
def q_join_blocks(spark, sf_dir):
    """Block lists in the last output item's content, joined with newlines."""
    r = _resp(spark, sf_dir)
    arr = R.vget(_out(r), "$", "array<variant>")
    content = R.vget(F.try_element_at(arr, F.lit(-1)), "$.content")
    return (r.select(RID, content.alias("c")).where(R.vkind(F.col("c")) == "ARRAY")
            .select(RID, R.join_blocks(F.col("c")).alias("joined")))


@register("choices_message", _T + "SELECT request_id, text AS message FROM t WHERE shape = 3")
def q_choices_message(spark, sf_dir):
    r = _resp(spark, sf_dir)
    out = _out(r)
    return (r.where((R.vkind(out) == "OBJECT") & R.vget(out, "$.choices").isNotNull())
            .select(RID, R.choices_message(out).alias("message")))


@register("fallback_text", _T + f"SELECT request_id, {_FALLBACK} AS message FROM t WHERE shape = 5")
def q_fallback_text(spark, sf_dir):
    """List outputs with no usable message fall back to their JSON text."""
    r = _resp(spark, sf_dir)
    out = _out(r)
    return (r.where((R.vkind(out) == "ARRAY") & R.list_message(out).isNull())
            .select(RID, R.fallback_text(out).alias("message")))


_STEPS = f"""
SELECT request_id, 0 AS pos, 'tool_call' AS step_type, {_TOOL} AS name,
       '{{"request":"' || request_id || '"}}' AS arguments, NULL AS output, NULL AS content FROM t WHERE shape = 1
UNION ALL SELECT request_id, 1, 'tool_result', {_TOOL}, NULL, '{{"rows":1}}', NULL FROM t WHERE shape = 1
UNION ALL SELECT request_id, 0, 'thinking', NULL, NULL, NULL, 'thinking' FROM t WHERE shape = 2
UNION ALL SELECT request_id, 0, 'thinking', NULL, NULL, NULL, text FROM t WHERE shape = 4"""


@register("extract_steps", _T + "SELECT request_id, CAST(pos AS INTEGER) AS pos, "
          "step_type, name, arguments, output, content FROM (" + _STEPS + ")")
def q_extract_steps(spark, sf_dir):
    return R.extract_steps(_resp(spark, sf_dir), [RID])


@register("classify_step", _T + "SELECT step_type, COUNT(*) AS steps FROM (" + _STEPS + ") GROUP BY step_type")
def q_classify_step(spark, sf_dir):
    return (R.extract_steps(_resp(spark, sf_dir), [RID])
            .groupBy("step_type").agg(F.count(F.lit(1)).alias("steps")))


_APR = """SELECT request_id, CAST(1 AS INTEGER) AS pos, 'apr-' || request_id AS approval_id, 'partd' AS name,
       '{}' AS arguments FROM t WHERE shape = 4"""


@register("approval_requests", _T + _APR)
def q_approval_requests(spark, sf_dir):
    return R.approval_requests(_resp(spark, sf_dir), [RID])


@register("approval_responses", _T + """
SELECT request_id, CAST(1 AS INTEGER) AS pos, 'mcp_approval_response' AS type,
       'auto_approve_apr-' || request_id AS id, 'apr-' || request_id AS approval_request_id, true AS approve
FROM t WHERE shape = 4""")
def q_approval_responses(spark, sf_dir):
    return R.approval_responses(R.approval_requests(_resp(spark, sf_dir), [RID]), [RID])


# ------------------------------------------------------------ multi-round
_NAPPR = mix("seed", 43, 20)
_ERR = f"({mix('seed', 59, S.ERROR_ONE_IN)} = 0)"
_ROUNDS_T = _T.rstrip().rstrip(")") + f"""),
r AS (
  SELECT request_id, seed, conv_id, turn, text, {_ERR} AS err, {mix('seed', 61, 2)} AS err_kind,
         {mix('seed', 37, S.FINAL_SHAPES)} AS fshape,
         CASE WHEN {_NAPPR} >= 18 THEN 10 WHEN {_NAPPR} >= 14 THEN {_NAPPR} - 13 ELSE 0 END AS n_appr
  FROM t)
"""
_MERGED = f"""
SELECT request_id, 2 * g.r + 1 AS step_no, g.r AS round_no, 'tool_call' AS step_type, {_TOOL} AS name,
       '{{"round":' || g.r || '}}' AS arguments, NULL AS output, NULL AS content
FROM r, range(n_appr) g(r) WHERE NOT err
UNION ALL
SELECT request_id, 2 * g.r + 2, g.r, 'tool_call', 'partd', '{{}}', NULL, NULL FROM r, range(n_appr) g(r) WHERE NOT err
UNION ALL
SELECT request_id, 2 * n_appr + 1, n_appr, 'tool_call', {_TOOL}, '{{"request":"' || request_id || '"}}', NULL, NULL
FROM r WHERE NOT err AND n_appr < 10 AND fshape = 1
UNION ALL
SELECT request_id, 2 * n_appr + 2, n_appr, 'tool_result', {_TOOL}, NULL, '{{"rows":1}}', NULL
FROM r WHERE NOT err AND n_appr < 10 AND fshape = 1
UNION ALL
SELECT request_id, 2 * n_appr + 1, n_appr, 'thinking', NULL, NULL, NULL, 'thinking'
FROM r WHERE NOT err AND n_appr < 10 AND fshape = 2"""


def _rounds(spark, sf_dir):
    return S.agent_rounds(spark, sf_dir, C.MAX_APPROVAL_ROUNDS)


@register("merged_steps", _ROUNDS_T + "SELECT request_id, CAST(step_no AS BIGINT) "
          "AS step_no, CAST(round_no AS INTEGER) AS round_no, step_type, name, arguments, output, content FROM ("
          + _MERGED + ")")
def q_merged_steps(spark, sf_dir):
    return R.merged_steps(_rounds(spark, sf_dir))


@register("tool_use_summary", _ROUNDS_T + ", m AS (" + _MERGED + """)
SELECT request_id, COUNT(*) AS steps, COUNT(CASE WHEN step_type = 'tool_call' THEN 1 END) AS tool_calls,
       CASE WHEN COUNT(CASE WHEN step_type = 'tool_call' THEN 1 END) > 0
            THEN 'Used ' || COUNT(CASE WHEN step_type = 'tool_call' THEN 1 END) || ' tool'
                 || CASE WHEN COUNT(CASE WHEN step_type = 'tool_call' THEN 1 END) > 1 THEN 's' ELSE '' END || ': '
                 || string_agg(CASE WHEN step_type = 'tool_call' THEN name END, ', ' ORDER BY step_no)
            ELSE COUNT(*) || ' intermediate step' || CASE WHEN COUNT(*) > 1 THEN 's' ELSE '' END END AS summary
FROM m GROUP BY request_id""")
def q_tool_use_summary(spark, sf_dir):
    return R.tool_use_summary(R.merged_steps(_rounds(spark, sf_dir)))


@register("chain_rounds", _ROUNDS_T + f"""
SELECT request_id, CAST(g.r AS INTEGER) AS round_no, CAST(3 * g.r AS BIGINT) AS seq, 'function_call' AS item_type,
       {_TOOL} AS item_ref,
       '{{"arguments":"{{\\"round\\":' || g.r || '}}","name":"' || {_TOOL} || '","type":"function_call"}}' AS item
FROM r, range(n_appr) g(r) WHERE NOT err
UNION ALL
SELECT request_id, CAST(g.r AS INTEGER), CAST(3 * g.r + 1 AS BIGINT), 'mcp_approval_request',
       'apr-' || request_id || '-' || g.r,
       '{{"arguments":"{{}}","id":"apr-' || request_id || '-' || g.r || '","name":"partd","type":"mcp_approval_request"}}'
FROM r, range(n_appr) g(r) WHERE NOT err
UNION ALL
SELECT request_id, CAST(g.r AS INTEGER), CAST(3 * g.r + 2 AS BIGINT), 'mcp_approval_response',
       'auto_approve_apr-' || request_id || '-' || g.r,
       '{{"approval_request_id":"apr-' || request_id || '-' || g.r || '","approve":true,"id":"auto_approve_apr-'
         || request_id || '-' || g.r || '","type":"mcp_approval_response"}}'
FROM r, range(n_appr) g(r) WHERE NOT err""")
def q_chain_rounds(spark, sf_dir):
    return R.chain_rounds(_rounds(spark, sf_dir))


@register("round_limit_audit", _ROUNDS_T + """
SELECT request_id, CAST(10 AS BIGINT) AS rounds, 200 AS last_status, true AS last_asks_approval,
       true AS hit_round_limit
FROM r WHERE NOT err AND n_appr = 10""")
def q_round_limit_audit(spark, sf_dir):
    """Requests still asking for approval when the round limit ended them
    (answered with the last body as if it were final)."""
    return R.round_summary(_rounds(spark, sf_dir)).where(F.col("hit_round_limit"))


@register("error_message", _ROUNDS_T + """
SELECT request_id, CASE WHEN err_kind = 0 THEN 500 ELSE 429 END AS status,
       CASE WHEN err_kind = 0 THEN 'upstream failure for request ' || request_id ELSE 'rate limited' END
         AS error_message
FROM r WHERE err""")
def q_error_message(spark, sf_dir):
    rr = _rounds(spark, sf_dir)
    return (rr.where(F.col("status") != 200)
            .select(RID, "status", R.error_message(R.parsed(F.col("body")), F.col("body")).alias("error_message")))


_HISTORY = f"""
WITH f AS (
  SELECT conv_id, turn FROM conversations
  WHERE role = 'assistant' AND {mix('conv_id * 100 + turn', 59, S.ERROR_ONE_IN)} = 0),
h AS (
  SELECT c.conv_id, c.turn, c.role, c.text AS content
  FROM conversations c
  WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.conv_id = c.conv_id AND f.turn = c.turn)
    AND NOT (c.role = 'user' AND EXISTS (SELECT 1 FROM f WHERE f.conv_id = c.conv_id AND f.turn - 1 = c.turn)))
"""


@register("history_build", _HISTORY + "SELECT * FROM h")
def q_history_build(spark, sf_dir):
    """Turn history per conversation with failed requests removed (their
    assistant turn and the user turn that asked)."""
    from ..sources.tables import load
    conv = load(spark, sf_dir, "conversations")
    failed = conv.where((F.col("role") == "assistant") & S.is_error_request(S.seed())).select("conv_id", "turn")
    return R.history(conv, failed)


@register("history_lists", _HISTORY + """, n AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, content NULLS FIRST) - 1) // 4 AS chunk
  FROM h)
SELECT conv_id, chunk, COUNT(*) AS n_messages,
       string_agg(coalesce(role, '') || ': ' || coalesce(content, ''), chr(10) ORDER BY turn NULLS FIRST, role NULLS FIRST, content NULLS FIRST)
         AS transcript
FROM n GROUP BY conv_id, chunk""")
def q_history_lists(spark, sf_dir):
    """The message list of every conversation in chunks of 4 messages, written out as text."""
    said = F.transform("messages", lambda x: F.concat(F.coalesce(x["role"], F.lit("")), F.lit(": "), F.coalesce(x["content"], F.lit(""))))
    return R.history_lists(q_history_build(spark, sf_dir), 4).select(
        "conv_id", "chunk", "n_messages", F.array_join(said, "\n").alias("transcript"))


@register("assign_conversation_id", """
SELECT conv_id, turn, CASE WHEN conv_id IS NOT NULL THEN printf('conv-%08d', conv_id) END AS conversation_id
FROM conversations""")
def q_assign_conversation_id(spark, sf_dir):
    """The given id.  ``conversations`` holds no key of the request that began a
    conversation, so rows without a conv_id get null: no column tells which of
    them belong together, and a hash of the turn would merge different ones."""
    from ..sources.tables import load
    conv = load(spark, sf_dir, "conversations")
    given = F.when(F.col("conv_id").isNotNull(), F.col("conversation_id")).alias("conversation_id")
    return R.assign_conversation_id(conv, []).select("conv_id", "turn", given)


_ANSWER_STEPS = """m AS (""" + _MERGED + """),
ms AS (SELECT request_id, string_agg(step_type || ': ' || coalesce(name, content, ''), ' | ' ORDER BY step_no) AS steps
       FROM m GROUP BY request_id)"""
# a request that hits the round limit ends with a body that still asks: no message in it, so its JSON text
_ASKING = f"""'[{{"arguments":"{{\\"round\\":9}}","name":"' || {_TOOL} || '","type":"function_call"}},'
  || '{{"arguments":"{{}}","id":"apr-' || r.request_id || '-9","name":"partd","type":"mcp_approval_request"}}]'"""


@register("chat_answers", _ROUNDS_T.rstrip() + ", " + _ANSWER_STEPS + f"""
SELECT r.request_id, r.conv_id, r.turn, CASE WHEN n_appr < 10 THEN text ELSE {_ASKING} END AS message,
       coalesce(ms.steps, '') AS steps
FROM r LEFT JOIN ms ON r.request_id = ms.request_id WHERE NOT err""")
def q_chat_answers(spark, sf_dir):
    """The final answer of every request that did not fail, with its steps."""
    return R.chat_answers(_rounds(spark, sf_dir))
