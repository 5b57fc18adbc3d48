"""Assistant response tables derived from ``conversations``.

``agent_responses(request_id, conv_id, turn, shape, text, body)``: one JSON
response body per assistant turn, in one of six shapes the assistant
endpoint may return (plain string output, tool-call list, text blocks,
chat-completions style, message plus approval request, tool list without
any message).  The expected message of shapes 0-4 is the turn's text.

``agent_rounds(request_id, round_no, status, body)``: the same requests as a
multi-round exchange: approval rounds (a tool call and an approval request)
followed by a final body; some requests never stop asking (round limit),
some fail with a non-200 status.

Bodies are built with ``to_json`` over structs, so escaping is exact.  A
request is known by the pair (conv_id, turn), written ``conv_id:turn``; the
choice of shapes follows a number made of the pair (``seed``), which is not a
key.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keyed import mix, pick
from .defined import defined_once
from .tables import load

# Ours: tool names used in the derived responses.
TOOL_NAMES = ["claim_lookup", "appeal_lookup", "member_lookup", "eligibility_lookup", "prior_auth_lookup"]
APPROVAL_TOOL = "partd"
N_SHAPES = 6
FINAL_SHAPES = 4          # approval-free shapes usable as a last round
ERROR_ONE_IN = 25


def request_id(conv_id="conv_id", turn="turn") -> Column:
    """The key of a request: one text per (conv_id, turn), whatever their size."""
    return F.concat(F.col(conv_id).cast("string"), F.lit(":"), F.col(turn).cast("string"))


def seed(conv_id="conv_id", turn="turn") -> Column:
    """A number that the fixture's choices follow; several requests may share it."""
    return F.col(conv_id) * F.lit(100) + F.col(turn)


def tool_name(number: Column) -> Column:
    return pick(mix(number, 41, len(TOOL_NAMES)), TOOL_NAMES)


def _j(*fields) -> Column:
    return F.to_json(F.struct(*fields))


def body_for_shape(shape: Column, text: Column, rid: Column, number: Column) -> Column:
    """JSON text of the response body for a shape number."""
    tool = tool_name(number)
    call = _j(F.lit("function_call").alias("type"), tool.alias("name"),
              F.format_string('{"request":"%s"}', rid).alias("arguments"))
    result = _j(F.lit("function_result").alias("type"), tool.alias("name"),
                F.lit('{"rows":1}').alias("output"))
    msg = _j(F.lit("message").alias("type"), F.lit("assistant").alias("role"), text.alias("content"))
    blocks = _j(F.lit("message").alias("type"),
                F.transform(F.split(text, "\n", -1),
                            lambda x: F.struct(F.lit("output_text").alias("type"), x.alias("text"))).alias("content"))
    thinking = _j(F.lit("assistant").alias("role"), F.lit("thinking").alias("content"))
    approval = _j(F.lit("mcp_approval_request").alias("type"),
                  F.format_string("apr-%s", rid).alias("id"),
                  F.lit(APPROVAL_TOOL).alias("name"), F.lit("{}").alias("arguments"))
    plain_msg = _j(F.lit("message").alias("type"), text.alias("content"))
    bare_call = _j(F.lit("function_call").alias("type"), tool.alias("name"), F.lit("{}").alias("arguments"))
    choices = _j(F.array(F.struct(F.struct(text.alias("content")).alias("message"))).alias("choices"))
    return (F.when(shape == 0, _j(text.alias("output")))
            .when(shape == 1, F.concat(F.lit('{"output":['), call, F.lit(","), result, F.lit(","), msg, F.lit("]}")))
            .when(shape == 2, F.concat(F.lit('{"output":['), thinking, F.lit(","), blocks, F.lit("]}")))
            .when(shape == 3, choices)
            .when(shape == 4, F.concat(F.lit('{"output":['), plain_msg, F.lit(","), approval, F.lit("]}")))
            .otherwise(F.concat(F.lit('{"output":['), bare_call, F.lit("]}"))))


def assistant_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "conversations")
    return (c.where(F.col("role") == "assistant")
            .select(request_id().alias("request_id"), seed().alias("seed"), "conv_id", "turn", "text"))


@defined_once
def agent_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = assistant_turns(spark, sf_dir)
    rid, number = F.col("request_id"), F.col("seed")
    shape = mix(number, 37, N_SHAPES)
    return t.select("request_id", "conv_id", "turn", shape.alias("shape"), "text",
                    body_for_shape(shape, F.col("text"), rid, number).alias("body"))


def approval_round_count(number: Column) -> Column:
    """0 for most requests, 1-4 for some, 10 (the round limit) for a few."""
    r = mix(number, 43, 20)
    return F.when(r >= 18, F.lit(10)).when(r >= 14, r - F.lit(13)).otherwise(F.lit(0))


def is_error_request(number: Column) -> Column:
    return mix(number, 59, ERROR_ONE_IN) == 0


@defined_once
def agent_rounds(spark: SparkSession, sf_dir: str, max_rounds: int = 10) -> DataFrame:
    """``(request_id, conv_id, turn, round_no, status, body)``: one row per round."""
    t = assistant_turns(spark, sf_dir)
    rid, number = F.col("request_id"), F.col("seed")
    n_appr = approval_round_count(number)
    err = is_error_request(number)
    # number of rounds: 1 for errors, n_appr (+1 final unless the limit is hit)
    n_rounds = (F.when(err, F.lit(1))
                .when(n_appr >= max_rounds, F.lit(max_rounds))
                .otherwise(n_appr + F.lit(1)))
    rounds = t.select("request_id", "seed", "conv_id", "turn", "text", n_appr.alias("n_appr"), err.alias("err"),
                      F.explode(F.sequence(F.lit(0), n_rounds - F.lit(1))).alias("round_no"))
    tool = tool_name(number)
    appr_body = F.concat(
        F.lit('{"output":['),
        _j(F.lit("function_call").alias("type"), tool.alias("name"),
           F.format_string('{"round":%d}', F.col("round_no")).alias("arguments")),
        F.lit(","),
        _j(F.lit("mcp_approval_request").alias("type"),
           F.format_string("apr-%s-%d", rid, F.col("round_no")).alias("id"),
           F.lit(APPROVAL_TOOL).alias("name"), F.lit("{}").alias("arguments")),
        F.lit("]}"))
    err_kind = mix(number, 61, 2)
    err_body = F.when(err_kind == 0, _j(F.format_string("upstream failure for request %s", rid).alias("message")))\
        .otherwise(_j(F.lit("rate limited").alias("error")))
    final_shape = mix(number, 37, FINAL_SHAPES)
    body = (F.when(F.col("err"), err_body)
            .when(F.col("round_no") < F.col("n_appr"), appr_body)
            .otherwise(body_for_shape(final_shape, F.col("text"), rid, number)))
    status = F.when(F.col("err"), F.when(err_kind == 0, F.lit(500)).otherwise(F.lit(429))).otherwise(F.lit(200))
    return rounds.select("request_id", "conv_id", "turn", F.col("round_no").cast("int").alias("round_no"),
                         status.alias("status"), body.alias("body"))
