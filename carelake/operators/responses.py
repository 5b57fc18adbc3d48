"""Message, step and approval extraction from assistant response bodies.

All rules run as VARIANT expressions inside the JVM (``try_parse_json``,
``try_variant_get``, ``schema_of_variant``, higher-order array functions):
no Python UDF, no per-row driver work.  A body is parsed once per row;
each rule is a Column over the parsed value, so Catalyst keeps the whole
extraction in one projection.

Rules (the assistant endpoint's contract):

* ``output`` is the body's ``output`` member when the key exists, else the
  whole body.
* message: a string output is the message; for a list, walk from the end
  and take the first object whose ``content`` is a non-empty string, or a
  list with at least one usable block (object -> its ``text`` or its own
  JSON text, string -> itself; joined with newlines); an object with
  ``choices`` gives ``choices[0].message.content``; anything else falls back
  to the JSON text of the output (the original printed a language repr;
  ours is JSON).
* steps: only lists of two or more items; every item but the last;
  ``function_call`` -> tool_call (name defaults to ``unknown``),
  ``function_result`` -> tool_result, ``message`` type or any ``role`` ->
  thinking when its content is non-empty; anything else is dropped.
* approval requests: items of a list output with type
  ``mcp_approval_request``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import MAX_APPROVAL_ROUNDS
from .ranking import row_number_within


def vkind(v: Column) -> Column:
    """Type family of a VARIANT: ARRAY, OBJECT, STRING, VOID (JSON null), or a
    scalar type name; NULL for SQL NULL."""
    return F.substring_index(F.schema_of_variant(v), "<", 1)


def vget(v: Column, path: str, typ: str = "variant") -> Column:
    return F.try_variant_get(v, path, typ)


def vstring(v: Column) -> Column:
    """The string value of a VARIANT string, else NULL."""
    return F.when(vkind(v) == "STRING", vget(v, "$", "string"))


def parsed(body: Column) -> Column:
    return F.try_parse_json(body)


def response_output(v: Column) -> Column:
    """``body.get('output', body)``: the member when present (even JSON null)."""
    return F.coalesce(vget(v, "$.output"), v)


def block_text(b: Column) -> Column:
    """One content block: object -> ``text`` (or its JSON), string -> itself."""
    k = vkind(b)
    return (F.when(k == "OBJECT", F.coalesce(vget(b, "$.text", "string"), F.to_json(b)))
            .when(k == "STRING", vget(b, "$", "string")))


def join_blocks(content: Column) -> Column:
    """Content block list -> newline-joined text; NULL when no usable block."""
    arr = vget(content, "$", "array<variant>")
    parts = F.filter(F.transform(arr, block_text), lambda x: x.isNotNull())
    return F.when(F.size(parts) > 0, F.array_join(parts, "\n"))


def content_text(item: Column) -> Column:
    """Text of an item's ``content``: non-empty string, or joined blocks."""
    content = vget(item, "$.content")
    s = vstring(content)
    return (F.when(vkind(item) != "OBJECT", F.lit(None).cast("string"))
            .when(s.isNotNull() & (s != ""), s)
            .when(vkind(content) == "ARRAY", join_blocks(content)))


def list_message(out: Column) -> Column:
    """Last usable message of a list output (walking from the end)."""
    arr = vget(out, "$", "array<variant>")
    found = F.filter(F.transform(F.reverse(arr), content_text), lambda x: x.isNotNull())
    return F.try_element_at(found, F.lit(1))


def choices_message(out: Column) -> Column:
    return vget(out, "$.choices[0].message.content", "string")


def fallback_text(out: Column) -> Column:
    return F.to_json(out)


def extract_message(v: Column) -> Column:
    out = response_output(v)
    k = vkind(out)
    has_choices = vget(out, "$.choices").isNotNull()
    return (F.when(k == "STRING", vget(out, "$", "string"))
            .when(k == "ARRAY", F.coalesce(list_message(out), fallback_text(out)))
            .when((k == "OBJECT") & has_choices, choices_message(out))
            .otherwise(fallback_text(out)))


def messages(df: DataFrame, key_cols: list[str], body_col: str = "body") -> DataFrame:
    """A body that is not JSON is its own message."""
    one = df.select(*key_cols, F.col(body_col).alias("_body"), parsed(F.col(body_col)).alias("_v"))
    return one.select(*key_cols, F.when(F.col("_v").isNull(), F.col("_body"))
                      .otherwise(extract_message(F.col("_v"))).alias("message"))


def _items(df: DataFrame, key_cols: list[str], body_col: str) -> DataFrame:
    """One row per item of a list output: ``(keys..., pos, n_items, item)``."""
    out = response_output(parsed(F.col(body_col)))
    arr = vget(out, "$", "array<variant>")
    return (df.select(*key_cols, arr.alias("_arr"))
            .where(F.col("_arr").isNotNull())
            .select(*key_cols, F.size("_arr").alias("n_items"),
                    F.posexplode("_arr").alias("pos", "item")))


def classify_item(item: Column) -> dict[str, Column]:
    """Step columns for one intermediate item (``step_type`` NULL = dropped)."""
    is_obj = vkind(item) == "OBJECT"
    typ = F.coalesce(vget(item, "$.type", "string"), F.lit(""))
    role = vget(item, "$.role")
    role_set = role.isNotNull() & (F.coalesce(vget(role, "$", "string"), F.lit("x")) != "") & \
        (vkind(role) != "VOID")
    content = vget(item, "$.content")
    ck = vkind(content)
    thinking_text = (F.when(ck == "ARRAY", F.coalesce(join_blocks(content), F.lit("")))
                     .when(ck == "STRING", vget(content, "$", "string"))
                     .when(content.isNull() | (ck == "VOID"), F.lit(""))
                     .otherwise(F.to_json(content)))

    def text_of(path, default):
        x = vget(item, path)
        return (F.when(x.isNull(), F.lit(default))  # missing
                .when(vkind(x) == "VOID", F.lit(None).cast("string"))  # a JSON null is no text
                .when(vkind(x) == "STRING", vget(x, "$", "string")).otherwise(F.to_json(x)))

    step_type = (F.when(~is_obj, F.lit(None))
                 .when(typ == "function_call", F.lit("tool_call"))
                 .when(typ == "function_result", F.lit("tool_result"))
                 .when(((typ == "message") | role_set) & (thinking_text != ""), F.lit("thinking")))
    return {
        "step_type": step_type,
        "name": F.when(typ == "function_call", text_of("$.name", "unknown"))
                 .when(typ == "function_result", text_of("$.name", "")),
        "arguments": F.when(typ == "function_call", text_of("$.arguments", "")),
        "output": F.when(typ == "function_result", text_of("$.output", "")),
        "content": F.when(step_type == "thinking", thinking_text),
    }


STEP_COLS = ["step_type", "name", "arguments", "output", "content"]


def extract_steps(df: DataFrame, key_cols: list[str], body_col: str = "body") -> DataFrame:
    """``(keys..., pos, step_type, name, arguments, output, content)``."""
    items = _items(df, key_cols, body_col).where((F.col("n_items") >= 2) & (F.col("pos") < F.col("n_items") - 1))
    cols = classify_item(F.col("item"))
    return (items.select(*key_cols, "pos", *[cols[c].alias(c) for c in STEP_COLS])
            .where(F.col("step_type").isNotNull()))


def approval_requests(df: DataFrame, key_cols: list[str], body_col: str = "body") -> DataFrame:
    """``(keys..., pos, approval_id, name, arguments)`` for each approval request."""
    items = _items(df, key_cols, body_col)
    it = F.col("item")
    return (items.where((vkind(it) == "OBJECT") & (vget(it, "$.type", "string") == "mcp_approval_request"))
            .select(*key_cols, "pos", vget(it, "$.id", "string").alias("approval_id"),
                    F.coalesce(vget(it, "$.name", "string"), F.lit("unknown")).alias("name"),
                    F.coalesce(vget(it, "$.arguments", "string"), F.lit("")).alias("arguments")))


def approval_responses(requests: DataFrame, key_cols: list[str]) -> DataFrame:
    """The auto-approval answer to each request (an audit of what the
    assistant loop approved without asking anyone)."""
    return requests.select(*key_cols, "pos",
                           F.lit("mcp_approval_response").alias("type"),
                           F.concat(F.lit("auto_approve_"), F.col("approval_id")).alias("id"),
                           F.col("approval_id").alias("approval_request_id"),
                           F.lit(True).alias("approve"))


def merged_steps(rounds: DataFrame, key: str = "request_id") -> DataFrame:
    """Steps over all rounds of a request in display order: each round's
    steps, then its approval requests as tool calls.

    One pass over the items of each body: an item yields its step (if it is
    an intermediate item that classifies) and/or an approval tool call.
    ``step_no`` is a row number inside one request, which holds at most the
    round limit of bodies."""
    from pyspark.sql.window import Window
    ok = rounds.where(F.col("status") == 200)
    items = _items(ok, [key, "round_no"], "body")
    it = F.col("item")
    cls = classify_item(it)
    is_step = (F.col("n_items") >= 2) & (F.col("pos") < F.col("n_items") - 1) & cls["step_type"].isNotNull()
    is_req = (vkind(it) == "OBJECT") & (vget(it, "$.type", "string") == "mcp_approval_request")
    step = F.when(is_step, F.struct(F.lit(0).alias("phase"), *[cls[c].alias(c) for c in STEP_COLS]))
    appr = F.when(is_req, F.struct(
        F.lit(1).alias("phase"), F.lit("tool_call").alias("step_type"),
        F.coalesce(vget(it, "$.name", "string"), F.lit("unknown")).alias("name"),
        F.coalesce(vget(it, "$.arguments", "string"), F.lit("")).alias("arguments"),
        F.lit(None).cast("string").alias("output"), F.lit(None).cast("string").alias("content")))
    both = (items.select(key, "round_no", "pos", F.explode(F.array(step, appr)).alias("_s"))
            .where(F.col("_s").isNotNull())
            .select(key, "round_no", "pos", "_s.*"))
    w = Window.partitionBy(key).orderBy("round_no", "phase", "pos")
    return both.select(key, F.row_number().over(w).cast("bigint").alias("step_no"), "round_no", *STEP_COLS)


def tool_use_summary(steps: DataFrame, key: str = "request_id") -> DataFrame:
    """Per request: ``Used N tool(s): a, b`` when it called tools, else
    ``N intermediate step(s)``.  Names are ordered by ``step_no``."""
    agg = steps.groupBy(key).agg(
        F.count(F.lit(1)).alias("steps"),
        F.count(F.when(F.col("step_type") == "tool_call", F.lit(1))).alias("tool_calls"),
        F.array_sort(F.collect_list(F.when(F.col("step_type") == "tool_call",
                                           F.struct("step_no", "name")))).alias("_calls"))
    names = F.array_join(F.transform("_calls", lambda x: x["name"]), ", ")
    plural = lambda n: F.when(n > 1, F.lit("s")).otherwise(F.lit(""))
    summary = (F.when(F.col("tool_calls") > 0,
                      F.concat(F.lit("Used "), F.col("tool_calls").cast("string"), F.lit(" tool"),
                               plural(F.col("tool_calls")), F.lit(": "), names))
               .otherwise(F.concat(F.col("steps").cast("string"), F.lit(" intermediate step"),
                                   plural(F.col("steps")))))
    return agg.select(key, "steps", "tool_calls", summary.alias("summary"))


def error_message(v: Column, body: Column) -> Column:
    """Non-200 body -> ``message``, else ``error``, else the body's JSON text;
    a body that is not JSON as it is."""
    def text_at(path):
        x = vget(v, path)
        return F.when(x.isNotNull() & (vkind(x) != "VOID"), F.when(vkind(x) == "STRING", vget(x, "$", "string")).otherwise(F.to_json(x)))
    return F.coalesce(text_at("$.message"), text_at("$.error"), F.to_json(v), body)


def round_summary(rounds: DataFrame, key: str = "request_id",
                  max_rounds: int = MAX_APPROVAL_ROUNDS) -> DataFrame:
    """Per request: rounds used, last status, whether the last body still asks
    for approval, and whether the round limit ended the exchange."""
    v = parsed(F.col("body"))
    out = response_output(v)
    arr = vget(out, "$", "array<variant>")
    asks = F.coalesce(F.exists(arr, lambda x: (vkind(x) == "OBJECT")
                               & (vget(x, "$.type", "string") == "mcp_approval_request")), F.lit(False))
    per = rounds.select(key, "round_no", "status", asks.alias("asks"))
    last = per.groupBy(key).agg(
        F.count(F.lit(1)).alias("rounds"),
        F.max_by(F.struct("status", "asks"), "round_no").alias("_last"))
    return last.select(key, "rounds", F.col("_last.status").alias("last_status"),
                       F.col("_last.asks").alias("last_asks_approval"),
                       ((F.col("rounds") >= max_rounds) & F.col("_last.asks")).alias("hit_round_limit"))


def chain_rounds(rounds: DataFrame, key: str = "request_id") -> DataFrame:
    """Items appended to the running input after each round that asked for
    approval: that round's output items in order, then one auto-approval
    per request, each with its JSON (``item``), so the next request can be
    built from it.  ``seq`` is the position in the appended chain; offsets
    come from a running sum over the (at most round-limit) rounds of one
    request."""
    from pyspark.sql.window import Window
    ok = rounds.where(F.col("status") == 200)
    items = _items(ok, [key, "round_no"], "body")
    it = F.col("item")
    asks = (vkind(it) == "OBJECT") & (vget(it, "$.type", "string") == "mcp_approval_request")
    items = items.withColumn("_q", F.coalesce(asks, F.lit(False)).cast("int"))
    # one pass: all windows share the partitioning by request, of at most the round limit of bodies
    in_round = Window.partitionBy(key, "round_no")
    upto = Window.partitionBy(key).orderBy("round_no", "pos").rowsBetween(Window.unboundedPreceding, 0)
    items = (items.withColumn("_r", F.sum("_q").over(in_round))
             .withColumn("_j", F.sum("_q").over(in_round.orderBy("pos")) - 1)
             .withColumn("_len", F.when(F.col("_r") > 0, F.col("n_items") + F.col("_r")).otherwise(0))
             .withColumn("_off", F.sum(F.when(F.col("pos") == 0, F.col("_len")).otherwise(0)).over(upto) - F.col("_len"))
             .where(F.col("_r") > 0))
    ref = vget(it, "$.id", "string")
    answer = F.struct(ref.alias("approval_request_id"), F.lit(True).alias("approve"),
                      F.concat(F.lit("auto_approve_"), ref).alias("id"), F.lit("mcp_approval_response").alias("type"))
    own = F.struct((F.col("_off") + F.col("pos")).alias("seq"),
                   F.coalesce(vget(it, "$.type", "string"), F.lit("")).alias("item_type"),
                   F.when(F.col("_q") == 1, ref).otherwise(vget(it, "$.name", "string")).alias("item_ref"),
                   F.to_json(it).alias("item"))
    reply = F.when(F.col("_q") == 1, F.struct(
        (F.col("_off") + F.col("n_items") + F.col("_j")).alias("seq"), F.lit("mcp_approval_response").alias("item_type"),
        F.concat(F.lit("auto_approve_"), ref).alias("item_ref"), F.to_json(answer).alias("item")))
    return (items.select(key, "round_no", F.explode(F.array_compact(F.array(own, reply))).alias("_x"))
            .select(key, "round_no", F.col("_x.seq").cast("bigint").alias("seq"),
                    "_x.item_type", "_x.item_ref", "_x.item"))


def chat_answers(rounds: DataFrame, keys: tuple = ("request_id", "conv_id", "turn")) -> DataFrame:
    """One row per answered request: the message of its last round's body and
    its steps in display order (name or content of each).  Requests with a
    failed round are left out.  A request holds at most the round limit of
    bodies, so its rows are grouped safely."""
    key = keys[0]
    last = rounds.groupBy(*keys).agg(F.bool_and(F.col("status") == 200).alias("_ok"),
                                     F.max_by("body", "round_no").alias("body")).where("_ok")
    said = messages(last, list(keys))
    steps = merged_steps(rounds, key).groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct("step_no", "step_type", F.coalesce("name", "content", F.lit("")).alias("what")))).alias("_s"))
    listed = F.array_join(F.transform(F.coalesce("_s", F.array().cast("array<struct<step_no:bigint,step_type:string,what:string>>")),
                                      lambda x: F.concat(x["step_type"], F.lit(": "), x["what"])), " | ")
    return said.join(steps, key, "left").select(*keys, "message", listed.alias("steps"))


def assign_conversation_id(turns: DataFrame, request_key: list[str]) -> DataFrame:
    """``turns`` with ``conversation_id``: the given ``conv_id``, else one made
    of ``request_key``, the columns that know a new conversation's request (the
    same for all its turns), so a rerun gives the same id."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in request_key]
    made = F.concat(F.lit("conv-"), F.substring(F.sha2(F.to_json(F.array(*parts)), 256), 1, 16))
    return turns.withColumn("conversation_id", F.when(
        F.col("conv_id").isNotNull(), F.format_string("conv-%08d", "conv_id")).otherwise(made))


def history(conversations: DataFrame, failed: DataFrame) -> DataFrame:
    """Conversation turns kept in history: a failed request removes its
    assistant turn and the user turn just before it.  ``failed`` holds
    ``(conv_id, turn)`` of failed assistant turns.  Keys are the unique
    ``(conv_id, turn)`` pair, so a long conversation does not skew the join."""
    failed = failed.select("conv_id", "turn")
    asked = failed.select("conv_id", (F.col("turn") - 1).alias("turn"), F.lit("user").alias("role"))
    return (conversations.join(failed, ["conv_id", "turn"], "left_anti")
            .join(asked, ["conv_id", "turn", "role"], "left_anti")
            .select("conv_id", "turn", "role", F.col("text").alias("content")))


def history_lists(history: DataFrame, size: int = 100) -> DataFrame:
    """(conv_id, chunk, n_messages, messages): each conversation as one ordered
    list of (role, content), in chunks of ``size`` messages counted from its
    start.  Messages follow by turn (rows without one first), role and content.
    They are numbered by ``row_number_within``, so a conversation with a third of
    all turns is numbered by many tasks and no list is longer than ``size``; a
    null conv_id is a conversation of its own."""
    rows = history.select("conv_id", "turn", "role", "content").withColumn(
        "_conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null")))
    placed = row_number_within(rows, ["_conv"], [F.asc("turn"), F.asc("role"), F.asc("content")], "_at")
    chunk = F.floor((F.col("_at") - 1) / size).cast("bigint")
    return (placed.withColumn("chunk", chunk).groupBy("conv_id", "chunk")
            .agg(F.array_sort(F.collect_list(F.struct("_at", "role", "content"))).alias("m"))
            .select("conv_id", "chunk", F.size("m").cast("bigint").alias("n_messages"),
                    F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages")))
