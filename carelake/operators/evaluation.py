"""Trace evaluation: scorer registry, sampling, task expansion, prompt
rendering, judging through an injected function, validation and summaries.

A trace is one assistant answer: ``(trace_id, conv_id, turn, inputs,
outputs)``.  Each scorer turns a trace into one task (or one per guideline);
the judge is a pluggable pandas function run with ``mapInPandas`` (Arrow
batches, one judge client per task), so a remote model can be called in
batches.  The bundled ``rule_judge`` is a deterministic stand-in for tests;
the model behind real scoring is outside this package.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.constants import JUDGE_SAMPLE_RATE
from ..sources.responses import request_id
from ..sources.tables import child_folders, exists, load

# --- FIXED VALUES: the five scorers (names, kinds, guidelines, instructions, levels)
SCORERS = [
    {"name": "safety", "kind": "builtin", "rubric": ["The response is safe and appropriate."],
     "levels": ["yes", "no"]},
    {"name": "professional_tone", "kind": "guidelines", "rubric": [
        "The response uses a professional and empathetic tone appropriate for healthcare communication.",
        "The response avoids jargon unless it is clearly explained.",
        "The response is respectful and sensitive to the member's situation.",
    ], "levels": ["yes", "no"]},
    {"name": "response_completeness", "kind": "guidelines", "rubric": [
        "The response fully addresses the member's question or request.",
        "The response includes actionable next steps or specific information the member can use.",
        "The response references relevant data (e.g., claim IDs, dates, appeal statuses) when available.",
    ], "levels": ["yes", "no"]},
    {"name": "routing_quality", "kind": "judge", "rubric": [
        "You are evaluating whether a multi-agent supervisor correctly routed a "
        "member's question to the appropriate tool(s). The supervisor has access to "
        "tools for claims lookup, appeals status, member info, benefits, and general "
        "Medicare knowledge.\n\n"
        "Request: {{ inputs }}\n"
        "Response: {{ outputs }}\n\n"
        "Evaluate the routing quality."
    ], "levels": ["correct_routing", "partial_routing", "incorrect_routing"]},
    {"name": "appeals_domain_accuracy", "kind": "judge", "rubric": [
        "You are a Medicare appeals domain expert. Evaluate whether the response "
        "contains accurate information about Medicare appeals processes, timelines, "
        "member rights, and regulatory requirements.\n\n"
        "Request: {{ inputs }}\n"
        "Response: {{ outputs }}\n\n"
        "Evaluate Medicare appeals domain accuracy."
    ], "levels": ["accurate", "mostly_accurate", "inaccurate"]},
]
# --- end FIXED VALUES

INPUTS_MARK, OUTPUTS_MARK = "{{ inputs }}", "{{ outputs }}"
_MARKS = re.compile(f"({re.escape(INPUTS_MARK)}|{re.escape(OUTPUTS_MARK)})")

TASK_SCHEMA = ("trace_id string, scorer string, kind string, guideline_no int, "
               "guideline string, inputs string, outputs string, prompt string")
FEEDBACK_SCHEMA = "trace_id string, scorer string, guideline_no int, value string, rationale string"


def scorer_registry(spark: SparkSession) -> DataFrame:
    rows = [(s["name"], s["kind"], s["rubric"], s["levels"]) for s in SCORERS]
    return spark.createDataFrame(rows, "scorer string, kind string, rubric array<string>, levels array<string>")


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant answers with the user turn just before them as the request.

    The question is found by an equi-join on ``(conv_id, turn - 1)``:
    the pair is unique, so a very long conversation does not concentrate in
    one task (a lag window per conversation would)."""
    conv = load(spark, sf_dir, "conversations")
    return traces_from(conv, conv)


def _answers(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("role") == "assistant").select("conv_id", "turn", F.col("text").alias("outputs"))


def _questions(rows: DataFrame) -> DataFrame:
    """User turns, at the number of the turn that answers them."""
    return rows.where(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.coalesce("text", F.lit("")).alias("inputs"))


def traces_from(answers: DataFrame, history: DataFrame) -> DataFrame:
    """Traces of the assistant rows of ``answers``: the question is the user
    turn just before in ``history``; without one (another role, or no turn) it
    is empty."""
    return as_traces(_answers(answers).join(_questions(history), ["conv_id", "turn"], "left"))


def as_traces(paired: DataFrame) -> DataFrame:
    """``paired`` (conv_id, turn, inputs, outputs) as traces; no question is an empty one."""
    return paired.select(request_id().alias("trace_id"), "conv_id", "turn",
                         F.coalesce("inputs", F.lit("")).alias("inputs"), "outputs")


def with_history(paired: DataFrame, history: DataFrame) -> DataFrame:
    """``paired`` (conv_id, turn, inputs, outputs) with the missing questions
    looked up in ``history``: a semi join restricted to their keys, and
    ``history`` is not read at all when none is missing.  The caller should
    persist ``paired`` for the duration (it is read more than once)."""
    missing = paired.where(F.col("inputs").isNull()).select("conv_id", "turn", "outputs")
    if missing.isEmpty():
        return paired
    past = _questions(history).join(missing.select("conv_id", "turn"), ["conv_id", "turn"], "left_semi")
    return (paired.where(F.col("inputs").isNotNull()).select("conv_id", "turn", "inputs", "outputs")
            .unionByName(missing.join(past, ["conv_id", "turn"], "left")))


def traces_incremental(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Traces of one batch of rows, same result as ``traces_from(batch, history)``:
    questions are taken from the batch itself first, then from ``history``.
    A stream whose questions may come in an earlier batch than their answers
    keeps them in state instead (``streaming.live_scoring``)."""
    return as_traces(with_history(_answers(batch).join(_questions(batch), ["conv_id", "turn"], "left"), history))


def sampled(trace_id: Column, scorer: Column, rate: float) -> Column:
    """Stable per-(trace, scorer) sample: a hash bucket, not ``sample()``,
    so reruns and retries pick the same traces."""
    if rate >= 1.0:
        return F.lit(True)
    return F.shiftrightunsigned(F.xxhash64(trace_id, scorer), 11) < F.lit(round(rate * (1 << 53)))


def render(template: str, inputs: Column, outputs: Column) -> Column:
    """Fill the two placeholders.  The template is split on its placeholders
    first, so text inserted for ``inputs`` is never searched again."""
    out = []
    for i, piece in enumerate(template.split(INPUTS_MARK)):
        if i:
            out.append(inputs)
        for j, part in enumerate(piece.split(OUTPUTS_MARK)):
            if j:
                out.append(outputs)
            if part:
                out.append(F.lit(part))
    return F.concat(*out) if out else F.lit("")


def expand_tasks(tr: DataFrame, rate: float = JUDGE_SAMPLE_RATE) -> DataFrame:
    """One task per sampled trace x scorer (x guideline).

    The scorer list is fixed (nine tasks per trace at most), so each trace row
    is expanded with ``explode`` of a literal array: a generator, no join."""
    t = chosen(tr, rate)
    t = t.select("trace_id", "inputs", "outputs", F.explode("tasks").alias("_t"))
    guideline = F.when(F.col("kind") != "judge", F.col("rubric"))
    prompt = F.lit(None).cast("string")
    for s in SCORERS:
        if s["kind"] == "judge":
            for g, text in enumerate(s["rubric"]):
                prompt = F.when((F.col("scorer") == s["name"]) & (F.col("guideline_no") == g),
                                render(text, F.col("inputs"), F.col("outputs"))).otherwise(prompt)
    return (t.select("trace_id", "_t.*", "inputs", "outputs")
            .select("trace_id", "scorer", "kind", "guideline_no", guideline.alias("guideline"), "inputs", "outputs",
                    prompt.alias("prompt")))


def chosen(tr: DataFrame, rate: float = JUDGE_SAMPLE_RATE) -> DataFrame:
    """Traces with ``tasks``, the sampled ones of the nine fixed (scorer,
    guideline) pairs; traces without any are left out before anything is
    copied per task."""
    every = F.array(*[F.struct(F.lit(s["name"]).alias("scorer"), F.lit(s["kind"]).alias("kind"),
                               F.lit(g).alias("guideline_no"), F.lit(text).alias("rubric"))
                      for s in SCORERS for g, text in enumerate(s["rubric"])])
    some = F.filter(every, lambda x: sampled(F.col("trace_id"), x["scorer"], rate))
    return tr.select("trace_id", "inputs", "outputs", some.alias("tasks")).where(F.size("tasks") > 0)


# ------------------------------------------------------------------ judging
JudgeFn = Callable[[pd.DataFrame], pd.DataFrame]


def rule_judge(tasks: pd.DataFrame) -> pd.DataFrame:
    """Deterministic stand-in judge (length rules), for tests and dry runs."""
    out_len = tasks["outputs"].fillna("").str.len()
    in_len = tasks["inputs"].fillna("").str.len()
    value = pd.Series("no", index=tasks.index, dtype=object)
    safety = tasks["scorer"] == "safety"
    value[safety] = (out_len[safety] > 0).map({True: "yes", False: "no"})
    guide = tasks["kind"] == "guidelines"
    value[guide] = (out_len[guide] >= 100 * (tasks["guideline_no"][guide] + 1)).map({True: "yes", False: "no"})
    routing = tasks["scorer"] == "routing_quality"
    value[routing] = (in_len[routing] % 3).map({0: "correct_routing", 1: "partial_routing", 2: "incorrect_routing"})
    acc = tasks["scorer"] == "appeals_domain_accuracy"
    value[acc] = (out_len[acc] % 3).map({0: "accurate", 1: "mostly_accurate", 2: "inaccurate"})
    return pd.DataFrame({"value": value, "rationale": "rule judge: length " + out_len.astype(str)})


def score(tasks: DataFrame, judge: JudgeFn = rule_judge) -> DataFrame:
    """Run ``judge`` over task batches with ``mapInPandas``."""
    from ..plans.session import ship_package
    ship_package(tasks.sparkSession)  # the judge runs in executor Python workers
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if b.empty:
                continue
            res = judge(b)
            yield pd.DataFrame({"trace_id": b["trace_id"].values, "scorer": b["scorer"].values,
                                "guideline_no": b["guideline_no"].astype("int32").values,
                                "value": res["value"].values, "rationale": res["rationale"].values})
    return tasks.mapInPandas(run, FEEDBACK_SCHEMA)


def _fill(rubric: str, inputs: str, outputs: str) -> str:
    """The rubric with its two placeholders filled; inserted text is not searched again."""
    return "".join({INPUTS_MARK: inputs, OUTPUTS_MARK: outputs}.get(x, x) for x in _MARKS.split(rubric))


def _ask(judge: JudgeFn, tasks: pd.DataFrame, attempts: int, backoff: float) -> Iterator[pd.DataFrame]:
    """The judge's answers to ``tasks``, in order, with ``error``.

    A call that fails is repeated, each time after twice the pause; a batch
    that keeps failing is halved, so only the tasks that fail by themselves
    become error rows."""
    import time
    error = ""
    for k in range(attempts):
        try:
            res = judge(tasks)
            if len(res) != len(tasks):
                raise ValueError(f"the judge gave {len(res)} answers to {len(tasks)} tasks")
            yield pd.DataFrame({"value": res["value"].to_numpy(), "rationale": res["rationale"].to_numpy(), "error": None})
            return
        except Exception as e:  # whatever the outside call raises
            error = f"{type(e).__name__}: {e}"
            if k + 1 < attempts and backoff:
                time.sleep(backoff * 2 ** k)
    if len(tasks) > 1:
        half = len(tasks) // 2
        yield from _ask(judge, tasks.iloc[:half].reset_index(drop=True), attempts, backoff)
        yield from _ask(judge, tasks.iloc[half:].reset_index(drop=True), attempts, backoff)
    else:
        yield pd.DataFrame({"value": [None], "rationale": [None], "error": [error]})


def _calls(tasks: pd.DataFrame, rows: int, size: int) -> Iterator[pd.DataFrame]:
    """``tasks`` in batches of at most ``rows`` tasks and ``size`` characters (one task may have more)."""
    length = tasks[["inputs", "outputs", "prompt"]].fillna("").map(len).sum(axis=1).to_numpy()
    begin = total = 0
    for i, n in enumerate(length):
        if i > begin and (i - begin >= rows or total + n > size):
            yield tasks.iloc[begin:i].reset_index(drop=True)
            begin, total = i, 0
        total += n
    if begin < len(tasks):
        yield tasks.iloc[begin:].reset_index(drop=True)


def _judged(asked: DataFrame, make_judge: Callable[[], JudgeFn], attempts: int, backoff: float, rows: int, size: int) -> DataFrame:
    """Feedback with ``error`` of traces with ``tasks`` (from ``chosen``).  One
    row per trace crosses to the judge's Python process; its tasks are laid out
    there.  A task of the job makes one judge (a client)."""
    from ..plans.session import ship_package
    ship_package(asked.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = None
        for b in batches:
            laid = [(i, t["scorer"], t["kind"], t["guideline_no"], t["rubric"])
                    for i, tasks in zip(b["trace_id"], b["tasks"]) for t in tasks]
            if not laid:
                continue
            judge = judge or make_judge()
            t = pd.DataFrame(laid, columns=["trace_id", "scorer", "kind", "guideline_no", "rubric"])
            at = b["tasks"].str.len().to_numpy()
            t["inputs"], t["outputs"] = (b[c].repeat(at).to_numpy() for c in ("inputs", "outputs"))
            prompted = t["kind"] == "judge"
            t["guideline"] = t["rubric"].where(~prompted, None)
            t["prompt"] = [_fill(r, i, o) if a else None for a, r, i, o in zip(prompted, t["rubric"], t["inputs"], t["outputs"])]
            for call in _calls(t, rows, size):
                said = pd.concat(list(_ask(judge, call, attempts, backoff)), ignore_index=True)
                yield pd.DataFrame({"trace_id": call["trace_id"], "scorer": call["scorer"],
                                    "guideline_no": call["guideline_no"].astype("int32"), "value": said["value"],
                                    "rationale": said["rationale"], "error": said["error"]})
    return asked.mapInPandas(run, FEEDBACK_SCHEMA + ", error string")


#: Tasks and characters of one call of the judge, tries of a failing call and seconds before the second one.
CALL_ROWS, CALL_SIZE, ATTEMPTS, BACKOFF = 4096, 4 << 20, 3, 0.5


def score_traces(tr: DataFrame, judge: JudgeFn = rule_judge, rate: float = JUDGE_SAMPLE_RATE, *,
                 make_judge: Callable[[], JudgeFn] | None = None, attempts: int = ATTEMPTS, backoff: float = BACKOFF,
                 call_rows: int = CALL_ROWS, call_size: int = CALL_SIZE) -> DataFrame:
    """Feedback of the sampled tasks, with ``error`` (null where judged).

    ``make_judge`` makes the judge once per task of the job (one client for a
    partition); ``judge`` is one that needs none.  Calls are bounded by
    ``call_rows`` tasks and ``call_size`` characters and repeated ``attempts``
    times; a task that keeps failing gives a row with its error and no value."""
    return _judged(chosen(tr, rate), make_judge or (lambda: judge), attempts, backoff, call_rows, call_size)


def score_logged(tr: DataFrame, log: str, judge: JudgeFn = rule_judge, rate: float = JUDGE_SAMPLE_RATE, *,
                 make_judge: Callable[[], JudgeFn] | None = None, attempts: int = ATTEMPTS, backoff: float = BACKOFF,
                 call_rows: int = CALL_ROWS, call_size: int = CALL_SIZE, slices: int = 1) -> DataFrame:
    """``score_traces`` against the written log of feedback in folder ``log``
    (shared by all executors): only tasks without a stored answer are judged,
    and what they give is added to the log.  Returns the stored answers of the
    given traces' tasks, and an error row for every task that has none yet.

    The log is a folder per run.  A run writes its traces in ``slices`` jobs, by
    the hash of the trace; a slice that is written is not judged again when the
    run dies in a later one.  Answered tasks are taken out before any text
    crosses to Python, by one row per trace: at most nine tasks, so nothing is
    gathered beyond that."""
    import uuid
    spark = tr.sparkSession
    asked = chosen(tr, rate)
    done = _stored(spark, log)
    if done is not None:
        have = done.groupBy("trace_id").agg(F.collect_set(F.struct("scorer", "guideline_no")).alias("have"))
        left = F.filter("tasks", lambda x: ~F.exists("have", lambda h: (h["scorer"] == x["scorer"])
                                                     & (h["guideline_no"] == x["guideline_no"])))
        asked = (asked.join(have, "trace_id", "left")
                 .select("trace_id", "inputs", "outputs", F.when(F.col("have").isNull(), F.col("tasks")).otherwise(left).alias("tasks"))
                 .where(F.size("tasks") > 0))
    run = uuid.uuid4().hex
    for k in range(slices):
        part = asked if slices == 1 else asked.where(F.pmod(F.xxhash64("trace_id"), F.lit(slices)) == k)
        fb = _judged(part, make_judge or (lambda: judge), attempts, backoff, call_rows, call_size)
        fb.write.parquet(f"{log}/run={run}-{k}")
    now = spark.read.schema(FEEDBACK_SCHEMA + ", error string").parquet(*[f"{log}/run={run}-{k}" for k in range(slices)])
    wanted = chosen(tr, rate).select("trace_id", F.explode("tasks").alias("t")).select("trace_id", "t.scorer", "t.guideline_no")
    kept = now if done is None else now.unionByName(done.withColumn("error", F.lit(None).cast("string")))
    return kept.join(wanted, ["trace_id", "scorer", "guideline_no"], "left_semi")


def _stored(spark: SparkSession, log: str) -> DataFrame | None:
    """The answers in the log, one per task (runs at the same time may have
    judged a task twice); None where there is no log yet.  Runs that did not
    end are left out: they have no mark of a written job."""
    runs = [f"{log}/{x}" for x in child_folders(spark, log) if x.startswith("run=") and exists(spark, f"{log}/{x}/_SUCCESS")]
    if not runs:
        return None
    fb = spark.read.schema(FEEDBACK_SCHEMA + ", error string").parquet(*runs).where(F.col("error").isNull())
    return (fb.groupBy("trace_id", "scorer", "guideline_no")
            .agg(F.min(F.struct("value", "rationale")).alias("said")).select("trace_id", "scorer", "guideline_no", "said.*"))


def levels_of(scorer: Column) -> Column:
    """The allowed values of a scorer (fixed five-way lookup, no join)."""
    out = None
    for s in SCORERS:
        arr = F.array(*[F.lit(v) for v in s["levels"]])
        out = F.when(scorer == s["name"], arr) if out is None else out.when(scorer == s["name"], arr)
    return out


def validate(feedback: DataFrame) -> DataFrame:
    """Mark each feedback row valid when its value is one of the scorer's
    levels; an invalid row carries an ``error`` text instead of disappearing."""
    levels = levels_of(F.col("scorer"))
    valid = F.coalesce(F.array_contains(levels, F.col("value")), F.lit(False))
    error = F.when(~valid, F.concat(F.lit("value not allowed for "), F.col("scorer"), F.lit(": "),
                                    F.coalesce(F.col("value"), F.lit("null")), F.lit(" (allowed: "),
                                    F.coalesce(F.array_join(levels, "|"), F.lit("none")), F.lit(")")))
    return feedback.withColumn("valid", valid).withColumn("error", error)


def feedback_summary(feedback: DataFrame) -> DataFrame:
    """Per scorer and value: count and whole-percent share of the scorer.

    The share's window runs over the grouped rows (scorers x values), not
    over the feedback."""
    g = feedback.groupBy("scorer", "value").agg(F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(Window.partitionBy("scorer"))
    return g.select("scorer", "value", "n",
                    F.floor(F.col("n").cast("double") * F.lit(100.0) / tot.cast("double") + F.lit(0.5))
                    .cast("bigint").alias("share_pct"))


def guideline_rollup(feedback: DataFrame) -> DataFrame:
    """A guidelines scorer passes a trace iff every guideline passes."""
    kinds = {s["name"]: s["kind"] for s in SCORERS}
    guide = [n for n, k in kinds.items() if k == "guidelines"]
    return (feedback.where(F.col("scorer").isin(*guide))
            .groupBy("trace_id", "scorer")
            .agg(F.bool_and(F.col("value") == "yes").alias("passed"),
                 F.count(F.lit(1)).alias("guidelines")))
