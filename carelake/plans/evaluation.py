"""Trace evaluation queries (batch and streaming)."""
from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ..operators import evaluation as E
from ..plans.session import ensure_checkpoint_dir
from ..sources.defined import defined_once
from ..sources.tables import load
from ..streaming.live_scoring import start_live_scoring
from .oracle_views import lit
from .registry import register

_TASK_ROWS = ", ".join(
    f"({lit(s['name'])}, {lit(s['kind'])}, {g}, {lit(text)})"
    for s in E.SCORERS for g, text in enumerate(s["rubric"]))
_TR = f"""WITH tr AS (
  SELECT a.conv_id || ':' || a.turn AS trace_id, a.conv_id, a.turn, COALESCE(p.text, '') AS inputs,
         a.text AS outputs
  FROM conversations a LEFT JOIN conversations p ON p.conv_id = a.conv_id AND p.turn = a.turn - 1 AND p.role = 'user'
  WHERE a.role = 'assistant'),
sc(scorer, kind, guideline_no, rubric) AS (VALUES {_TASK_ROWS}),
tasks AS (SELECT tr.trace_id, sc.scorer, sc.kind, CAST(sc.guideline_no AS INTEGER) AS guideline_no,
                 CASE WHEN sc.kind = 'judge' THEN NULL ELSE sc.rubric END AS guideline, tr.inputs, tr.outputs,
                 CASE WHEN sc.kind = 'judge'
                      THEN replace(replace(sc.rubric, '{E.INPUTS_MARK}', tr.inputs), '{E.OUTPUTS_MARK}', tr.outputs)
                 END AS prompt
          FROM tr, sc),
fb AS (SELECT trace_id, scorer, guideline_no,
         CASE WHEN scorer = 'safety' THEN CASE WHEN length(outputs) > 0 THEN 'yes' ELSE 'no' END
              WHEN scorer = 'routing_quality'
                THEN (['correct_routing', 'partial_routing', 'incorrect_routing'])[length(inputs) % 3 + 1]
              WHEN scorer = 'appeals_domain_accuracy'
                THEN (['accurate', 'mostly_accurate', 'inaccurate'])[length(outputs) % 3 + 1]
              ELSE CASE WHEN length(outputs) >= 100 * (guideline_no + 1) THEN 'yes' ELSE 'no' END END AS value,
         'rule judge: length ' || length(outputs) AS rationale
       FROM tasks)
"""


@defined_once
def _tasks(spark, sf_dir):
    """Evaluation tasks over the traces, defined once per session."""
    return E.expand_tasks(E.traces(spark, sf_dir))


def _feedback(spark, sf_dir):
    return E.score_traces(E.traces(spark, sf_dir)).drop("error")  # the rule judge answers every task


@register("sample_traces", _TR + "SELECT DISTINCT scorer, trace_id FROM tasks")
def q_sample_traces(spark, sf_dir):
    return _tasks(spark, sf_dir).select("scorer", "trace_id").distinct()


@register("expand_eval_tasks", _TR + "SELECT trace_id, scorer, kind, guideline_no, guideline FROM tasks")
def q_expand_eval_tasks(spark, sf_dir):
    return _tasks(spark, sf_dir).select("trace_id", "scorer", "kind", "guideline_no", "guideline")


@register("render_prompt", _TR + "SELECT trace_id, scorer, prompt FROM tasks WHERE kind = 'judge'")
def q_render_prompt(spark, sf_dir):
    return _tasks(spark, sf_dir).where(F.col("kind") == "judge").select("trace_id", "scorer", "prompt")


@register("score_traces", _TR + "SELECT trace_id, scorer, guideline_no, value, rationale FROM fb")
def q_score_traces(spark, sf_dir):
    return _feedback(spark, sf_dir)


@register("validate_feedback", _TR + """
SELECT trace_id, scorer, guideline_no, value, rationale,
       CASE WHEN scorer IN ('safety', 'professional_tone', 'response_completeness') THEN value IN ('yes', 'no')
            WHEN scorer = 'routing_quality' THEN value IN ('correct_routing', 'partial_routing', 'incorrect_routing')
            WHEN scorer = 'appeals_domain_accuracy' THEN value IN ('accurate', 'mostly_accurate', 'inaccurate')
            ELSE false END AS valid,
       CAST(NULL AS VARCHAR) AS error
FROM fb""")
def q_validate_feedback(spark, sf_dir):
    return E.validate(_feedback(spark, sf_dir))


@register("feedback_summary", _TR + """
SELECT scorer, value, COUNT(*) AS n,
       CAST(floor(CAST(COUNT(*) AS DOUBLE) * 100.0 / CAST(SUM(COUNT(*)) OVER (PARTITION BY scorer) AS DOUBLE) + 0.5)
            AS BIGINT) AS share_pct
FROM fb GROUP BY scorer, value""")
def q_feedback_summary(spark, sf_dir):
    return E.feedback_summary(_feedback(spark, sf_dir))


@register("guideline_rollup", _TR + """
SELECT trace_id, scorer, bool_and(value = 'yes') AS passed, COUNT(*) AS guidelines
FROM fb WHERE scorer IN ('professional_tone', 'response_completeness') GROUP BY trace_id, scorer""")
def q_guideline_rollup(spark, sf_dir):
    return E.guideline_rollup(_feedback(spark, sf_dir))


def _unsteady_judge():
    """The rule judge behind a client that fails for about a third of the traces."""
    def judge(tasks):
        from zlib import crc32
        if any(crc32(x.encode()) % 3 == 0 for x in tasks["trace_id"]):
            raise ConnectionError("the judge does not answer")
        return E.rule_judge(tasks)
    return judge


@register("resumed_scoring", _TR + "SELECT trace_id, scorer, guideline_no, value, rationale FROM fb")
def q_resumed_scoring(spark, sf_dir):
    """Two scoring runs over one written log: the first one's judge fails for
    some traces, which become error rows; the second judges only those.  Every
    task has one answer."""
    import uuid
    log = f"{ensure_checkpoint_dir(spark).rstrip('/')}/carelake_feedback/{uuid.uuid4().hex}"
    tr = E.traces(spark, sf_dir)
    E.score_logged(tr, log, make_judge=_unsteady_judge, attempts=1, backoff=0)
    return E.score_logged(tr, log).where(F.col("error").isNull()).drop("error")


@register("live_scoring", _TR + "SELECT trace_id, scorer, guideline_no, value, rationale FROM fb")
def q_live_scoring(spark, sf_dir):
    """Stream the conversation files through the scorer (available-now trigger,
    questions kept in state) and read the written feedback back."""
    import uuid
    root = ensure_checkpoint_dir(spark).rstrip("/") + "/carelake_live/" + \
        hashlib.sha1(sf_dir.encode()).hexdigest()[:10] + "/" + uuid.uuid4().hex[:8]
    schema = load(spark, sf_dir, "conversations").schema
    q = start_live_scoring(spark, sf_dir, None, f"{root}/feedback", f"{root}/checkpoint", schema=schema)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{root}/feedback").select("trace_id", "scorer", "guideline_no", "value",
                                                         "rationale")
