"""Live trace scoring with Structured Streaming.

New conversation rows arrive as files.  An answer is paired with its question,
the user turn just before it, through keyed state: every question is kept for
``question_keep`` under the key of the exchange, ``(conv_id, turn)``, so an
answer that comes in a later micro-batch, or after a restart, still meets it.
The key is the pair and not the conversation, so a conversation with a third
of all rows is many small states.  A question is forgotten when its time is
over, so the state holds the questions of that time and does not grow with the
stream.  What happens to an answer whose question has not come is up to
``answer_wait``: without it the answer goes on at once; with it, it waits in
state for so long, for a question that arrives late.  Answers that go on
without a question look it up in the static ``history``, if there is one (turns
from before the stream), and are judged with an empty question otherwise.

Times are arrival times: each row has its batch's, and the watermark follows
``clock_slack`` behind (the clock may be set back by so much without a row being
late).  It moves with arriving batches, so what ends is seen by the next one.

Each micro-batch samples the paired traces, runs the judge and writes the
feedback of its epoch to a folder of its own, replacing it on a retry.
Offsets, commits and state live in the checkpoint folder.  The scoring
functions are the batch ones, so a stream over the same rows gives the batch
result.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.constants import JUDGE_SAMPLE_RATE
from ..operators import evaluation as E
from ..sources.tables import is_folder

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def milliseconds(text: str) -> int:
    """Milliseconds of a time like ``"10 minutes"``."""
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", text)
    if not m:
        raise ValueError(f"not a time: {text!r}")
    return int(m[1]) * _UNITS[m[2]] * 1000


def _pairing(keep: int, wait: int | None) -> Callable:
    """The state function of one exchange: (question, waiting answers)."""
    def pair(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        conv_id, asked_at = key
        question, waiting = state.get if state.exists else (None, [])
        waiting = list(waiting)

        def out(inputs: str | None) -> pd.DataFrame:
            return pd.DataFrame({"conv_id": [conv_id] * len(waiting), "turn": [asked_at + 1] * len(waiting),
                                 "inputs": pd.Series([inputs] * len(waiting), dtype=object),
                                 "outputs": pd.Series(waiting, dtype=object)})
        if state.hasTimedOut:
            state.remove()
            if waiting:
                yield out(None)
            return
        now = 0
        for pdf in rows:
            now = max(now, int(pdf["arrived"].max()))
            said = pdf["text"][pdf["role"] == "user"]
            if len(said):  # a turn that comes again replaces the question
                question = said.iloc[-1] or ""
            waiting += pdf["text"][pdf["role"] == "assistant"].tolist()
        if waiting and (question is not None or wait is None):
            yield out(question)
            waiting = []
        if question is None and not waiting:
            if state.exists:
                state.remove()
            return
        state.update((question, waiting))
        state.setTimeoutTimestamp(max(now + (keep if question is not None else wait), state.getCurrentWatermarkMs() + 1))
    return pair


def pair_questions(rows: DataFrame, question_keep: str = "1 day", answer_wait: str | None = None) -> DataFrame:
    """conv_id, turn, inputs (null: no question has come), outputs of the
    answers in the stream ``rows`` (conv_id, turn, role, text, and ``_arrived``
    with a watermark).  Rows without conversation or turn have no question and
    keep no state."""
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    asked_at = F.when(F.col("role") == "user", F.col("turn")).otherwise(F.col("turn") - 1)
    pairs = (rows.where(known & F.col("role").isin("user", "assistant"))
             .select("conv_id", asked_at.cast("long").alias("asked_at"), "role", "text", "_arrived",
                     F.unix_millis("_arrived").alias("arrived")).groupBy("conv_id", "asked_at"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    paired = pairs.applyInPandasWithState(
        _pairing(milliseconds(question_keep), None if answer_wait is None else milliseconds(answer_wait)),
        f"conv_id {types['conv_id']}, turn {types['turn']}, inputs string, outputs string",
        "question string, waiting array<string>", "append", GroupStateTimeout.EventTimeTimeout)
    alone = rows.where(~known & (F.col("role") == "assistant")).select(
        "conv_id", "turn", F.lit(None).cast("string").alias("inputs"), F.col("text").alias("outputs"))
    return paired.unionByName(alone)


def start_live_scoring(spark: SparkSession, source_dir: str, history: DataFrame | None, sink_dir: str,
                       checkpoint_dir: str, judge=E.rule_judge, rate: float = JUDGE_SAMPLE_RATE,
                       file_name: str = "conversations.parquet", available_now: bool = True,
                       max_files_per_trigger: int | None = None, replay_guard: str | None = None,
                       schema=None, question_keep: str = "1 day", answer_wait: str | None = None,
                       clock_slack: str = "1 minute", make_judge=None):
    """Start the scoring stream.

    ``schema`` is that of the arriving rows (default: ``history``'s).
    ``replay_guard`` (e.g. ``"1 hour"``) drops a conversation turn seen again
    within that much arrival time (a replayed file): a watermark on the
    arrival time bounds the de-duplication state, so it does not grow with
    the stream.  ``question_keep`` and ``answer_wait`` bound the pairing state
    (see the module's text)."""
    from ..plans.session import ship_package
    ship_package(spark)  # the state function runs in executor Python workers
    reader = spark.readStream.schema(schema or history.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_folder(spark, f"{source_dir}/{file_name}"):  # a table of part files
        rows = reader.parquet(f"{source_dir}/{file_name}")
    else:
        rows = reader.option("pathGlobFilter", file_name).parquet(source_dir)
    rows = rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", replay_guard or clock_slack)
    if replay_guard:
        rows = rows.dropDuplicatesWithinWatermark(["conv_id", "turn"])

    def score_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()  # read by the look-up of missing questions and by the judge
        try:
            tr = E.as_traces(batch if history is None else E.with_history(batch, history))
            fb = E.score_traces(tr, judge, rate, make_judge=make_judge)
            fb.write.mode("overwrite").parquet(f"{sink_dir}/epoch={epoch_id}")
        finally:
            batch.unpersist()

    w = (pair_questions(rows, question_keep, answer_wait).writeStream.foreachBatch(score_batch)
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
