"""Live scoring over a stream equals the batch result."""
import tempfile

from pyspark.sql import functions as F

from carelake.operators import evaluation as E
from carelake.sources.tables import load
from carelake.streaming.live_scoring import start_live_scoring

from .conftest import SF_SMALL


def test_stream_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="carelake-live-", dir="/tmp")
    hist = load(spark, SF_SMALL, "conversations")
    q = start_live_scoring(spark, SF_SMALL, hist, f"{root}/fb", f"{root}/ck", max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    streamed = spark.read.parquet(f"{root}/fb").select("trace_id", "scorer", "guideline_no", "value")
    batch = E.score(E.expand_tasks(E.traces(spark, SF_SMALL))).select("trace_id", "scorer", "guideline_no",
                                                                       "value")
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_replay_guard_drops_replayed_file(spark):
    import shutil
    src = tempfile.mkdtemp(prefix="carelake-src-", dir="/tmp")
    shutil.copy(f"{SF_SMALL}/conversations.parquet", f"{src}/conversations.parquet")
    shutil.copy(f"{SF_SMALL}/conversations.parquet", f"{src}/conversations_replay.parquet")
    hist = load(spark, SF_SMALL, "conversations")
    out = {}
    for guard in (None, "1 hour"):
        root = tempfile.mkdtemp(prefix="carelake-live-", dir="/tmp")
        q = start_live_scoring(spark, src, hist, f"{root}/fb", f"{root}/ck", file_name="conversations*.parquet",
                               max_files_per_trigger=1, replay_guard=guard)
        q.awaitTermination()
        assert q.exception() is None
        out[guard] = spark.read.parquet(f"{root}/fb").count()
    batch = E.score(E.expand_tasks(E.traces(spark, SF_SMALL))).count()
    assert out[None] == 2 * batch
    assert out["1 hour"] == batch


def test_previous_turns_from_history_when_not_in_batch(spark):
    """User turns arrive in one file, answers in a later one: every previous
    turn must come from history, and the result still equals the batch one."""
    from pyspark.sql import functions as F
    src = tempfile.mkdtemp(prefix="carelake-split-", dir="/tmp")
    conv = load(spark, SF_SMALL, "conversations")
    conv.where(F.col("role") != "assistant").coalesce(1).write.parquet(f"{src}/part_a")
    conv.where(F.col("role") == "assistant").coalesce(1).write.parquet(f"{src}/part_b")
    import glob
    import shutil
    flat = tempfile.mkdtemp(prefix="carelake-flat-", dir="/tmp")
    shutil.copy(glob.glob(f"{src}/part_a/*.parquet")[0], f"{flat}/conversations_a.parquet")
    shutil.copy(glob.glob(f"{src}/part_b/*.parquet")[0], f"{flat}/conversations_b.parquet")
    root = tempfile.mkdtemp(prefix="carelake-live-", dir="/tmp")
    q = start_live_scoring(spark, flat, conv, f"{root}/fb", f"{root}/ck", file_name="conversations_*.parquet",
                           max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    streamed = spark.read.parquet(f"{root}/fb").select("trace_id", "scorer", "guideline_no", "value")
    batch = E.score(E.expand_tasks(E.traces(spark, SF_SMALL))).select("trace_id", "scorer", "guideline_no", "value")
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


def test_traces_incremental_equals_full_join(spark):
    from pyspark.sql import functions as F
    conv = load(spark, SF_SMALL, "conversations")
    half = conv.where(F.col("conv_id") % 2 == 0)
    a = sorted(tuple(r) for r in E.traces_incremental(half, conv).collect())
    b = sorted(tuple(r) for r in E.traces_from(half, conv).collect())
    assert a == b and len(a) > 0


# ------------------------------------------------------------ pairing state
TURNS = "conv_id long, turn long, role string, text string"


class Source:
    """A folder of arriving files and the stream that reads it, one file a batch."""

    def __init__(self, spark, **options):
        self.spark, self.options, self.n = spark, options, 0
        self.root = tempfile.mkdtemp(prefix="carelake-live-", dir="/tmp")

    def arrive(self, df):
        import glob
        import shutil
        self.n += 1
        df.coalesce(1).write.parquet(f"{self.root}/made/{self.n}")
        import os
        os.makedirs(f"{self.root}/src", exist_ok=True)
        shutil.copy(glob.glob(f"{self.root}/made/{self.n}/*.parquet")[0], f"{self.root}/src/turns_{self.n:03d}.parquet")

    def run(self):
        q = start_live_scoring(self.spark, f"{self.root}/src", None, f"{self.root}/fb", f"{self.root}/ck",
                               file_name="turns_*.parquet", max_files_per_trigger=1, schema=TURNS, clock_slack="0 seconds",
                               **self.options)
        q.awaitTermination()
        assert q.exception() is None
        return q

    def feedback(self):
        return self.spark.read.parquet(f"{self.root}/fb").drop("epoch")


def same(spark, got, turns):
    want = E.score_traces(E.traces_from(turns, turns))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_questions_of_an_earlier_batch_and_of_an_earlier_run(spark):
    """Without history: first all users, then, after a restart, all others."""
    conv = load(spark, SF_SMALL, "conversations")
    s = Source(spark)
    s.arrive(conv.where("role <> 'assistant' AND conv_id % 2 = 0"))
    s.arrive(conv.where("role <> 'assistant' AND conv_id % 2 = 1"))
    s.run()
    assert s.feedback().count() == 0
    s.arrive(conv.where("role = 'assistant'"))
    s.run()
    same(spark, s.feedback(), conv)


def test_only_a_user_turn_is_a_question(spark):
    turns = spark.createDataFrame([
        (1, 0, "system", "be kind"), (1, 1, "assistant", "hello there"), (2, 0, "user", "q" * 7), (2, 1, "system", "note"),
        (2, 2, "assistant", "a" * 150), (3, 4, "user", None), (3, 5, "assistant", "to nothing"), (None, 1, "user", "lost"),
        (None, 2, "assistant", "no conversation"), (4, None, "assistant", "no turn"), (5, 0, "user", "qq"),
        (5, 1, "assistant", "x" * 310)], TURNS)
    s = Source(spark)
    s.arrive(turns)
    s.run()
    same(spark, s.feedback(), turns)
    inputs = {r.trace_id: r.inputs for r in E.traces_from(turns, turns).collect()}
    assert inputs["1:1"] == inputs["2:2"] == inputs["3:5"] == "" and inputs["5:1"] == "qq"


def test_an_answer_waits_for_a_late_question(spark):
    conv = load(spark, SF_SMALL, "conversations").where("role IN ('user', 'assistant')")
    both = conv.alias("a").where("role = 'assistant'").join(
        conv.alias("q").where("role = 'user'"), F.expr("a.conv_id = q.conv_id AND a.turn = q.turn + 1"))
    conv = both.select("a.*").union(both.select("q.*"))
    s = Source(spark, answer_wait="1 hour")
    s.arrive(conv.where("role = 'assistant'"))
    s.run()
    assert s.feedback().count() == 0
    s.arrive(conv.where("role = 'user'"))
    s.run()
    same(spark, s.feedback(), conv)


def test_waiting_and_keeping_end(spark):
    import time
    s = Source(spark, answer_wait="1 second", question_keep="1 second")
    s.arrive(spark.createDataFrame([(1, 1, "assistant", "early answer"), (2, 0, "user", "asked")], TURNS))
    s.run()
    assert s.feedback().count() == 0
    time.sleep(1.5)
    s.arrive(spark.createDataFrame([(3, 0, "user", "something else")], TURNS))
    q = s.run()
    assert {r.trace_id for r in s.feedback().collect()} == {"1:1"}  # judged without its question
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert held[-1] == 1  # the first question's time is over as well


def test_an_answer_is_looked_up_in_history_when_state_has_no_question(spark):
    past = spark.createDataFrame([(1, 0, "user", "before the stream"), (2, 0, "system", "not a question")], TURNS)
    now = spark.createDataFrame([(1, 1, "assistant", "yes"), (2, 1, "assistant", "no")], TURNS)
    paired = now.select("conv_id", "turn", F.lit(None).cast("string").alias("inputs"), F.col("text").alias("outputs"))
    got = {r.trace_id: r.inputs for r in E.as_traces(E.with_history(paired, past)).collect()}
    assert got == {"1:1": "before the stream", "2:1": ""}
