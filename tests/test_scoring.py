"""Judging through a client that fails, and the written log of feedback."""
import collections
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from carelake.operators import evaluation as E

from .conftest import SF_SMALL

TRACES = "trace_id string, conv_id long, turn long, inputs string, outputs string"


def counting(folder, fails=lambda tasks: False):
    """Makes judges that note every made client and every call in ``folder``."""
    def make():
        import uuid
        open(f"{folder}/client-{uuid.uuid4().hex}", "w").close()

        def judge(tasks):
            with open(f"{folder}/call-{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(tasks["trace_id"] + "/" + tasks["scorer"] + "/" + tasks["guideline_no"].astype(str)))
            if fails(tasks):
                raise ConnectionError("down")
            return E.rule_judge(tasks)
        return judge
    return make


def calls(folder):
    return [open(f"{folder}/{x}").read().split("\n") for x in os.listdir(folder) if x.startswith("call-")]


def clients(folder):
    return sum(x.startswith("client-") for x in os.listdir(folder))


def fresh():
    return tempfile.mkdtemp(prefix="carelake-judge-", dir="/tmp")


def some(spark, n=40):
    return spark.createDataFrame([(f"{i}:1", i, 1, "q" * (i % 5), "a" * i) for i in range(n)], TRACES)


def keyed(df):
    return collections.Counter((r.trace_id, r.scorer, r.guideline_no, r.value) for r in df.collect())


def test_one_client_a_task_and_bounded_calls(spark):
    d, tr = fresh(), some(spark).repartition(3, "trace_id")
    got = keyed(E.score_traces(tr, make_judge=counting(d), call_rows=7))
    assert got == keyed(E.score(E.expand_tasks(tr)))
    assert clients(d) <= 3 and max(map(len, calls(d))) == 7


def test_a_call_is_bounded_by_characters(spark):
    t = pd.DataFrame({"inputs": ["x" * 10] * 5, "outputs": ["", None, "y" * 95, "", ""], "prompt": [None] * 5})
    assert [len(c) for c in E._calls(t, 10, 40)] == [2, 1, 2]
    assert [len(c) for c in E._calls(t, 2, 1000)] == [2, 2, 1]
    assert list(E._calls(t.iloc[:0], 2, 1000)) == []


def test_failing_tasks_become_error_rows_and_the_others_are_judged(spark):
    d, tr = fresh(), some(spark)
    bad = {"3:1", "17:1"}
    fb = E.score_traces(tr, make_judge=counting(d, lambda t: t["trace_id"].isin(bad).any()), attempts=2, backoff=0).cache()
    wrong = fb.where("error IS NOT NULL")
    assert {r.trace_id for r in wrong.collect()} == bad and wrong.count() == 18
    assert {(r.value, r.error) for r in wrong.collect()} == {(None, "ConnectionError: down")}
    assert keyed(fb.where("error IS NULL")) == keyed(E.score(E.expand_tasks(tr.where(~F.col("trace_id").isin(*bad)))))


def test_a_call_that_fails_once_is_repeated(spark):
    d = fresh()
    tr = some(spark, 10).coalesce(1)
    fb = E.score_traces(tr, make_judge=counting(d, lambda t: len(calls(d)) == 1), attempts=3, backoff=0.01).collect()
    assert len(fb) == 90 and all(r.error is None for r in fb) and len(calls(d)) == 2


def test_wrong_number_of_answers_is_a_failure(spark):
    fb = E.score_traces(some(spark, 2), lambda t: E.rule_judge(t).iloc[1:], attempts=1).collect()
    assert len(fb) == 18 and all("0 answers to 1 tasks" in r.error for r in fb)


@pytest.mark.parametrize("slices", [1, 3])
def test_log_gives_every_task_once_after_recovery(spark, slices):
    d, log, tr = fresh(), fresh() + "/log", some(spark)
    bad = {"3:1", "17:1"}
    first = E.score_logged(tr, log, make_judge=counting(d, lambda t: t["trace_id"].isin(bad).any()), attempts=1, backoff=0, slices=slices)
    assert first.where("error IS NOT NULL").count() == 18 and first.where("error IS NULL").count() == 40 * 9 - 18
    d = fresh()
    second = E.score_logged(tr, log, make_judge=counting(d), slices=slices)
    assert keyed(second) == keyed(E.score(E.expand_tasks(tr))) and second.where("error IS NOT NULL").count() == 0
    assert {x.split("/")[0] for c in calls(d) for x in c} == bad  # nothing else was asked again
    d = fresh()
    again = E.score_logged(tr.unionByName(some(spark, 43).where("conv_id >= 40")), log, make_judge=counting(d), slices=slices)
    assert again.count() == 43 * 9 and {x.split("/")[0] for c in calls(d) for x in c} == {"40:1", "41:1", "42:1"}
    only = E.score_logged(some(spark, 2), log, make_judge=counting(fresh()), slices=slices)
    assert keyed(only) == keyed(E.score(E.expand_tasks(some(spark, 2))))


def test_a_run_that_died_is_not_in_the_log(spark):
    log, tr = fresh() + "/log", some(spark, 5)
    E.score_logged(tr.where("conv_id < 2"), log)
    E.score_logged(tr.where("conv_id >= 2"), log)
    runs = sorted(x for x in os.listdir(log) if x.startswith("run="))
    os.rename(f"{log}/{runs[0]}/_SUCCESS", f"{log}/{runs[0]}/_lost")
    d = fresh()
    assert keyed(E.score_logged(tr, log, make_judge=counting(d))) == keyed(E.score(E.expand_tasks(tr)))
    assert len({x.split("/")[0] for c in calls(d) for x in c}) in (2, 3)


def test_resumed_query_leaves_only_failing_traces_to_the_second_run(spark):
    from carelake.plans import evaluation as P
    tr = E.traces(spark, SF_SMALL)
    fb = E.score_traces(tr, make_judge=P._unsteady_judge, attempts=1, backoff=0)
    n = fb.where("error IS NOT NULL").count()
    assert 0 < n < fb.count()
