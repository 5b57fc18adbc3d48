"""Property tests: the response rules never fail on arbitrary JSON, and the
simple cases give what the rules promise."""
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from carelake.operators import responses as R

SCALARS = st.one_of(st.none(), st.booleans(), st.integers(-5, 5), st.text(max_size=5))
JSON = st.recursive(SCALARS, lambda inner: st.one_of(
    st.lists(inner, max_size=4),
    st.dictionaries(st.sampled_from(["output", "content", "type", "role", "text", "choices", "message", "name",
                                     "id", "arguments"]), inner, max_size=4)), max_leaves=12)


def _run(spark, bodies):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "request_id long, body string")
    msgs = {r.request_id: r.message for r in R.messages(df, ["request_id"]).collect()}
    steps = R.extract_steps(df, ["request_id"]).collect()
    appr = R.approval_requests(df, ["request_id"]).collect()
    return msgs, steps, appr


@settings(max_examples=8, deadline=None)
@given(bodies=st.lists(JSON, min_size=1, max_size=25))
def test_rules_never_fail(spark, bodies):
    msgs, steps, appr = _run(spark, [json.dumps(b) for b in bodies])
    assert len(msgs) == len(bodies)
    for s in steps:
        assert s.step_type in ("tool_call", "tool_result", "thinking")


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.text(min_size=1, max_size=20), min_size=1, max_size=10),
       junk=st.lists(st.sampled_from([{"type": "function_call"}, {"content": ""}, "x", 3, None]), max_size=3))
def test_string_and_last_content(spark, texts, junk):
    bodies = [json.dumps({"output": t}) for t in texts]
    bodies += [json.dumps({"output": [{"content": "first"}, {"content": t}] + junk}) for t in texts]
    msgs, _, _ = _run(spark, bodies)
    n = len(texts)
    assert [msgs[i] for i in range(n)] == texts
    assert [msgs[n + i] for i in range(n)] == texts
