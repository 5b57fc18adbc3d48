"""Epsilon grid join and exact top-k, against brute force."""
import collections
import subprocess
import sys

import numpy as np
import pytest

from carelake.llm import epsgrid, queries, topk

SCHEMA = "vec_id long, embedding array<float>, label int, v string, rows string, node string, score string"


def frame(llm, rows):
    return llm.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def messy():
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(8, 16))
    out = [(i, (centers[i % 8] + rng.normal(size=16) * 0.18).astype(np.float32).tolist(), i % 3) for i in range(240)]
    out += [(1000 + i, out[5][1], 2) for i in range(30)] + [(2000, [2 * x for x in out[5][1]], 2)]
    nan, inf = float("nan"), float("inf")
    out += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [nan] * 16, 1), (3003, [1.0, None], 1), (3004, [inf] * 16, 1),
            (3005, [], 1), (3006, out[0][1], None), (None, out[0][1], 0), (20, out[20][1], 2), (20, out[20][1], 2),
            (3010, [1.0, 2.0], 1), (3011, [1.0, 2.0, 0.0], 1)]
    return out


def fine(x):
    return x is not None and all(c is not None and np.isfinite(c) for c in x)


@pytest.mark.parametrize("block,leaf", [(512, 64), (8, 3)])
def test_near_vectors(llm, monkeypatch, block, leaf):
    monkeypatch.setattr(epsgrid, "BLOCK", block)
    monkeypatch.setattr(epsgrid, "LEAF", leaf)
    rows = messy()
    got = epsgrid.near_vectors(frame(llm, rows)).collect()
    ok = [i for i, r in enumerate(rows) if fine(r[1]) and r[2] is not None and any(r[1])]
    x = np.zeros((len(rows), 16))
    for i in ok:
        x[i, :len(rows[i][1])] = rows[i][1]
    links = collections.defaultdict(set)
    for i in ok:
        for j in ok:
            if i != j and rows[i][2] == rows[j][2] and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= 0.93:
                links[i].add(j)
    want = collections.Counter()
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        c = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        want[r[0], len(links[i]), c, r[0] == c] += 1
    assert sum(map(len, links.values())) > 1000
    assert collections.Counter(map(tuple, got)) == want


def test_near_vectors_empty(llm):
    assert epsgrid.near_vectors(frame(llm, [])).count() == 0
    one = epsgrid.near_vectors(frame(llm, [(1, None, 1)])).collect()
    assert [tuple(r) for r in one] == [(1, 0, 1, True)]


@pytest.mark.parametrize("blocks", [(16384, 1024), (37, 2)])
def test_top_k(llm, blocks):
    rows = messy()
    df = topk.scaled(frame(llm, rows))
    from pyspark.sql import functions as F
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, 20, *blocks).collect()
    v = {i: [int(np.floor(64 * float(c))) for c in r[1]] for i, r in enumerate(rows) if fine(r[1])}
    want = collections.Counter()
    for i in v:
        if rows[i][0] is None or rows[i][0] % 20:
            continue
        cand = sorted((-sum(a * b for a, b in zip(v[i], v[j])), rows[j][0] is None, rows[j][0] or 0) for j in v if j != i)[:20]
        for k, (s, null, d) in enumerate(cand):
            want[rows[i][0], k + 1, None if null else d, -s] += 1
    assert collections.Counter(map(tuple, got)) == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0, 20).count() == 0


def test_large_components_do_not_wrap(llm):
    from pyspark.sql import functions as F
    df = topk.scaled(frame(llm, [(0, [3e6, 1.0], 1), (1, [3e6, -1.0], 1)]))
    assert [tuple(r) for r in topk.top_k(df, F.col("vec_id") == 0, 20).collect()] == [(0, 1, 1, 192_000_000 ** 2 - 64 * 64)]


def test_queries(llm, sf):
    d = sf(embeddings=frame(llm, messy()))
    assert queries.QUERIES["op4_epsilon_grid_join"](llm, d).columns == ["vec_id", "n_links", "component_id", "kept"]
    assert queries.QUERIES["op10_exact_top_k"](llm, d).columns == ["query_id", "rank", "vec_id", "score"]


@pytest.mark.parametrize("module", ["topk", "repeats", "epsgrid"])
def test_workers_need_no_other_import(module):
    """A worker that has loaded nothing else (no pandas) has pyarrow.compute."""
    code = f"import pyarrow as pa\nfrom carelake.llm import {module}\nassert hasattr(pa, 'compute')"
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
