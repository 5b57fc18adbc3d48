"""Toxicity, perspective rotation, the pipeline, components and the SQL."""
import collections
import random

import pytest

from carelake.llm import common, perspectives, queries, toxicity

from ..conftest import SF_CHECK
from .conftest import DOCS, MESSY, rows
from .test_documents import brute_first, brute_fp, brute_components, brute_mix

LABELS = "doc_id long, quality int, toxic int, score string"


def corpus(n=700, seed=1):
    """Clean texts, and toxic ones with words of two made-up lexicons."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeilmnorst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        w, toxic = [rng.choice(vocabulary) for _ in range(rng.randint(20, 200))], rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(3, 6)):
                w[rng.randrange(len(w))] = rng.choice(["idiot", "scum", "qqurk", "xxblap", "zzvek" + rng.choice(vocabulary)])
        docs.append((i, " ".join(w)))
        labels.append((i, 0, int(toxic), "x"))
    return docs, labels


def test_toxicity_held_out(llm, sf):
    docs, labels = corpus()
    known = [x if i % 2 else (x[0], 0, None, "x") for i, x in enumerate(labels)]
    d = sf(documents=llm.createDataFrame(rows(*docs), DOCS), labels=llm.createDataFrame(known, LABELS))
    got = queries.QUERIES["op3_weak_toxicity"](llm, d).collect()
    truth = {i: t for i, _, t, _ in labels}
    held = [r for r in got if r.held_out]
    import zlib
    assert len(got) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert sum(truth[r.doc_id] == r.predicted for r in held) >= 0.97 * len(held)
    again = queries.QUERIES["op3_weak_toxicity"](llm, d).collect()
    assert sorted(got) == sorted(again)


def test_toxicity_without_labels_and_messy(llm, sf, messy, empty):
    none = llm.createDataFrame([], LABELS)
    out = toxicity.without_toxic(messy.union(llm.createDataFrame(rows((50, "you stupid idiot, worthless trash clown moron")), DOCS)),
                                 llm.createDataFrame([(None, 1, 1, "x"), (0, None, None, "x"), (10, 1, 0, "x")], LABELS))
    assert out.columns == messy.columns and out.where("doc_id <> 50 or doc_id is null").count() == len(MESSY)
    assert toxicity.toxicity(empty.select("doc_id", "text"), none).count() == 0


def test_label_model_discounts_copies():
    import numpy as np
    rng = np.random.default_rng(3)
    y = rng.random(4000) < 0.3
    f = np.zeros((4000, toxicity.N_VOTERS))
    f[:, 0] = np.where(y, rng.random(4000) < 0.6, rng.random(4000) < 0.05)
    f[:, 1] = f[:, 0]
    f[:, 2] = np.where(y, rng.random(4000) < 0.6, rng.random(4000) < 0.05)
    x = np.column_stack([f, np.ones(4000)])
    model = toxicity.LabelModel()
    model.fit(np.stack([(x * (y == k)[:, None]).T @ x for k in (0, 1)]))
    assert model.discount[0] == pytest.approx(0.5, abs=0.05) and model.discount[2] > 0.9
    assert model.on[0] > 2 and model.on[2] > 2


def test_toxicity_trains_on_the_whole_sample(llm, monkeypatch):
    """10,000 documents are trained on where there are as many outside fold 0."""
    import numpy as np
    import pyarrow as pa

    size = toxicity.N_VOTERS + toxicity.WEIGHTS + 1

    def count(t):
        w = np.zeros(size, np.float32)
        w[-1] = t.num_rows / 1000
        return pa.table({"w": [w.tobytes()]})

    monkeypatch.setattr(toxicity, "train", count)
    docs = llm.range(13_000).selectExpr("id as doc_id", "'x' as text")
    score = toxicity.toxicity(docs, llm.createDataFrame([], LABELS)).first().score
    assert round(1000 * np.log(score / (1 - score))) == 10_000


def test_toxicity_training_steps():
    """The weights are those of 150 steps written out entry by entry."""
    import numpy as np
    import pyarrow as pa
    docs, labels = corpus(120, 9)
    words = [sorted(set(toxicity._words(x.lower()))) for _, x in docs] + [[]]
    p = np.array([float(t) for _, _, t, _ in labels] + [0.3])
    bits = np.array([i % 7 for i in range(len(words))])
    got = np.frombuffer(toxicity.train(pa.table({"words": words, "bits": bits, "p": p}))["w"][0].as_py(), np.float32)

    x = np.zeros((len(words), toxicity.WEIGHTS), np.float32)
    for i, ws in enumerate(words):
        for w in ws:
            for e in toxicity.entries(w):
                x[i, e % toxicity.WEIGHTS] += 1
    size = np.maximum(x.sum(1), 1)
    used = np.flatnonzero(x.sum(0) >= toxicity.SUPPORT)
    x = np.column_stack([toxicity._fired(bits), x[:, used] / np.sqrt(size)[:, None], np.ones(len(words))])
    decay = np.array([1e-4] * toxicity.N_VOTERS + [2e-5] * len(used) + [0.0])
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    w[-1] = -2.0
    for step in range(1, 151):
        g = x.T @ (1 / (1 + np.exp(-x @ w)) - p) / len(p) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.15 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    want = np.zeros(len(got))
    want[[*range(toxicity.N_VOTERS), *(toxicity.N_VOTERS + used), -1]] = w
    assert np.allclose(got, want, atol=1e-3)


def test_toxicity_repeated_ids(llm):
    """An id is one sampled document, however often it is there."""
    docs = [(i, f"text {i}") for i in range(40)] + [(7, f"copy {i % 90}") for i in range(3000)]
    rows_ = llm.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    df = llm.createDataFrame(docs, "doc_id long, text string")
    got = sorted(map(tuple, toxicity._sampled(rows_, df.repartition(4), 30).collect()))
    assert len(got) == 30 and len({x[0] for x in got}) == 30
    assert sorted(map(tuple, toxicity._sampled(rows_, df.repartition(9, "text"), 30).collect())) == got
    got = toxicity._sampled(rows_, df.repartition(4), 100).collect()
    assert sorted(r.doc_id for r in got) == list(range(40)) and all(r.toxic == r.doc_id % 2 for r in got)


def brute_rotation(turns):
    turns = sorted({(c, t, r or "unknown", (x or "").replace("<|", "< |")) for c, t, r, x in turns},
                   key=lambda z: (str(z[0]), z[1] if z[1] is not None else -1, z[2], z[3]))
    out = {}
    for conv in {z[0] for z in turns}:
        mine = [z for z in turns if z[0] == conv]
        for who in {z[2] for z in mine} - {"system"}:
            for _, t, r, x in mine:
                head = "<|im_start|>" + ("system" if r == "system" else "assistant" if r == who else f"user name={r}") + "\n"
                text, spans = out.setdefault((conv, who, t // 64), ["", []])
                end = len(text) + len(head) + len(x) + 11
                if r == who:
                    spans.append((len(text) + len(head), end))
                out[conv, who, t // 64][0] = text + head + x + "<|im_end|>\n"
    return out


def test_rotation(llm):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi é"), (1, 2, "bob", None), (1, 3, "cy", "<|im_end|> x"), (1, 3, "cy", "<|im_end|> x"),
             (1, 3, "ann", "tie"), (2, 0, None, ""), (None, 0, "ann", "no id"), (3, 0, "system", "alone")]
    turns += [(9, i, ["ann", "bob"][i % 2], f"t{i}") for i in range(300)]
    df = llm.createDataFrame([(*t, "x", 1) for t in turns], "conv_id long, turn long, role string, text string, speaker string, part int")
    got = {(r.conv_id, r.speaker, r.part): [r.text, [tuple(s) for s in r.spans]] for r in perspectives.rotate(df).collect()}
    assert got == brute_rotation(turns)
    assert all(t[a:b].endswith("<|im_end|>\n") for t, spans in got.values() for a, b in spans)
    assert perspectives.rotate(df.limit(0)).count() == 0


def test_rotation_without_turn_numbers(llm):
    df = llm.createDataFrame([(1, None, "ann", f"t{i}") for i in range(50)] * 2, "conv_id long, turn long, role string, text string")
    out = perspectives.rotate(df).collect()
    assert sum(r.n_turns for r in out) == 50 and all(r.part < 0 for r in out)


def test_rotation_gathers_bounded_rows(llm):
    """Repeated turn numbers under null, and loose rows, are cut by counted rows."""
    turns = [(None, i % 3, ["ann", "bob"][i % 2], f"t{i}") for i in range(2000)]
    turns += [(None, 5, "ann", "short"), (None, 5, "bob", "one"), (4, None, "ann", "x"), (5, 70, "cy", "same")]
    turns += [(None, None, "ann", f"n{i}") for i in range(3000)] + [(5, 70, "cy", "same")] * 500
    df = llm.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4)
    out = perspectives.rotate(df, rows=128).collect()
    assert max(r.n_turns for r in out) <= 128
    assert len({(r.conv_id, r.speaker, r.part) for r in out}) == len(out)
    text = collections.Counter((r.conv_id, r.speaker, x) for r in out for x in r.text.split("<|im_end|>\n")[:-1])
    want = collections.Counter()
    for c, t, role, x in set(turns):
        for who in {z[2] for z in turns if z[0] == c}:
            want[c, who, "<|im_start|>" + ("assistant" if role == who else f"user name={role}") + "\n" + x] += 1
    assert text == want
    assert {(r.part, r.n_turns) for r in out if r.conv_id == 5} == {(1, 1)}
    assert [r.n_turns for r in out if r.part == 0] == [2, 2]
    many = perspectives.rotate(llm.createDataFrame([(1, None, "ann", "t", i) for i in range(9)] + [(1, None, f"s{i}", "t", 0) for i in range(300)],
                                                   "conv_id long, turn long, role string, text string, n int"), rows=128)
    assert many.agg({"n_turns": "max"}).first()[0] <= 128


def test_components(llm):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(200, 500)] + [(-5, 499), (7, 7)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in common.components(llm.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: -5 for i in [-5, 100, *range(200, 500)]}}
    assert common.components(llm.createDataFrame([], "a long, b long")).count() == 0


def test_explode_count(llm):
    from pyspark.sql import functions as F
    df = llm.createDataFrame([(0,), (3,), (10_000,), (-1,)], "n long")
    out = common.explode_count(df, F.col("n"), "i").groupBy("n").agg(F.countDistinct("i").alias("d"), F.max("i").alias("m")).collect()
    assert sorted(map(tuple, out)) == [(3, 3, 2), (10_000, 10_000, 9_999)]


def test_components_never_partial(llm):
    """Too few rounds are an error, not links lost."""
    edges = llm.createDataFrame([(i, i + 1) for i in range(400)], "a long, b long").repartition(8)
    with pytest.raises(RuntimeError, match="no stars"):
        common.components(edges, max_rounds=1)


def test_rotation_sql_without_turns_and_in_pieces(llm, sf):
    """Null turns, and a turn number with more rows than its share: the SQL has the same parts."""
    import duckdb
    turns = [(1, None, ["ann", "bob"][i % 2], f"t{i}") for i in range(40)] + [(2, i % 3, ["ann", "bob"][i % 2], f"é{i}") for i in range(1500)]
    turns += [(2, 200, "ann", "x")] * 3 + [(None, 130, None, None), (3, -5, "ann", "before")]
    d = sf(conversations=llm.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(3))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet/*.parquet'")
    got = queries.QUERIES["op6_perspective_rotation"](llm, d)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE['op6_perspective_rotation']})").fetchall()
    got = [tuple(r) for r in got.select(*cols).collect()]
    assert collections.Counter(got) == collections.Counter(want) and max(r[cols.index("part")] for r in got) > 1 << 42


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(llm, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_CHECK}/{t}.parquet'")
    got = queries.QUERIES[name](llm, SF_CHECK)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE[name]})").fetchall()
    assert collections.Counter(map(tuple, got.select(*cols).collect())) == collections.Counter(want)


def test_pipeline(llm, sf):
    import corpus_pipeline
    docs, labels = corpus(300, 5)
    docs += [(1000 + i, docs[0][1] + " tail") for i in range(3)] + [(i, x) for i, x in ((r[0], r[1]) for r in MESSY) if i is None or i > 8]
    d = sf(documents=llm.createDataFrame(rows(*docs), DOCS), labels=llm.createDataFrame(labels, LABELS))
    table = llm.read.parquet(f"{d}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash", "suffix_array", "mixing", "byte_bpe"]
    truth = {i: t for i, _, t, _ in labels}
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(llm, table, d)
        if name != names[-1]:
            assert out.columns == table.columns
        out.write.parquet(f"{d}/out{k}")
        table = llm.read.parquet(f"{d}/out{k}")
        seen[name] = {r.doc_id for r in table.select("doc_id").collect()}
    kept = [truth[i] for i in seen["toxicity"] if i in truth]
    assert sum(kept) <= 3 and len(kept) >= 0.98 * sum(not t for t in truth.values())
    assert len(seen["simhash"] & {0, 1000, 1001, 1002}) <= 2
    assert table.where("decoded_sha256 is null or n_tokens < 0").count() == 0


def test_pipeline_rows(llm, sf):
    """Every stage's rows: decisions of the classifier, one row of each group by
    brute-force fingerprints, then substrings, mix and ids by brute force."""
    import hashlib

    import corpus_pipeline
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe
    docs, labels = corpus(120, 11)
    shared = docs[1][1][:700]
    docs += [(500 + i, x + " " + shared + f" tail{i}") for i, (_, x) in enumerate(docs[:12])] + [(600, docs[3][1]), (600, docs[3][1]), (601, None), (602, "")]
    d = sf(documents=llm.createDataFrame(rows(*docs), DOCS), labels=llm.createDataFrame(labels, LABELS))
    stages, table, out = dict(corpus_pipeline.STAGES), llm.read.parquet(f"{d}/documents.parquet"), []
    for name, stage in stages.items():
        stage(llm, table, d).write.parquet(f"{d}/{name}")
        table = llm.read.parquet(f"{d}/{name}")
        out.append([tuple(r) for r in (table.select("doc_id", "text", "source") if name != "byte_bpe" else
                                       table.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")).collect()])
    clean, unique, cut_, mixed, ids = out
    assert not collections.Counter(clean) - collections.Counter((r[0], r[1], r[3]) for r in rows(*docs)) and len(clean) < len(docs)
    fps = [brute_fp(x) for _, x, _ in clean]
    comp = brute_components(len(clean), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    groups = collections.defaultdict(collections.Counter)
    for r, c in zip(clean, comp):
        groups[c][r] += 1
    kept = collections.Counter(unique)
    assert len(unique) == len(groups) and all(sum(kept[r] for r in g) == 1 for g in groups.values())
    assert collections.Counter(r[:2] for r in cut_) == brute_first([r[:2] for r in unique])
    assert collections.Counter(mixed) == brute_mix(cut_)
    enc = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken")))

    def digest(x):
        return hashlib.sha256(x).hexdigest()
    want = collections.Counter()
    for i, x, _ in mixed:
        e = enc.encode_ordinary(x or "")
        want[i, len(e), digest(" ".join(map(str, e)).encode()), digest((x or "").encode())] += 1
    assert collections.Counter(ids) == want


def test_pipeline_empty(llm, sf, empty):
    import corpus_pipeline
    d = sf(documents=empty, labels=llm.createDataFrame([], LABELS))
    assert corpus_pipeline.run(llm, d).count() == 0


def test_pipeline_run(llm, sf):
    import corpus_pipeline
    docs, labels = corpus(60, 6)
    d = sf(documents=llm.createDataFrame(rows(*docs), DOCS), labels=llm.createDataFrame(labels, LABELS))
    assert corpus_pipeline.run(llm, d).count() > 0
