"""Sharding, mixing, SimHash, substrings, passages, BPE: against brute force."""
import base64
import collections
import hashlib
import random
import re
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from carelake.llm import bpe, common, debruijn, mixing, queries, repeats, sharding, simhash, suffixes

from .conftest import DOCS, MESSY, rows

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ROOT = Path(__file__).resolve().parents[2]
TEXTS = [(r[0], r[1]) for r in MESSY]


def run(llm, sf, name, docs, **more):
    return [r.asDict() for r in queries.QUERIES[name](llm, sf(documents=docs, **more)).collect()]


def tables(llm, sf, name, texts):
    return run(llm, sf, name, llm.createDataFrame(rows(*texts), DOCS))


# ------------------------------------------------------------------ 1
def test_ring_law_slots_and_values(llm, sf, messy):
    got = run(llm, sf, "op1_ring_shards", messy)
    size = collections.Counter(r["shard"] for r in got)
    assert len(got) == len(MESSY) and max(size.values()) - min(size.get(s, 0) for s in range(24)) <= 1
    for s in size:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(size[s]))
    want = collections.Counter((i, len((x or "").encode()) + 8, None if x is None else zlib.crc32(x.encode())) for i, x in TEXTS)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


def test_ring_hot_key_and_empty(llm, sf, empty):
    docs = llm.createDataFrame(rows(*[(5, "t")] * 500, *[(i, str(i)) for i in range(700)]), DOCS)
    out = sharding.ring_shards(docs.select("doc_id"), ["doc_id"], [], 24).collect()
    size = collections.Counter(r["shard"] for r in out)
    assert len(out) == 1200 and set(size.values()) == {50} and len({(r["shard"], r["slot"]) for r in out}) == 1200
    assert sharding.ring_shards(empty.select("doc_id"), ["doc_id"], [], 24).count() == 0


def test_ring_moves_only_overflow():
    cells, counts = np.arange(0, sharding.CELLS, 7), np.full(len(range(0, sharding.CELLS, 7)), 3)
    plan = sharding.assign(cells, counts, 24, 128)
    at, owner = sharding.ring(24, 128)
    home = owner[np.searchsorted(at, plan["cell"].to_numpy()) % len(at)]
    moved = (plan["hi"] - plan["lo"])[home != plan["shard"]].sum()
    load = np.bincount(home, (plan["hi"] - plan["lo"]).to_numpy(), minlength=24)
    assert moved == np.maximum(load - counts.sum() / 24, 0).round().sum() or moved < counts.sum() * 0.12


# ------------------------------------------------------------------ 7
def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (i % 3) + 1 for i, s in enumerate(names)}
    free, target, left = set(names), {}, float(sum(sizes.values()))
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if 3 * sizes[s] < level * w[s]}
        if not full:
            target |= {s: level * w[s] for s in free}
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= full
    return target


def test_mix_targets_and_budgets(llm, sf):
    rng = random.Random(3)
    texts = [(i, " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(0, 60))), rng.choice(["b", "a", "c", "é", None, "", "a"]))
             for i in range(400)] + [(900 + i, "one two three", "tiny") for i in range(2)]
    got = tables(llm, sf, "op7_source_mix", texts)
    source = {i: s for i, _, s in texts}
    sizes = collections.Counter()
    for i, x, s in texts:
        sizes[s] += len(x.split())
    want, taken = brute_targets(sizes), collections.Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] >= r["size"] * (int(want[s]) // max(sizes[s], 1))  # complete epochs come first
        taken[s] += r["taken"]
    assert len(got) == len(texts) and all(taken[s] == int(want[s] + 1e-6) or abs(taken[s] - want[s]) < 1 for s in want)


def test_mix_messy_and_documents(llm, sf, messy, empty):
    got = run(llm, sf, "op7_source_mix", messy)
    assert len(got) == len(MESSY) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    out = mixing.mix_documents(messy)
    assert out.columns == messy.columns and out.count() > 0
    assert mixing.mix_documents(empty).count() == 0 and mixing.mix_words(empty).count() == 0


def test_mix_hot_equal_rows(llm):
    docs = llm.createDataFrame(rows(*[(1, "a b c", "x")] * 300, *[(i, "d e", "y") for i in range(50)]), DOCS)
    got = mixing.mix_words(docs).collect()
    assert len(got) == 350
    by = {s: sum(r["taken"] for r in got if r["source_size"] == s) for s in (900, 100)}
    assert by == {900: 700, 100: 300}


def brute_mix(docs):
    """How often the mix takes each (doc_id, text, source) whole, equal rows together."""
    import math
    n, sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", x or "")) for _, x, _ in docs], collections.Counter()
    for (_, _, s), k in zip(docs, n):
        sizes[s] += k
    target, out = brute_targets(sizes), collections.Counter()
    for s in sizes:
        mine = []
        for (i, x, t), k in zip(docs, n):
            if t == s:
                u = (int(hashlib.md5(f"{'' if i is None else i}|{k}|{len(x or '')}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
                quality = 1 / (1 + abs(len(x or "") / k - 6)) if k else 1.0
                mine.append((math.log(-math.log(u) / quality), i is not None, i or 0, k, x or "", (i, x, t)))
        budget = int(math.floor(target[s]))
        epochs, left = budget // max(sizes[s], 1), budget % max(sizes[s], 1)
        for _, _, _, k, _, row in sorted(mine, key=lambda m: m[:5]):
            part = max(0, min(k, left))
            out[row] += epochs + int(part > 0 and part * 2 >= k)
            left -= k
    return +out


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_documents_brute(llm, seed):
    """Whole rows, a third of them equal in every column and in the bucket that the budget ends in."""
    rng = random.Random(seed)
    docs = [(i, " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(0, 40))), rng.choice(["a", "b", "c", None])) for i in range(200)]
    docs += [(7, "equal rows of six words here", rng.choice(["a", "b"]))] * 100 + [(None, None, "b"), (None, "x y", None)]
    df = llm.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    got = collections.Counter(map(tuple, mixing.mix_documents(df).collect()))
    assert got == brute_mix(docs)


# ------------------------------------------------------------------ 8
def brute_fp(x):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in x or ""))
    import xxhash
    sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(y.encode(), 42) for y in sh]
    return sum(1 << i for i in range(64) if sum(v >> i & 1 for v in h) * 2 > len(h))


def brute_components(n, linked):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def test_simhash_query(llm, sf):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(150)) for _ in range(6)]
    texts = [(r[0], r[1]) for r in MESSY]
    for i in range(60):
        w = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = "zz"
        texts.append((100 + i, " ".join(w)))
    got = tables(llm, sf, "op8_simhash_bk_trees", texts)
    fps = [brute_fp(x) for _, x in texts]
    comp = brute_components(len(texts), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    first = collections.defaultdict(list)
    for (i, _), c in zip(texts, comp):
        first[c] += [i] if i is not None else []
    want = collections.Counter((i, f"{f:016x}", min(first[c], default=None)) for (i, _), f, c in zip(texts, fps, comp))
    assert collections.Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


@pytest.mark.parametrize("shard", [2, 7, 1000])
def test_links_need_no_shard_size(llm, shard):
    rng = random.Random(shard)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(160):
        x = rng.choice(fps)
        for _ in range(rng.randint(1, 3)):
            x ^= 1 << rng.randrange(64)
        fps.append(x)
    fps = sorted(set(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = simhash.fingerprint_links(llm.createDataFrame([(x,) for x in signed], "fp long"), 2, shard).collect()
    for e in edges:
        assert e.a != e.b
    pos = {x: i for i, x in enumerate(signed)}
    found = {frozenset((pos[e.a], pos[e.b])) for e in edges}
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    want = brute_components(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    assert near and brute_components(len(fps), lambda i, j: frozenset((i, j)) in found) == want


def test_keep_one(llm, messy, empty):
    out = simhash.keep_one(messy)
    assert out.columns == messy.columns
    ids = [r.doc_id for r in out.collect()]
    comp = {r.component for r in simhash.simhash_components(messy).collect()}
    assert len(ids) == len(comp) and ids.count(7) <= 2
    assert simhash.keep_one(empty).count() == 0


# ------------------------------------------------------------------ 2 and 9
def passages(rng, n, unit):
    """Texts that share passages of many lengths, some inside themselves."""
    shared = [unit(rng, k) for k in (60, 199, 200, 201, 260, 700)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts += [unit(rng, rng.randint(0, 90)), rng.choice(shared)[rng.randint(0, 3):]]
        out.append("".join(parts))
    return out


def letters(rng, k):
    return "".join(rng.choice("abcé \n") for _ in range(k))


def brute_bytes(texts, least=200):
    raw = [(x or "").encode() for x in texts]
    n = collections.Counter(x[i:i + least] for x in raw for i in range(len(x) - least + 1))
    out = []
    for x in raw:
        gone = np.zeros(len(x) + 1, int)
        for i in range(len(x) - least + 1):
            if n[x[i:i + least]] > 1:
                gone[i] += 1
                gone[i + least] -= 1
        gone = np.cumsum(gone[:len(x)]) > 0
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(x), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(x, np.uint8)[~gone])).hexdigest()))
    return out


@pytest.mark.parametrize("seed,group", [(1, 512), (2, 1)])
def test_suffix_query(llm, sf, monkeypatch, seed, group):
    monkeypatch.setattr(suffixes, "GROUP", group)  # 1: every group is a crowded one
    rng = random.Random(seed)
    texts = [x for _, x in TEXTS if x is None or len(x) < 3000] + passages(rng, 50, letters) + ["ab" * 400, "a" * 1000, letters(rng, 199)]
    got = tables(llm, sf, "op2_suffix_array_dedup", texts)
    want = collections.Counter((i, *r) for i, r in enumerate(brute_bytes(texts)))
    assert sum(r[1] for r in brute_bytes(texts)) > 5000
    assert collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want


def test_suffix_long_and_empty(llm, sf, messy, empty):
    got = run(llm, sf, "op2_suffix_array_dedup", messy)
    assert len(got) == len(MESSY)
    by = {r["doc_id"]: r for r in got if r["doc_id"] in (0, 11, 12, 13)}
    assert by[11]["n_removed"] == by[11]["n_bytes"] and by[12]["n_removed"] == 30_000 and by[0]["n_removed"] == by[0]["n_bytes"]
    assert suffixes.cut_texts(repeats.keyed(empty)).count() == 0 and suffixes.dedup(empty).count() == 0


def test_suffix_strips(llm, monkeypatch):
    rng = random.Random(8)
    texts = [letters(rng, 9000), letters(rng, 500)]
    texts[1] += texts[0][3000:6000]
    monkeypatch.setattr(repeats, "STRIP", 700)  # a very long text is read in strips
    seen = {}
    for strip in (700, 1 << 18):
        monkeypatch.setattr(repeats, "STRIP", strip)
        t, e = suffixes.tokens([texts[0].encode()])
        powers, rows_ = repeats.Powers(), []
        for i in range(0, len(t) - 199, strip):
            piece = t[i:i + strip + 199]
            _, s, c, a, _ = repeats.segments(piece, np.array([len(piece)]), 200, 64, powers)
            rows_ += [(x + i + k, h) for x, n, h in zip(s, c, a) for k in range(n)]
        seen[strip] = rows_
    assert seen[700] == seen[1 << 18]  # every window, with the same anchor


def test_suffix_keeps_first(llm):
    rng = random.Random(4)
    p = letters(rng, 400)
    texts = [letters(rng, 50) + p + letters(rng, 50) for _ in range(6)] + ["unique " + letters(rng, 300)]
    docs = llm.createDataFrame(rows(*texts, (90, texts[6])), DOCS)
    out = {r.doc_id: r.text for r in suffixes.dedup(docs).collect()}
    assert suffixes.dedup(docs).columns == docs.columns
    assert sum(p in out[i] for i in range(6)) == 1 and sum(len(out[i].encode()) < 250 for i in range(6)) == 5
    assert out[6] == texts[6] and out[90] == ""  # of equal texts the first row stays


def brute_first(docs, least=200):
    """Rows (doc_id, text) after the later copies are gone, the first kept: texts in the order of their hash."""
    import xxhash

    def place(x):
        h = xxhash.xxh64_intdigest((x or "").encode(), 42)
        return h - (1 << 64) if h >> 63 else h
    seen, cut = set(), {}
    for x in sorted({x or "" for _, x in docs}, key=place):
        raw = x.encode()
        gone = np.zeros(len(raw) + 1, int)
        for i in range(len(raw) - least + 1):
            if raw[i:i + least] in seen:
                gone[i] += 1
                gone[i + least] -= 1
            seen.add(raw[i:i + least])
        left = bytes(np.frombuffer(raw, np.uint8)[np.cumsum(gone[:len(raw)]) == 0])
        cut[x] = left.decode("utf-8", "ignore")
    out, first = collections.Counter(), set()
    for i, x in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        x = x or ""
        out[i, "" if x in first and len(x.encode()) >= least else cut[x]] += 1
        first.add(x)
    return out


def test_suffix_dedup_repeated_rows(llm):
    """Rows equal in every column, equal texts without an id, a hot text: one stays whole."""
    rng = random.Random(6)
    texts = passages(rng, 30, letters)
    a, b, c = (letters(rng, k) for k in (400, 300, 150))
    docs = list(enumerate(texts)) + [(101, a)] * 2 + [(None, b)] * 60 + [(5, c), (5, c), (None, None), (None, None), (3, a)]
    df = llm.createDataFrame(docs, "doc_id long, text string").repartition(6)
    out = collections.Counter(map(tuple, suffixes.dedup(df).collect()))
    assert out == brute_first(docs)
    assert out[None, b] == 1 and out[None, ""] == 61 and out[3, a] == 1 and out[101, ""] == 2 and out[5, c] == 2


def test_previous_factor_is_exact():
    rng = np.random.default_rng(2)
    for _ in range(30):
        raw = rng.integers(0, 2, 120).astype(np.uint8).repeat(8)  # units of 8 bytes
        rank = suffixes.levels(raw)
        start = np.arange(0, len(raw) - 200)
        later = np.zeros(len(raw) + 128, np.int64)
        later[:len(raw)] = rank[128] + 1
        order = np.argsort(rank[128][start] * 10_000 + later[start + 128], kind="stable")
        sa = start[order]
        lcp = np.concatenate([[0], suffixes.common_prefix(rank, sa[:-1], sa[1:])])
        got = np.zeros(len(start), np.int64)
        got[order] = suffixes.previous_factor(sa, lcp, 8)
        b = raw.tobytes()
        for i in range(0, len(start), 17):
            best = max((next((k for k in range(0, 240, 8) if b[i + k:i + k + 8] != b[j + k:j + k + 8] or i + k + 8 > len(b)), 240)
                        for j in range(i)), default=0)
            assert min(int(got[i]), 128) == min(best, 128)


def words(rng, k):
    return "".join(rng.choice(["aa", "b", "cé", "Dd"]) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(k // 4))


def brute_words(texts, k=35):
    ws = [(x or "").encode().split() for x in texts]
    n = collections.Counter(tuple(w[i:i + k]) for w in ws for i in range(len(w) - k + 1))
    out = []
    for w in ws:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - k + 1):
            if n[tuple(w[i:i + k])] > 1:
                gone[i:i + k] = True
        out.append((len(w), int(gone.sum()), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("seed,group", [(1, 512), (2, 1)])
def test_passage_query(llm, sf, monkeypatch, seed, group):
    monkeypatch.setattr(debruijn, "GROUP", group)
    rng = random.Random(seed)
    texts = [x for _, x in TEXTS if x is None or len(x) < 3000] + passages(rng, 60, words) + ["it " * 300, "a b " * 90]
    got = tables(llm, sf, "op9_debruijn_passages", texts)
    want = brute_words(texts)
    assert sum(r[1] for r in want) > 1000
    assert collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == collections.Counter(
        (i, *r) for i, r in enumerate(want))


def test_passage_contents_are_taken_once(llm, sf, monkeypatch):
    """Without an anchor of too many segments, texts are cut into segments once."""
    calls, real = [], debruijn.contents
    monkeypatch.setattr(debruijn, "contents", lambda *a: calls.append(1) or real(*a))
    monkeypatch.setattr(debruijn, "crowded", lambda *a: pytest.fail("no anchor is crowded"))
    texts = passages(random.Random(3), 30, words)
    got = tables(llm, sf, "op9_debruijn_passages", texts)
    assert calls == [1] and sorted((r["doc_id"], r["n_removed"]) for r in got) == [(i, r[1]) for i, r in enumerate(brute_words(texts))]


@pytest.mark.parametrize("module,query,find", [(debruijn, "op9_debruijn_passages", words), (suffixes, "op2_suffix_array_dedup", letters)])
def test_crowded_anchors_take_few_texts_once_more(llm, sf, monkeypatch, module, query, find):
    """Only the texts that hold segments of crowded anchors are shuffled again, and once."""
    packed, real = llm.sparkContext.accumulator(0), repeats.packed

    def counted(docs):
        def count(batches):
            for b in batches:
                packed.add(b.num_rows)
                yield b
        return real(docs).mapInArrow(count, real(docs).schema)

    monkeypatch.setattr(repeats, "packed", counted)
    monkeypatch.setattr(module, "GROUP", 3)
    rng = random.Random(4)
    texts = passages(rng, 5, find) * 3 + [find(rng, 400) for _ in range(200)]
    got = tables(llm, sf, query, texts)
    brute = brute_words if module is debruijn else brute_bytes
    assert collections.Counter(r["kept_sha256"] for r in got) == collections.Counter(r[-1] for r in brute(texts))
    assert packed.value < 2.5 * len(texts)


@pytest.mark.parametrize("stage", [simhash.keep_one, suffixes.dedup, mixing.mix_documents])
def test_stages_make_few_files_of_many_partitions(llm, monkeypatch, stage):
    """What is cut and handed on has no more files than its text needs, however many partitions a shuffle has."""
    rng = random.Random(5)
    texts = [x + "." for x in passages(rng, 20, letters)] * 2 + [letters(rng, 300) for _ in range(20)]
    docs = llm.createDataFrame(rows(*texts), DOCS)
    want, sizes, real = collections.Counter(map(tuple, stage(docs).collect())), [], type(docs).checkpoint

    def checkpoint(df, eager=True):
        out = real(df, eager)
        sizes.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(type(docs), "checkpoint", checkpoint)
    changed = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: llm.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            llm.conf.set(k, v)
        out = stage(docs)
        assert sizes and max(sizes) <= common.FEWEST and out.rdd.getNumPartitions() <= common.FEWEST
        assert collections.Counter(map(tuple, out.collect())) == want
    finally:
        for k, v in before.items():
            llm.conf.set(k, v)


def test_files_follow_the_text(llm, empty, monkeypatch):
    assert common.files_for(empty) == common.FEWEST
    monkeypatch.setattr(common, "FILE_BYTES", 10)
    assert common.files_for(llm.createDataFrame([(1, "é" * 300), (2, None)], "doc_id long, text string")) == 60


def test_passage_paths_are_contracted_by_text(llm, monkeypatch):
    """Long paths do not need a round for each doubling of their length."""
    seen, real = [], debruijn.components
    monkeypatch.setattr(debruijn, "components", lambda e: real(seen.append(e) or e, max_rounds=2))
    pieces = [(p * 10_000 + i, p * 10_000 + i, p * 10_000 + i + 1, p) for p in range(1, 8) for i in range(700)]
    got = debruijn.paths(llm.createDataFrame(pieces, "piece long, u long, v long, home long")).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter((x, h * 10_000) for x, _, _, h in pieces)


def test_removed_words_and_spans():
    rng = random.Random(4)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("pieces", pa.list_(pa.struct(
        [("rel", pa.int32()), ("len", pa.int32()), ("path", pa.int64())])))]))
    size = np.array([rng.choice([0, 3, 40, 90]) for _ in range(60)])
    found = [None if n < 40 else [
        {"start": rng.randrange(n), "pieces": [{"rel": rng.randrange(4), "len": rng.randint(1, 9), "path": rng.randint(-2, 2)}
                                               for _ in range(rng.randrange(4))]} for _ in range(rng.randrange(6))] for n in size]
    gone, spans = debruijn._removed(pa.array([None, *found], kind).slice(1), 5, size)
    at = 0
    for n, f, count in zip(size, found, spans):
        want, runs, merged = np.zeros(n + 1, bool), 0, []
        for path, a, b in sorted((p["path"], o["start"] + p["rel"], o["start"] + p["rel"] + p["len"]) for o in f or () for p in o["pieces"]):
            if merged and merged[-1][0] == path and a <= merged[-1][2]:
                merged[-1][2] = max(b, merged[-1][2])
            else:
                merged.append([path, a, b])
        for _, a, b in merged:
            if a + 5 <= b + 4 <= n:
                want[a:b + 4], runs = True, runs + 1
        assert gone[at:at + n + 1].tolist() == want.tolist() and count == runs
        at += n + 1


def test_passage_messy(llm, sf, messy, empty):
    assert len(run(llm, sf, "op9_debruijn_passages", messy)) == len(MESSY)
    assert debruijn.cut_passages(repeats.keyed(empty)).count() == 0


# ------------------------------------------------------------------ 5
@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_query(llm, sf, reference):
    rng = random.Random(6)
    texts = list(TEXTS) + [(100 + i, "".join(rng.choice("eta oins'\nÀß²½ǅ漢́\x1c\x85\xa0　٣0!") for _ in range(rng.randint(0, 400))))
                           for i in range(80)] + [(200, "<|endoftext|> it's WE'LL 'tis  \n\n x")]
    got = tables(llm, sf, "op5_byte_bpe", texts)
    want = collections.Counter()
    for i, x in texts:
        ids = reference.encode_ordinary(x or "")
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((x or "").encode()).hexdigest()] += 1
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want


def test_bpe_pieces_of_any_length(reference):
    rng = random.Random(7)
    pieces = [bytes(rng.choice(b"ethaoinsr\xc3\xa9 ") for _ in range(rng.choice([1, 3, 8, 47, 48, 49, 300]))) for _ in range(400)]
    pieces += [b"a" * 999, b"ab" * 200, b"-" * 77]
    n, ids = bpe.Vocabulary(PATH).encode(pieces)
    ends = np.cumsum(n)
    for p, k, e in zip(pieces, n, ends):
        assert ids[e - k:e].tolist() == reference._core_bpe.encode_single_piece(p)


def test_bpe_refuses_unknown_ids():
    with pytest.raises(ValueError):
        bpe.Vocabulary(PATH).decode(np.array([1]), np.array([999_999]))


def test_bpe_forgets_and_empty(llm, monkeypatch, empty):
    monkeypatch.setattr(bpe, "REMEMBERED", 2)
    docs = llm.createDataFrame(rows("a b c d", None, "a b"), DOCS)
    out = bpe.round_trip(docs, PATH).collect()
    assert [bytes(r.decoded).decode() for r in out] == ["a b c d", "", "a b"]
    assert bpe.round_trip(empty, PATH).count() == 0


@pytest.mark.parametrize("ids_given", [False, True])
def test_bpe_sends_ids_on_in_bounded_parts(reference, monkeypatch, ids_given):
    """A batch of long texts is decoded and sent on about PART ids at a time, no row lost."""
    monkeypatch.setattr(bpe, "PART", 50)
    texts = ["", None, *(f"word {i} " * (i % 9) for i in range(60)), "long " * 100, None, ""]
    ids = [reference.encode_ordinary(x or "") for x in texts]
    of = pa.array(ids, pa.list_(pa.int32())) if ids_given else pa.array(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), of], names=["doc_id", "ids" if ids_given else "text"])
    out = list(bpe.coder(PATH, None if ids_given else public_tokenizers.PATTERN, True)(iter([batch.slice(1)])))
    assert len(out) > 10 and all(b.num_rows == 1 or len(b.column(1).flatten()) <= 50 for b in out)
    got = [(r["doc_id"], r["ids"], r["decoded"].decode()) for b in out for r in b.to_pylist()]
    assert got == [(i, ids[i], texts[i] or "") for i in range(1, len(texts))]


def test_workers_do_not_load_pandas():
    """What a task imports of the operators leaves pandas out: each worker of an executor would hold its own."""
    code = "import sys; from carelake.llm import bpe, mixing, simhash, suffixes, toxicity; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, timeout=120).returncode == 0


def test_long_pieces_are_joined_from_blocks(reference):
    """Runs, words, letters and a piece of a megabyte: blocks joined at their seams equal the whole."""
    import random
    import time
    rnd = random.Random(8)
    voc = bpe.Vocabulary(PATH)

    def letters(n, kind="abcdefghijklmnopqrstuvwxyz"):
        return "".join(rnd.choice(kind) for _ in range(n))
    pieces = [c * n for c in "a =_\n\u4e2d" for n in (63, 64, 65, 127, 129, 1000, 4097)]
    pieces += [letters(n) for n in (64, 65, 129, 3000)] + [letters(n, "etaoinshr") for n in (65, 200, 5000)]
    pieces += [letters(n, [chr(0x4e00 + i) for i in range(900)]) for n in (22, 50, 999)]
    pieces += [("internationalization" * 60)[:n] for n in range(64, 260, 13)]
    pieces += ["b" + "a" * 5000, "\n" + " " * 30_001, "x-" + "=" * 9999, "a" * 63 + "b" * 777 + "ab" * 999]
    begin = time.time()
    pieces.append(letters(1_000_000, "etaoinshrdlucm"))
    n, ids = voc.encode([p.encode() for p in pieces])
    assert time.time() - begin < 120
    ends = np.cumsum(n)
    for p, e, k in zip(pieces, ends, n):
        assert ids[e - k:e].tolist() == reference._core_bpe.encode_single_piece(p.encode())
