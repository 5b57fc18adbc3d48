"""Hard negatives, vector codes and licence scans, against brute force."""
import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import cellcodes, hardneg, licences, queries

from .conftest import MESSY
from .test_vectors import fine, frame, messy


def vectors(rows, factor):
    """(index of the row, integer vector) of the rows that count, padded to one length."""
    dims = max(len(r[1]) for r in rows if fine(r[1]))
    return {i: [int(np.floor(factor * float(c))) for c in r[1]] + [0] * (dims - len(r[1])) for i, r in enumerate(rows) if fine(r[1])}


def mined(rows):
    """The contract of op11, row by row."""
    v = {i: x for i, x in vectors(rows, 256).items() if rows[i][2] is not None}
    label = {i: rows[i][2] if rows[i][0] is None or rows[i][0] % 7 else (rows[i][2] + 1) % 10 for i in v}
    want = collections.Counter()
    for i in v:
        if rows[i][0] is None or rows[i][0] % 100:
            continue
        score = {j: sum(a * b for a, b in zip(v[i], v[j])) for j in v if j != i}
        best = sorted(score, key=lambda j: (-score[j], rows[j][0] is None, rows[j][0] or 0))
        for p in [j for j in best if label[j] == label[i]][:5]:
            fit = [j for j in best if label[j] != label[i] and 30 * score[p] <= 100 * score[j] <= 90 * score[p]][:10]
            for k, j in enumerate(fit):
                want[rows[i][0], rows[p][0], k + 1, rows[j][0], score[p], score[j]] += 1
    return want


def near(seed=3, n=500):
    """Rows with positive scores, ties, repeated rows and one vector that a third of them hold."""
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=6) + 0.8).round(1).tolist(), int(rng.integers(3))) for i in range(n)]
    rows += [(1000 + i, [0.5] * 6, 1) for i in range(n // 2)] + [rows[100]] * 2 + [rows[200]] * 3 + [rows[7]] * 12
    return rows + [(300, None, 1), (None, rows[100][1], rows[100][2]), (None, rows[100][1], 9), (400, [], 2), (1700, [0.1], None)]


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 18), (37 * 16, 3 * 16)])
@pytest.mark.parametrize("make", [messy, near])
def test_hard_negatives(llm, sf, monkeypatch, make, sizes):
    monkeypatch.setattr(hardneg, "SCORES", 100)
    monkeypatch.setattr(hardneg.hard_negatives, "__defaults__", (5, 10, (30, 90), *sizes))
    rows = make()
    got = queries.QUERIES["op11_hard_negatives"](llm, sf(embeddings=frame(llm, rows))).collect()
    want = mined(rows)
    assert collections.Counter(map(tuple, got)) == want
    assert len(want) > 20


def test_slots_share_no_row_and_lose_none(llm):
    """Overlapping windows with room for fewer rows than they hold."""
    rows = [(0, [10.0], 0), (100, [10.0], 0), *((1 + i, [10.0 - i], 0) for i in range(4)), *((200 + i, [i / 8], 1) for i in range(90))]
    df = llm.createDataFrame([(i, x, [int(256 * c) for c in v]) for i, v, x in rows], "vec_id long, label long, v array<long>")
    got = hardneg.hard_negatives(df, F.col("vec_id") == 0, positives=5, negatives=7).collect()
    s = {i: int(256 * v[0]) * 2560 for i, v, _ in rows}
    for p in (100, 1, 2, 3, 4):
        fit = [i for i, _, x in rows if x == 1 and 30 * s[p] <= 100 * s[i] <= 90 * s[p]]
        fit = sorted(fit, key=lambda i: (-s[i], i))[:7]
        assert [r.negative_id for r in sorted(got, key=lambda r: r["rank"]) if r.positive_id == p] == fit and len(fit) == 7


def test_hard_negatives_without_rows(llm):
    none = llm.createDataFrame([], "vec_id long, label long, v array<long>")
    assert hardneg.hard_negatives(none, F.col("vec_id") % 100 == 0).collect() == []
    one = llm.createDataFrame([(0, 1, [5]), (1, 2, [5])], "vec_id long, label long, v array<long>")
    assert hardneg.hard_negatives(one, F.col("vec_id") % 100 == 0).collect() == []


def coded(rows, parts=4, entries=256, rounds=4):
    """The contract of op12, every part with every entry."""
    v = vectors(rows, 1024)
    dims = max(map(len, v.values()))
    x = np.zeros((len(v), -(-dims // parts) * parts), np.int64)
    x[:, :dims] = list(v.values())
    x = x.reshape(len(v), parts, -1)
    ids = [rows[i][0] for i in v]
    first = {}
    for n, i in enumerate(ids):
        if i is not None and (i not in first or x[n].ravel().tolist() < x[first[i]].ravel().tolist()):
            first[i] = n
    books = x[[first[i] for i in sorted(first)[:entries]]].copy()
    for r in range(rounds + 1):
        d = ((x[:, None] - books[None]) ** 2).sum(-1)  # row, entry, part
        code, dist = d.argmin(1), d.min(1).sum(1)
        for p in range(parts if r < rounds else 0):
            for e in np.unique(code[:, p]):
                books[e, p] = x[code[:, p] == e, p].sum(0) // (code[:, p] == e).sum()
    label = collections.Counter()
    for n, i in enumerate(v):
        label[rows[i][2]] += int(dist[n])
    sha = hashlib.sha256(",".join(str(c) for c in books.transpose(1, 0, 2).ravel()).encode()).hexdigest()
    return collections.Counter((ids[n], "".join(f"{c:02x}" for c in code[n]), int(dist[n]), label[rows[i][2]], sha)
                               for n, i in enumerate(v))


@pytest.mark.parametrize("cells,at_once", [(1 << 16, 1 << 21), (40, 300)])
def test_codes(llm, sf, monkeypatch, cells, at_once):
    monkeypatch.setattr(cellcodes, "CELLS", cells)
    monkeypatch.setattr(cellcodes, "AT_ONCE", at_once)
    rows = messy() + [(50, [0.25] * 16, None), (51, [0.25] * 17, 4)]
    got = queries.QUERIES["op12_cell_codes"](llm, sf(embeddings=frame(llm, rows))).collect()
    assert collections.Counter(map(tuple, got)) == coded(rows)


def test_cells_leave_out_only_what_cannot_be_nearest():
    rng = np.random.default_rng(5)
    book = rng.integers(-2000, 2000, (64, 5))
    x = np.concatenate([book[rng.integers(64, size=500)] + rng.integers(-90, 90, (500, 5)), book, (book[:20] + book[20:40]) // 2])
    for width in (1, 7, 150, 900, 1 << 20):
        cells = cellcodes.Cells(book, width)
        d = ((x[:, None] - book) ** 2).sum(-1)
        for _ in range(2):
            code, dist = cells.nearest(x)
            assert (code == d.argmin(1)).all() and (dist == d.min(1)).all()
        if width <= 150:
            assert cells.evaluated < 0.5 * cells.asked * len(book)


def test_few_or_no_vectors(llm, sf):
    for rows in ([], [(1, None, 1)], [(None, [1.0, 2.0], 1)]):
        df = frame(llm, rows)
        kept = df.where(cellcodes.finite("embedding")).select("vec_id", "label", cellcodes.floors("embedding", 8).alias("v"))
        assert cellcodes.code(kept, cellcodes.learn(kept)).collect() == []
    rows = [(2, [], 1), (1, [], None)]
    got = queries.QUERIES["op12_cell_codes"](llm, sf(embeddings=frame(llm, rows))).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == [(1, "00000000", 0), (2, "00000000", 0)]


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def based(text):
    w, found = words_of(text), []
    for phrase, label in licences.PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_matches_are_the_longest():
    rnd = random.Random(2)
    for _ in range(60):
        made = [[rnd.choice("ab") if rnd.random() < 0.9 else "c" for _ in range(rnd.randint(1, 30))] for _ in range(4)]
        text = [rnd.choice("aabbcx") for _ in range(60)]
        code = [[w.encode() for w in t] for t in made]
        held = {tuple(t[i:j]) for t in made for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        longest = [max([n for n in range(1, i + 2) if tuple(text[i + 1 - n:i + 1]) in held], default=0) for i in range(60)]
        want = [(i + 1 - n, n) for i, n in enumerate(longest) if n >= licences.LEAST and (i == 59 or longest[i + 1] != n + 1)]
        said = []
        a = licences.Automaton(code[:3], code[3:])
        *got, n = a.matches([[w.encode() for w in text[:23]], [], [w.encode() for w in text[23:]]], lambda s, p: said.append(s))
        assert n == 60 and [m[:2] for m in got] == want
        for start, size, state in got:
            assert {(t, e) for t in range(3) for e in range(size, len(made[t]) + 1) if made[t][e - size:e] == text[start:start + size]} == set(
                a.ends[state])
        assert said == [i for i in range(60) if text[i:i + len(made[3])] == made[3]]


def test_spans_of_templates():
    scan = licences.scanner(licences.TEMPLATES, {})
    rnd = random.Random(1)
    for name, text in licences.TEMPLATES.items():
        w = text.split()
        n, *_, spans, labels, score = scan(f"before {text} after".encode())
        assert labels == [name] and score == 1 and [(s["label"], s["covered"]) for s in spans] == [(name, 1.0)]
        assert (spans[0]["start"], spans[0]["end"]) == (1, n - 1)
        some = [x if rnd.random() > 0.06 else "qqq" for x in w]
        assert scan(" ".join(some).encode())[6] == [name]
        assert scan(" ".join(w[:len(w) // 5]).encode())[6] == []
        rnd.shuffle(w)
        assert scan(" ".join(w).encode())[6] == []
        twice = scan(f"{text} . {text}".encode())
        assert len(twice[5]) == 2 and twice[7] == 1
    both = licences.TEMPLATES["bsd"] + " x" * 50 + licences.TEMPLATES["mpl"]
    assert scan(both.encode())[6] == ["bsd", "mpl"]


@pytest.mark.parametrize("size", [1 << 20, 5])
def test_licences(llm, monkeypatch, size):
    monkeypatch.setattr(licences.word_slices, "__defaults__", (size,))
    docs = MESSY + [(50 + i, t, *MESSY[0][2:]) for i, t in enumerate([
        "Released under the MIT License.", "GNU General Public-License; gnu general public LICENSE cc--BY", "cc by cc by cc", "mit license",
        "the mit licenses, İ apache license", "CC BY " * 3000, licences.TEMPLATES["bsd"], "x " * 70_000 + "Apache License",
        licences.TEMPLATES["mit"] + " MIT License", "gnu general apache license public license"])]
    from .conftest import DOCS
    got = licences.scan_licences(llm.createDataFrame(docs, DOCS)).collect()
    assert "label" in got[0] and got[0]["score"] is not None  # a column of that name is replaced
    mine = collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, ",".join(r.base_labels)) for r in got)
    assert mine == collections.Counter((d[0], *based(d[1])) for d in docs)
    by = {r.doc_id: r for r in got}
    assert by[56].labels == ["bsd"] and by[58].labels == ["mit"] and by[56].base_labels == []
    assert by[0].score == 0 and by[50].score == 1 and all(set(r.base_labels) <= set(r.labels) for r in got)


def test_licence_query(llm, sf, messy, empty):
    assert licences.scan_licences(empty).count() == 0
    got = queries.QUERIES["op13_licence_spans"](llm, sf(documents=messy))
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert got.count() == len(MESSY)
