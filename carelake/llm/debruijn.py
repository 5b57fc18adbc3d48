"""Repeated word passages by a compacted de Bruijn graph.

Tokens are words; a k-mer of WINDOW words is an edge from the node of its
first to the node of its last WINDOW - 1 words.  Edges are counted where their
minimizers meet (``repeats``: equal k-mers share an anchor, so an edge's
copies are all compared in one group, with their words), and only edges that
occur at least twice stay.  Consecutive repeated edges without a branch form a
piece; pieces are joined end node to start node, and where exactly one piece
ends and one starts they are one path (connected through the nodes by
``components``).  Back at the source, a text's occurrences of a path are put
together by their coordinates, a span must be at least one window long, and
its words are removed.

Branches are judged inside a group and at the ends of pieces.  Groups over
``repeats.GROUP`` distinct segments count their edges as rows instead.

Defined results: a null text has no words; texts of fewer words than WINDOW
lose nothing; equal texts give equal results; an empty table gives no rows;
other columns are ignored.
"""
from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, files_for, prepare, table
from .registry import register
from .repeats import GROUP, Powers, contents, contents_once, distinct_segments, grouped, keyed, mix, repeated, texts

WINDOW, GRAM = 35, 12
#: Texts whose words are held at once.
TEXTS = 64
_TABLE = np.random.default_rng(9).integers(0, 1 << 64, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = Powers()
PIECE = "a long, s long, rel int, len int, piece long, u long, v long, home long"


def tokens(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words end."""
    raw = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    space = _SPACE[raw]
    before = np.concatenate([[True], space[:-1]])
    start = np.flatnonzero(~space & before)
    end = np.flatnonzero(space & ~before)
    limits = np.cumsum(np.array([len(x) + 1 for x in parts], np.int64))
    h = _POWERS.prefix(_TABLE[raw], 0)
    return mix(_POWERS.span(h, start, end, 0) + (end - start).astype(np.uint64)), np.searchsorted(start, limits)


def slicer(text: bytes):
    words = text.split()
    return lambda start, n: b" ".join(words[start:start + n])


def _edges(content: list[bytes], cnt: np.ndarray, window: int):
    """Both hashes of every k-mer, the hash of every node, words and places:
    (h1, h2, node before, node after, words, first word of the k-mer)."""
    words, ends = tokens(content)
    idx = np.arange(cnt.sum()) - np.repeat(np.cumsum(cnt) - cnt, cnt)
    at = idx + np.repeat(np.concatenate([[0], ends[:-1]]), cnt)
    p = [_POWERS.prefix(words, w) for w in (0, 1)]
    h = [_POWERS.span(p[w], at, at + window, w) for w in (0, 1)]
    u = _POWERS.span(p[0], at, at + window - 1, 0)
    v = _POWERS.span(p[0], at + 1, at + window, 0)
    return h[0], h[1], u, v, words, at


def kernel(window: int):
    def compact(t: pa.Table) -> pa.RecordBatch:
        cnt, n = t["cnt"].to_numpy().astype(np.int64), t["n"].to_numpy()
        h1, h2, u, v, words, at = _edges(t["content"].to_pylist(), cnt, window)
        of = np.repeat(np.arange(len(cnt)), cnt)
        order = np.argsort(h1, kind="stable")
        new, other = (np.concatenate([[True], x[1:] != x[:-1]])[:len(order)] for x in (h1[order], h2[order]))
        if (other & ~new).any():
            order = np.lexsort((h2, h1))
            new, other = (np.concatenate([[True], x[1:] != x[:-1]])[:len(order)] for x in (h1[order], h2[order]))
        step = new | other
        first = order[step]
        edge = np.empty(len(order), np.int64)
        edge[order] = np.cumsum(step) - 1
        same = np.ones(len(order), bool)  # the words themselves, not only their hashes
        later = np.flatnonzero(first[edge] != np.arange(len(edge)))
        x, y, equal = at[later], at[first[edge[later]]], np.ones(len(later), bool)
        for i in range(window):
            equal &= words[x + i] == words[y + i]
        same[later] = equal
        total = np.bincount(edge[same], n[of[same]].astype(np.float64), minlength=len(first))
        often = same & (total[edge] > 1)
        # branching nodes, among the distinct repeated edges here
        f = first[total > 1]

        def many(x):
            values, count = np.unique(x[f], return_counts=True)
            return values[count > 1]
        branch = np.zeros(len(often), bool)
        branch[often] = np.isin(u[often], np.concatenate([many(u), many(v)]))
        begin = often.copy()
        begin[1:] &= ~often[:-1] | (of[1:] != of[:-1]) | branch[1:]
        begin = np.flatnonzero(begin)
        nxt = np.concatenate([begin[1:], [len(often)]])
        broken = np.flatnonzero(~often)
        stop = np.minimum(nxt, np.concatenate([broken, [len(often)]])[np.searchsorted(broken, begin)])
        ends = np.cumsum(cnt)
        stop = np.minimum(stop, ends[of[begin]])
        piece = mix(h1[begin] ^ mix(h2[stop - 1] + (stop - begin).astype(np.uint64)))
        own = of[begin]
        return pa.RecordBatch.from_arrays(
            [pa.array(t["a"].to_numpy()[own]), pa.array(t["s"].to_numpy()[own]),
             pa.array((begin - (ends - cnt)[own]).astype(np.int32)), pa.array((stop - begin).astype(np.int32)),
             *(pa.array(x.view(np.int64)) for x in (piece, u[begin], v[stop - 1])), pa.array(t["k1"].to_numpy()[own])],
            names=["a", "s", "rel", "len", "piece", "u", "v", "home"])
    return compact


def crowded(rows: DataFrame, window: int) -> DataFrame:
    """Pieces of one edge each, for anchors with too many segments for a group."""
    def edges(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                p = b.slice(lo, 256)
                cnt = p.column("cnt").to_numpy().astype(np.int64)
                h1, h2, u, v, _, _ = _edges(p.column("content").to_pylist(), cnt, window)
                idx = np.arange(cnt.sum()) - np.repeat(np.cumsum(cnt) - cnt, cnt)
                rep = [pa.array(np.repeat(p.column(c).to_numpy(), cnt)) for c in ("a", "s", "n", "k1")]
                yield pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in (h1, h2, u, v)), *rep,
                                                  pa.array(idx.astype(np.int32))],
                                                 names=["h1", "h2", "u", "v", "a", "s", "n", "home", "rel"])
    e = rows.mapInArrow(edges, "h1 long, h2 long, u long, v long, a long, s long, n long, home long, rel int")
    often = cut(e.groupBy("h1", "h2").agg(F.sum("n").alias("total")).where("total > 1").select("h1", "h2"))
    return e.join(often, ["h1", "h2"]).select("a", "s", "rel", F.lit(1).alias("len"), F.col("h1").alias("piece"), "u", "v", "home")


def paths(pieces: DataFrame) -> DataFrame:
    """(piece, path): pieces joined through nodes where one ends and one starts.
    Neighbours are mostly first found in one text (home), so they are dealt by
    it and most paths are contracted inside a task."""
    p = cut(pieces.select("piece", "u", "v", "home").dropDuplicates(["piece"]))
    starts = p.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("piece").alias("next")).where("n = 1")
    ends = (p.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("piece").alias("prev"), F.min("home").alias("home"))
            .where("n = 1"))
    glue = ends.join(starts, ends.v == starts.u).select(F.col("prev").alias("a"), F.col("next").alias("b"), "home")
    return components(glue.repartition("home")).withColumnsRenamed({"node": "piece", "component": "path"})


def passage_pieces(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """k1, k2, pieces (start, len, path) of the texts of ``docs`` (k1, k2,
    text) in which words repeat."""
    files = files_for(docs)
    occ = repeated(docs, tokens, window, GRAM, files)
    segs = cut(distinct_segments(occ, files), files)
    pieces = grouped(contents(segs.where(F.col("segs") <= GROUP), docs, slicer, window), kernel(window), PIECE)
    large = segs.where(F.col("segs") > GROUP)
    if not large.isEmpty():
        pieces = pieces.union(crowded(contents_once(large, docs, slicer, window, files), window))
    pieces = cut(pieces, files)
    named = pieces.join(paths(pieces), "piece", "left").withColumn("path", F.coalesce("path", "piece"))
    found = cut(named.groupBy("a", "s").agg(F.collect_list(F.struct("rel", "len", "path")).alias("pieces")), files)
    once = occ.dropDuplicates(["k1", "k2", "start"])
    return (once.join(found, ["a", "s"]).groupBy("k1", "k2")
            .agg(F.collect_list(F.struct("start", "pieces")).alias("found")))


def _removed(found: pa.ListArray, window: int, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words in verified spans of paths, of all texts one after another (each
    followed by one more place, never removed), and how many spans each has."""
    occ = found.flatten()
    text = np.repeat(np.arange(len(found)), pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False))
    many, pieces = pc.list_value_length(occ.field("pieces")).to_numpy(zero_copy_only=False), occ.field("pieces").flatten()
    rel, n, path = (pieces.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("rel", "len", "path"))
    text, start = np.repeat(text, many), np.repeat(occ.field("start").to_numpy(zero_copy_only=False).astype(np.int64), many) + rel
    order = np.lexsort((start, path, text))
    text, path, start, end = text[order], path[order], start[order], (start + n)[order]
    new = np.ones(len(order), bool)
    new[1:] = (text[1:] != text[:-1]) | (path[1:] != path[:-1])
    own = np.cumsum(new) << 32
    end = np.maximum.accumulate(own + end) - own  # the furthest end so far on this path
    new[1:] |= start[1:] > end[:-1]  # else adjacent in the source
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(order)]])[:len(first)] - 1
    text, start, stop = text[first], start[first], end[last] - 1 + window
    fits = (start + window <= stop) & (stop <= size[text])
    text, start, stop = text[fits], start[fits], stop[fits]
    base = np.cumsum(size + 1) - size - 1
    length = int((size + 1).sum())
    edge = np.bincount(base[text] + start, minlength=length) - np.bincount(base[text] + stop, minlength=length)
    return np.cumsum(edge) > 0, np.bincount(text, minlength=len(size))


def cut_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per distinct text of ``docs`` (k1, k2, text): k1, k2, n_words,
    n_removed, n_spans, kept (binary; kept words joined by one space)."""
    joined = texts(docs).join(passage_pieces(docs, window), ["k1", "k2"], "left")

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for lo in range(0, b.num_rows, TEXTS):
                p = b.slice(lo, TEXTS)
                words = [unpack(z).split() for z in p.column("z").to_pylist()]
                size = np.array([len(w) for w in words], np.int64)
                gone, spans = _removed(p.column("found"), window, size)
                ends = np.cumsum(size + 1)
                lost = np.diff(np.concatenate([[0], np.cumsum(gone)])[np.concatenate([[0], ends])])
                kept = [b" ".join(compress(w, (~gone[e - len(w) - 1:e - 1]).tolist()) if k else w)
                        for w, e, k in zip(words, ends.tolist(), lost.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [p.column("k1"), p.column("k2"), *(pa.array(x, pa.int64()) for x in (size, lost, spans)),
                     pa.array(kept, pa.binary())], names=["k1", "k2", "n_words", "n_removed", "n_spans", "kept"])
    return joined.mapInArrow(run, "k1 long, k2 long, n_words long, n_removed long, n_spans long, kept binary")


@register("op9_debruijn_passages")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = keyed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = cut_passages(rows).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    return rows.select("doc_id", "k1", "k2").join(kept, ["k1", "k2"]).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")
