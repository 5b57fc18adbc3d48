"""Repeated windows of a corpus: candidate search shared by the substring operators.

A window is W consecutive tokens (bytes or words) of one text.  Among the
K-grams inside it, the one with the smallest hash, the leftmost of equals, is
its anchor: it depends on the window's content alone, so equal windows have
equal anchors at equal distances.  Neighbouring windows share anchors; the
run of windows with one anchor is a segment, and every window of every text
belongs to exactly one segment.  So a window repeats only among the segments
whose anchors have equal hashes, and

* a segment that occurs twice as a whole repeats in all its windows,
* other segments of a repeated anchor are compared by content, one copy of
  each distinct one, by the operator's own method,
* an anchor that occurs once is settled without looking at its content.

Texts are known by two 64-bit hashes, so equal texts share one result and the
order of rows never matters.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small

_POS = np.uint64((1 << 24) - 1)
_B = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
#: Tokens handled in one array.
STRIP = 1 << 18
OCC = "a long, s long, k1 long, k2 long, start int, cnt int"


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of both bases and of their inverses, made once and extended."""

    def __init__(self):
        self.up, self.down = [], []
        self.extend(STRIP * 2)

    def extend(self, n: int) -> None:
        self.n = n
        self.up, self.down = [], []
        for b in _B:
            inverse = np.uint64(pow(int(b), -1, 1 << 64))
            for base, to in ((b, self.up), (inverse, self.down)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                to.append(np.multiply.accumulate(p))

    def prefix(self, tokens: np.ndarray, which: int) -> np.ndarray:
        if len(tokens) + 1 > self.n:
            self.extend(2 * len(tokens) + 2)
        out = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(tokens * self.up[which][:len(tokens)], out=out[1:])
        return out

    def span(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        """Hashes of the token runs [start, end)."""
        return mix((prefix[end] - prefix[start]) * self.down[which][start])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    size, out = 1, x
    while size * 2 <= w:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = w - size
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def segments(tokens: np.ndarray, ends: np.ndarray, window: int, gram: int, powers: Powers):
    """Segments of the texts laid one after another in ``tokens`` (hashes),
    ``ends`` being their ends: (text, start in it, number of windows, anchor
    hash, segment hash)."""
    n = len(tokens) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    h = powers.prefix(tokens, 0)
    m = len(tokens) - gram + 1
    grams = mix((h[gram:] - h[:m]) * powers.down[0][:m])
    low = sliding_min((grams & ~_POS) | np.arange(m, dtype=np.uint64), window - gram + 1)
    at = (low & _POS).astype(np.int64)
    start = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(n + 1, np.int32)  # windows that stay in one text
    has = ends - start >= window
    np.add.at(inside, start[has], 1)
    np.add.at(inside, ends[has] - window + 1, -1)
    ok = np.cumsum(inside[:n]) > 0
    text = np.repeat(np.arange(len(ends)), ends - start)[:n]
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | ~ok[:-1]
    first = np.flatnonzero(new & ok)
    stop = np.flatnonzero(np.concatenate([(new | ~ok)[1:], [True]]) & ok) + 1
    g = powers.prefix(tokens, 1)
    seg = powers.span(g, first, stop + window - 1, 1)
    seg = mix(seg ^ (at[first] - first).astype(np.uint64) * _B[0] ^ (stop - first).astype(np.uint64) * _B[1])
    return text[first], first - start[text[first]], stop - first, grams[at[first]], seg


def scanner(tokenize: Callable[[list], tuple[np.ndarray, np.ndarray]], window: int, gram: int):
    """Occurrences of segments in batches (k1, k2, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()

        def rows(b: pa.RecordBatch, part: list[int], texts: list) -> pa.RecordBatch:
            tokens, ends = tokenize(texts)
            k1, k2 = b.column(0).to_numpy()[part], b.column(1).to_numpy()[part]
            outs = []
            if len(part) == 1 and len(tokens) > 4 * STRIP:  # a very long text, in strips of whole windows
                for i in range(0, len(tokens) - window + 1, STRIP):
                    piece = tokens[i:i + STRIP + window - 1]
                    t, s, c, a, g = segments(piece, np.array([len(piece)]), window, gram, powers)
                    outs.append((t, s + i, c, a, g))
            else:
                outs.append(segments(tokens, ends, window, gram, powers))
            t, s, c, a, g = (np.concatenate(x) for x in zip(*outs))
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(g.view(np.int64)), pa.array(k1[t]), pa.array(k2[t]),
                 pa.array(s.astype(np.int32)), pa.array(c.astype(np.int32))], names=["a", "s", "k1", "k2", "start", "cnt"])

        for b in batches:
            part, texts, size = [], [], 0
            for i, x in enumerate(b.column(2)):
                v = x.as_buffer() if x.is_valid else None
                raw = v.to_pybytes() if v is not None else b""
                if part and size + len(raw) > STRIP:
                    yield rows(b, part, texts)
                    part, texts, size = [], [], 0
                part.append(i)
                texts.append(raw)
                size += len(raw)
            if part:
                yield rows(b, part, texts)
    return run


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with k1 and k2, the hashes that know a text (null: empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("k1", F.xxhash64(text)).withColumn("k2", F.xxhash64(F.lit(1), text))


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` with the text as compressed bytes ``z``, for the shuffles."""
    schema = docs.withColumn("text", F.lit(b"")).withColumnRenamed("text", "z").schema

    def run(batches):
        press = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            k = b.schema.get_field_index("text")
            z = pa.array([press(x.as_buffer().to_pybytes()) if x.is_valid else press(b"") for x in b.column(k)], pa.binary())
            yield pa.RecordBatch.from_arrays([z if i == k else c for i, c in enumerate(b.columns)], names=schema.names)
    return docs.mapInArrow(run, schema)


def repeated(docs: DataFrame, tokenize, window: int, gram: int, files: int | None = None) -> DataFrame:
    """Occurrences (``OCC``) of the segments whose anchor occurs at least twice
    among all rows of ``docs`` (with k1, k2, text)."""
    occ = docs.select("k1", "k2", "text").mapInArrow(scanner(tokenize, window, gram), OCC)
    # written first: a join of two plain shuffles can split an anchor with very many occurrences
    many = cut(occ.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a"), files)
    return cut(occ.join(many, "a", "left_semi"), files)


#: Distinct segments of one anchor that one task compares (under 2 MB of content at 200 bytes a
#: window); beyond it, windows are counted as rows.
GROUP = 4096
#: Bytes of content handled at once.
PACK = 1 << 19
SEG = "a long, s long, n long, k1 long, k2 long, start int, cnt int, segs long"


def distinct_segments(occ: DataFrame, files: int | None = None) -> DataFrame:
    """``SEG``: distinct segments, how often each occurs (n), its first
    occurrence by (k1, k2, start), and the distinct segments of its anchor (segs)."""
    segs = cut(occ.groupBy("a", "s").agg(F.count(F.lit(1)).alias("n"),
                                         F.min(F.struct("k1", "k2", "start", "cnt")).alias("at")), files)
    per = cut(segs.groupBy("a").agg(F.count(F.lit(1)).alias("segs")), files)
    return segs.join(per, "a").select("a", "s", "n", "at.*", "segs")


def texts(docs: DataFrame) -> DataFrame:
    """Distinct texts: k1, k2, z (compressed)."""
    return packed(docs.select("k1", "k2", "text")).groupBy("k1", "k2").agg(F.first("z").alias("z"))


def contents(segs: DataFrame, docs: DataFrame, slicer: Callable[[bytes], Callable[[int, int], bytes]], window: int) -> DataFrame:
    """``segs`` with the content of their first occurrence."""
    need = segs.groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "s", "n", "start", "cnt", "segs")).alias("need"))

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            sizes, flat = pc.list_value_length(b.column(3)).to_numpy(), b.column(3).flatten()
            start, cnt = (flat.field(c).to_pylist() for c in ("start", "cnt"))
            out, i = [], 0
            for z, size in zip(b.column(2).to_pylist(), sizes.tolist()):
                piece = slicer(unpack(z))
                out += [piece(x, n + window - 1) for x, n in zip(start[i:i + size], cnt[i:i + size])]
                i += size
            k1, k2 = (pa.array(np.repeat(b.column(c).to_numpy(), sizes)) for c in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [*(flat.field(c) for c in ("a", "s", "n")), k1, k2, *(flat.field(c) for c in ("start", "cnt", "segs")),
                 pa.array(out, pa.binary())], names=["a", "s", "n", "k1", "k2", "start", "cnt", "segs", "content"])
    return texts(docs).join(need, ["k1", "k2"]).mapInArrow(run, SEG + ", content binary")


def contents_once(segs: DataFrame, docs: DataFrame, slicer: Callable[[bytes], Callable[[int, int], bytes]], window: int,
                  files: int | None = None) -> DataFrame:
    """``contents`` for ``crowded``, which reads them twice: written, and where
    few texts hold the segments, only those are taken."""
    keys = cut(segs.select("k1", "k2").distinct(), files)
    if (few := small(keys)) is not keys:
        docs = docs.join(few, ["k1", "k2"], "left_semi")
    return cut(contents(segs, docs, slicer, window), files)


def grouped(rows: DataFrame, kernel: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """``kernel`` over complete groups of equal ``a``, in the order of (a, k1,
    k2, start), about ``PACK`` bytes at a time."""
    def run(batches):
        held = None
        for last, b in _until_end(batches):
            if b is not None:
                t = pa.Table.from_batches([b])
                held = t if held is None else pa.concat_tables([held, t])
            if held is None or not held.num_rows:
                continue
            a = held["a"].to_numpy()
            edge = np.concatenate([[0], np.flatnonzero(a[1:] != a[:-1]) + 1, [len(a)] if last else []]).astype(np.int64)
            size = np.concatenate([[0], np.cumsum(pc.binary_length(held["content"]).to_numpy())])
            i = 0
            while i < len(edge) - 1:
                j = max(i + 1, int(np.searchsorted(size[edge], size[edge[i]] + PACK, side="right")) - 1)
                yield kernel(held.slice(edge[i], edge[j] - edge[i]))
                i = j
            held = held.slice(edge[-1])
    return rows.repartition("a").sortWithinPartitions("a", "k1", "k2", "start").mapInArrow(run, schema)


def _until_end(batches):
    for b in batches:
        yield False, b
    yield True, None


def runs(flags: np.ndarray, cnt: np.ndarray) -> pa.Array:
    """For consecutive stretches of ``cnt`` flags: the runs of true ones, as
    flat lists start, length, start, length, ..."""
    ends = np.cumsum(cnt)
    of = np.repeat(np.arange(len(cnt)), cnt)
    change = np.empty(len(flags), bool)
    change[:1] = True
    change[1:] = (flags[1:] != flags[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(change)
    size = np.diff(np.concatenate([first, [len(flags)]]))
    yes = flags[first]
    first, size = first[yes], size[yes]
    owner = of[first]
    flat = np.column_stack([first - (ends - cnt)[owner], size]).ravel()
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(cnt)) * 2)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


def crowded(rows: DataFrame, tokenize, window: int) -> DataFrame:
    """For anchors with more distinct segments than a group may hold (``rows``,
    from ``contents_once``): a, s and the runs of windows that occur elsewhere (``anywhere``) and before
    (``earlier``), from counting windows as rows, with map-side combining."""
    def windows(batches):
        powers = Powers()
        for b in batches:
            if not b.num_rows:
                continue
            for lo in range(0, b.num_rows, 256):
                p = b.slice(lo, 256)
                tokens, ends = tokenize(p.column("content").to_pylist())
                cnt = p.column("cnt").to_numpy()
                idx = np.arange(cnt.sum()) - np.repeat(np.cumsum(cnt) - cnt, cnt)
                at = idx + np.repeat(np.concatenate([[0], ends[:-1]]), cnt)
                h = [powers.span(powers.prefix(tokens, w), at, at + window, w).view(np.int64) for w in (0, 1)]
                rep = [pa.array(np.repeat(p.column(c).to_numpy(), cnt)) for c in ("a", "s", "n", "k1", "k2", "start")]
                yield pa.RecordBatch.from_arrays([*map(pa.array, h), *rep, pa.array(idx.astype(np.int32))],
                                                 names=["h1", "h2", "a", "s", "n", "k1", "k2", "start", "i"])

    w = rows.mapInArrow(windows, "h1 long, h2 long, a long, s long, n long, k1 long, k2 long, start int, i int")
    order = F.struct("k1", "k2", (F.col("start") + F.col("i")).alias("p"))
    per = cut(w.groupBy("h1", "h2").agg(F.sum("n").alias("total"), F.min(order).alias("first")).where("total > 1"))
    hit = w.join(per, ["h1", "h2"]).withColumn("own", order)
    return hit.groupBy("a", "s").agg(
        F.array_sort(F.collect_list("i")).alias("anywhere"),
        F.array_sort(F.collect_list(F.when(F.col("own") != F.col("first"), F.col("i")))).alias("earlier"),
    ).select("a", "s", *(F.flatten(F.transform(c, lambda x: F.array(x, F.lit(1)))).alias(c) for c in ("anywhere", "earlier")))


def spans(occ: DataFrame, found: DataFrame, keep_first: bool, files: int | None = None) -> DataFrame:
    """k1, k2 and ``cuts`` (windows to remove, as start, length pairs) of the
    texts that lose something.  ``found``: a, s, n, k1, k2, start of distinct
    segments and the runs ``anywhere`` and ``earlier`` (null where not compared)."""
    once = occ.dropDuplicates(["k1", "k2", "start"])
    f = cut(found.select("a", "s", "n", F.struct("k1", "k2", "start").alias("at"), "anywhere", "earlier"), files)
    whole = F.array(F.lit(0), F.col("cnt"))
    own = F.struct("k1", "k2", "start") == F.col("at")
    if keep_first:
        cuts = F.when(~own, whole).otherwise(F.col("earlier"))
    else:
        cuts = F.when(F.col("n") > 1, whole).otherwise(F.col("anywhere"))
    rows = once.join(f, ["a", "s"]).withColumn("cuts", cuts).where(F.size(F.coalesce("cuts", F.array().cast("array<int>"))) > 0)
    return rows.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "cuts")).alias("cuts"))


def covered(cuts: list, window: int, size: int) -> np.ndarray:
    """Which of ``size`` tokens lie in a removed window."""
    edge = np.zeros(size + 1, np.int32)
    for c in cuts or ():
        r = np.asarray(c["cuts"], np.int64).reshape(-1, 2) + np.array([c["start"], 0])
        np.add.at(edge, r[:, 0], 1)
        np.add.at(edge, np.minimum(r[:, 0] + r[:, 1] + window - 1, size), -1)
    return np.cumsum(edge[:size]) > 0
