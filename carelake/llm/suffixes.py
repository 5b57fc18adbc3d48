"""Duplicate byte strings by suffix arrays and longest-previous-factor arrays.

Candidates come from ``repeats``: only segments whose anchor repeats are
compared.  Distinct segments of one anchor are laid one after another in the
order of their first occurrence; the suffixes at the starts of windows are
sorted by prefix doubling, neighbours' common prefixes follow from the ranks,
and pointer jumping finds for each suffix the previous and the next smaller
position in suffix order.  The longer common prefix of the two is the longest
previous factor: a window starts there again if it is at least MIN_BYTES.
The mirrored array (larger positions) tells which windows occur later.

``keep="first"`` removes later copies and keeps the first (first by the hash
of the text, then position; of equal texts the row with the smallest doc_id
stays as it is, of rows equal in every column one); ``keep="none"`` removes every copy.

Defined results: a null text is empty; texts shorter than MIN_BYTES lose
nothing; equal texts give equal results (but see ``keep="first"``); cut texts
are bytes, and ``dedup`` drops characters cut in two; an empty table gives
no rows; other columns are passed on by ``dedup`` and ignored by the query.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, explode_count, files_for, prepare, released, table
from .registry import register
from .repeats import GROUP, contents, contents_once, covered, crowded, distinct_segments, grouped, keyed, packed, repeated, runs, spans, texts

#: A multiple of 8 up to 248.
MIN_BYTES = 200
GRAM = 64
#: Random numbers for bytes.
_TABLE = np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64)


def tokens(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return _TABLE[np.frombuffer(b"".join(parts), np.uint8)], np.cumsum([len(x) for x in parts], dtype=np.int64)


def slicer(text: bytes):
    return lambda start, n: text[start:start + n]


def _ranks(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    step = np.empty(len(s), np.int64)
    step[:1] = 0
    step[1:] = np.cumsum(s[1:] != s[:-1])
    out = np.empty(len(s), np.int64)
    out[order] = step
    return out


def levels(raw: np.ndarray) -> dict[int, np.ndarray]:
    """Ranks of all suffixes by their first 8, 16, ..., 128 bytes."""
    padded = np.concatenate([raw, np.zeros(256, np.uint8)]).astype(np.uint64)
    n = len(raw)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i:i + n]
    out, size = {8: _ranks(key)}, 8
    while size < 128:
        r = out[size]
        later = np.zeros(n, np.int64)
        later[:max(n - size, 0)] = r[size:] + 1
        out[size * 2] = _ranks(r * (n + 1) + later)
        size *= 2
    return out


def common_prefix(rank: dict[int, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common prefix of suffixes i and j, in whole 8 bytes, up to 248."""
    n = len(rank[8])
    got = np.zeros(len(i), np.int64)
    for size in (128, 64, 32, 16, 8):
        x, y = i + got, j + got
        ok = (x < n) & (y < n)
        same = np.zeros(len(i), bool)
        same[ok] = rank[size][x[ok]] == rank[size][y[ok]]
        got += same * size
    return got


def previous_factor(sa: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """Longest previous factor of each suffix in suffix order: the common
    prefix with the previous or next smaller position, where it is at least
    ``least`` (0 otherwise).  ``lcp[i]`` is that of sa[i - 1] and sa[i]."""
    n, best = len(sa), np.zeros(len(sa), np.int64)
    for step in (-1, 1):
        # to[i]: nearest not yet excluded neighbour; low[i]: common prefix with it
        to = np.arange(n) + step
        low = lcp.copy() if step < 0 else np.concatenate([lcp[1:], [0]])
        live = np.flatnonzero(low >= least)
        while len(live):
            t = to[live]
            smaller = sa[t] < sa[live]
            done = live[smaller]
            best[done] = np.maximum(best[done], low[done])
            live, t = live[~smaller], t[~smaller]
            new_low, new_to = np.minimum(low[live], low[t]), to[t]
            low[live], to[live] = new_low, new_to
            live = live[new_low >= least]
    return best


def kernel(least: int):
    def compare(t: pa.Table) -> pa.RecordBatch:
        cnt, n = t["cnt"].to_numpy().astype(np.int64), t["n"].to_numpy()
        content = t["content"].to_pylist()
        raw = np.frombuffer(b"".join(content), np.uint8)
        size = np.array([len(x) for x in content])
        rank = levels(raw)
        # window starts, in text order; their suffix order by 256 bytes
        start = np.arange(cnt.sum()) - np.repeat(np.cumsum(cnt) - cnt, cnt) + np.repeat(np.cumsum(size) - size, cnt)
        later = np.zeros(len(raw) + 128, np.int64)
        later[:len(raw)] = rank[128] + 1
        order = np.argsort(rank[128][start] * (len(raw) + 1) + later[start + 128], kind="stable")
        sa = start[order]
        lcp = np.concatenate([[0], common_prefix(rank, sa[:-1], sa[1:])])[:len(sa)]
        earlier, after = np.zeros(len(sa), bool), np.zeros(len(sa), bool)
        earlier[order] = previous_factor(sa, lcp, least) >= least
        after[order] = previous_factor(-sa, lcp, least) >= least
        whole = np.repeat(n > 1, cnt)
        return pa.RecordBatch.from_arrays(
            [t["a"].combine_chunks(), t["s"].combine_chunks(), runs(earlier | after | whole, cnt), runs(earlier, cnt)],
            names=["a", "s", "anywhere", "earlier"])
    return compare


def byte_cuts(docs: DataFrame, least: int = MIN_BYTES, keep: str = "first", files: int | None = None) -> DataFrame:
    """k1, k2, cuts of the texts of ``docs`` (with k1, k2) that lose bytes."""
    files = files or files_for(docs)
    occ = repeated(docs, tokens, least, GRAM, files)
    segs = cut(distinct_segments(occ, files), files)
    out = "a long, s long, anywhere array<int>, earlier array<int>"
    found = grouped(contents(segs.where(F.col("segs").between(2, GROUP)), docs, slicer, least), kernel(least), out)
    large = segs.where(F.col("segs") > F.greatest(F.lit(GROUP), F.lit(1)))
    if not large.isEmpty():
        found = found.union(crowded(contents_once(large, docs, slicer, least, files), tokens, least))
    found = cut(found, files)
    return spans(occ, segs.join(found, ["a", "s"], "left"), keep == "first", files)


def _cutter(least: int):
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            kept, sizes, gone, count = [], [], [], []
            for z, cuts in zip(b.column("z").to_pylist(), b.column("cuts").to_pylist()):
                raw = np.frombuffer(unpack(z), np.uint8)
                out = covered(cuts, least, len(raw))
                kept.append(raw[~out].tobytes())
                sizes.append(len(raw))
                gone.append(int(out.sum()))
                count.append(int(np.count_nonzero(np.diff(np.concatenate([[0], out.astype(np.int8)])) == 1)))
            rest = [(c, n) for c, n in zip(b.columns, b.schema.names) if n not in ("z", "cuts")]
            yield pa.RecordBatch.from_arrays(
                [*(c for c, _ in rest), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()),
                 pa.array(kept, pa.binary())], names=[*(n for _, n in rest), "n_bytes", "n_removed", "n_spans", "kept"])
    return run


_ADDED = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept", T.BinaryType())]


def cut_texts(docs: DataFrame, least: int = MIN_BYTES) -> DataFrame:
    """Per distinct text of ``docs`` (k1, k2, text), every copy of a repeated
    string removed: k1, k2, n_bytes, n_removed, n_spans, kept (binary)."""
    joined = texts(docs).join(byte_cuts(docs, least, "none"), ["k1", "k2"], "left")
    schema = T.StructType([f for f in joined.schema.fields if f.name not in ("z", "cuts")] + _ADDED)
    return joined.mapInArrow(_cutter(least), schema)


def dedup(docs: DataFrame, least: int = MIN_BYTES) -> DataFrame:
    """``docs`` with later copies of repeated strings taken out of ``text``,
    the first kept; characters cut in two are dropped.

    Of equal texts the row with the smallest doc_id (null last) is the first,
    of equal doc_ids the one with the smallest hash of its columns; of rows
    equal in every column one is the first and the others are copies."""
    rest = [c for c in docs.columns if c != "text"]
    rows = keyed(docs.select(F.struct(*rest).alias("_row"), "doc_id", "text"))
    rows = rows.withColumn("_id", F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", F.xxhash64("_row").alias("h1"), F.xxhash64(F.lit(1), "_row").alias("h2"))).drop("doc_id")
    files = files_for(rows)
    cuts = byte_cuts(rows, least, "first", files)
    each = rows.groupBy("k1", "k2", "_id").agg(F.count(F.lit(1)).alias("m"))
    same = cut(each.groupBy("k1", "k2").agg(F.sum("m").alias("rows"), F.min("_id").alias("first_id"), F.min_by("m", "_id").alias("ties"))
               .where("rows > 1").drop("rows"), files)
    cuts = cut(cuts.join(same, ["k1", "k2"], "full"), files)
    schema = T.StructType([T.StructField("_row", rows.schema["_row"].dataType), T.StructField("_text", T.StringType())])

    def finish(r: DataFrame, copy) -> DataFrame:
        """_row and the remaining _text of ``r``; null for ``copy`` leaves a row out."""
        joined = packed(r).withColumnsRenamed({"k1": "_k1", "k2": "_k2"}).join(
            cuts.withColumnsRenamed({"k1": "_a", "k2": "_b"}), (F.col("_k1") == F.col("_a")) & (F.col("_k2") == F.col("_b")), "left")
        return (joined.withColumn("_copy", copy).where(F.col("_copy").isNotNull())
                .select("_row", "z", "cuts", "_copy").mapInArrow(released(run), schema))

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for z, cuts_, copy_ in zip(*(b.column(c).to_pylist() for c in ("z", "cuts", "_copy"))):
                raw = np.frombuffer(unpack(z), np.uint8)
                gone = np.full(len(raw), True) if copy_ and len(raw) >= least else covered(cuts_, least, len(raw))
                out.append(raw[~gone].tobytes().decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(out, pa.string())], names=["_row", "_text"])

    first = F.col("_id").eqNullSafe(F.col("first_id"))
    # a first row that is there several times is left out here and counted below
    out = finish(rows, F.when(F.col("first_id").isNull(), False).when(~first, True).when(F.col("ties") == 1, False))
    tied = same.where("ties > 1")
    if not tied.isEmpty():
        keys = tied.select(F.col("k1").alias("_c1"), F.col("k2").alias("_c2"), F.col("first_id").alias("_f"), F.col("ties").alias("_m"))
        one = (rows.join(keys, (F.col("k1") == F.col("_c1")) & (F.col("k2") == F.col("_c2")) & (F.col("_id") == F.col("_f")))
               .groupBy("k1", "k2").agg(F.first("_row").alias("_row"), F.first("text").alias("text"), F.max("_m").alias("_m")))
        out = out.union(finish(explode_count(one, F.col("_m"), "_i").drop("_id"), F.col("_i") > 0))
    return out.select(*(F.col("_text").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns)).coalesce(files)


@register("op2_suffix_array_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = keyed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = cut_texts(rows).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    return rows.select("doc_id", "k1", "k2").join(kept, ["k1", "k2"]).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
