"""Byte-level BPE encoding and decoding with DuckDB inside each task.

Texts are split by the pattern; every distinct piece of a task is encoded once
by a recursive query over token-position rows: each step joins neighbouring
tokens with the merge table and contracts every piece's leftmost
minimum-rank pair, until no pair of the piece can merge.  The query keeps the
rows of all its steps, so pieces are given to it by the rows that they can
make, at most half the square of their bytes each.  Decoding joins ids with the vocabulary and puts the bytes together by an ordered
aggregation.

A piece over ``LONG`` bytes is encoded in blocks of that size, which are then
joined in pairs.  A row of tokens is the encoding of its bytes if every two
neighbours are the encoding of theirs; so only the tokens at the seam are in
question, and where the two there do not encode to themselves, a few tokens
around the seam are encoded anew, more and more, until the ends fit.  Where
that grows over ``LONG`` bytes (a run whose blocks are out of step), a step
contracts all occurrences of the minimum pair, from the left.

One task is one Python process with one DuckDB session, for both ways.  It
remembers at most ``REMEMBERED`` bytes of pieces, a query makes at most
``AT_ONCE`` rows, and ids are put together, decoded and sent on ``PART`` at a
time, so its memory does not grow with its input.  The
vocabulary file is a parameter and is read where the task runs.

Defined results: a null text is empty; an empty text has no ids and decodes to
nothing; an id that is not in the vocabulary fails; equal rows give equal
results; an empty table gives no rows; other columns are passed on, but for
those named like a new one, which are replaced.
"""
from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain, islice

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, released, table
from .registry import register

LONG = 64
#: Bytes of known pieces (with 64 for each piece), rows that one query makes, DuckDB's memory.
REMEMBERED, AT_ONCE, MEMORY = 24 << 20, 4 << 20, "512MB"
#: Ids that are put together, decoded and sent on at once.
PART = 1 << 17

STEP = """
WITH RECURSIVE t(w, pos, id, live) AS (
  SELECT w, pos, id, true FROM tokens
  UNION ALL
  (WITH a AS MATERIALIZED (
     SELECT p.*, m.id AS merged
     FROM (SELECT w, pos, id, lead(id) OVER s AS id2, lag(pos) OVER s AS before
           FROM t WHERE live WINDOW s AS (PARTITION BY w ORDER BY pos)) p
     LEFT JOIN merges m ON m.l = p.id AND m.r = p.id2),
   b AS (SELECT w, min(merged::BIGINT * 4294967296 + pos) % 4294967296 AS spot FROM a WHERE merged IS NOT NULL GROUP BY w)
   SELECT a.w, pos, CASE WHEN pos = spot THEN merged ELSE id END, spot IS NOT NULL
   FROM a LEFT JOIN b ON a.w = b.w
   WHERE spot IS NULL OR before IS NULL OR before <> spot))
SELECT w, id FROM t WHERE NOT live ORDER BY w, pos
"""

STEP_LONG = """
WITH RECURSIVE t(w, pos, id, live) AS (
  SELECT w, pos, id, true FROM tokens
  UNION ALL
  SELECT w, pos, CASE WHEN taken THEN low ELSE id END, live
  FROM (
    SELECT *, coalesce(lag(taken) OVER (PARTITION BY w ORDER BY pos), false) AS gone
    FROM (
      SELECT w, pos, id, low, low IS NOT NULL AS live,
             hit AND (row_number() OVER (PARTITION BY w, island, hit ORDER BY pos)) % 2 = 1 AS taken
      FROM (
        SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY w ORDER BY pos ROWS UNBOUNDED PRECEDING) AS island
        FROM (
          SELECT *, coalesce(rank = low, false) AS hit
          FROM (
            SELECT a.*, m.id AS rank, min(m.id) OVER (PARTITION BY w) AS low
            FROM (SELECT w, pos, id, lead(id) OVER (PARTITION BY w ORDER BY pos) AS id2 FROM t WHERE live) a
            LEFT JOIN merges m ON m.l = a.id AND m.r = a.id2)))))
  WHERE NOT gone)
SELECT w, id FROM t WHERE NOT live ORDER BY w, pos
"""

DECODE = """
SELECT w, string_agg(v.chars, '' ORDER BY pos) AS chars, count(v.id) AS known, count(*) AS n
FROM tokens LEFT JOIN vocabulary v USING (id) GROUP BY w ORDER BY w
"""


def spans(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The values of all spans [start, start + count), one span after another."""
    ends = np.cumsum(counts)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)]


class Vocabulary:
    """One task's DuckDB session with the merge table and the vocabulary."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.words = {r: t for t, r in ranks.items()}
        self.fits: dict[tuple[int, int], bool] = {}  # whether two tokens are the encoding of their bytes
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        splits = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                  if t[:i] in ranks and t[i:] in ranks]
        merges = pa.table(dict(zip("lr", (pa.array(x, pa.int32()) for x in list(zip(*splits))[:2])))
                          | {"id": pa.array([x[2] for x in splits], pa.int32())})
        words = pa.table({"id": pa.array(ranks.values(), pa.int32()),
                          "chars": [t.decode("latin-1") for t in ranks]})  # one character a byte
        for name, t in (("merges", merges), ("vocabulary", words)):
            self.con.register("given", t)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.con.unregister("given")

    def _rows(self, sizes: np.ndarray, ids: np.ndarray) -> None:
        w = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        pos = (np.arange(len(w)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        self.con.register("tokens", pa.table({"w": w, "pos": pos, "id": pa.array(ids, pa.int32())}))

    def _contract(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of every piece (none empty), and all ids, by the recursive query."""
        sizes, ids, done = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], 0
        while done < len(pieces):
            end, most, long = done, 0, len(pieces[done]) > LONG
            while end < len(pieces) and (len(pieces[end]) > LONG) == long:
                most += len(pieces[end]) * (len(pieces[end]) + 1) // 2 + len(pieces[end])
                if end > done and most > AT_ONCE:
                    break
                end += 1
            some = pieces[done:end]
            self._rows(np.array([len(p) for p in some]), self.of_byte[np.frombuffer(b"".join(some), np.uint8)])
            got = self.con.execute(STEP_LONG if long else STEP).fetchnumpy()
            sizes.append(np.bincount(got["w"], minlength=len(some)))
            ids.append(np.asarray(got["id"], np.int32))
            done = end
        return np.concatenate(sizes), np.concatenate(ids)

    def _apart(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of every piece (none empty), one array each."""
        sizes, ids = self._contract(pieces)
        return np.split(ids, np.cumsum(sizes)[:-1]) if pieces else []

    def _joined(self, left: list[np.ndarray], right: list[np.ndarray]) -> list[np.ndarray]:
        """The encodings of left[i] + right[i], both encodings of their own bytes."""
        out: list = [None] * len(left)
        todo, k = list(range(len(left))), 0
        while todo:
            # the k tokens on both sides of the seam are encoded anew; then the neighbours there must fit
            middle = self._apart([self._bytes([*left[i][max(len(left[i]) - k, 0):], *right[i][:k]]) for i in todo]) if k else [
                np.zeros(0, np.int32)] * len(todo)
            made, pairs = [], []
            for i, new in zip(todo, middle):
                a, b = left[i][:max(len(left[i]) - k, 0)], right[i][k:]
                made.append((a, new, b))
                seams = [(a[-1:], new[:1]), (new[-1:], b[:1])] if k else [(a[-1:], b[:1])]
                pairs += [(i, (int(x[0]), int(y[0]))) for x, y in seams if len(x) and len(y)]
            if len(self.fits) > AT_ONCE >> 6:
                self.fits.clear()
            apart = sorted({p for _, p in pairs if p not in self.fits})
            if apart:
                for p, ids in zip(apart, self._apart([self._bytes(p) for p in apart])):
                    self.fits[p] = ids.tolist() == list(p)
            bad = {i for i, p in pairs if not self.fits[p]}
            for i, parts in zip(todo, made):
                if i not in bad:
                    out[i] = np.concatenate(parts)
            todo, k = [i for i in todo if i in bad], max(2, 2 * k)
        return out

    def _bytes(self, ids) -> bytes:
        return b"".join(self.words[i] for i in ids)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of every piece (none empty), and all ids."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        if not (size > LONG).any():
            return self._contract(pieces)
        n, ids = self._contract([p for p in pieces if len(p) <= LONG])
        found = self._encode_long([p for p in pieces if len(p) > LONG])
        counts = np.empty(len(pieces), np.int64)
        counts[size <= LONG], counts[size > LONG] = n, [len(x) for x in found]
        starts, of = np.empty(len(pieces), np.int64), np.concatenate([np.flatnonzero(size <= LONG), np.flatnonzero(size > LONG)])
        starts[of] = np.cumsum(counts[of]) - counts[of]
        return counts, spans(np.concatenate([ids, *found]), starts, counts)

    def _encode_long(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces over LONG bytes: their blocks' ids, joined in pairs."""
        blocks = [[p[i:i + LONG] for i in range(0, len(p), LONG)] for p in pieces]
        at = iter(self._apart(list(chain.from_iterable(blocks))))
        found = [[next(at) for _ in b] for b in blocks]
        left = [i for i, b in enumerate(found) if len(b) > 1]
        while left:  # all pieces' blocks are joined in pairs at once
            seams = [(i, j) for i in left for j in range(0, len(found[i]) - 1, 2)]
            joined = iter(self._joined([found[i][j] for i, j in seams], [found[i][j + 1] for i, j in seams]))
            for i in left:
                b = found[i]
                found[i] = [next(joined) if j + 1 < len(b) else b[j] for j in range(0, len(b), 2)]
            left = [i for i in left if len(found[i]) > 1]
        return [b[0] for b in found]

    def decode(self, sizes: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """Bytes of every sequence of ids."""
        out = [b""] * len(sizes)
        self._rows(sizes, ids)
        for w, chars, known, n in self.con.execute(DECODE).fetchall():
            if known < n:
                raise ValueError("an id is not in the vocabulary")
            out[w] = chars.encode("latin-1")
        return out


def _batches(batches: Iterator[pa.RecordBatch], column: str):
    for b in batches:
        k = b.schema.get_field_index(column)
        yield b, k, b.column(k)


class Numbers(dict):
    """Numbers the keys that are asked for, in order."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of ``pattern`` in a text.  Texts of the first 256 characters
    are split by the same pattern with its classes written out, which the
    standard library matches faster."""
    every = regex.compile(pattern).findall
    if pattern != public_tokenizers.PATTERN:
        return every

    def kind(*starts):
        return "".join(re.escape(chr(i)) for i in range(256) if unicodedata.category(chr(i)).startswith(starts))
    letter, number = kind("L"), kind("N")
    space = "".join(re.escape(chr(i)) for i in range(256) if regex.match(r"\p{White_Space}", chr(i)))
    narrow = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                        rf"|[{space}]+(?![^{space}])|[{space}]+").findall

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return every(text)
        return narrow(text)
    return split


def _parts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Rows [start, end) of at most ``most`` ids in all, or of one row."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + most, side="right")))
        yield at, to
        at = to


def _encoded(voc_of: Callable[[], Vocabulary], pattern: str) -> Callable[[pa.Array], Iterator[pa.ListArray]]:
    """Ids of the texts of a column, about ``PART`` at a time; known pieces are
    remembered from call to call."""
    split, known, weight = splitter(pattern), Numbers(), 0
    starts, counts, ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)  # of the known pieces, by their number

    def run(texts: pa.Array) -> Iterator[pa.ListArray]:
        nonlocal known, weight, starts, counts, ids
        if weight > REMEMBERED:
            known, weight, starts, counts, ids = Numbers(), 0, starts[:0], counts[:0], ids[:0]
        old = len(known)
        # the pieces of one text at a time, kept as their numbers
        docs = [np.fromiter(map(known.__getitem__, split(x.as_py() or "")), np.int32) for x in texts]
        new = [p.encode() for p in islice(known, old, None)]
        weight += 64 * len(new) + sum(map(len, new))
        n, found = voc_of().encode(new)
        del new
        starts = np.concatenate([starts, len(ids) + np.cumsum(n) - n])
        counts, ids = np.concatenate([counts, n]), np.concatenate([ids, found])
        sizes = np.array([counts[d].sum() for d in docs], np.int64)
        for at, to in _parts(sizes, PART):
            flat = np.concatenate(docs[at:to])
            ends = np.concatenate([[0], np.cumsum(sizes[at:to])])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(spans(ids, starts[flat], counts[flat]), pa.int32()))
    return run


def _given(ids: pa.ListArray) -> Iterator[pa.ListArray]:
    """The rows of a column of ids, about ``PART`` ids at a time."""
    for at, to in _parts(np.diff(ids.offsets.to_numpy()), PART):
        yield ids.slice(at, to - at)


def _decoded(voc: Vocabulary, ids: pa.ListArray) -> pa.Array:
    return pa.array(voc.decode(np.diff(ids.offsets.to_numpy()), ids.flatten().to_numpy()), pa.binary())


def coder(path: str, pattern: str | None, decodes: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """With ``pattern``, ids in place of text; with ``decodes``, the bytes of
    the ids as one more column; both by one session."""
    def run(batches):
        voc = None

        def session() -> Vocabulary:
            nonlocal voc
            voc = voc or Vocabulary(path)
            return voc
        parts = _encoded(session, pattern) if pattern else _given
        for b, k, given in _batches(batches, "text" if pattern else "ids"):
            if not b.num_rows:
                continue
            at = 0
            for ids in parts(given):
                cols = [ids if i == k else c.slice(at, len(ids)) for i, c in enumerate(b.columns)]
                names = ["ids" if i == k else n for i, n in enumerate(b.schema.names)]
                if decodes:
                    cols, names = [*cols, _decoded(session(), ids)], [*names, "decoded"]
                at += len(ids)
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return released(run)


_DECODED = T.StructField("decoded", T.BinaryType())


def _encoded_schema(docs: DataFrame) -> list[T.StructField]:
    return [T.StructField("ids", T.ArrayType(T.IntegerType())) if f.name == "text" else f for f in docs.schema.fields]


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` with ``ids`` (array of int) in place of ``text``."""
    docs = docs.drop("ids")
    return docs.mapInArrow(coder(path, pattern, False), T.StructType(_encoded_schema(docs)))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary) from its ``ids`` (no nulls)."""
    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(coder(path, None, True), T.StructType([*encoded.schema.fields, _DECODED]))


def round_trip(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Documents with ids, their count and digests of ids and decoded bytes;
    encoded and decoded in one step, so a task holds one vocabulary."""
    docs = docs.drop("ids", "decoded")
    both = docs.mapInArrow(coder(path, pattern, True), T.StructType([*_encoded_schema(docs), _DECODED]))
    return (both.withColumn("n_tokens", F.size("ids").cast("long"))
            .withColumn("ids_sha256", F.sha2(F.array_join("ids", " "), 256))
            .withColumn("decoded_sha256", F.sha2("decoded", 256)))


@register("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
