"""Vector codes by product quantisation with memoised grid cells.

Vectors are cut into equal consecutive parts; each part position has a
codebook of entries, and a part is coded by its nearest entry.  A part is not
compared with all of them: the coarse grid cell that holds it is looked up in
the task's memory, which keeps for every cell met so far the entries that can
be nearest to any point of the cell's box.  An entry is dominated, and left
out, if its least distance to the box is over another entry's greatest one.
Only the entries that stay are evaluated, exactly, so the codes are those of
the full search whatever the cells.  The width of the cells is a share of the
codebook's own spread: fine enough that most entries are left out.  Copies, and
parts that are close, share a cell; in many dimensions few others do.

The codebook starts as parts of given rows; each round assigns all parts and
moves every used entry to the floor of its parts' mean.  Tasks send on sums and
counts by entry; Spark adds them, and the driver reads one row for an entry's
component (at most entries x components of a vector) and sends the
codebook of the same size to the tasks.  Vectors are never shuffled.

Defined results: vectors that are null or hold null or non-finite components
are dropped; the parts of the longest vector (its length rounded up to a
multiple of the parts) are those of all, shorter ones are zero in the
components they lack; an id that is there several times is an entry once, with
its smallest vector, and null ids are none; with fewer ids than entries the
codebook is smaller; equal rows give equal results; an empty table, or one
without any id, gives no rows.  All numbers are integers; if a squared
distance may not fit 64 bits, the job fails.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, prepare, table
from .registry import register
from .vectors import finite, floors, matrix

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Width of a cell to the median distance from an entry to the next, cells and
#: entries that a task remembers for a part position, numbers worked on at once.
FINE, CELLS, KEPT, AT_ONCE = 0.5, 1 << 16, 1 << 22, 1 << 21


class Cells:
    """A task's memory of grid cells for one part position: the entries not
    dominated in a cell, numbered in ascending order."""

    def __init__(self, book: np.ndarray, width: int):
        self.book, self.width = book, width
        self.known: dict[bytes, int] = {}
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.entries = np.zeros(0, np.int32)
        self.evaluated = self.asked = 0

    def _learn(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and entries of new cells (rows of cell numbers)."""
        step = max(1, AT_ONCE // max(len(self.book), 1))
        sizes, entries = [], []
        for at in range(0, len(cells), step):
            some = cells[at:at + step]
            least, most = np.zeros((2, len(some), len(self.book)), np.int64)
            for j in range(some.shape[1]):  # a side of a box is met by many cells
                side, back = np.unique(some[:, j], return_inverse=True)
                low = (side * self.width)[:, None] - self.book[:, j]
                high = -(low + self.width - 1)  # parts are integers
                out = np.maximum(0, np.maximum(low, high))
                far = np.maximum(np.abs(low), np.abs(high))
                least += (out * out)[back]
                most += (far * far)[back]
            stay = least <= most.min(-1, keepdims=True)
            sizes.append(stay.sum(-1))
            entries.append(np.nonzero(stay)[1].astype(np.int32))
        return np.concatenate(sizes), np.concatenate(entries)

    def _lists(self, x: np.ndarray) -> np.ndarray:
        """Number of the cell of every part; cells not met before are added."""
        cells = np.ascontiguousarray(x // self.width)
        if not cells.shape[1]:
            cells = np.zeros((len(x), 1), np.int64)
        keys = cells.view(np.dtype((np.void, cells.dtype.itemsize * cells.shape[1]))).ravel()
        _, first, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) + len(first) > CELLS or len(self.entries) > KEPT:
            self.__init__(self.book, self.width)
        names = [keys[i].tobytes() for i in first]
        new = [i for i, k in enumerate(names) if k not in self.known]
        if new:
            sizes, entries = self._learn(x[first[new]] // self.width)
            for i in new:
                self.known[names[i]] = len(self.known)
            self.starts = np.concatenate([self.starts, len(self.entries) + np.cumsum(sizes) - sizes])
            self.sizes, self.entries = np.concatenate([self.sizes, sizes]), np.concatenate([self.entries, entries])
        return np.array([self.known[k] for k in names], np.int64)[back]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of every part, ties to the lower one, and the squared distance."""
        codes, dist = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        cell = self._lists(x)
        size = self.sizes[cell]
        self.asked, self.evaluated = self.asked + len(x), self.evaluated + int(size.sum())
        ends = np.cumsum(size)
        most = max(1, AT_ONCE // max(x.shape[1], 1))
        at = 0
        while at < len(x):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
            n = size[at:to]
            begin = np.cumsum(n) - n
            entry = self.entries[np.arange(n.sum()) + np.repeat(self.starts[cell[at:to]] - begin, n)]
            gap = np.repeat(x[at:to], n, axis=0) - self.book[entry]
            d = np.einsum("ij,ij->i", gap, gap)
            low = np.minimum.reduceat(d, begin)
            hit = np.flatnonzero(d == np.repeat(low, n))
            row = np.repeat(np.arange(to - at), n)[hit]
            _, first = np.unique(row, return_index=True)
            codes[at:to], dist[at:to] = entry[hit[first]], low
            at = to
        return codes, dist


def _width(book: np.ndarray) -> int:
    """Width of a position's cells: a share of the median distance from an
    entry to the next one, spread over the components."""
    if len(book) < 2 or not book.shape[1]:
        return 1 << 20
    x = book.astype(float)
    gap = np.maximum(0, (x * x).sum(1)[:, None] + (x * x).sum(1) - 2 * x @ x.T)
    np.fill_diagonal(gap, np.inf)
    return max(1, int(np.sqrt(np.median(gap.min(1)) / x.shape[1]) * FINE))


def _start(books: list[np.ndarray]) -> list[Cells]:
    return [Cells(b, _width(b)) for b in books]


def _parts(col: pa.Array, books: list[np.ndarray]) -> np.ndarray:
    """Vectors as (row, part, component)."""
    width = books[0].shape[1]
    return matrix(col, width * len(books)).reshape(len(col), len(books), width)


def _moved(vectors: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: used entries are the floors of their parts' means."""
    parts, (entries, width) = len(books), books[0].shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _start(books)
        total, count = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for b in batches:
            x = _parts(b.column(0), books)
            for p, cells in enumerate(memory):
                code, _ = cells.nearest(x[:, p])
                count[p] += np.bincount(code, minlength=entries)
                order = np.argsort(code, kind="stable")
                used, first = np.unique(code[order], return_index=True)
                if len(used):
                    total[p, used] += np.add.reduceat(x[order, p], first, axis=0)
        used = np.flatnonzero(count.ravel())
        for at in range(0, len(used), 64):
            some = used[at:at + 64]
            flat = total.reshape(-1, width)[some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(some, width)), pa.array(np.tile(np.arange(width), len(some))), pa.array(flat.ravel()),
                 pa.array(np.repeat(count.ravel()[some], width))], names=["entry", "at", "total", "n"])

    if not width:
        return books
    found = (vectors.select("v").mapInArrow(sums, "entry long, at long, total long, n long")
             .groupBy("entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toPandas())
    new = np.stack(books).reshape(-1, width).copy()
    new[found["entry"], found["at"]] = found["total"].to_numpy() // found["n"].to_numpy()  # towards minus infinity
    return list(new.reshape(parts, entries, width))


def learn(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks (entry x component, one a part) learned from ``vectors``
    (vec_id, v array of long), started as the ``entries`` smallest ids."""
    dims, low, high = vectors.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    width = -(-(dims or 0) // parts)
    gap = max((high or 0) - (low or 0), high or 0, -(low or 0)) * 4  # boxes of cells reach beyond the components
    if gap * gap * max(width, 1) >= 2**63:
        raise OverflowError("a squared distance may not fit 64 bits")
    first = (vectors.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("v").alias("v"))
             .orderBy("vec_id").limit(entries).toArrow())
    x = matrix(first["v"], width * parts).reshape(first.num_rows, parts, width)
    books = [x[:, p].copy() for p in range(parts)]
    for _ in range(rounds if first.num_rows else 0):
        books = _moved(vectors, books)
    return books


def code(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vectors`` without v, with ``codes`` (array of int, one a part) and
    ``error`` (squared distances summed over the parts)."""
    rest = vectors.drop("codes", "error").schema.fields
    names = [f.name for f in rest if f.name != "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _start(books)
        for b in batches:
            x = _parts(b.column(b.schema.get_field_index("v")), books)
            found = [cells.nearest(x[:, p]) for p, cells in enumerate(memory)]
            codes = np.stack([f[0] for f in found], axis=1).astype(np.int32)
            codes = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(books), pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(n)) for n in names), codes,
                                              pa.array(sum(f[1] for f in found))], names=[*names, "codes", "error"])

    kept = vectors.select(*names, "v").where(F.lit(len(books[0]) > 0))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest if f.name != "v")
    return kept.mapInArrow(run, f"{schema}, codes array<int>, error long")


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def _oracle() -> str:
    """The rounds written out; squared distances by exact products of doubles."""
    sql = ["""k AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT (max(len(v)) + 3) // 4 AS w FROM k),
p AS MATERIALIZED (
  SELECT r, vec_id, part, list_slice(list_resize(v, 4 * w, 0.0::DOUBLE), part * w + 1, (part + 1) * w) AS x FROM k, w, range(4) t(part)),
c0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x AS y FROM p
  WHERE r IN (SELECT r FROM (SELECT r, vec_id FROM k WHERE vec_id IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY v) = 1) ORDER BY vec_id LIMIT 256))"""]
    for i in range(ROUNDS + 1):
        sql.append(f"""a{i} AS MATERIALIZED (
  SELECT r, part, min((list_inner_product(x, x) + list_inner_product(y, y) - 2 * list_inner_product(x, y))::BIGINT * 256 + e) AS m
  FROM p JOIN c{i} USING (part) GROUP BY r, part)""")
        if i < ROUNDS:
            sql.append(f"""s{i} AS (
  SELECT part, m % 256 AS e, pos, sum(x[pos]::BIGINT)::BIGINT AS s, count(*) AS n
  FROM a{i} JOIN p USING (r, part), w, range(1, w.w + 1) u(pos) GROUP BY ALL),
m{i} AS (SELECT part, e, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY pos) AS y FROM s{i} GROUP BY ALL),
c{i + 1} AS MATERIALIZED (SELECT part, e, coalesce(m{i}.y, c{i}.y) AS y FROM c{i} LEFT JOIN m{i} USING (part, e))""")
    return "WITH " + ",\n".join(sql) + f""",
d AS (SELECT sha256(string_agg(array_to_string(list_transform(y, lambda x: x::BIGINT), ','), ',' ORDER BY part, e)) AS h FROM c{ROUNDS}),
f AS (
  SELECT r, string_agg(format('{{:02x}}', m % 256), '' ORDER BY part) AS code, sum(m // 256)::BIGINT AS error FROM a{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM f JOIN k USING (r), d"""


@register("op12_cell_codes", _oracle())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = cut(table(spark, sf_dir, "embeddings").where(finite("embedding")).select(
        "vec_id", "label", floors("embedding", 1024).alias("v")))
    books = learn(rows)
    coded = cut(code(rows, books))
    every = coded.groupBy(F.col("label").alias("_l")).agg(F.sum("error").alias("label_error"))
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return coded.join(every, F.col("label").eqNullSafe(F.col("_l"))).select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
