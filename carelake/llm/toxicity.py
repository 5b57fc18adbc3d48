"""Toxicity by weak supervision.

Three steps, each over tables:

1. Voters.  Every voter is a lexicon or a pattern that fires on a document or
   abstains: public insult words, words and word beginnings mined from a
   bounded sample of labelled rows (dealt by rank into several voters each,
   some speaking for toxic and some for clean text), and shapes of text.
   Whole texts of all documents are read.
2. Label model.  A generative model with one firing rate per voter and class
   is fitted by expectation-maximization over the vote patterns of the whole
   corpus, rows with a usable label keeping it.  Correlations of voters within
   a class are estimated from the same sums, and a voter's evidence is divided
   by one plus its correlations with the others, so copies of a voter do not
   count again.
3. Classifier.  A logistic regression on hashed words, word beginnings and
   votes is trained on the posterior labels of a bounded sample of documents
   and scores every document.

Bounds: ``SAMPLE`` rows are taken, by the hash of their doc_id, for mining and
``TRAINED`` for training; only sums over voters, the mined lexicon and the weights reach
the driver.  Rows of the held-out fold (crc32 of the id as text, modulo 5,
equal 0) give neither labels nor training documents.

Defined results: null or empty texts get the score of a text on which no voter
fires; a null doc_id counts as held out; null labels are no labels, of several
labels of an id the largest counts; of several texts of an id the one with the
smallest XXH64 is mined and trained on, all are scored; without labels of both classes only the
public lexicon speaks; equal rows get equal scores; an empty table gives no
rows; other columns are never inputs.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, prepare, release, released, table
from .registry import register

#: Rows of the labelled sample that is mined, and of the sample trained on.
SAMPLE, TRAINED = 10_000, 10_000
FOLDS = 5
STEPS = 150
#: Common English insults.
INSULTS = """clown creep disgusting dumb fool garbage idiot idiotic imbecile jerk loser losers lunatic moron
moronic morons nasty pathetic pig pigs scum scumbag shut stupid sucks trash ugly vermin worthless""".split()
BUCKETS = 1 << 22
WEIGHTS = 1 << 18
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: Voters: public lexicon, mined words, mined beginnings, mined clean words and beginnings, shapes of text.
N_SEED, N_WORD, N_BEGIN, N_CLEAN, N_SHAPE = 3, 6, 8, 4, 3
N_VOTERS = N_SEED + N_WORD + N_BEGIN + N_CLEAN + N_SHAPE
#: Mined entries of a class and kind, and documents an entry must be in.
ENTRIES, SUPPORT, SURE = 240, 4, 26
ROUNDS = 6
_words = re.compile(r"[^\W\d_]+").findall
#: Weights are scored as integers, in units of 1 / SCALE.
SCALE = 1 << 24
#: Words a task remembers.
REMEMBERED = 300_000


def entries(word: str) -> list[int]:
    """Hashes of a word (even) and of its beginnings (odd)."""
    return [zlib.crc32(word.encode()) * 2 % BUCKETS] + [
        (zlib.crc32(b"^" + word[:n].encode()) * 2 + 1) % BUCKETS for n in BEGINNINGS if n <= len(word)]


def shapes(text: str) -> int:
    """Bits of the shape voters: shouting, exclamation marks, many of the latter."""
    n = max(len(text), 1)
    marks, words = text.count("!"), text.split()
    shout = sum(map(str.isupper, words)) * 2 > max(len(words), 1)
    return int(shout) | int(marks * 50 > n) << 1 | int(marks >= 3) << 2


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def in_one(learn: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``learn``, a function of a bounded sample, that gives its memory back."""
    def run(t: pa.Table) -> pa.Table:
        out = learn(t)
        release()
        return out
    return run


def mine(t: pa.Table) -> pa.Table:
    """(entry, voter) from sampled documents with ``entries`` and ``toxic``."""
    y = t["toxic"].to_numpy()
    found: dict[int, int] = {}
    if 0 < y.sum() < len(y):
        lists = t["entries"].combine_chunks()
        flat, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        pos, neg = np.zeros(BUCKETS, np.int32), np.zeros(BUCKETS, np.int32)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for at in range(0, len(y), 256):
            to = min(at + 256, len(y))
            # an entry counts once a document, however many of its words begin so
            once = np.unique(np.repeat(np.arange(at, to), sizes[at:to]) * BUCKETS + flat[ends[at]:ends[to]])
            of = y[once // BUCKETS]
            np.add.at(pos, once[of == 1] % BUCKETS, 1)
            np.add.at(neg, once[of == 0] % BUCKETS, 1)
        some = np.flatnonzero((pos >= SUPPORT) | (neg >= 4 * SUPPORT))  # all that may be chosen below
        pos, neg = pos[some].astype(np.int64), neg[some].astype(np.int64)
        p, n = (pos + 0.1) / (y.sum() + 0.2), (neg + 0.1) / ((1 - y).sum() + 0.2)
        gain = np.log(p / n)
        # likelihood ratio of the counts against equal rates: entries of chance stay out
        share, seen = y.mean(), np.maximum(pos + neg, 1)
        sure = pos * np.log(np.maximum(pos, 0.1) / (seen * share)) + neg * np.log(np.maximum(neg, 0.1) / (seen * (1 - share)))
        sure = 2 * sure > SURE
        first = N_SEED
        for kind, voters in ((0, N_WORD), (1, N_BEGIN)):
            mine_ = (some % 2 == kind) & (pos >= SUPPORT) & (gain > 1.6) & sure
            best = np.flatnonzero(mine_)
            best = best[np.argsort(-(gain * np.sqrt(pos))[best], kind="stable")][:ENTRIES]
            for r, e in enumerate(some[best].tolist()):
                found[e] = first + r % voters
            first += voters
        calm = np.flatnonzero((neg >= 4 * SUPPORT) & (gain < -1.2) & sure)
        for r, e in enumerate(some[calm[np.argsort((gain * np.sqrt(neg))[calm], kind="stable")][:ENTRIES]].tolist()):
            found[e] = first + r % N_CLEAN
    return pa.table({"entry": pa.array(found.keys(), pa.int32()), "voter": pa.array(found.values(), pa.int32())})


class Reader:
    """Votes (a bit mask) and weight (an integer sum, so that no order of words
    matters) of a text's distinct words; remembers words, within a bound."""

    def __init__(self, lexicon: dict[int, int], weights: np.ndarray | None = None):
        self.lexicon, self.known = lexicon, {}
        self.seed = {w: 1 << i % N_SEED for i, w in enumerate(INSULTS)}
        self.weights = None if weights is None else np.round(weights * SCALE).astype(np.int64).tolist()

    def word(self, word: str) -> tuple[int, int, int]:
        bits, weight, found = self.seed.get(word, 0), 0, entries(word)
        for e in found:
            if e in self.lexicon:
                bits |= 1 << self.lexicon[e]
            if self.weights:
                weight += self.weights[e % WEIGHTS]
        return bits, weight, len(found)

    def __call__(self, text: str | None) -> tuple[int, int, int]:
        """Votes, weight, and the number of entries."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        known, bits, weight, n = self.known, 0, 0, 0
        for w in set(_words((text or "").lower())):
            hit = known.get(w)
            if hit is None:
                hit = known[w] = self.word(w)
            bits |= hit[0]
            weight += hit[1]
            n += hit[2]
        return bits | shapes(text or "") << (N_VOTERS - N_SHAPE), weight, n


def _known_or(labels: pa.Array, p: np.ndarray) -> np.ndarray:
    """The labels where there are some, else ``p``."""
    y = np.array([np.nan if x is None else x for x in labels.to_pylist()], np.float64)
    return np.where(np.isnan(y), p, y)


def _fired(bits: np.ndarray) -> np.ndarray:
    return (bits[:, None] >> np.arange(N_VOTERS) & 1).astype(np.float64)


class LabelModel:
    """Firing rates of the voters by class, class balance, and by how much
    correlations discount each voter."""

    def __init__(self):
        speaks = np.array([3.0] * (N_SEED + N_WORD + N_BEGIN) + [-0.7] * N_CLEAN + [0.0] * N_SHAPE)
        self.prior = -2.0
        self.on, self.off, self.discount = speaks, np.zeros(N_VOTERS), np.full(N_VOTERS, 0.5)

    def posterior(self, bits: np.ndarray) -> np.ndarray:
        f = _fired(bits)
        z = self.prior + f @ (self.on * self.discount) + (1 - f) @ (self.off * self.discount)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def fit(self, sums: np.ndarray) -> None:
        """``sums``: for either class the weighted second moments of (votes, 1)."""
        n = sums[:, -1, -1] + 1.0
        rate = (sums[:, -1, :-1] + np.array([[0.02], [0.02]])) / (n[:, None] + 0.04)
        rate = np.clip(rate, 1e-4, 1 - 1e-4)
        self.prior = float(np.log(n[1] / n[0]))
        self.on, self.off = np.log(rate[1] / rate[0]), np.log((1 - rate[1]) / (1 - rate[0]))
        both = np.zeros((N_VOTERS, N_VOTERS))
        for k in (0, 1):
            cov = sums[k, :-1, :-1] / n[k] - np.outer(rate[k], rate[k])
            sd = np.sqrt(rate[k] * (1 - rate[k]))
            both = np.maximum(both, cov / np.outer(sd, sd))
        np.fill_diagonal(both, 0)
        self.discount = 1 / (1 + np.clip(both, 0, 1).sum(1))


def label_model(votes: DataFrame) -> LabelModel:
    """Fitted over ``votes`` (bits, toxic or null) of all documents."""
    model = LabelModel()
    patterns = cut(votes.groupBy("bits", "toxic").agg(F.count(F.lit(1)).alias("n")))
    side = N_VOTERS + 1

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, side, side))
        for b in batches:
            if not b.num_rows:
                continue
            bits, n = b.column(0).to_numpy(), b.column(2).to_numpy().astype(np.float64)
            p = _known_or(b.column(1), model.posterior(bits))
            f = np.column_stack([_fired(bits), np.ones(len(bits))])
            for k, w in ((0, n * (1 - p)), (1, n * p)):
                total[k] += (f * w[:, None]).T @ f
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "x"])

    for _ in range(ROUNDS):
        got = patterns.mapInArrow(moments, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).toPandas()
        sums = np.zeros(2 * side * side)
        sums[got["at"].to_numpy(np.int64)] = got["x"].to_numpy()
        model.fit(sums.reshape(2, side, side))
    return model


def train(t: pa.Table) -> pa.Table:
    """Weights (as bytes) of a logistic regression on the entries of ``words``,
    on ``bits`` and the posterior ``p`` of sampled documents: votes, hashed
    entries, intercept.  A step sums entries by distinct word and words by
    document, so an entry is read once a word and not once a document."""
    lists = t["words"].combine_chunks()
    docs, words = len(lists), lists.flatten().dictionary_encode()
    row = np.repeat(np.arange(docs), np.diff(lists.offsets.to_numpy()))
    at = words.indices.to_numpy()  # the distinct word of each word
    found = [entries(w) for w in words.dictionary.to_pylist()]
    many = np.array([len(x) for x in found], np.int64)
    of = np.repeat(np.arange(len(found)), many)
    col = np.array([e for x in found for e in x], np.int64) % WEIGHTS
    used = np.bincount(at, minlength=len(found))
    common = np.bincount(col, used[of], minlength=WEIGHTS)[col] >= SUPPORT  # rarer ones teach nothing
    scale = 1 / np.sqrt(np.maximum(np.bincount(row, many[at], minlength=docs), 1))
    of, col = of[common], col[common]
    f = _fired(t["bits"].to_numpy())
    p = t["p"].to_numpy()
    n = max(len(p), 1)
    size = N_VOTERS + WEIGHTS + 1
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    w[-1] = -2.0
    for step in range(1, STEPS + 1):
        of_word = np.bincount(of, w[N_VOTERS + col], minlength=len(found))
        z = f @ w[:N_VOTERS] + np.bincount(row, of_word[at], minlength=docs) * scale + w[-1]
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - p
        of_word = np.bincount(at, (err * scale)[row], minlength=len(found))
        g = np.concatenate([f.T @ err, np.bincount(col, of_word[of], minlength=WEIGHTS), [err.sum()]]) / n
        g[:N_VOTERS] += 1e-4 * w[:N_VOTERS]
        g[N_VOTERS:-1] += 2e-5 * w[N_VOTERS:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.15 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return pa.table({"w": [w.astype(np.float32).tobytes()]})


def _with_entries(docs: DataFrame, extra: str) -> DataFrame:
    """``entries`` of each text beside the other columns (doc_id first, text second)."""
    def run(batches):
        for b in batches:
            found = [[e for w in sorted(set(_words((x or "").lower()))) for e in entries(w)] for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), *b.columns[2:]],
                                             names=["entries", *b.schema.names[2:]])
    return docs.mapInArrow(released(run), f"entries array<int>, {extra}")


def _to_train(docs: DataFrame, lexicon: dict[int, int], model: LabelModel) -> DataFrame:
    """Distinct ``words``, votes and posterior of documents (doc_id, text, toxic)."""
    def run(batches):
        read = Reader(lexicon)
        for b in batches:
            texts = b.column(1).to_pylist()
            found = [sorted(set(_words((x or "").lower()))) for x in texts]
            bits = np.array([read(x)[0] for x in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.string())), pa.array(bits), pa.array(_known_or(b.column(2), model.posterior(bits)))],
                names=["words", "bits", "p"])
    return docs.mapInArrow(released(run), "words array<string>, bits long, p double")


def _sampled(rows: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """At most ``size`` documents of ``rows`` (one a doc_id, and more columns), by the
    hash of the id.  An id that is there more than once gives the text with the
    smallest hash, so it is one document and the same one in each run."""
    few = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)  # broadcast: at most so many narrow rows
    rest = [c for c in rows.columns if c != "doc_id"]
    text = F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")
    return docs.join(F.broadcast(few), "doc_id").groupBy("doc_id", *rest).agg(text).select("doc_id", "text", *rest)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and other columns) with ``score``, the
    probability of the label toxic."""
    whole, docs = docs, docs.select("doc_id", "text")
    usable = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    found = (_with_entries(_sampled(usable, docs, SAMPLE), "toxic int")
             .withColumn("all", F.lit(1)).groupBy("all").applyInArrow(in_one(mine), "entry int, voter int").collect())  # a bounded lexicon
    lexicon = {r.entry: r.voter for r in found}

    def vote(batches):
        read = Reader(lexicon)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([read(x)[0] for x in b.column(1).to_pylist()], pa.int64())], names=["doc_id", "bits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    votes = cut(docs.mapInArrow(released(vote), f"doc_id {kind}, bits long"))
    learn = votes.join(usable, "doc_id", "left")
    model = label_model(learn.select("bits", "toxic"))

    pool = learn.where(fold(F.col("doc_id")) != 0).select("doc_id", "toxic").dropDuplicates()  # one label an id
    got = (_to_train(_sampled(pool, docs, TRAINED), lexicon, model)
           .withColumn("all", F.lit(1)).groupBy("all").applyInArrow(in_one(train), "w binary").collect())  # one row of weights
    w = np.frombuffer(got[0].w, np.float32) if got else np.zeros(N_VOTERS + WEIGHTS + 1, np.float32)

    at = whole.columns.index("text")

    def score(batches):
        read = Reader(lexicon, w[N_VOTERS:-1].astype(np.float64))
        for b in batches:
            got = np.array([read(x) for x in b.column(at).to_pylist()], np.int64).reshape(-1, 3)
            z = (float(w[-1]) + _fired(got[:, 0]) @ w[:N_VOTERS].astype(np.float64)
                 + got[:, 1] / SCALE / np.sqrt(np.maximum(got[:, 2], 1)))
            out = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], names=[*b.schema.names, "score"])

    return whole.mapInArrow(released(score), T.StructType([*whole.schema.fields, T.StructField("score", T.DoubleType())]))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is under one half."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    return toxicity(rows, labels).where("score < 0.5").select("_row.*")


@register("op3_weak_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
