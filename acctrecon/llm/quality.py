"""Quality classifier: a linear-chain conditional random field over lines.

A document is a chain of lines, each good or bad.  A line's emission score is
linear in its own features and those of the lines before and after it; a
transition score couples neighbouring lines.  Training lines carry their
document's label.  Forward-backward gives each line's marginal probability of
good, and the mean of the marginals, weighted by line length, is the
document's quality.

The field is fitted on a bounded sample: at most ``TRAIN_DOCS`` labelled
documents of at most ``TRAIN_LINES`` lines, in hash order.  The features of
all documents are computed and scored in Arrow batches by Spark.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrecon.llm.common import batches, rows_of, utf8

#: Bounds of the training sample.
TRAIN_DOCS = 4000
TRAIN_LINES = 400
STEPS = 150
RATE = 0.1
PENALTY = 1e-3
#: Bytes of one long line that are worked on together.
_BLOCK = 1 << 20

_CLASSES = ["lower", "upper", "digit", "space", "stop", "bang", "bar", "symbol", "high"]
_CLASS = np.full(256, _CLASSES.index("symbol"), dtype=np.uint8)
for _name, _bytes in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)),
                      ("space", [9, 10, 11, 12, 13, 32]), ("stop", b".,;:'\"()-?"), ("bang", b"!"),
                      ("bar", b"|"), ("high", range(128, 256))):
    _CLASS[list(_bytes)] = _CLASSES.index(_name)
_MARKS = frozenset(np.flatnonzero(np.isin(_CLASS, [_CLASSES.index("bang"), _CLASSES.index("symbol")])).tolist())
#: Own features of a line: length, word count, mean word length, share of
#: distinct words, share of words equal to the one before, share of words
#: ending in a symbol, then the shares of the byte classes.
OWN = 6 + len(_CLASSES)


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lines x OWN features, line lengths plus one) of a UTF-8 text."""
    lines = text.split(b"\n")
    x = np.zeros((len(lines), OWN))
    sizes = np.array([len(s) for s in lines], dtype=np.int64)
    counts = np.zeros((len(lines), len(_CLASSES)))
    raw, before = np.frombuffer(text, dtype=np.uint8), 0
    for at in range(0, len(raw), _BLOCK):
        part = raw[at:at + _BLOCK]
        ends = part == 10
        passed = np.cumsum(ends)
        line = before + passed - ends
        before += int(passed[-1])
        counts += np.bincount(line * len(_CLASSES) + _CLASS[part], minlength=counts.size).reshape(counts.shape)
    counts[:-1, _CLASSES.index("space")] -= 1  # the newline itself
    x[:, 6:] = counts / np.maximum(sizes, 1)[:, None]
    x[:, 0] = np.log1p(sizes)
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words)
        if n:
            x[i, 1] = math.log1p(n)
            x[i, 2] = math.log1p((len(line) - n + 1) / n)
            x[i, 3] = len(set(words)) / n
            x[i, 4] = sum(map(bytes.__eq__, words, words[1:])) / n
            x[i, 5] = sum([w[-1] in _MARKS for w in words]) / n
    return x, sizes + 1


def with_neighbours(x: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and the line after (zeros with
    a flag where there is none), and a constant."""
    n, gap = len(x), np.zeros((1, x.shape[1]))
    edge = np.zeros((n, 3))
    edge[0, 0] = edge[-1, 1] = edge[:, 2] = 1
    return np.hstack([x, np.vstack([gap, x[:-1]]), np.vstack([x[1:], gap]), edge])


@dataclass
class LineField:
    """weights: emission score of good over bad; links: scores of bad after
    bad and good after good over a change."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(OWN))
    scale: np.ndarray = field(default_factory=lambda: np.ones(OWN))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(3 * OWN + 3))
    links: np.ndarray = field(default_factory=lambda: np.zeros(2))

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return with_neighbours((x - self.mean) / self.scale) @ self.weights

    def marginals(self, scores: np.ndarray) -> np.ndarray:
        """P(good) of each line, from log-odds passed along the chain."""
        a, b = float(self.links[0]), float(self.links[1])
        s, n = scores.tolist(), len(scores)
        ahead, back = [0.0] * n, [0.0] * n
        for i in range(1, n):
            ahead[i] = _pass(s[i - 1] + ahead[i - 1], a, b)
        for i in range(n - 2, -1, -1):
            back[i] = _pass(s[i + 1] + back[i + 1], a, b)
        z = np.array(s) + np.array(ahead) + np.array(back)
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))

    def score(self, text: bytes) -> float:
        x, sizes = line_features(text)
        return float(np.average(self.marginals(self.emissions(x)), weights=sizes))


def _pass(odds: float, a: float, b: float) -> float:
    """Log-odds of a line from its neighbour's: log (e^(b+odds) + 1) / (e^odds + e^a)."""
    return _add(b + odds, 0.0) - _add(odds, a)


def _add(x: float, y: float) -> float:
    top = x if x > y else y
    return top + math.log1p(math.exp(-abs(x - y)))


def fit(chains: list[tuple[np.ndarray, int, float]]) -> LineField:
    """Maximum penalised likelihood by full-batch Adam.  chains: own features
    of a document's lines, its label, its weight."""
    model = LineField()
    if not chains:
        return model
    every = np.vstack([x for x, _, _ in chains])
    model.mean, model.scale = every.mean(axis=0), every.std(axis=0) + 1e-6
    chains = sorted(chains, key=lambda c: -len(c[0]))
    lens = np.array([len(x) for x, _, _ in chains])
    d, t = len(chains), int(lens[0])
    rows = np.vstack([with_neighbours((x - model.mean) / model.scale) for x, _, _ in chains])
    doc = np.repeat(np.arange(d), lens)
    line = np.concatenate([np.arange(n) for n in lens])
    label = np.array([y for _, y, _ in chains], dtype=float)
    share = np.array([w for _, _, w in chains])
    share = share / share.sum()
    live = [int((lens > i).sum()) for i in range(t)]  # chains are sorted: the first ones
    theta = np.zeros(rows.shape[1] + 2)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, (a, b) = theta[:-2], theta[-2:]
        s = np.zeros((d, t))
        s[doc, line] = rows @ w
        ahead, back = np.zeros((d, t)), np.zeros((d, t))
        go = lambda o: np.logaddexp(b + o, 0) - np.logaddexp(o, a)
        for i in range(1, t):
            k = live[i]
            ahead[:k, i] = go(s[:k, i - 1] + ahead[:k, i - 1])
        for i in range(t - 2, -1, -1):
            k = live[i + 1]
            back[:k, i] = go(s[:k, i + 1] + back[:k, i + 1])
        good = 1 / (1 + np.exp(-np.clip(s + ahead + back, -700, 700)))
        g = rows.T @ ((label[doc] - good[doc, line]) * share[doc])
        both = np.zeros(2)
        for i in range(1, t):  # expected bad-bad and good-good steps
            k = live[i]
            left, right = s[:k, i - 1] + ahead[:k, i - 1], s[:k, i] + back[:k, i]
            z = np.stack([np.full(k, a), right, left, b + left + right])
            z = np.exp(z - z.max(axis=0))
            z /= z.sum(axis=0)
            both += [((1 - label[:k] - z[0]) * share[:k]).sum(), ((label[:k] - z[3]) * share[:k]).sum()]
        grad = np.concatenate([g, both]) - PENALTY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    model.weights, model.links = theta[:-2], theta[-2:]
    return model


def _label_table(labels: DataFrame) -> DataFrame:
    """One label for each doc_id; contradicting and null labels are none."""
    return (labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id")
            .agg(F.min("quality").cast("int").alias("label"), F.max("quality").alias("_most"))
            .where("label = _most").select(F.col("doc_id").alias("_d"), "label"))


def held_out(column):
    """Every third document by checksum: never learned from."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(3)) == 1


def train(docs: DataFrame, labels: DataFrame, *, most_docs: int = TRAIN_DOCS,
          most_lines: int = TRAIN_LINES) -> LineField:
    """Fit the field on at most ``most_docs`` labelled documents that are not
    held out, half of them of each class where there are enough, weighted
    back to the classes' shares.  Without labels all scores are one half."""
    known = _label_table(labels).where(~held_out(F.col("_d")))
    shares = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    order = F.xxhash64("_d")
    sample = None
    for label in shares:
        part = known.where(F.col("label") == label).orderBy(order, "_d").limit(most_docs // 2)
        sample = part if sample is None else sample.union(part)
    if sample is None:
        return LineField()

    def run(stream):
        schema = pa.schema([("label", pa.int32()), ("x", pa.binary())])

        def rows():
            for label, text in rows_of(stream):
                if text.count(b"\n") < most_lines:
                    yield label, line_features(text)[0].tobytes()
        yield from batches(rows(), schema, lambda r: len(r[1]) + 64)

    # the sample has most_docs rows at most, so its ids may be broadcast; an id
    # that repeats over many rows counts once, with the smallest of its texts
    got = (docs.select(F.col("doc_id"), utf8("text").alias("text"))
           .join(F.broadcast(sample), F.col("doc_id") == F.col("_d"))
           .groupBy("_d", "label").agg(F.min("text").alias("text")).select("label", "text")
           .mapInArrow(run, "label int, x binary").collect())
    n = {k: max(1, sum(r.label == k for r in got)) for k in shares}
    got.sort(key=lambda r: (r.label, bytes(r.x)))  # the same fit whatever the order of rows
    return fit([(np.frombuffer(r.x).reshape(-1, OWN), r.label, shares[r.label] / n[r.label]) for r in got])


def score_documents(docs: DataFrame, model: LineField) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score (0 to 1),
    predicted (1 if score >= 0.5).

    Null and empty texts are one empty line and have a score.  Null doc_ids
    (held_out is then null) and repeated rows are carried through; other
    columns are not read.  An empty table gives an empty result.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(stream):
        yield from batches(((i, model.score(t)) for i, t in rows_of(stream)), schema)

    return (docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
            .mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: LineField) -> DataFrame:
    """The rows of ``docs`` with a score of one half or more, all columns.

    Null and empty texts are judged as one empty line.  Each row is judged by
    its text alone, so repeated rows, rows without a doc_id and ties of any
    kind need no rule; further columns may have any name; an empty table gives
    an empty result.
    """
    @F.pandas_udf("double")
    def quality(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(bytes(t)) for t in texts], dtype="float64")

    return docs.where(quality(utf8("text")) >= 0.5)
