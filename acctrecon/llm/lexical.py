"""Ranked lexical search with no random access (NRA).

The index deals the documents to shards of bounded size.  A shard holds, for
each term, its postings sorted by impact, so a term's list is only ever read
from the front.  For a query every list of the shard is read down to a level
of impact that falls by half each round.  A document that has been met has a
lower bound (what has been read) and an upper one (plus what the lists that
have not shown it can still give).  Reading goes on until every document whose
upper bound reaches the k-th best score has equal bounds, so that membership,
ties and scores are settled; documents that can't reach it are let go before.

Scores need the statistics of all documents (N, L and df), which the index
sums before any list is read.  A task carries each query's best documents from
shard to shard, and the tasks' best meet in two grouped steps.

Queries are held in blocks of bounded bytes; only terms of the block's queries
are indexed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctrecon.llm.common import BATCH_BYTES, cut, rows_of, utf8

TOP = 10
#: Bytes of query text in a block, at most (or one longer query); documents
#: and bytes of text in a shard, at most (or one longer document).
BLOCK = 4 << 20
SHARD = (1 << 14, 16 << 20)
#: Groups in which the tasks' best documents first meet.
LANES = 64
#: Term bytes: letters and digits of ASCII, and all that is not ASCII; only
#: A-Z change.  Every other byte separates.
_TERM = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
              for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats."""
    return text.translate(_TERM).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, n: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """The part of a score that a term's ``tf`` occurrences among a
    document's ``n`` terms give, before the term's weight."""
    m = 25 + (75 * n * n_docs) // max(all_terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


_INDEX = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("docs", pa.binary()), ("known", pa.binary()),
                    ("sizes", pa.binary()), ("terms", pa.binary()), ("ends", pa.binary()), ("rows", pa.binary()),
                    ("tf", pa.binary())])


def build_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """One row for each shard of ``docs`` (doc_id, text): the number of
    documents with terms and of their terms, and as packed arrays the doc_ids,
    whether each is known, the terms of each document, the numbers of the
    terms found, where each term's postings end, and the postings: row and tf.
    ``vocabulary`` numbers the terms to index."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def shard(ids, sizes, found):
        size = np.array(sizes, dtype=np.int64)
        rows = np.repeat(np.arange(len(ids)), [len(c) for c in found])
        term = np.array([t for c in found for t in c], dtype=np.int64)
        tf = np.array([x for c in found for x in c.values()], dtype=np.int64)
        order = np.argsort(term, kind="stable")
        term, rows, tf = term[order], rows[order], tf[order]
        heads, starts = np.unique(term, return_index=True)
        ends = np.append(starts[1:], len(term)) if len(heads) else starts
        values = [[int((size > 0).sum())], [int(size.sum())],
                  *[[np.asarray(a, kind).tobytes()] for a, kind in (
                      ([i or 0 for i in ids], "<i8"), ([i is not None for i in ids], "?"), (size, "<i8"),
                      (heads, "<i4"), (ends, "<i4"), (rows, "<i4"), (tf, "<i4"))]]
        return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(values, _INDEX)], schema=_INDEX)

    def run(stream):
        number = held.value
        ids, sizes, found, weighs = [], [], [], 0
        for doc, text in rows_of(stream):
            words = terms(text)
            ids.append(doc)
            sizes.append(len(words))
            found.append(Counter(filter(None, map(number.get, words))))
            weighs += len(text)
            if len(ids) >= SHARD[0] or weighs >= SHARD[1]:
                yield shard(ids, sizes, found)
                ids, sizes, found, weighs = [], [], [], 0
        if ids:
            yield shard(ids, sizes, found)

    kinds = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'binary'}" for f in _INDEX)
    return (docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text")).mapInArrow(run, kinds))


def frequencies(index: DataFrame) -> DataFrame:
    """(term, df) of all shards."""
    def run(stream):
        for batch in stream:
            for heads, ends in zip(batch["terms"].to_pylist(), batch["ends"].to_pylist()):
                ends = np.frombuffer(ends, "<i4")
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(heads, "<i4")),
                                                  pa.array(np.diff(ends, prepend=0).astype(np.int64))],
                                                 names=["term", "n"])

    return (index.select("terms", "ends").mapInArrow(run, "term int, n long")
            .groupBy("term").agg(F.sum("n").alias("df")))


class Best:
    """A query's best documents so far: at most k of (score, doc_id), highest
    score first, then smallest id, unknown ids last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def add(self, scores, ids, known) -> None:
        self.rows += [(int(s), int(i) if ok else None) for s, i, ok in zip(scores, ids, known)]
        self.rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        del self.rows[self.k:]

    @property
    def least(self) -> int:
        """A score below this one can't enter."""
        return self.rows[-1][0] if len(self.rows) == self.k else 1


class Shard:
    """A shard's lists, sorted by impact."""

    def __init__(self, row: dict, n_docs: int, all_terms: int, weights: dict[int, int]):
        get = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, self.known, sizes = get("docs", "<i8"), get("known", "?"), get("sizes", "<i8")
        rows, tf, self.lists = get("rows", "<i4").astype(np.int64), get("tf", "<i4").astype(np.int64), {}
        part = impact(tf, sizes[rows], n_docs, all_terms)
        start = 0
        for term, end in zip(get("terms", "<i4").tolist(), get("ends", "<i4").tolist()):
            order = np.argsort(-part[start:end], kind="stable")
            self.lists[term] = rows[start:end][order], part[start:end][order] * weights[term]
            start = end

    def search(self, query: dict[int, int], best: Best) -> int:
        """Add the documents that belong among ``best`` for a query (term ->
        how often).  Returns how many postings were read."""
        lists = [(rows, impacts * query[t]) for t in query if t in self.lists
                 for rows, impacts in (self.lists[t],) if impacts[0] > 0]
        if not lists:
            return 0
        n, k = len(self.ids), best.k
        falling = [-impacts for _, impacts in lists]
        at = np.zeros(len(lists), dtype=np.int64)
        bound = np.array([impacts[0] for _, impacts in lists])
        lower = np.zeros(n, dtype=np.int64)
        seen = np.zeros((len(lists), n), dtype=bool)
        alive = np.ones(n, dtype=bool)
        level = int(bound.max())
        while True:
            level //= 2
            for j, (rows, impacts) in enumerate(lists):
                to = int(np.searchsorted(falling[j], -level, side="right")) if level else len(rows)
                if to > at[j]:
                    met = rows[at[j]:to]
                    lower[met] += impacts[at[j]:to]  # a document is once in a list
                    seen[j, met] = True
                    at[j] = to
                bound[j] = impacts[to] if to < len(rows) else 0
            # what the lists that haven't shown a document can still give it
            open_ = np.flatnonzero(alive)
            rest = bound.sum() - bound @ seen[:, open_]
            low = lower[open_]
            least = best.least
            if len(low) > k:
                least = max(least, int(np.partition(low, len(low) - k)[len(low) - k]))
            stay = low + rest >= least
            alive[open_[~stay]] = False
            if not rest[stay].any():
                break
        # the documents left have equal bounds
        left = open_[stay]
        left = left[lower[left] >= max(1, best.least)]
        if len(left) > k:  # ties at the k-th score all compete by their ids
            least = np.partition(lower[left], len(left) - k)[len(left) - k]
            left = left[lower[left] >= least]
        best.add(lower[left], self.ids[left], self.known[left])
        return int(at.sum())


def _search_index(index: DataFrame, queries: list[tuple[int, dict[int, int]]], n_docs: int, all_terms: int,
                  weights: dict[int, int], k: int) -> DataFrame:
    """(query, doc_id, score): each task's best documents of each query."""
    held = index.sparkSession.sparkContext.broadcast((queries, weights))
    schema = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(stream):
        queries, weights = held.value
        best = [Best(k) for _ in queries]
        for batch in stream:
            for at in range(batch.num_rows):
                shard = Shard(batch.slice(at, 1).to_pylist()[0], n_docs, all_terms, weights)
                for (_, query), found in zip(queries, best):
                    shard.search(query, found)
        rows = [(q, i, s) for (q, _), found in zip(queries, best) for s, i in found.rows]
        for at in range(0, len(rows), 1 << 16):
            part = list(zip(*rows[at:at + (1 << 16)]))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(part, schema)], schema=schema)

    return index.mapInArrow(run, "query int, doc_id long, score long")


def _first(rows: DataFrame, by: list[str | Column], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """The queries in lists of bounded bytes, read one partition at a time."""
    held, size = [], 0
    for row in items.select(F.col("item_id").cast("long"), utf8("text").alias("text")).toLocalIterator():
        held.append((row[0], bytes(row[1])))
        size += len(row[1]) + 64
        if size >= BLOCK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _search_block(docs: DataFrame, block: list[tuple[int | None, bytes]], k: int) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    counted = [Counter(terms(text)) for _, text in block]
    # numbers from 1: 0 is no term
    vocabulary = {t: i for i, t in enumerate(sorted({t for c in counted for t in c}), 1)}
    queries = [(q, {vocabulary[t]: n for t, n in c.items()}) for q, c in enumerate(counted)]
    index = cut(build_index(docs, vocabulary), "index")
    total = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, all_terms = total.n or 0, total.l or 0
    # at most one row for each term of the block's queries
    weights = {r.term: weight(n_docs, r.df) for r in frequencies(index).collect()}
    found = cut(_search_index(index, queries, n_docs, all_terms, weights, k)
                .withColumn("lane", F.spark_partition_id() % LANES), "found")
    top = _first(_first(found, ["query", "lane"], k).drop("rank"), ["query"], k)
    named = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(block)], "number int, item_id long")
    return (top.join(F.broadcast(named), F.col("query") == F.col("number"))
            .select("item_id", "rank", "doc_id", "score"))


def ranked_search(docs: DataFrame, items: DataFrame, *, k: int = TOP) -> DataFrame:
    """The ``k`` best rows of ``docs`` (doc_id, text) for each row of
    ``items`` (item_id, text): item_id, rank (from 1), doc_id, score.

    Only scores above 0 count; equal scores go by ascending doc_id.  Null,
    empty and blank texts have no terms: such documents are in no statistic,
    such items have no rows.  Each row of ``docs`` is a document of its own,
    also if its doc_id repeats; a null doc_id comes last among equal scores.
    Each row of ``items`` is a query of its own, so a repeated item_id (or
    null) has its ranks once for each row.  Other columns are not read; an
    empty table on either side gives an empty result.
    """
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in _blocks(items):
        out = out.union(cut(_search_block(docs, block, k), "best"))
    return out
