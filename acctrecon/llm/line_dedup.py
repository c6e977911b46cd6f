"""Reversible line dedup: cuckoo filters over exact reference-count tables.

The index of a corpus has three tables in the shared folder:

* postings (doc_id, key): each line key that a document holds, once;
* counts (key, n_docs, owner): exact reference counts and the largest holder;
* filters (shard, buckets, slots): a cuckoo filter for each shard of the key
  space, holding the keys that at least ``min_docs`` documents share.

insert() and delete() merge the exact tables and move just those keys in or
out of the filters whose count crossed the bound, so a deletion undoes its
insertion.  A document's lines first meet the filters, and only the few that
pass are joined with the counts, which decide.  The filters are broadcast when
their measured size is within ``BROADCAST_BYTES``; beyond it the postings are
dealt to the shards and meet the filter of their shard there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctrecon.llm.common import batches, cut, rows_of, utf8

MIN_CHARS = 20
MIN_DOCS = 3
BROADCAST_BYTES = 32 << 20
#: Keys a shard is planned for.
SHARD_KEYS = 1 << 16
#: Postings of one shard that meet its filter in one task, about.
PROBE = 1 << 20
#: Tables that the postings of an index are spread over, at most.
PARTS = 16
SLOTS = 4
KICKS = 500
_SPACE = b" \t\n\x0b\x0c\r"
_FILTER = "shard long, buckets long, slots binary"


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The 128-bit key of a line; None if it is too short to count."""
    line = line.strip(_SPACE).lower()
    if len(line) < min_chars or (len(line) < 4 * min_chars and
                                 len(line.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(line, digest_size=16).digest()


class CuckooFilter:
    """16-bit tags of 128-bit keys in buckets of four slots.

    A shard whose keys don't fit grows by doubling, from the exact keys."""

    def __init__(self, buckets: int, slots: bytes | None = None):
        self.mask = buckets - 1
        self.slots = (np.frombuffer(slots, dtype="<u2").copy() if slots is not None
                      else np.zeros(buckets * SLOTS, dtype="<u2")).reshape(buckets, SLOTS)

    @classmethod
    def of(cls, keys: list[bytes]) -> CuckooFilter:
        buckets = 1 << max(3, (max(1, len(keys)) * 5 // (SLOTS * 4)).bit_length())
        while True:
            f = cls(buckets)
            if all(f.insert(k) for k in keys):
                return f
            buckets *= 2

    @property
    def buckets(self) -> int:
        return self.mask + 1

    def _places(self, key: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(key[8:10], "little") or 1
        first = int.from_bytes(key[10:14], "little") & self.mask
        return tag, first, self._other(first, tag)

    def _other(self, bucket: int, tag: int) -> int:
        return (bucket ^ (tag * 0x5BD1E995)) & self.mask

    def insert(self, key: bytes) -> bool:
        tag, a, b = self._places(key)
        for bucket in (a, b):
            row = self.slots[bucket]
            for s in range(SLOTS):
                if not row[s]:
                    row[s] = tag
                    return True
        at = b
        for kick in range(KICKS):
            s = (tag + kick) % SLOTS
            tag, self.slots[at][s] = int(self.slots[at][s]), tag
            at = self._other(at, tag)
            row = self.slots[at]
            for s in range(SLOTS):
                if not row[s]:
                    row[s] = tag
                    return True
        return False

    def delete(self, key: bytes) -> bool:
        tag, a, b = self._places(key)
        for bucket in (a, b):
            for s in range(SLOTS):
                if self.slots[bucket][s] == tag:
                    self.slots[bucket][s] = 0
                    return True
        return False

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """keys: (n, 16) bytes."""
        tags = keys[:, 8:10].copy().view("<u2").ravel()
        tags = np.where(tags == 0, 1, tags).astype("<u2")
        a = keys[:, 10:14].copy().view("<u4").ravel().astype(np.int64) & self.mask
        b = (a ^ (tags.astype(np.int64) * 0x5BD1E995)) & self.mask
        return ((self.slots[a] == tags[:, None]) | (self.slots[b] == tags[:, None])).any(axis=1)


def postings_of(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, key): every key of each document once."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary())])

    def run(stream):
        def rows():
            for doc, text in rows_of(stream):
                for key in {line_key(x, min_chars) for x in text.split(b"\n")} - {None}:
                    yield doc, key
        yield from batches(rows(), schema, count=1 << 15)

    return (docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
            .mapInArrow(run, "doc_id long, key binary"))


def _shard(shards: int):
    # the first four hex digits' worth of bytes deal keys to shards
    return F.pmod(F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long"), F.lit(shards))


class LineIndex:
    """The index of the documents inserted and not deleted.  Each insert or
    delete returns a new index; the old one stays valid (its tables are not
    changed), which is what makes a step reversible and safe to repeat."""

    def __init__(self, spark: SparkSession, postings: DataFrame | None = None,
                 counts: DataFrame | None = None, filters: DataFrame | None = None,
                 shards: int = 1, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, parts: int = 1):
        self.parts = parts  # tables that the postings are spread over
        self.spark, self.shards, self.min_docs, self.min_chars = spark, shards, min_docs, min_chars
        empty = spark.createDataFrame
        self.postings = postings if postings is not None else empty([], "doc_id long, key binary")
        self.counts = counts if counts is not None else empty([], "key binary, n_docs long, owner long")
        self.filters = filters if filters is not None else empty([], _FILTER)

    def _with(self, postings: DataFrame, counts: DataFrame, moved: DataFrame, regrow: bool, parts: int = 1) -> LineIndex:
        """moved: keys with ``into``, true to insert and false to delete."""
        shards, filters = self.shards, self.filters
        shared = counts.where(F.col("n_docs") >= self.min_docs)
        wanted = max(1, -(-shared.count() // SHARD_KEYS)) if regrow else shards
        if wanted > 2 * shards or self.filters.isEmpty():  # deal all keys anew
            shards, filters = max(wanted, shards), self.filters.limit(0)
            moved = shared.select("key", F.lit(True).alias("into"))
        built = cut(update_filters(filters, moved, shared, shards), "filters")
        return LineIndex(self.spark, postings, counts, built, shards, self.min_docs, self.min_chars, parts)

    def insert(self, docs: DataFrame) -> LineIndex:
        """Index further documents (doc_id, text).  Documents that the index
        holds already add nothing for the keys they hold.  Their postings are
        a table beside those that are there, which are written anew once in
        ``PARTS`` insertions."""
        new = cut(postings_of(docs, self.min_chars).distinct()
                  if self.postings.isEmpty() else
                  postings_of(docs, self.min_chars).distinct().join(
                      self.postings.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k")),
                      (F.col("doc_id") == F.col("_d")) & (F.col("key") == F.col("_k")), "left_anti"), "postings")
        first = self.counts.isEmpty()
        added = new.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("owner"))
        if first:
            counts = cut(added, "counts")
            moved = counts.where(F.col("n_docs") >= self.min_docs).select("key", F.lit(True).alias("into"))
            return self._with(new, counts, moved, True)
        both = cut(self.counts.select("key", F.col("n_docs").alias("was"), F.lit(0).cast("long").alias("n"), "owner")
                   .union(added.select("key", F.lit(0).cast("long"), "n_docs", "owner"))
                   .groupBy("key").agg(F.sum("was").alias("was"), F.sum("n").alias("n"), F.max("owner").alias("owner")),
                   "merged")
        total = F.col("was") + F.col("n")
        moved = (both.where((F.col("was") < self.min_docs) & (total >= self.min_docs))
                 .select("key", F.lit(True).alias("into")))
        counts = both.select("key", total.alias("n_docs"), "owner")
        every = self.postings.union(new)
        whole = self.parts >= PARTS
        return self._with(cut(every, "postings") if whole else every, counts, moved, True, 1 if whole else self.parts + 1)

    def delete(self, ids: DataFrame) -> LineIndex:
        """Take out the documents whose doc_id is in ``ids``."""
        gone = ids.select(F.col("doc_id").cast("long").alias("_d")).distinct()
        out = self.postings.join(gone, F.col("doc_id") == F.col("_d"), "left_semi")
        rest = cut(self.postings.join(gone, F.col("doc_id") == F.col("_d"), "left_anti"), "postings")
        lost = cut(out.groupBy("key").agg(F.count("*").alias("less")), "lost")
        # owners are counted anew just for the keys that lost a holder
        owners = cut(rest.join(lost.select(F.col("key").alias("_k")), F.col("key") == F.col("_k"), "left_semi")
                     .groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("owner")), "owners")
        counts = cut(self.counts.join(lost.select("key"), "key", "left_anti").union(owners), "counts")
        was = self.counts.join(lost.select("key"), "key", "left_semi").where(F.col("n_docs") >= self.min_docs)
        moved = (was.select("key").join(owners.where(F.col("n_docs") >= self.min_docs).select("key"), "key",
                                        "left_anti").select("key", F.lit(False).alias("into")))
        return self._with(rest, counts, moved, False)

    def _maybe_shared(self, postings: DataFrame) -> DataFrame:
        """The postings whose key the filters may hold."""
        size = self.filters.agg(F.sum(F.length("slots"))).first()[0] or 0
        if size > BROADCAST_BYTES:
            return self._probed_by_shard(postings)
        held = self.spark.sparkContext.broadcast(
            {r.shard: (r.buckets, bytes(r.slots)) for r in self.filters.toLocalIterator()})
        shards = self.shards

        def run(stream: Iterator[pa.RecordBatch]):
            filters = {k: CuckooFilter(*v) for k, v in held.value.items()}
            for batch in stream:
                if not batch.num_rows:
                    continue
                keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).reshape(-1, 16)
                lane = keys[:, :4].copy().view(">u4").ravel().astype(np.int64) % shards
                keep = np.zeros(len(keys), dtype=bool)
                for shard in np.unique(lane):
                    if int(shard) in filters:
                        at = np.flatnonzero(lane == shard)
                        keep[at] = filters[int(shard)].holds(keys[at])
                yield batch.filter(pa.array(keep))

        return postings.select("doc_id", "key").mapInArrow(run, "doc_id long, key binary")

    def _probed_by_shard(self, postings: DataFrame) -> DataFrame:
        """The same, where the filters are too large for every task: postings
        and filters meet by shard.  A shard with many postings is dealt to
        several tasks, each with a copy of its filter."""
        rows = postings.select(_shard(self.shards).alias("shard"), "doc_id", "key")
        lanes = cut(rows.groupBy("shard").agg(F.count("*").alias("n"))
                    .select(F.col("shard").alias("_s"), F.ceil(F.col("n") / F.lit(PROBE)).cast("int").alias("_lanes")), "lanes")
        rows = (rows.join(lanes, F.col("shard") == F.col("_s"))
                .select("shard", F.pmod(F.xxhash64("doc_id", "key"), F.col("_lanes")).cast("int").alias("lane"), "doc_id", "key"))
        filters = (self.filters.join(lanes, F.col("shard") == F.col("_s"))
                   .select("shard", F.explode(F.sequence(F.lit(0), F.col("_lanes") - 1)).alias("lane"), "buckets", "slots"))
        schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary())])

        def probe(held, rows):
            if not held.num_rows or not rows.num_rows:
                return schema.empty_table()
            f = CuckooFilter(held["buckets"][0].as_py(), held["slots"][0].as_py())
            keys = np.frombuffer(b"".join(rows["key"].to_pylist()), dtype=np.uint8).reshape(-1, 16)
            return rows.select(["doc_id", "key"]).filter(pa.array(f.holds(keys)))

        return (filters.groupBy("shard", "lane").cogroup(rows.groupBy("shard", "lane"))
                .applyInArrow(probe, "doc_id long, key binary"))

    def drops(self, postings: DataFrame) -> DataFrame:
        """(doc_id, keys): the line keys that each document loses."""
        hit = cut(self._maybe_shared(postings), "hits")
        shared = cut(self.counts.where(F.col("n_docs") >= self.min_docs), "shared")
        return (hit.join(shared.select(F.col("key").alias("_k"), "owner"), F.col("key") == F.col("_k"))
                .where("owner <> doc_id").groupBy("doc_id").agg(F.collect_set("key").alias("keys")))


def update_filters(filters: DataFrame, moved: DataFrame, shared: DataFrame, shards: int) -> DataFrame:
    """Each shard's filter with its moved keys inserted or deleted.  A shard
    that is full is built anew from its exact keys (``shared``)."""
    spread = moved.select(_shard(shards).alias("shard"), "key", "into")

    def apply(key, old, new):
        coming = [bytes(k) for k in new.loc[new["into"], "key"]]
        going = [bytes(k) for k in new.loc[~new["into"].astype(bool), "key"]]
        full = False
        if len(old):
            f = CuckooFilter(int(old["buckets"].iloc[0]), bytes(old["slots"].iloc[0]))
            for k in going:
                f.delete(k)
            full = not all(f.insert(k) for k in coming)
        else:
            f = CuckooFilter.of(coming)
        return pd.DataFrame({"shard": [key[0]], "buckets": [0 if full else f.buckets],
                             "slots": [b"" if full else f.slots.tobytes()]})

    def build(key, rows):
        f = CuckooFilter.of([bytes(k) for k in rows["key"]])
        return pd.DataFrame({"shard": [key[0]], "buckets": [f.buckets], "slots": [f.slots.tobytes()]})

    out = cut(filters.groupBy("shard").cogroup(spread.groupBy("shard")).applyInPandas(apply, _FILTER), "updated")
    full = out.where("buckets = 0").select("shard")
    if full.isEmpty():
        return out
    again = (shared.select(_shard(shards).alias("shard"), "key").join(F.broadcast(full), "shard")
             .groupBy("shard").applyInPandas(build, _FILTER))
    return out.where("buckets > 0").union(again)


def _kept(docs: DataFrame, drops: DataFrame, min_chars: int) -> DataFrame:
    """(row, kept): all columns of docs, and text, n_lines, n_dropped."""
    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def left(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
        out = []
        for text, gone in zip(texts, keys):
            lines = bytes(text).split(b"\n")
            gone = {bytes(k) for k in gone} if gone is not None else ()
            stay = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
            out.append((b"\n".join(stay).decode("utf-8", "replace"), len(lines), len(lines) - len(stay)))
        return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])

    # drops grow with the documents, so the plan is the same at every size
    return (docs.select(F.struct("*").alias("row"))
            .join(drops.select(F.col("doc_id").alias("_d"), "keys").hint("merge"), F.col("row.doc_id") == F.col("_d"), "left")
            .select("row", left(F.coalesce(F.col("row.text"), F.lit("")).cast("binary"), F.col("keys")).alias("kept")))


def _deduped(docs: DataFrame, index: LineIndex | None, min_docs: int, min_chars: int) -> DataFrame:
    if index is None:
        index = LineIndex(docs.sparkSession, min_docs=min_docs, min_chars=min_chars).insert(docs)
        postings = index.postings
    else:
        postings = postings_of(docs, index.min_chars)
    return _kept(docs, cut(index.drops(postings), "drops"), index.min_chars)


def line_dedup(docs: DataFrame, *, index: LineIndex | None = None, min_docs: int = MIN_DOCS,
               min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text without the dropped
    lines, n_lines, n_dropped.

    Without ``index``, one is made of ``docs``.  Lines end at \\n; null and
    empty texts are one empty line.  A key (line stripped of ASCII white
    space, A-Z lower-cased) of at least ``min_chars`` code points that at least
    ``min_docs`` documents hold loses all lines but those of its largest
    holder.  Rows that repeat a doc_id count as one document and share its
    decision.  Rows with a null doc_id hold no key and lose no line.  Other
    columns are not read; an empty table gives an empty result.
    """
    return _deduped(docs.select("doc_id", "text"), index, min_docs, min_chars).select(
        "row.doc_id", "kept.text", "kept.n_lines", "kept.n_dropped")


def without_repeats(docs: DataFrame, *, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows and columns of ``docs`` with line_dedup's text; n_chars, if
    there is one, is the new text's length.  A document whose lines all go
    stays, with an empty text."""
    new = {"text": F.col("kept.text"), "n_chars": F.char_length("kept.text").cast("long")}
    return _deduped(docs, None, min_docs, min_chars).select(
        *[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
