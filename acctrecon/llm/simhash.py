"""SimHash near-dedup through an inverted index on byte positions.

A fingerprint has 8 bytes.  Two fingerprints that differ in at most d bits
differ in at most d bytes, so they share at least 8 - d positional bytes: the
count filter.  One byte per posting would give lists of n / 256, so a posting
joins the bytes of several positions: the 8 positions form d + 2 blocks, and
each posting holds two whole blocks.  d changed bytes touch at most d blocks
and leave two, so every link meets in some list.  In a list, each pair's
shared positional bytes are tallied, pairs that reach 8 - d are kept, and the
bit distance is verified.

Lists hold distinct fingerprints.  Lists longer than ``LIST`` are not paired:
their fingerprints take an exact way of linear size.  Each one is filed under
every value at distance d / 2 or less; two that share a value are at most d
apart, any two that are d apart share one, and all those of a value link to
its smallest.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrecon.llm.common import batches, cut, rows_of, utf8
from acctrecon.llm.components import components

SHINGLE = 3
BITS = 2
SEED = 42
LIST = 32
_CHUNK = 1 << 16
_LANE = np.arange(8, dtype=np.int64) * 256
_SET = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text, as an unsigned integer."""
    words = text.lower().split()  # on bytes: A-Z only, white space 09-0D and 20 only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashed, space, lanes = xxhash.xxh64_intdigest, b" ".join, np.zeros(2048, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        end = min(n, at + _CHUNK)
        runs = zip(*[words[at + k:end + k] for k in range(shingle)]) if len(words) >= shingle else [words]
        h = np.array([hashed(space(s), SEED) for s in runs], dtype="<u8")
        lanes += np.bincount((h.view(np.uint8).reshape(-1, 8) + _LANE).ravel(), minlength=2048)
    ones = (lanes.reshape(8, 256) @ _SET).ravel()
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of each row; fp has the 64 bits as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(stream):
        yield from batches(((i, _signed(fingerprint(t, shingle))) for i, t in rows_of(stream)), schema)

    return (docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
            .mapInArrow(run, "doc_id long, fp long").select(F.col("doc_id").cast(kind), "fp"))


def _postings(fps: DataFrame, bits: int) -> DataFrame:
    """Each fingerprint under each pair of blocks of whole bytes."""
    blocks = [list(map(int, b)) for b in np.array_split(np.arange(8), bits + 2)]
    keys = []
    for n, (a, b) in enumerate(combinations(blocks, 2)):
        mask = sum(0xFF << (8 * p) for p in a + b)
        keys.append(F.struct(F.lit(n).alias("blocks"), F.col("fp").bitwiseAND(
            F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("bytes")))
    return fps.select("fp", "node", F.explode(F.array(*keys)).alias("key"))


def _tally(a, b):
    """How many positional bytes two fingerprints share."""
    x = a.bitwiseXOR(b)
    return sum((F.shiftrightunsigned(x, 8 * p).bitwiseAND(F.lit(0xFF)) == 0).cast("int") for p in range(8))


def links(fps: DataFrame, bits: int = BITS, longest: int = LIST, most: int | None = None) -> DataFrame:
    """Edges (a, b) between nodes of distinct fingerprints (fp, node), of
    which there are at most ``most``, that keep every link's ends connected;
    each edge lies within a component."""
    postings = _postings(fps, bits)
    lists = cut(postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "lists",
                most and most * (bits + 1) * (bits + 2) // 4)
    shared = cut(postings.join(lists, "key"), "shared")
    short = (shared.where(F.col("n") <= longest).groupBy("key")
             .agg(F.sort_array(F.collect_list(F.struct("fp", "node"))).alias("p")))
    pair = (short.select(F.posexplode("p").alias("i", "x"), "p")
            .select("x", F.explode(F.slice("p", F.col("i") + 2, F.greatest(F.size("p") - F.col("i") - 1, F.lit(0))))
                    .alias("y")))
    near = (pair.where(_tally(F.col("x.fp"), F.col("y.fp")) >= 8 - bits)
            .where(F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= bits)
            .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
    crowd = shared.where(F.col("n") > longest).select("fp", "node").distinct()
    flips = [0]
    for size in range(1, bits // 2 + 1):
        flips += [sum(1 << i for i in c) for c in combinations(range(64), size)]
    flips = [f - (1 << 64) if f >> 63 else f for f in flips]
    filed = crowd.select("node", F.explode(F.transform(
        F.array(*[F.lit(f) for f in flips]), lambda f: f.bitwiseXOR(F.col("fp")))).alias("value"))
    # at most len(flips) distinct fingerprints lie under one value
    met = filed.groupBy("value").agg(F.collect_list("node").alias("nodes")).where(F.size("nodes") > 1)
    stars = met.select(F.array_min("nodes").alias("a"), F.explode("nodes").alias("b"))
    return near.union(stars.where("a <> b")).distinct()


def classified(docs: DataFrame, *, shingle: int = SHINGLE, bits: int = BITS, longest: int = LIST) -> DataFrame:
    """(doc_id, fp, class) of each row: ``class`` is the smallest fingerprint
    that links reach.  Fingerprints are the nodes, so a doc_id with several
    texts joins nothing, and a row without a doc_id links like any other."""
    if bits not in (2, 4):
        raise ValueError("bits is 2 or 4")
    rows = cut(fingerprints(docs, shingle), "fingerprints")
    found = components(links(rows.select("fp", F.col("fp").alias("node")).distinct(), bits, longest, rows.count()))
    return (rows.join(found, F.col("fp") == F.col("node"), "left")
            .select("doc_id", "fp", F.coalesce("component", "fp").alias("class")))


def simhash_near_dedup(docs: DataFrame, *, shingle: int = SHINGLE, bits: int = BITS,
                       longest: int = LIST) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (16
    hex digits), component_id (smallest doc_id that links reach).

    Null and empty texts have fingerprint zero and link like any other.
    Equal fingerprints link, so repeated rows share a component.  A doc_id that
    repeats with texts of several fingerprints may have several components.
    Rows with a null doc_id link too; a component_id is null where no row of
    the component has an id.  Other columns are not read; an empty table gives
    an empty result.  ``bits`` is even, 2 or 4.
    """
    rows = cut(classified(docs, shingle=shingle, bits=bits, longest=longest), "classes")
    # one row for each class, so that a large one is split by the join
    least = cut(rows.groupBy("class").agg(F.min("doc_id").alias("component_id")), "least", rows.count())
    return (rows.join(least.withColumnRenamed("class", "_class"), F.col("class") == F.col("_class"))
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, *, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """Of each component, one row of ``docs`` with all its columns: that of
    the smallest doc_id (rows without one come last), then of the smallest
    fingerprint, then of the smallest text (null before empty).

    A component is one of near copies, so of rows that are equal one stays,
    and a row of another component stays whatever its doc_id.  Null and empty
    texts are copies of each other.  Any further columns may have any name; an
    empty table gives an empty result.
    """
    rows = cut(classified(docs, shingle=shingle, bits=bits), "classes")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.col("fp").alias("fp"))
    best = cut(rows.groupBy("class").agg(F.min(first).alias("best")), "best")
    judged = cut(rows.join(best.withColumnRenamed("class", "_class"), F.col("class") == F.col("_class"))
                 .select("doc_id", "fp", (F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("fp") == F.col("best.fp")))
                         .alias("stays")), "judged")
    ids = cut(judged.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("stays").alias("stays")), "ids")
    # rows are told apart by their doc_id alone, but for those that repeat it
    again = cut(ids.where("doc_id is null or n > 1").select(F.col("doc_id").alias("_again")), "again")
    whole = docs.select(F.col("doc_id").alias("id"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    # a table of its own, so that its size is known before the texts are read
    gone = cut(ids.where("n > 1 or not stays").select(F.col("doc_id").alias("_gone")), "gone")
    out = whole.where("id is not null").join(gone, F.col("id") == F.col("_gone"), "left_anti").select("row.*")
    if again.isEmpty():
        return out
    kept = cut(judged.where("stays").join(again, F.col("doc_id").eqNullSafe(F.col("_again")), "left_semi")
               .select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp")).distinct(), "kept")
    of = F.pandas_udf(lambda texts: texts.map(lambda t: _signed(fingerprint(t, shingle))), "long")
    few = (whole.join(again, F.col("id").eqNullSafe(F.col("_again")), "left_semi")
           .withColumn("fp", of(F.coalesce("row.text", F.lit("")).cast("binary"))))
    one = (few.join(kept, F.col("id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp")), "left_semi")
           .groupBy("id", "fp").agg(F.min_by("row", F.struct(F.coalesce("row.text", F.lit("")), F.col("row.text").isNotNull())).alias("row")))
    return out.unionByName(one.select("row.*"))
