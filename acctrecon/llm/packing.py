"""Packing by power-of-two decomposition.

A document of n tokens becomes pieces whose lengths are the binary digits of
n (with as many pieces of the longest length as fit).  Every piece is a
sequence of its own, and sequences of equal length form a bucket, so batches
need no padding and no sequence crosses documents.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctrecon.llm.bpe import CACHE, SHORT, Bounded, encode_texts, grouped, packed, ship
from acctrecon.llm.common import batches, rows_of, utf8

LONGEST = 2048
END_ID = 1
_SEQUENCES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
              "bucket int")
#: Words that go through the tokenizer as one text.
ROW = 256


def pieces(n: int, longest: int = LONGEST) -> list[tuple[int, int]]:
    """(start, length) of each piece of n tokens, longest first."""
    out, at = [], 0
    while n - at >= longest:
        out.append((at, longest))
        at += longest
    for bit in reversed(range(longest.bit_length() - 1)):
        if (n - at) >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


class ChunkTokenizer:
    """Ids from a tokenizer file.  Text is cut before single spaces, where no
    piece of the tokenizer's pattern can cross, and each distinct chunk goes
    through the tokenizer once while it is cached.

    The string of an added token (<|endoftext|>) is text like any other, or
    with ``added`` that token, as the library has it by default."""

    def __init__(self, path: str, cache: int = 2 * CACHE, added: bool = False):
        # a task has one core: the library starts no threads of its own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.known = Bounded(None, cache)
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        breaks = tuple(self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in " \n")
        self.spaced[[i for t, i in self.tokenizer.get_vocab(False).items() if t.startswith(breaks)]] = True

    def _words(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word with a space before it."""
        return self._rows([" " + w for w in words])

    def _rows(self, words: list[str]) -> list[bytes]:
        """Packed ids of words of letters with a space or a line break before
        them.  They go through in rows: a piece begins with the space, or is
        the line break, so just the first token of each begins with it."""
        rows = [words[k:k + ROW] for k in range(0, len(words), ROW)]
        out: list[bytes] = []
        for row, e in zip(rows, self._encoded(["".join(row) for row in rows])):
            ids = np.array(e, dtype="<u4")
            starts = np.flatnonzero(self.spaced[ids]) * 4
            if len(starts) != len(row):
                raise ValueError("a row of words has other pieces than words")
            data, starts = ids.tobytes(), starts.tolist()
            out += [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])]
        return out

    def _ids(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        words = [i for i, t in enumerate(texts) if t[:1] in (" ", "\n") and t[1:].isalpha() and len(t) <= SHORT]
        others = sorted(set(range(len(texts))).difference(words))
        out: list[bytes] = [b""] * len(texts)
        for i, e in zip(others, self._encoded([texts[i] for i in others])):
            out[i] = packed(e)
        for i, x in zip(words, self._rows([texts[i] for i in words])):
            out[i] = x
        return out

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        whole = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        if not whole:
            return encode_texts(texts, self.known, self._ids, self._words)
        # an added token can take in what is next to it, so no cut is safe
        self.tokenizer.encode_special_tokens = False
        try:
            found = dict(zip(whole, map(packed, self._encoded([texts[i] for i in whole]))))
        finally:
            self.tokenizer.encode_special_tokens = True
        others = iter(encode_texts([t for i, t in enumerate(texts) if i not in found], self.known, self._ids,
                                   self._words))
        return [found[i] if i in found else next(others) for i in range(len(texts))]


@lru_cache(maxsize=1)
def _tokenizer(name: str, cache: int, added: bool) -> ChunkTokenizer:
    """One tokenizer for a worker, kept over its tasks."""
    return ChunkTokenizer(SparkFiles.get(name), cache, added)


def pack(docs: DataFrame, tokenizer: str, *, longest: int = LONGEST, end_id: int = END_ID,
         cache: int = 2 * CACHE, added: bool = False) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text): doc_id, start, length,
    ids (little-endian unsigned 32-bit), doc_tokens, bucket (log2 of length),
    sequence_id, offset (0).

    A document's ids end with ``end_id``, so null and empty texts have one
    piece of one id.  Rows that repeat a doc_id are packed each on its own;
    null ids are carried through; other columns are not read.  A sequence_id
    is unique in the result.  An empty table gives an empty result.  A worker
    keeps the ids of at most ``cache`` chunks (some 250 bytes each), also
    after the stage has ended; the result does not depend on it.  The string of
    an added token in a text is plain text, or with ``added`` that token.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("longest is a power of two")
    name = ship(docs.sparkSession, tokenizer)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids", pa.binary()), ("doc_tokens", pa.int64())])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(stream):
        encode = _tokenizer(name, cache, added).encode

        def rows():
            for held in grouped(rows_of(stream)):
                for (doc, _), ids in zip(held, encode([t.decode("utf-8", "replace") for _, t in held])):
                    ids += end
                    n = len(ids) // 4
                    for start, length in pieces(n, longest):
                        yield doc, start, length, ids[4 * start:4 * (start + length)], n

        yield from batches(rows(), schema, lambda r: len(r[3]) + 64, count=1 << 14)

    return (docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
            .mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long")
            .select("doc_id", "start", "length", "ids", "doc_tokens",
                    F.log2("length").cast("int").alias("bucket"),
                    F.monotonically_increasing_id().alias("sequence_id"),
                    F.lit(0).cast("long").alias("offset")))


def write_buckets(packed: DataFrame, path: str) -> None:
    """The sequences as files, one folder for each length.  Sequences of one
    length are dealt to the same tasks, and a length that many have to several,
    so folders hold few, full files."""
    packed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_buckets(spark: SparkSession, path: str, length: int | None = None) -> DataFrame:
    """The sequences of ``write_buckets``, all or those of one length, whose
    folder alone is read then."""
    out = spark.read.schema(_SEQUENCES).parquet(path)
    return out if length is None else out.where(F.col("bucket") == length.bit_length() - 1)
