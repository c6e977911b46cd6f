"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece exactly one token can end its encoding.  last[i]
stores that token: it is the one that spells the end of the prefix, starts
where another prefix ends, and whose pair with that prefix's last token stays
as it is when the two are encoded together.  The encoding is read backwards
from last[n].  A prefix's entry depends on the prefix alone, so an append
only adds entries, and an edit re-uses all entries before it.
"""

from __future__ import annotations

import base64
import re
import string
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctrecon.llm.common import BATCH_BYTES, batches, rows_of, utf8

#: Entries of a worker's caches, each; a full cache starts afresh.
CACHE = 1 << 18
#: Longer chunks and pieces are not cached.
SHORT = 64
#: Unicode White_Space (fixed values).
_WHITE = "".join(map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                           0x202F, 0x205F, 0x3000)))
#: Chunks put together from others are cached up to this length.
FEW = 8
#: A run of these after a word is a piece of its own.
PUNCTUATION = string.punctuation
#: A space that the next white space or the end follows, and one with white
#: space or an end on both sides: only there may a run of white space cross
#: from one space-delimited chunk into the next.
_NEAR = re.compile(f" (?:[{_WHITE}]|\\Z)")
_CROSS = re.compile(f"(?:\\A|[{_WHITE}]) (?:[{_WHITE}]|\\Z)")


def crosses(text: str) -> bool:
    """Whether the text must be split as a whole: some run of white space
    spans space-delimited chunks."""
    return _NEAR.search(text) is not None and _CROSS.search(text) is not None


def pattern():
    """The public splitting pattern, with white space as Unicode has it."""
    p = public_tokenizers.PATTERN.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
    return regex.compile(p)


def parts_of(chunk: str) -> tuple[str, ...]:
    """The keys of a chunk's pieces, if it is a word, perhaps with punctuation
    after it, or two such with a line break between them; else the chunk is
    its own only key.  A key stands for its text with a space before it, and
    one that has a space (no chunk has) for what comes after the space."""
    head, line, tail = chunk.partition("\n")
    word = head.rstrip(PUNCTUATION)
    if not word.isalpha():
        return (chunk,)
    out = [word, f" {head[len(word):]}"] if len(word) < len(head) else [word]
    if line:
        word = tail.rstrip(PUNCTUATION)
        if not word.isalpha():
            return (chunk,)
        out.append(f" \n{word}")
        if len(word) < len(tail):
            out.append(f" {tail[len(word):]}")
    return tuple(out)


def without_tails(chunks: pa.LargeStringArray) -> tuple[list[str], np.ndarray]:
    """The distinct keys of the chunks' parts, and the places of two for each
    chunk: a word with punctuation after it is cut from that, any other chunk is
    its own key, and its second place is past the end."""
    heads = pc.utf8_rtrim(chunks, characters=PUNCTUATION)
    sizes = pc.binary_length(chunks).to_numpy()
    stops = np.cumsum(sizes)
    starts = stops - sizes + pc.binary_length(heads).to_numpy()
    lose = pc.utf8_is_alpha(heads).to_numpy(zero_copy_only=False) & (starts < stops)
    while True:
        coded = pc.if_else(pa.array(lose), heads, chunks).dictionary_encode()
        # Arrow and Python may know the letters of different Unicode versions
        keys = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        heads_at = coded.indices.to_numpy()
        bad = lose & ~np.fromiter(map(str.isalpha, keys), dtype=bool, count=len(keys))[heads_at]
        if not bad.any():
            break
        lose &= ~bad
    n = (stops - starts)[lose]
    ends = np.concatenate([[0], np.cumsum(n)])
    data = np.frombuffer(chunks.buffers()[2] or b"", dtype=np.uint8)[
        np.repeat(starts[lose] - ends[:-1], n) + np.arange(ends[-1])]
    tails = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    tails = tails.dictionary_encode()
    more = [" " + t.decode() for t in tails.dictionary.to_pylist()]
    pairs = np.full((len(chunks), 2), len(keys) + len(more), dtype=np.int64)
    pairs[:, 0] = heads_at
    pairs[lose, 1] = len(keys) + tails.indices.to_numpy()
    return keys + more, pairs


def laid(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``at`` of ``ids`` one after the other, and where each begins,
    with the end of the last."""
    n = sizes[at]
    done = np.concatenate([[0], np.cumsum(n)])
    return ids[np.repeat(starts[at] - done[:-1], n) + np.arange(done[-1])], done


def runs(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed ids as one array, with each run's start and length."""
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
    return np.frombuffer(b"".join(ids), dtype="<u4"), np.cumsum(sizes) - sizes, sizes


def encode_texts(texts: list[str], known: Bounded, many, words=None) -> list[bytes]:
    """Packed ids of each text.  Texts are split before single spaces, and
    words from the punctuation after them, in Arrow; each distinct chunk is
    looked up once.  Of what is not in ``known``, ``many`` gives packed ids for
    a list of texts, and ``words``, if there is one, for a list of words of at
    most SHORT letters, each with a space before it.  What chunks are put
    together from is kept, and of these chunks only very short ones, which
    recur."""
    whole = [crosses(t) for t in texts]
    parts = pc.split_pattern(pa.array(["" if w else t for t, w in zip(texts, whole)], pa.large_string()), " ")
    ends = parts.offsets.to_numpy()
    coded = parts.values.dictionary_encode()
    del parts
    at = coded.indices.to_numpy().astype(np.int64)
    chunks, pairs = without_tails(coded.dictionary)
    del coded
    # what splitting took is given back before the chunks are worked on
    pa.default_memory_pool().release_unused()
    ids = chunk_ids(chunks, known, many, words or (lambda some: many([" " + w for w in some])))
    del chunks
    every, starts, sizes = runs([*ids, b""])
    del ids
    every, done = laid(every, starts, sizes, pairs.ravel())
    starts, stops = done[:-1:2], done[2::2]
    # a text's first chunk has no space before it; a text that must be split
    # as a whole is one chunk
    first, more, sizes = runs(many([t if w else t.split(" ", 1)[0] for t, w in zip(texts, whole)]))
    at[ends[:-1]] = len(starts) + np.arange(len(texts))
    out, done = laid(np.concatenate([every, first]), np.concatenate([starts, len(every) + more]),
                     np.concatenate([stops - starts, sizes]), at)
    cuts = done[ends]
    return [out[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


def chunk_ids(chunks: list[str], known: Bounded, many, words) -> list[bytes]:
    """Packed ids of each of the chunks, which differ; keys as ``parts_of``
    has them."""
    ids = list(map(known.get, chunks))
    lack = [i for i, x in enumerate(ids) if x is None]
    if lack:
        plain = [i for i in lack if chunks[i].isalpha() and len(chunks[i]) <= SHORT]
        basic = [chunks[i] for i in plain]
        found = words(basic)
        for i, x in zip(plain, found):
            ids[i] = x
        new = dict(zip(basic, found))
        others = [(i, parts_of(chunks[i])) for i in lack if ids[i] is None]
        wanted = {k for _, of in others for k in of if k not in new}
        for k in wanted:
            x = known.get(k)
            if x is not None:
                new[k] = x
        wanted.difference_update(new)
        more = [k for k in wanted if k.isalpha() and len(k) <= SHORT]
        new.update(zip(more, words(more)))
        rest = list(wanted.difference(more))
        new.update(zip(rest, many([k[1:] if k[:1] == " " else " " + k for k in rest])))
        for i, of in others:
            ids[i] = b"".join([new[k] for k in of])
        keep = ((k, x) for k, x in new.items() if len(k) <= SHORT)
        more = [(chunks[i], ids[i]) for i, _ in others if len(chunks[i]) <= FEW]
        if len(known) + len(new) + len(more) > known.most:
            # full: it starts afresh, with what these texts have
            known.clear()
            more = ((c, x) for c, x in zip(chunks, ids) if len(c) <= FEW or len(c) <= SHORT and c.isalpha())
        known.update(islice(chain(keep, more), known.most - len(known)))
    return ids


def grouped(stream: Iterator[tuple], most: int = 4 << 20, count: int = 4096) -> Iterator[list[tuple]]:
    """(id, UTF-8 text) rows in lists of bounded bytes."""
    held, size = [], 0
    for row in stream:
        held.append(row)
        size += len(row[1])
        if size > most or len(held) >= count:
            yield held
            held, size = [], 0
    if held:
        yield held


class Bounded(dict):
    """A cache that computes what it lacks and empties itself when full."""

    def __init__(self, make, most: int = CACHE):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class PrefixEncoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.spelling = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.size = {i: len(t) for t, i in ranks.items()}
        self.fits = Bounded(self._fits)
        self.piece = Bounded(self._piece, CACHE // 4)
        self.chunk = Bounded(None)
        self.split = pattern().findall

    def _merged(self, data: bytes) -> list[int]:
        """Rank-ordered merging of a few bytes; used to judge token pairs."""
        parts, rank = [data[i:i + 1] for i in range(len(data))], self.ranks.get
        while len(parts) > 1:
            low, at = None, -1
            for i in range(len(parts) - 1):
                r = rank(parts[i] + parts[i + 1])
                if r is not None and (low is None or r < low):
                    low, at = r, i
            if low is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _fits(self, pair: int) -> bool:
        """Whether two tokens, numbered as one, stay as they are."""
        left, right = pair >> 32, pair & 0xFFFFFFFF
        return self._merged(self.spelling[left] + self.spelling[right]) == [left, right]

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """``last`` holds the last token of each prefix of ``data`` that has
        been worked out (last[0] is a filler); add those of the rest."""
        rank, fits, longest = self.ranks.get, self.fits, self.longest
        for end in range(len(last), len(data) + 1):
            for start in range(end - 1, max(-1, end - longest - 1), -1):
                token = rank(data[start:end])
                if token is not None and (not start or fits[last[start] << 32 | token]):
                    last.append(token)
                    break
            else:
                raise ValueError("a byte has no token")
        return last

    def read(self, data: bytes, last: list[int]) -> list[int]:
        out, end, size = [], len(data), self.size
        while end:
            token = last[end]
            out.append(token)
            end -= size[token]
        return out[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        token = self.ranks.get(data)
        return [token] if token is not None else self.read(data, self.extend(data, [-1]))

    def _words(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word with a space before it, a piece.  Taken in
        order, a word has a prefix in common with the one before it, whose last
        tokens hold for it too."""
        pieces = [b" " + w.encode() for w in words]
        out, before, last = [b""] * len(pieces), b"", [-1]
        for i in sorted(range(len(pieces)), key=pieces.__getitem__):
            data = pieces[i]
            token = self.ranks.get(data)
            if token is not None:
                out[i] = packed([token])
                continue
            same = min(len(before), len(data))
            while data[:same] != before[:same]:
                same -= 1
            del last[same + 1:]
            out[i] = packed(self.read(data, self.extend(data, last)))
            before = data
        return out

    def _piece(self, piece: str) -> bytes:
        return packed(self.encode_piece(piece.encode()))

    def _pieces(self, text: str) -> bytes:
        known = self.piece
        return b"".join([known[p] if len(p) <= SHORT else self._piece(p) for p in self.split(text)])

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        return encode_texts(texts, self.chunk, lambda many: list(map(self._pieces, many)), self._words)

    def encode(self, text: str) -> bytes:
        """The ids of one text as little-endian unsigned 32-bit integers."""
        return self._pieces(text)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.spelling.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


class Appendable:
    """One piece under edits: its bytes, last tokens and encoding.

    append() adds entries only.  edit() keeps the entries before the edit and
    works on until as many bytes as the longest token has in a row are past
    the edit and have their old entry again; from there on all are as before.
    """

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data = encoder, data
        self.last = encoder.extend(data, [-1])
        self.worked = len(data)

    def append(self, more: bytes) -> Appendable:
        self.data += more
        self.encoder.extend(self.data, self.last)
        self.worked = len(more)
        return self

    def edit(self, start: int, end: int, new: bytes) -> Appendable:
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        last, same, at = old[:start + 1], 0, start
        while at < len(self.data):
            at += 1
            self.encoder.extend(self.data[:at], last)
            # an entry counts once its token lies wholly after the edit
            token = len(self.encoder.spelling[last[at]])
            before = at - shift
            same = same + 1 if at - token >= start + len(new) and before > end and last[at] == old[before] else 0
            if same >= self.encoder.longest:
                last += old[before + 1:]
                break
        self.worked, self.last = at - start, last
        return self

    def ids(self) -> list[int]:
        return self.encoder.read(self.data, self.last)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def _encoder(name: str) -> PrefixEncoder:
    """One encoder for a worker, kept over its tasks."""
    return PrefixEncoder(read_ranks(SparkFiles.get(name)))


def ship(spark: SparkSession, path: str) -> str:
    """Send a vocabulary file to all executors; its name there."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode_documents(docs: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, ids) for each row of ``docs`` (doc_id, text); ids are
    little-endian unsigned 32-bit integers by the rank file ``ranks``.

    Null and empty texts have no ids.  Special tokens' strings are ordinary
    text.  Null doc_ids and repeated rows are carried through; other columns
    are not read.
    """
    name = ship(docs.sparkSession, ranks)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(stream):
        encode = _encoder(name).encode_many
        for held in grouped(rows_of(stream)):
            ids = encode([t.decode("utf-8", "replace") for _, t in held])
            yield from batches(zip([i for i, _ in held], ids), schema, lambda r: len(r[1]) + 64)

    return (docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
            .mapInArrow(run, "doc_id long, ids binary"))


def decode_documents(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded bytes as ``data``."""
    name = ship(encoded.sparkSession, ranks)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("data", pa.binary())])

    def run(stream):
        decode = _encoder(name).decode
        rows = ((i, ids, decode(ids or b"")) for i, ids in rows_of(stream))
        yield from batches(rows, schema, lambda r: 2 * len(r[2]) + 64, BATCH_BYTES)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, data binary")
