"""Cross-entropy difference of two matched n-gram models.

A target model and a background model have the same order, smoothing and
vocabulary.  P(w | v) mixes the pair estimate with an add-one word estimate.
A document's score is the mean, over its tokens, of the target loss less the
background loss: the lower, the more it is like the target.

Counts of every lower-cased word and of every pair of neighbouring words are
exact and grow with the texts.  Most pairs occur once, so what is moved per
pair decides the cost:

1. Texts become blocks: distinct words, and the documents' tokens as numbers
   of those words.  Texts are read once and moved nowhere.
2. A block sends each word with its counts to one of many groups of words, as
   one packed list a group; the group adds up and answers in the order of the
   list, so an answer needs no keys.
3. A block sends its distinct pairs likewise.  A pair's key is two word
   hashes, as long as the number of words asks for; words whose hashes collide
   (found in step 2, where words are spelled) get keys of their own, so keys
   are exact.
4. A block and its answers meet, and losses are added up per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrecon.llm.common import cut, rows_of, utf8

#: Weight of the pair estimate.
MIX = 0.5
#: A block has this many tokens and documents, about; a longer text is cut
#: between tokens and goes into several.
BLOCK = (1 << 20, 1 << 14)
#: Words and pairs of all blocks in a group, about.
WORD_GROUP, PAIR_GROUP = 1 << 19, 1 << 20
#: Ids of marked documents that are broadcast, at most; more are joined.
MARKED = 1 << 20
#: Words that a broadcast holds, at most: those whose hashes collide (hashes
#: are so long that a quarter as many are expected) and, apart from them,
#: those that are often followed.
KNOWN = 1 << 20
#: Words of more bytes go by a 128-bit digest.
_WORD = 48


def mark_target(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with target: labelled good and not toxic.  The
    marked ids are broadcast while there are at most ``MARKED``, else joined."""
    good = cut(labels.where("doc_id is not null").groupBy("doc_id")
               .agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
               .where("q = 1 and t = 0").select(F.col("doc_id").alias("_d"), F.lit(True).alias("_good")), "good")
    if good.count() <= MARKED:
        good = F.broadcast(good)
    return (docs.select("doc_id", "text").join(good, F.col("doc_id") == F.col("_d"), "left")
            .select("doc_id", "text", F.coalesce("_good", F.lit(False)).alias("target")))


# -- packed lists

def _pack(a: np.ndarray) -> bytes:
    """An integer array: the bytes of each significance together, zipped."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else a.view(np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def _narrow(a: np.ndarray) -> np.ndarray:
    return a.astype("<u1" if not len(a) or a.max() < 1 << 8 else "<u4" if a.max() < 1 << 32 else "<u8")


def _pack_counts(*columns: np.ndarray) -> bytes:
    """Arrays of numbers from 0 on, each with the width of its entries."""
    out = []
    for c in map(_narrow, columns):
        data = _pack(c)
        out.append(bytes([c.itemsize]) + len(data).to_bytes(8, "little") + data)
    return b"".join(out)


def _unpack_counts(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        size, length = data[at], int.from_bytes(data[at + 1:at + 9], "little")
        out.append(_unpack(data[at + 9:at + 9 + length], f"<u{size}").astype(np.int64))
        at += 9 + length
    return out


# -- blocks

_BLOCKS = pa.schema([("block", pa.int64()), ("n_words", pa.int64()), ("n_pairs", pa.int64()), ("docs", pa.binary()),
                     ("words", pa.binary()), ("tokens", pa.binary())])
_BLOCK_ROW = "block long, n_words long, n_pairs long, docs binary, words binary, tokens binary"


def _word(word: bytes) -> bytes:
    # no word holds a line break, so no word is equal to a digest
    return word if len(word) <= _WORD else b"\n" + hashlib.blake2b(word, digest_size=16).hexdigest().encode()


def _spelled(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b" ".join(words))


def _spellings(data: bytes) -> list[bytes]:
    # a word holds no white space but the line break that marks a digest
    return zstandard.ZstdDecompressor().decompress(data).split(b" ")


class _Block:
    """Documents under way to a block.  Word 0 stands for a text's start."""

    def __init__(self):
        self.number: dict[bytes, int] = {b"": 0}
        self.rows, self.parts, self.size = [], [], 0

    def add(self, row: int, doc, target: bool, first: bool, before: bytes, tokens: list[bytes]) -> None:
        """Tokens of one text, or of a stretch of it after ``before``."""
        number = self.number
        start = number.setdefault(before, len(number))
        coded = [number.setdefault(t, len(number)) for t in tokens]
        self.rows.append((row, doc, target, first, len(coded)))
        self.parts.append(np.array([start, *coded], dtype=np.uint32))
        self.size += len(coded)

    def row(self, block: int) -> list:
        words = sorted(self.number)
        place = np.empty(len(words), dtype=np.uint32)
        place[[self.number[w] for w in words]] = np.arange(len(words), dtype=np.uint32)
        tokens = place[np.concatenate(self.parts)]
        row, doc, target, first, n = (np.array(c) for c in zip(*[(r, d or 0, t, f, n) for r, d, t, f, n in self.rows]))
        known = np.array([d is not None for _, d, _, _, _ in self.rows])
        v, w = _neighbours(tokens, n)
        pairs = np.sort(v.astype(np.int64) * len(words) + w)
        pairs = int((pairs[1:] != pairs[:-1]).sum()) + min(1, len(pairs))
        docs = _pack_counts(row, known, target, first, n) + _pack_signed(doc)
        return [block, len(words), pairs, docs, _spelled(words), _pack(tokens)]


def _pack_signed(doc: np.ndarray) -> bytes:
    data = _pack(doc.astype("<i8"))
    return data + len(data).to_bytes(8, "little")


def _documents(data: bytes) -> tuple[np.ndarray, ...]:
    """Row, whether the id is known, target, whether the text starts here,
    number of tokens, and id of a block's documents."""
    size = int.from_bytes(data[-8:], "little")
    row, known, target, first, n = _unpack_counts(data[:-8 - size])
    return row, known.astype(bool), target.astype(bool), first.astype(bool), n, _unpack(data[-8 - size:-8], "<i8")


def _neighbours(tokens: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word before, word) of the tokens of documents of ``n`` tokens each,
    each with one more number before its own."""
    ends = np.cumsum(n + 1)
    is_word = np.ones(len(tokens), dtype=bool)
    is_word[ends - n - 1] = False
    at = np.flatnonzero(is_word)
    return tokens[at - 1], tokens[at]


def blocks(docs: DataFrame) -> DataFrame:
    """Blocks of the rows of ``docs`` (doc_id, text, target)."""
    tokens_most, docs_most = BLOCK

    def run(stream):
        task = TaskContext.get().partitionId() << 33
        held, row, made = _Block(), task, 0

        def flushed():
            nonlocal held, made
            out = pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(held.row(task + made), _BLOCKS)],
                                             schema=_BLOCKS)
            held, made = _Block(), made + 1
            return out

        for doc, text, target in rows_of(stream):
            words, before, at = text.lower().split(), b"", 0
            while True:
                part = [t if len(t) <= _WORD else _word(t) for t in words[at:at + tokens_most]]
                held.add(row, doc, target, not at, before, part)
                if held.size >= tokens_most or len(held.rows) >= docs_most:
                    yield flushed()
                before, at = part[-1] if part else b"", at + tokens_most
                if at >= len(words):
                    break
            row += 1
        if held.rows:
            yield flushed()

    return (docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"), "target").mapInArrow(run, _BLOCK_ROW))


# -- counting in groups

_SENT = pa.schema([("group", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_SENT_ROW = "group int, block long, keys binary, counts binary"
_ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("group", pa.int32()), ("counts", pa.binary())])
_ANSWER_ROW = "block long, kind int, group int, counts binary"


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def _word_group(words: list[bytes], groups: int, width: int) -> np.ndarray:
    # words with one key have the hash's first bits in common, so a group
    return ((_hashes(words) >> np.uint64(max(40, 65 - 8 * width))) % np.uint64(groups)).astype(np.int64)


def key_bytes(words: int) -> int:
    """Bytes of a key: one bit less is enough for hashes of ``words`` words
    of which a quarter of KNOWN collide, and the rest is for keys of their
    own."""
    bits = 2 * max(words, 1).bit_length() - (KNOWN // 4).bit_length()
    return min(7, max(4, -(-(bits + 1) // 8)))


def _deal(group: np.ndarray, groups: int) -> Iterator[tuple[int, np.ndarray]]:
    """(group, places of its members, in their order)."""
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(groups + 1))
    for g in np.flatnonzero(np.diff(bounds)):
        yield int(g), order[bounds[g]:bounds[g + 1]]


def _sent_words(held: DataFrame, groups: int, width: int) -> DataFrame:
    def run(stream):
        for block, documents, words, tokens in rows_of(stream):
            spelled, docs = _spellings(words), _documents(documents)
            v, w = _neighbours(_unpack(tokens, "<u4"), docs[4])
            marked = np.repeat(docs[2], docs[4])
            columns = [np.bincount(x, minlength=len(spelled)) for x in (w, w[marked], v, v[marked])]
            rows = [(g, block, _spelled([spelled[i] for i in at]), _pack_counts(*[c[at] for c in columns]))
                    for g, at in _deal(_word_group(spelled, groups, width), groups)]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _SENT)], schema=_SENT)

    return held.select("block", "docs", "words", "tokens").mapInArrow(run, _SENT_ROW)


def _count_words(sent: DataFrame, often: int, width: int) -> DataFrame:
    """Answers to the blocks (kind 0: counts of words as word and as word
    before, in both models), and per group a row of kind 1 (numbers of words,
    of tokens in both models, and of words in the next two rows), of kind 2
    (words that collide) and of kind 3 (words followed more than ``often``
    times)."""
    def count(table):
        block, group = table["block"].to_pylist(), table["group"][0].as_py()
        number: dict[bytes, int] = {}
        places, sums = [], []
        for keys, counts in zip(table["keys"].to_pylist(), table["counts"].to_pylist()):
            spelled = _spellings(keys)
            places.append(np.fromiter((number.setdefault(w, len(number)) for w in spelled), dtype=np.int64, count=len(spelled)))
            sums.append(_unpack_counts(counts))
        at = np.concatenate(places)
        # sums of doubles are exact up to 2^53
        total = [np.bincount(at, weights=np.concatenate([s[k] for s in sums])).astype(np.int64) for k in range(4)]
        words = list(number)
        again = np.unique(_hashes(words) >> np.uint64(65 - 8 * width), return_inverse=True, return_counts=True)
        odd = sorted(words[i] for i in np.flatnonzero(again[2][again[1]] > 1))
        hot = sorted(words[i] for i in np.flatnonzero(total[2] > often))
        out = [(b, 0, group, _pack_counts(*[t[p] for t in total])) for b, p in zip(block, places)]
        real = np.array([w != b"" for w in words])
        out += [(-1, 1, group, _pack_counts(np.array([real.sum(), total[0].sum(), total[1].sum(), len(odd), len(hot)]))),
                (-1, 2, group, _spelled(odd) if odd else b""), (-1, 3, group, _spelled(hot) if hot else b"")]
        return pa.table([pa.array(c, type=f.type) for c, f in zip(zip(*out), _ANSWER)], schema=_ANSWER)

    return sent.groupBy("group").applyInArrow(count, _ANSWER_ROW)


class _Keys:
    """Exact keys of words, and the group of a pair: all pairs of a word
    before are in one group, but for words that are often followed (``hot``;
    None: for all words)."""

    def __init__(self, colliding: list[bytes], hot: list[bytes] | None, groups: int, width: int):
        self.width = width
        # the numbers past the hashes are free
        self.own = {w: (1 << 8 * width - 1) + i for i, w in enumerate(colliding)}
        self.hot, self.groups = None if hot is None else set(hot), groups

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Keys, and whether the pairs that begin with the word are spread."""
        keys = _hashes(words) >> np.uint64(65 - 8 * self.width)
        if self.own:
            for i, w in enumerate(words):
                if w in self.own:
                    keys[i] = self.own[w]
        spread = np.full(len(words), self.hot is None)
        if self.hot:
            spread[[i for i, w in enumerate(words) if w in self.hot]] = True
        return keys, spread

    def group(self, v: np.ndarray, w: np.ndarray, spread: np.ndarray) -> np.ndarray:
        mixed = v + np.where(spread, w * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(9), np.uint64(0))
        return (mixed % np.uint64(self.groups)).astype(np.int64)


def _pairs(words: int, tokens: np.ndarray, docs: tuple) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct pairs of places, as place * words + place, and the
    number of each token's pair."""
    v, w = _neighbours(tokens, docs[4])
    return np.unique(v.astype(np.int64) * words + w, return_inverse=True)


def _dealt_pairs(words: list[bytes], pairs: np.ndarray, keys: _Keys) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(group, places of its pairs, key of the word before, of the word), in
    the order of keys."""
    key, spread = keys.of(words)
    before, word = pairs // len(words), pairs % len(words)
    v, w = key[before], key[word]
    for g, at in _deal(keys.group(v, w, spread[before]), keys.groups):
        at = at[np.lexsort((w[at], v[at]))]
        yield g, at, v[at], w[at]


def _pack_pairs(v: np.ndarray, w: np.ndarray, width: int) -> bytes:
    """Pairs sorted by v: the w of ``width`` bytes each, distinct v as steps,
    and how many pairs each has."""
    heads, n = np.unique(v, return_counts=True)
    cut_ = lambda a: np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    steps = cut_(np.diff(heads, prepend=np.uint64(0)))
    return zstandard.ZstdCompressor(level=1).compress(
        cut_(w) + len(heads).to_bytes(8, "little") + steps + _pack_counts(n))


def _unpack_pairs(data: bytes, n_pairs: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)

    def whole(at, n):
        out = np.zeros((n, 8), dtype=np.uint8)
        out[:, :width] = np.frombuffer(raw, np.uint8, width * n, at).reshape(width, n).T
        return out.view("<u8").ravel()

    w, at = whole(0, n_pairs), width * n_pairs
    heads = int.from_bytes(raw[at:at + 8], "little")
    v = np.cumsum(whole(at + 8, heads), dtype=np.uint64)
    return np.repeat(v, _unpack_counts(raw[at + 8 + width * heads:])[0]), w


def _sent_pairs(held: DataFrame, keys: _Keys) -> DataFrame:
    shared = held.sparkSession.sparkContext.broadcast(keys)

    def run(stream):
        keys = shared.value
        for block, documents, words, tokens in rows_of(stream):
            spelled, docs = _spellings(words), _documents(documents)
            pairs, each = _pairs(len(spelled), _unpack(tokens, "<u4"), docs)
            marked = np.repeat(docs[2], docs[4])
            n, of_target = (np.bincount(x, minlength=len(pairs)) for x in (each, each[marked]))
            rows = [(g, block, _pack_pairs(v, w, keys.width), _pack_counts(n[at], of_target[at]))
                    for g, at, v, w in _dealt_pairs(spelled, pairs, keys)]
            for at in range(0, len(rows), 64):
                part = zip(*rows[at:at + 64])
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(part, _SENT)], schema=_SENT)

    return held.select("block", "docs", "words", "tokens").mapInArrow(run, _SENT_ROW)


def _count_pairs(sent: DataFrame, width: int) -> DataFrame:
    """Answers to the blocks (kind 4): counts of pairs in both models."""
    def count(table):
        lists, sums = [], []
        for keys, counts in zip(table["keys"].to_pylist(), table["counts"].to_pylist()):
            sums.append(_unpack_counts(counts))
            lists.append(_unpack_pairs(keys, len(sums[-1][0]), width))
        v, w = (np.concatenate([x[k] for x in lists]) for k in (0, 1))
        order = np.lexsort((w, v))
        v, w = v[order], w[order]
        new = np.ones(len(v), dtype=bool)
        new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
        starts = np.flatnonzero(new)
        place = np.empty(len(v), dtype=np.int64)
        place[order] = np.cumsum(new) - 1
        total = [np.add.reduceat(np.concatenate([s[k] for s in sums])[order], starts) for k in (0, 1)]
        ends = np.cumsum([len(x[0]) for x in lists])
        parts = np.split(place, ends[:-1])
        out = [(b, 4, g, _pack_counts(total[0][p], total[1][p]))
               for b, g, p in zip(table["block"].to_pylist(), table["group"].to_pylist(), parts)]
        return pa.table([pa.array(c, type=f.type) for c, f in zip(zip(*out), _ANSWER)], schema=_ANSWER)

    return sent.groupBy("group").applyInArrow(count, _ANSWER_ROW)


# -- scoring

_SCORED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("target_loss", pa.float64()),
                     ("background_loss", pa.float64())])


def _score(held: DataFrame, answers: DataFrame, word_groups: int, keys: _Keys, size: int, tokens: list[int],
           mix: float) -> DataFrame:
    """(row, doc_id, n, target_loss, background_loss): sums over the tokens
    of each document in a block.  ``size`` is the number of words, ``tokens``
    that of tokens in the background and in the target."""
    shared = held.sparkSession.sparkContext.broadcast(keys)

    def score(blocks, answers):
        keys = shared.value
        row = blocks.to_pylist()[0]
        got = {(k, g): _unpack_counts(c) for k, g, c in zip(*[answers[c].to_pylist() for c in ("kind", "group", "counts")])}
        spelled, docs = _spellings(row["words"]), _documents(row["docs"])
        word = np.zeros((4, len(spelled)), dtype=np.int64)
        for g, at in _deal(_word_group(spelled, word_groups, keys.width), word_groups):
            word[:, at] = got[0, g]
        pairs, each = _pairs(len(spelled), _unpack(row["tokens"], "<u4"), docs)
        joint = np.zeros((2, len(pairs)), dtype=np.int64)
        for g, at, _, _ in _dealt_pairs(spelled, pairs, keys):
            joint[:, at] = got[4, g]
        before, after = pairs // len(spelled), pairs % len(spelled)
        which = np.repeat(np.arange(len(docs[4])), docs[4])
        sums = []
        for k in (1, 0):
            alone = (word[k, after] + 1.0) / (tokens[k] + size)
            seen = word[2 + k, before]
            p = np.where(seen > 0, mix * joint[k] / np.maximum(seen, 1) + (1 - mix) * alone, alone)
            sums.append(np.bincount(which, weights=-np.log(p)[each], minlength=len(docs[4])))
        ids = pa.array(docs[5], mask=~docs[1])
        return pa.table([pa.array(docs[0]), ids, pa.array(docs[4]), *map(pa.array, sums)], schema=_SCORED)

    return (held.select("block", "docs", "words", "tokens").groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(score, "row long, doc_id long, n long, target_loss double, background_loss double"))


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, *, mix: float = MIX) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, target_loss,
    background_loss (means over the tokens), score (their difference).  The
    target model is that of the documents that ``labels`` marks good and not
    toxic, the background model that of all documents.

    Null, empty and blank texts have no token and zero losses.  Null doc_ids
    and repeated rows are carried through, and counted by the models; a doc_id
    with contradicting labels is not good, null labels are ignored.  Other
    columns are not read.  An empty table gives an empty result.
    """
    held = cut(blocks(mark_target(docs, labels)), "blocks")
    n = held.agg(F.sum("n_words").alias("words"), F.sum("n_pairs").alias("pairs")).first()
    word_groups, pair_groups = (max(1, -(-(x or 0) // most)) for x, most in ((n.words, WORD_GROUP), (n.pairs, PAIR_GROUP)))
    width = key_bytes(n.words or 0)
    words = cut(_count_words(_sent_words(held, word_groups, width), PAIR_GROUP // 4, width), "words")
    # a row for each group
    told = [_unpack_counts(bytes(r.counts))[0] for r in words.where("block = -1 and kind = 1").select("counts").collect()]
    size, background, target, n_colliding, n_hot = np.sum(told, axis=0).tolist() if told else [0] * 5
    if n_colliding > KNOWN:
        raise ValueError("more words collide than their hashes allow for")

    def listed(kind: int) -> list[bytes]:
        rows = words.where(f"block = -1 and kind = {kind} and length(counts) > 0").select("counts").collect()
        return [w for r in rows for w in _spellings(bytes(r.counts))]

    keys = _Keys(sorted(listed(2)), listed(3) if n_hot <= KNOWN else None, pair_groups, width)
    pairs = cut(_count_pairs(_sent_pairs(held, keys), width), "pairs")
    answers = words.where("block >= 0").union(pairs)
    scored = _score(held, answers, word_groups, keys, size, [background, target], mix)
    mean = lambda c: F.sum(c) / F.greatest(F.sum("n"), F.lit(1))
    # a long text has several rows
    return (scored.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"),
                                      mean("target_loss").alias("target_loss"),
                                      mean("background_loss").alias("background_loss"))
            .select("doc_id", "n_tokens", "target_loss", "background_loss",
                    (F.col("target_loss") - F.col("background_loss")).alias("score")))
