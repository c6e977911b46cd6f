"""SentencePiece encoding and decoding by a prefix table.

A merge-type vocabulary (BPE) gives every prefix of a text exactly one token
that can end its encoding.  An automaton over the spellings reports, for each
position, the tokens that end there; the one whose pair with the last token of
the prefix before it stays as it is when the two are encoded together is the
prefix's last token.  The ids are read backwards from the end of the text.

Only characters that stand next to each other within some spelling can ever
merge, so a text may be cut anywhere else: before a space, at line breaks, and
mostly before punctuation.  Each distinct word goes through the table once
while it is cached.
"""

from __future__ import annotations

import gc
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrecon.llm.bpe import Bounded, grouped, packed, ship
from acctrecon.llm.common import BATCH_BYTES, rows_of, utf8

#: Entries of a worker's cache of words (some 200 bytes each), and of half as
#: many token pairs; a full cache starts afresh.
CACHE = 1 << 19
#: Longer words are not cached, nor longer ones that end in punctuation.
SHORT, FEW = 48, 8
#: Characters of a word whose last tokens are kept for words that begin alike.
HEAD = 6
#: The library's mark of a space, and what it writes for the unknown token
#: and for a byte that is no text (fixed values).
SPACE = "▁"
UNKNOWN = " ⁇ "
NO_TEXT = "�"
_BYTE = re.compile("<0x([0-9A-F]{2})>")
_LINES = re.compile(r"\n|[^\n]+")
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*")


class State:
    """A state of the automaton: the longest end of the text read that some
    spelling begins with.  ``out`` has the tokens that end there, the longest
    first, as (token, length)."""

    __slots__ = ("next", "fail", "out")

    def __init__(self):
        self.next: dict[str, State] = {}
        self.fail: State | None = None
        self.out: tuple[tuple[int, int], ...] = ()


def automaton(spellings: dict[str, int]) -> State:
    """The start state for ``spellings`` (spelling -> token): a trie whose
    states know where to go on when the next character doesn't follow."""
    start = State()
    for text, token in spellings.items():
        at = start
        for c in text:
            at = at.next[c] if c in at.next else at.next.setdefault(c, State())
        at.out = ((token, len(text)),)
    level = [start]
    while level:
        below = []
        for at in level:
            for c, to in at.next.items():
                back = at.fail
                while back is not None and c not in back.next:
                    back = back.fail
                to.fail = start if back is None else back.next[c]
                to.out += to.fail.out
                below.append(to)
        level = below
    return start


class Words(Bounded):
    """A cache that computes what it lacks.  It keeps short words, and of
    those that are put together from others only very short ones, which recur.
    When half full it sets its words aside as old and drops those that were
    old before; an old word that comes up is kept again."""

    def __init__(self, make, most: int = CACHE):
        super().__init__(make, most)
        self.old: dict[str, bytes] = {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value, plain = self.make(key)
            if len(key) > (SHORT if plain else FEW):
                return value
        if len(self) >= self.most // 2:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceTable:
    """Vocabulary, automaton and pair tests of one model file.

    The model is of the merge type, writes a space as a mark of its own, puts
    one before a text, spells unknown characters in bytes and changes nothing
    else; any other model is an error."""

    def __init__(self, path: str, cache: int = CACHE):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        if model.encode_as_pieces("a  ﬁ b") != model.encode_as_pieces(f"a{SPACE}{SPACE}ﬁ{SPACE}b"):
            raise ValueError("the model changes its text before it encodes")
        self.spelling = [model.id_to_piece(i) for i in range(size)]
        self.length = list(map(len, self.spelling))
        self.end, self.unknown = model.eos_id(), model.unk_id()
        self.byte = {i: int(_BYTE.fullmatch(self.spelling[i])[1], 16) for i in range(size) if model.is_byte(i)}
        if len(self.byte) != 256:
            raise ValueError("the model doesn't spell unknown characters in bytes")
        self.control = {i for i in range(size) if model.is_control(i)}
        self.of_byte = {b: i for i, b in self.byte.items()}
        plain = [i for i in range(size) if i not in self.control and i not in self.byte and i != self.unknown
                 and not model.is_unused(i)]
        self.score = {self.spelling[i]: model.get_score(i) for i in plain}
        self.touch = {s[k:k + 2] for s in self.score for k in range(len(s) - 1)}
        self.breaks = not any("\n" in pair for pair in self.touch)
        # a token that its own spelling isn't encoded to never occurs
        made = {i: self._merged(self.spelling[i]) for i in plain}
        reached = [i for i in plain if len(made[i][0]) == 1]
        self.whole = {self.spelling[i]: np.array([i], "<i4").tobytes() for i in reached}
        self.start = automaton({self.spelling[i]: i for i in reached})
        self.data = [b"" if i in self.control else bytes([self.byte[i]]) if i in self.byte
                     else (UNKNOWN if i == self.unknown else x.replace(SPACE, " ")).encode()
                     for i, x in enumerate(self.spelling)]
        self.texts = pa.array(self.data, pa.large_binary())
        self.size = np.array(list(map(len, self.data)))
        self.ends = np.isin(np.arange(size), list(self.control))
        self.skip = np.array([x[:1] == SPACE and i not in self.control and i not in self.byte and i != self.unknown
                              for i, x in enumerate(self.spelling)])
        self._trace({self.spelling[i]: made[i][1] for i in reached})
        self.fits = Bounded(self._fits, cache // 2)
        self.heads = Bounded(self._head, cache // 8)
        self.word = Words(self._word, cache)

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Best-scored merging, leftmost first, of a few characters; and the
        two parts that the last merge joined."""
        parts, score, joined = list(text), self.score.get, None
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            joined = parts[at], parts[at + 1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts, joined

    def _trace(self, joined: dict[str, tuple[str, str] | None]) -> None:
        """Per token, the parts that stand at its right end (``right``) and
        at its left end (``left``) while it grows, each with the rank of the
        merge that takes it in.  Only for tokens whose merges all have ranks
        of their own that rise; the pairs of others are judged by merging."""
        times = Counter(self.score.values())
        self.rank = {s: -x for s, x in self.score.items() if len(s) > 1}
        self.right, self.left = {}, {}
        for s in sorted(joined, key=len):
            if len(s) == 1:
                self.right[s] = self.left[s] = [(s, math.inf)]
                continue
            a, b = joined[s]
            r = self.rank[s]
            if times[self.score[s]] == 1 and all(x in self.right and self.rank.get(x, -math.inf) < r for x in (a, b)):
                grown = lambda spine: [(x, min(end, r)) for x, end in spine]
                self.right[s] = [(s, math.inf), *grown(self.right[b])]
                self.left[s] = [(s, math.inf), *grown(self.left[a])]

    def _fits(self, pair: int) -> bool:
        """Whether two tokens (first * number of tokens + second) stay as
        they are when their spellings are encoded together."""
        a, b = divmod(pair, len(self.spelling))
        if a == self.unknown:
            return True
        a, b = self.spelling[a], self.spelling[b]
        if a[-1] + b[0] not in self.touch:
            return True
        if a not in self.right or b not in self.left:
            return self._merged(a + b)[0] == [a, b]
        rank = self.rank.get
        for x, x_ends in self.right[a]:
            for y, y_ends in self.left[b]:
                r = rank(x + y)
                # of equal merges the left one comes first
                if r is not None and r < x_ends and r <= y_ends:
                    return False
        return True

    def last_tokens(self, text: str) -> list[int]:
        """For each prefix of ``text`` (by length) its last token; characters
        without a spelling have the unknown token.  Entries of a prefix depend
        on it alone, so those of the first characters are kept."""
        if len(text) <= HEAD:
            return self._read(text, self.start, [self.unknown])[1]
        state, last = self.heads[text[:HEAD]]
        return self._read(text[HEAD:], state, last.copy())[1]

    def _head(self, text: str) -> tuple[State, list[int]]:
        return self._read(text, self.start, [self.unknown])

    def _read(self, text: str, state: State, last: list[int]) -> tuple[State, list[int]]:
        """Read on from ``state``, with the last tokens of the prefixes that
        led there: the new state, and the tokens with those of ``text``."""
        fits, start, size, unknown, end = self.fits, self.start, len(self.spelling), self.unknown, len(last) - 1
        for c in text:
            end += 1
            to = state.next.get(c)
            while to is None and state is not start:
                state = state.fail
                to = state.next.get(c)
            if to is None:
                last.append(unknown)
                continue
            state = to
            for token, length in to.out:
                if length == end or fits[last[end - length] * size + token]:
                    last.append(token)
                    break
            else:
                last.append(unknown)
        return state, last

    def _word(self, word: str) -> tuple[bytes, bool]:
        """Packed ids of a word with the marks before it, and whether they
        come from the table and not from other words."""
        whole = self.whole.get(word)
        if whole is not None:
            return whole, True
        if self.breaks and "\n" in word and word != "\n":
            return b"".join([self.word[x] for x in _LINES.findall(word)]), False
        if len(word) > SHORT:
            # text without spaces: cut it wherever nothing can merge
            inside = map(self.touch.__contains__, map(add, word, word[1:]))
            cuts = [0, *[k for k, joined in enumerate(inside, 1) if not joined], len(word)]
            if len(cuts) > 2:
                return b"".join([self.word[word[a:b]] for a, b in zip(cuts, cuts[1:])]), False
        elif len(word) > 1 and word[-2:] not in self.touch:
            return self.word[word[:-1]] + self.word[word[-1]], False
        last, out, at, length = self.last_tokens(word), [], len(word), self.length
        while at:
            token = last[at]
            if token == self.unknown:
                out += [self.of_byte[b] for b in reversed(word[at - 1].encode())]
                at -= 1
            else:
                out.append(token)
                at -= length[token]
        out.reverse()
        return packed(out), True

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, without an end id, as little-endian 32-bit
        integers."""
        if not text:
            return b""
        if text[0] == " " or "  " in text or SPACE in text:
            words = _WORDS.findall(SPACE + text.replace(" ", SPACE))
        else:
            words = (SPACE + text.replace(" ", " " + SPACE)).split(" ")
        return b"".join(map(self.word.__getitem__, words))

    def decode(self, ids: list[int]) -> str:
        """The text of any ids, as the library's decode gives it."""
        first = next((i for i in ids if i not in self.control), self.unknown)
        skip = 1 if first not in self.byte and first != self.unknown and self.spelling[first][0] == SPACE else 0
        body = ids[:-1] if ids and ids[-1] in self.control else ids
        if self.control.isdisjoint(body):
            try:
                return b"".join(map(self.data.__getitem__, body)).decode()[skip:]
            except UnicodeDecodeError:
                pass
        # bytes make a text up to the next token of another kind
        out, held = [], bytearray()
        for i in ids:
            if i in self.byte:
                held.append(self.byte[i])
            elif held:
                out += [_from_bytes(bytes(held)), self.data[i].decode()]
                held.clear()
            else:
                out.append(self.data[i].decode())
        return "".join([*out, _from_bytes(bytes(held))])[skip:]

    def decode_many(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """``decode`` of runs of ``counts`` ids.  All data are put together at
        once; runs with bytes that are no text, or with control tokens before
        their last, are decoded one by one."""
        data = self.texts.take(pa.array(ids)).buffers()[2]
        data = memoryview(data) if data else b""
        upto = np.concatenate([[0], np.cumsum(counts)])
        at = np.concatenate([[0], np.cumsum(self.size[ids])])[upto].tolist()
        ends = self.ends[ids]
        before = np.concatenate([[0], np.cumsum(ends)])[upto].tolist()
        upto, out = upto.tolist(), []
        for k, (a, b) in enumerate(zip(upto, upto[1:])):
            if a == b:
                out.append("")
                continue
            text = None
            if before[k + 1] - before[k] == ends[b - 1]:
                try:
                    text = str(data[at[k]:at[k + 1]], "utf-8")[int(self.skip[ids[a]]):]
                except UnicodeDecodeError:
                    pass
            out.append(self.decode(ids[a:b].tolist()) if text is None else text)
        return out


def _from_bytes(data: bytes) -> str:
    """UTF-8 as text; each byte that is no text becomes U+FFFD."""
    out = []
    while data:
        try:
            out.append(data.decode())
            break
        except UnicodeDecodeError as e:
            out += [data[:e.start].decode(), NO_TEXT]
            data = data[e.start + 1:]
    return "".join(out)


@lru_cache(maxsize=1)
def _table(name: str, cache: int) -> PieceTable:
    """One table for a worker, kept over its tasks."""
    out = PieceTable(SparkFiles.get(name), cache)
    gc.freeze()  # its many states need no look by the garbage collector
    return out


def _encoded(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(doc_id, packed ids) rows in batches of bounded bytes."""
    def batch():
        offsets = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in packed_ids])]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed_ids), "<i4")))
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), ids], schema=schema)

    docs, packed_ids, size = [], [], 0
    for doc, ids in rows:
        docs.append(doc)
        packed_ids.append(ids)
        size += 64 + len(ids)
        if size >= BATCH_BYTES:
            yield batch()
            docs, packed_ids, size = [], [], 0
    if docs:
        yield batch()


def encode_documents(docs: DataFrame, model: str, *, cache: int = CACHE) -> DataFrame:
    """(doc_id, ids) for each row of ``docs`` (doc_id, text), by the model file
    ``model``; ids is an array of integers that ends with the end id.

    Null and empty texts have the end id alone.  Strings of control tokens are
    ordinary text.  Null doc_ids and repeated rows are carried through; other
    columns are not read; an empty table gives an empty result.  A worker's
    caches have at most ``cache`` entries each; the result does not depend on
    it.
    """
    name = ship(docs.sparkSession, model)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(stream):
        table = _table(name, cache)
        end = np.array([table.end], "<i4").tobytes()
        yield from _encoded(((i, table.encode(t.decode("utf-8", "replace")) + end)
                             for held in grouped(rows_of(stream)) for i, t in held), schema)

    return (docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text"))
            .mapInArrow(run, "doc_id long, ids array<int>"))


def decode_documents(encoded: DataFrame, model: str, *, cache: int = CACHE) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded text as ``text``; null ids
    are no ids, control ids have no text."""
    name = ship(encoded.sparkSession, model)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text", pa.string())])

    def run(stream):
        decode = _table(name, cache).decode_many
        for batch in stream:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids = part["ids"].cast(schema.field("ids").type)
                counts = pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False)
                texts = decode(ids.flatten().to_numpy(zero_copy_only=False), counts)
                yield pa.RecordBatch.from_arrays([part["doc_id"], ids, pa.array(texts, pa.string())], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
