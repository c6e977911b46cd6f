"""Each operator on small tables of odd rows, against brute force."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers as P
from acctrecon.llm import bpe, embeddings, line_dedup as L, lm_score, packing, quality, quotes, simhash, warc
from acctrecon.llm.common import new_folder
from acctrecon.llm.components import components
from acctrecon.llm.exact_dedup import exact_dedup
from acctrecon.llm.queries import ORACLE_SQL, QUERIES, RANKS, TOKENIZER

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
LINE = "A line that several documents share"
ROWS = [
    (1, None), (2, ""), (3, "\n\n"), (4, LINE + "\nown words of four"), (5, "  " + LINE.upper() + "\t\nfive"),
    (6, LINE + "\n" + LINE), (6, LINE + "\n" + LINE), (7, "one two three four five six seven"),
    (8, "one two three four five six seven"), (9, "ONE two three four five six seven"), (None, LINE),
    (10, "wörter ohne ende " * 4000), (11, "x" * 30000), (12, "short"), (13, "<|endoftext|> it's  odd   .\r\n"),
]


@pytest.fixture(scope="module")
def docs(spark):
    extra = [(i, t, "en", "s", len(t or ""), "k", i) for i, t in ROWS]
    return spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long, "
                                        "keep_id string, node long")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


# -- 1
def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(None, 1, 0), (4, None, 0), (7, 1, 0), (7, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.score_documents(docs, quality.train(docs, labels)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out is None if r.doc_id is None else r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
               for r in rows)
    assert got(quality.score_documents(none, quality.LineField())) == []
    assert quality.keep_good(docs, quality.LineField()).columns == docs.columns


def test_quality_counts_a_repeated_doc_id_once(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1][:20]
    rows = [(i, ("good plain words here\n" if i % 2 else "BUY!!! $$$ 1234\n") * (1 + i % 5)) for i in ids]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids], "doc_id long, quality int, toxic int")
    train = lambda r: quality.train(spark.createDataFrame(r, "doc_id long, text string"), labels)
    once = train(rows)
    many = train(rows + [(ids[0], rows[0][1] + "z" * k) for k in range(40)])
    assert np.array_equal(once.weights, many.weights) and np.array_equal(once.links, many.links)


def test_field_marginals_are_those_of_all_labelings():
    r = np.random.default_rng(0)
    m = quality.LineField(links=np.array([0.7, -0.4]))
    s = r.normal(size=6)
    total, good = 0.0, np.zeros(6)
    for y in itertools.product((0, 1), repeat=6):
        w = np.exp(sum(s[i] for i in range(6) if y[i]) + sum(
            m.links[a] for a, b in zip(y, y[1:]) if a == b))
        total, good = total + w, good + w * np.array(y)
    assert np.allclose(m.marginals(s), good / total)


def slow_line(line):
    """Own features of a line, one by one."""
    words, n = line.split(), max(1, len(line))
    kinds = ["".join(map(chr, range(97, 123))), "".join(map(chr, range(65, 91))), "0123456789", "\t\n\x0b\x0c\r ", ".,;:'\"()-?", "!", "|"]
    share = [sum(chr(c) in k for c in line) / n for k in kinds]
    high = sum(c >= 128 for c in line) / n
    other = sum(c < 128 and not any(chr(c) in k for k in kinds) for c in line) / n
    some = [0.0] * 5
    if words:
        marked = sum(w[-1] < 128 and (chr(w[-1]) == "!" or not any(chr(w[-1]) in k for k in kinds)) for w in words)
        some = [np.log1p(len(words)), np.log1p((len(line) - len(words) + 1) / len(words)), len(set(words)) / len(words),
                sum(a == b for a, b in zip(words, words[1:])) / len(words), marked / len(words)]
    return np.array([np.log1p(len(line)), *some, *share, other, high])


def test_quality_score_is_the_slow_one(spark):
    """Features line by line, marginals over all labelings, weights by length."""
    model = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert model.weights.any()
    for text in ("", "One short line.", "A first line of words\n\nBUY NOW $$$ 50% OFF!!!\n| a | b |\nthe the end of it é #",
                 "x" * 400 + "\ny", "\n\n"):
        lines = text.encode().split(b"\n")
        own = [(slow_line(x) - model.mean) / model.scale for x in lines]
        s, n = [], len(lines)
        for i in range(n):
            near = [own[i], own[i - 1] if i else own[0] * 0, own[i + 1] if i + 1 < n else own[0] * 0]
            s.append(np.concatenate([*near, [float(i == 0), float(i == n - 1), 1.0]]) @ model.weights)
        total, good = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(s[i] for i in range(n) if y[i]) + sum(model.links[a] for a, b in zip(y, y[1:]) if a == b))
            total, good = total + w, good + w * np.array(y)
        length = np.array([len(x) + 1 for x in lines])
        assert abs(model.score(text.encode()) - (good / total) @ length / length.sum()) < 1e-9, text


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op1_quality"](spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    known = [(rows[x.doc_id].predicted, x.quality) for x in labels if rows[x.doc_id].held_out]
    assert sum(a == b for a, b in known) / len(known) > 0.95


# -- 2
def brute_lines(rows):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(SPACE))
    held = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 20:
                held.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or len(held.get(key(x), ())) < 3 or max(held[key(x)]) == i]
        out.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=str)


def test_line_dedup(docs, none):
    assert got(L.line_dedup(docs)) == brute_lines(ROWS)
    assert got(L.line_dedup(none)) == []
    out = L.without_repeats(docs)
    assert out.columns == docs.columns and all(r.n_chars == len(r.text) for r in out.collect())


def test_line_index_is_reversible(spark, docs):
    more = spark.createDataFrame([(20, LINE), (21, LINE + "\nnew text that is long enough"), (22, None)],
                                 "doc_id long, text string")
    base = L.LineIndex(spark).insert(docs)
    grown = base.insert(more)
    assert got(L.line_dedup(more, index=grown)) == [(20, "", 1, 1), (21, LINE + "\nnew text that is long enough", 2, 0),
                                                    (22, "", 1, 0)]
    back = grown.delete(more.select("doc_id"))
    assert got(back.counts.select("key", "n_docs", "owner")) == got(base.counts.select("key", "n_docs", "owner"))
    assert got(L.line_dedup(docs, index=back)) == got(L.line_dedup(docs, index=base))
    gone = back.delete(docs.select("doc_id"))
    assert gone.counts.count() == 0 and all(not any(r.slots) for r in gone.filters.collect())


@pytest.mark.parametrize("probe", [1 << 20, 2])
def test_filters_past_the_bound_are_probed_by_shard(spark, docs, monkeypatch, probe):
    """With no filter small enough to be sent, shards of few keys, and shards
    whose postings go to several tasks."""
    for name, value in (("BROADCAST_BYTES", 0), ("SHARD_KEYS", 2), ("PROBE", probe)):
        monkeypatch.setattr(L, name, value)
    lines = [f"shared line number {k:04d} of many" for k in range(40)]
    rows = [*ROWS, *[(100 + i, "\n".join(lines[i % 7:] + [f"own line of document {i:05d}"])) for i in range(12)]]
    seen = []
    plain = L.LineIndex._probed_by_shard
    monkeypatch.setattr(L.LineIndex, "_probed_by_shard", lambda self, p: seen.append((p.count(), plain(self, p))) or seen[-1][1])
    assert got(L.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_lines(rows)
    every, passed = seen[0][0], seen[0][1].count()
    assert len(seen) == 1 and 0 < passed < every  # lines of one document meet no filter


def test_an_index_grows_by_parts(spark, monkeypatch):
    monkeypatch.setattr(L, "PARTS", 3)
    monkeypatch.setattr(L, "SHARD_KEYS", 4)
    rows = [(i, "\n".join(f"a line that is long enough {k}" for k in range(i % 5, 9))) for i in range(24)]
    index, parts = L.LineIndex(spark), []
    for at in range(0, 24, 4):
        index = index.insert(spark.createDataFrame(rows[at:at + 4], "doc_id long, text string"))
        parts.append(index.parts)
    assert max(parts) == 3 and parts.count(1) > 1 and index.shards > 1  # written anew, and dealt to more shards
    table = spark.createDataFrame(rows, "doc_id long, text string")
    once = L.LineIndex(spark).insert(table)
    assert got(index.counts.select("key", "n_docs", "owner")) == got(once.counts.select("key", "n_docs", "owner"))
    assert got(L.line_dedup(table, index=index)) == brute_lines(rows)


def test_a_full_shard_is_built_anew(spark):
    keys = [hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(60)]
    table = lambda k, into: spark.createDataFrame([(bytearray(x), into) for x in k], "key binary, into boolean")
    small = L.CuckooFilter.of(keys[:4])
    old = spark.createDataFrame([(0, small.buckets, bytearray(small.slots.tobytes()))], "shard long, buckets long, slots binary")
    built = L.update_filters(old, table(keys[4:], True), table(keys, True), 1).collect()
    f = L.CuckooFilter(built[0].buckets, bytes(built[0].slots))
    assert len(built) == 1 and f.buckets > small.buckets
    assert f.holds(np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 16)).all()


def test_cuckoo_filter():
    keys = [hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(3000)]
    f = L.CuckooFilter.of(keys[:2000])
    rows = np.frombuffer(b"".join(keys), dtype=np.uint8).reshape(-1, 16)
    assert f.holds(rows)[:2000].all() and f.holds(rows)[2000:].mean() < 0.01
    assert all(f.delete(k) for k in keys[:1000])
    assert f.holds(rows)[1000:2000].all() and f.holds(rows)[:1000].mean() < 0.01


# -- 3
def test_warc(spark):
    body = "ä" * 600
    rows = [(1, "u\r\nX: y", body), (2, None, body), (2, "u", body), (3, "u", None), (4, "u", "small"), (5, "u", "small"),
            (None, "u", body), (6, "u", "WARC/1.1\r\n\r\n" * 200)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    folder = new_folder(spark, "warc")
    index = warc.write_archive(pages, folder)
    back = warc.read_records(index, folder).collect()
    want = [(i, "revisit" if i == 1 else "response", 2 if i == 1 else None, len((h or "").encode()),
             hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h in rows]
    assert sorted([(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in back],
                  key=str) == sorted(want, key=str)
    one = warc.read_records(index.where("page_id = 6"), folder).collect()
    assert len(one) == 1 and bytes(one[0].payload).decode() == rows[-1][2]
    assert got(warc.archive_round_trip(pages.limit(0))) == []


def test_warc_of_a_page_id_with_several_payloads(spark):
    a, b, c = ("abc"[k] * 1200 for k in range(3))
    rows = [(5, a), (9, a), (5, b), (5, "small"), (7, c), (5, c), (5, c), (9, b), (9, "small")]
    pages = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string")
    folder = new_folder(spark, "warc")
    back = warc.read_records(warc.write_archive(pages, folder), folder).collect()
    refers = {(5, a): 9, (5, b): 9, (5, c): 7}
    want = [(i, refers.get((i, h)), hashlib.sha1(h.encode()).hexdigest(), None if (i, h) in refers else h) for i, h in rows]
    assert sorted([(r.page_id, r.refers_to, r.payload_digest, r.payload and bytes(r.payload).decode()) for r in back],
                  key=str) == sorted(want, key=str)


def test_warc_reads_by_bytes_and_cleans_up(spark, monkeypatch):
    """A payload of many frames' size, bundles that roll over, and as many
    read tasks as the compressed bytes ask for."""
    monkeypatch.setattr(warc, "READ_BYTES", 40_000)
    r = random.Random(8)
    noise = lambda n: "".join(chr(r.randint(33, 126)) for _ in range(n))
    rows = [(i, "u", noise(3000)) for i in range(150)] + [(500, "u", noise(700_000)), (501, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    folder = new_folder(spark, "warc")
    index = warc.write_archive(pages, folder, frame_bytes=10_000, bundle_bytes=60_000)
    frames = index.select("bundle", "frame", "frame_bytes").distinct().collect()
    assert len({f.bundle for f in frames}) > 3 and max(f.frame_bytes for f in frames) > 400_000
    back = warc.read_records(index, folder)
    assert back.rdd.getNumPartitions() == -(-sum(f.frame_bytes for f in frames) // 40_000) > 5
    assert {x.page_id: bytes(x.payload).decode() for x in back.collect()} == {i: h or "" for i, _, h in rows}
    gone = []
    monkeypatch.setattr(warc, "remove_at_exit", lambda spark, folder: gone.append(folder))
    assert warc.archive_round_trip(pages).count() == len(rows) and len(gone) == 1 and "/warc-" in gone[0]
    assert warc.archive_round_trip(pages, folder + "-kept").count() == len(rows) and len(gone) == 1


# -- 4
def brute_replies(rows):
    """turn -> parent by the written rules, passages as text: a message
    replies to the latest earlier first writer of its outermost passages, whole
    paragraphs before lines before sentences, else to the turn before it."""
    import re

    flat = lambda t: " ".join(re.findall(r"\w+", t.casefold()))

    def parts(text):
        runs, out = [], []
        for line in text.split("\n"):
            m = re.match(r"[ \t]*((?:>[ \t]?)*)", line)
            level, rest = m[1].count(">"), line[m.end():] if m[1] else line
            if not rest.strip():
                runs.append(None)
            elif runs and runs[-1] and runs[-1][0] == level:
                runs[-1][1].append(rest)
            else:
                runs.append((level, [rest]))
        for level, lines in filter(None, runs):
            whole = " ".join(lines)
            out += [(level, 0, flat(whole))] + [(level, 1, flat(x)) for x in lines]
            out += [(level, 2, flat(x)) for x in re.split(r"(?<=[.!?])\s+", whole)]
        return {p for p in out if p[2]}

    first, parent, turns = {}, {}, sorted({t for t, _ in rows})
    every = {t: set().union(*[parts(x) for u, x in rows if u == t]) for t in turns}
    for t in turns:
        for level, grain, key in every[t]:
            if not level:
                first[grain, key] = min(t, first.get((grain, key), t))
    for n, t in enumerate(turns):
        found = [(-level, -grain, first[grain, key]) for level, grain, key in every[t]
                 if level and first.get((grain, key), t) < t]
        parent[t] = max(found)[2] if found else (turns[n - 1] if n else None)
    return parent


def test_quotes_against_brute_force(spark):
    """Planted quotes: whole, of one sentence, wrapped anew, nested; and
    quotes that nobody wrote."""
    r, rows = random.Random(11), []
    for conv in range(25):
        said = []
        for turn in range(r.randint(3, 9)):
            own = " ".join(f"Word{r.randint(0, 60)} and word{r.randint(0, 60)} go to place{r.randint(0, 400)}{r.choice('.!?')}"
                           for _ in range(r.randint(1, 4)))
            text = own
            if said and r.random() < 0.8:
                _, source = r.choice(said)
                sentences = source.replace("! ", "!|").replace("? ", "?|").replace(". ", ".|").split("|")
                kind = r.randint(0, 4)
                if kind == 0:
                    quoted = [source]
                elif kind == 1:
                    quoted = [r.choice(sentences)]
                elif kind == 2:  # wrapped anew
                    words = source.split(" ")
                    cut = r.randint(1, max(1, len(words) - 1))
                    quoted = [" ".join(words[:cut]), " ".join(words[cut:])]
                elif kind == 3:
                    quoted = ["> " + r.choice(sentences).upper(), sentences[-1]]
                else:
                    quoted = [f"nobody wrote this {turn}"]
                text = "\n".join("> " + q for q in quoted if q) + "\n" + own
            said.append((turn, own))
            rows.append((conv, turn, "user", text))
    want = {(c, t): p for c in range(25) for t, p in brute_replies([(t, x) for k, t, _, x in rows if k == c]).items()}
    out = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(x.conv_id, x.turn): x.parent_turn for x in out} == want
    jumps = [1 for (c, t), p in want.items() if p is not None and p != t - 1]
    assert len(jumps) > 25 and any(x.n_linked < x.n_quotes for x in out)


def test_quotes_of_a_long_text(spark):
    long = " ".join(f"Sentence number {k} of a long text." for k in range(20000))
    rows = [(1, 0, "user", long), (1, 1, "user", "short"), (1, 2, "user", "> Sentence number 19999 of a long text.\nYes"),
            (1, 3, "user", "> > " * 500 + "deep\n" + "> short")]
    out = {x.turn: x for x in quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
           .collect()}
    assert {t: x.parent_turn for t, x in out.items()} == {0: None, 1: 0, 2: 0, 3: 1} and out[3].max_level == 1000


def test_quotes(spark):
    rows = [(1, 0, "user", "First point.\n\nSecond point!"), (1, 1, "assistant", "> second  POINT\nAgreed."),
            (1, 2, "user", "Ann wrote:\n> > Second point!\n> Agreed.\nThanks"), (1, 3, "user", "> nobody said this\nHm"),
            (1, 4, "user", "> First point.\nBack to the first"), (2, 0, None, None), (2, 0, None, ""),
            (None, None, "user", "> x"), (2, 7, "user", "end")]
    out = quotes.link_quotes(spark.createDataFrame([(*r, 1) for r in rows],
                                                   "conv_id long, turn long, role string, text string, position int"))
    by = {(r.conv_id, r.turn, r.position): r for r in out.collect()}
    assert len(by) == len(rows)
    assert {r.turn: r.parent_turn for r in by.values() if r.conv_id == 1} == {0: None, 1: 0, 2: 1, 3: 2, 4: 0}
    assert [r.turn for r in sorted((r for r in by.values() if r.conv_id == 1), key=lambda r: r.position)] == [0, 1, 4, 2, 3]
    assert next(r.text for r in by.values() if (r.conv_id, r.turn) == (1, 2)) == "Thanks"
    assert sorted(r.position for r in by.values() if r.conv_id == 2) == [0, 1, 2]
    assert got(quotes.link_quotes(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))) == []


# -- 5
BITS = ["a", "the", " ", "  ", "\n", "\t", "'s", "1", "é", " ", "\x1c", "\x85", "<|endoftext|>", "日本", "🙂", "...", "\r\n"]


def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe(docs, none):
    lib = library()
    rows = bpe.decode_documents(bpe.encode_documents(docs, RANKS), RANKS).collect()
    want = sorted([(i, np.array(lib.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in ROWS], key=str)
    assert sorted([(r.doc_id, bytes(r.ids), bytes(r.data)) for r in rows], key=str) == want
    assert got(bpe.encode_documents(none, RANKS)) == []


def test_bpe_random_texts_appends_and_edits():
    lib, enc, r = library(), bpe.PrefixEncoder(bpe.read_ranks(RANKS)), random.Random(5)
    texts = ["".join(r.choices(BITS, k=r.randint(0, 20))) for _ in range(2000)]
    for t, ids in zip(texts, enc.encode_many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(t) and enc.decode(ids) == t.encode()
    whole = lambda b: lib._core_bpe.encode_single_piece(b)
    for _ in range(60):
        a = bytes(r.choices(b"theand ing", k=r.randint(1, 400)))
        piece = bpe.Appendable(enc, a).append(b"ation")
        assert piece.ids() == whole(a + b"ation") and piece.worked == 5
        at = r.randint(0, len(a))
        to = r.randint(at, min(len(a), at + 4))
        piece.edit(at, to, b"er")
        assert piece.data == (a + b"ation")[:at] + b"er" + (a + b"ation")[to:] and piece.ids() == whole(piece.data)
    long = bpe.Appendable(enc, b"theanding" * 400)
    long.edit(5, 6, b"q")
    assert long.ids() == whole(long.data) and long.worked < 400


# -- 6
@pytest.mark.parametrize("bounds", [{}, {"BLOCK": (5, 3), "WORD_GROUP": 7, "PAIR_GROUP": 40, "MARKED": 1},
                                    {"BLOCK": (1000, 2), "PAIR_GROUP": 50, "KNOWN": 0}, {"BLOCK": (9, 9), "key_bytes": lambda words: 1}])
def test_lm_score_counts_words_and_pairs_by_themselves(spark, docs, none, monkeypatch, bounds):
    """Also with tiny blocks and groups, marked ids that are joined, every
    word spread, and hashes of 7 bits, some of which collide."""
    for name, value in bounds.items():
        monkeypatch.setattr(lm_score, name, value)
    labels = spark.createDataFrame([(7, 1, 0), (7, 1, 0), (5, 1, 0), (11, 1, 0), (10, 0, 0), (4, 1, 1), (8, 1, 0), (8, 0, 0),
                                    (None, 1, 0), (9, None, None)], "doc_id long, quality int, toxic int")
    good = {5, 7, 11}
    texts = [(i, [b"", *(t or "").encode().lower().split()]) for i, t in ROWS]
    pair, context, word = ([Counter(), Counter()] for _ in range(3))
    for i, seq in texts:
        for k in (0, 1) if i in good else (0,):
            pair[k].update(zip(seq, seq[1:]))
            context[k].update(seq[:-1])
            word[k].update(seq[1:])

    def p(k, v, w):
        alone = (word[k][w] + 1) / (sum(word[k].values()) + len(word[0]))
        return 0.5 * pair[k][v, w] / context[k][v] + 0.5 * alone if context[k][v] else alone

    assert all(abs(sum(p(k, v, w) for w in word[0]) - 1) < 1e-9 for k in (0, 1) for v in context[0])
    want = []
    for i, seq in texts:
        n = len(seq) - 1
        loss = [sum(-np.log(p(k, v, w)) for v, w in zip(seq, seq[1:])) / max(n, 1) for k in (1, 0)]
        want.append((i, n, *loss, loss[0] - loss[1]))
    out = lm_score.cross_entropy_difference(docs.repartition(3), labels)
    assert out.columns == ["doc_id", "n_tokens", "target_loss", "background_loss", "score"]
    key = lambda r: (str(r[0]), r[1], round(r[2], 6))
    rows, want = sorted(map(tuple, out.collect()), key=key), sorted(want, key=key)
    assert [r[:2] for r in rows] == [r[:2] for r in want]
    assert np.allclose([r[2:] for r in rows], [r[2:] for r in want], atol=1e-9)
    assert got(lm_score.cross_entropy_difference(none, labels)) == []


# -- 7
def test_exact_dedup_of_a_digest_past_the_heavy_ones(spark):
    """With two digests split off, the third hottest is joined, not held."""
    text = lambda i: "abc"[0 if i % 10 < 5 else 1 if i % 10 < 8 else 2] if i % 4 else f"own {i}"
    rows = [(i, text(i)) for i in range(2000)]
    out = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), k=2, tracked=8)
    groups = Counter(t for _, t in rows)
    last = {t: i for i, t in rows}
    assert got(out.select("doc_id", "keep_id", "group_size", "kept")) == sorted(
        [(i, last[t], groups[t], last[t] == i) for i, t in rows], key=str)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k", [1, 512])
def test_exact_dedup(docs, none, k):
    text = [(i, t or "") for i, t in ROWS]
    want = []
    for i, t in text:
        ids = [j for j, s in text if s == t]
        keep = max([j for j in ids if j is not None], default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert got(exact_dedup(docs, k=k, tracked=max(k, 8))) == sorted(want, key=str)
    assert got(exact_dedup(none)) == []


# -- 8
def test_embeddings(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(12, 8))
    x = np.vstack([base + r.normal(size=(12, 8)) * e for e in (0, 0, .05, .1, .15, .3)])
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    rows += [(100, None, 1), (101, [0.0] * 8, 1), (102, [float("nan")] * 8, 1), (103, [None] * 8, 1), (104, x[0].tolist(), None),
             (105, [], 1), (106, [1.0], 1), (0, x[0].tolist(), 0), (107, (x[0] * 3).tolist(), 0)]
    v = spark.createDataFrame([(*a, "z") for a in rows], "vec_id long, embedding array<double>, label int, component string")
    unit = [embeddings.unit_vector(e) if lab is not None else None for _, e, lab in rows]
    n = len(rows)
    link = [[b for b in range(n) if a != b and unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b])
             and rows[a][2] == rows[b][2] and unit[a] @ unit[b] >= 0.98] for a in range(n)]
    want = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            new = set(link[todo.pop()]) - seen
            seen |= new
            todo += new
        root = min(rows[b][0] for b in seen)
        want.append((rows[a][0], len(link[a]), root, rows[a][0] == root))
    embeddings.CELL, before = 6, embeddings.CELL
    try:
        assert got(embeddings.embedding_near_dedup(v)) == sorted(want, key=str)
    finally:
        embeddings.CELL = before
    assert got(embeddings.embedding_near_dedup(v.limit(0))) == []


def test_embeddings_of_one_vec_id_link_each_by_itself(spark):
    x, y, z = ([float(i == k) for i in range(4)] for k in range(3))
    near = [1.0, 0.05, 0.0, 0.0]
    rows = [(5, x), (5, y), (7, near), (8, near), (9, y), (5, z), (3, z), (6, [0.0, 0.0, 0.0, 1.0])]
    v = spark.createDataFrame([(*r, "l") for r in rows], "vec_id long, embedding array<double>, label string")
    want = [(5, 2, 5, True), (7, 2, 5, False), (8, 2, 5, False), (5, 1, 5, True), (9, 1, 5, False),
            (5, 1, 3, False), (3, 1, 3, True), (6, 0, 6, True)]
    assert got(embeddings.embedding_near_dedup(v)) == sorted(want, key=str)


def test_components_of_a_long_chain(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(5, 5), (90, 80)], "a long, b long")
    assert got(components(edges)) == sorted([(i, 0) for i in range(n + 1)] + [(80, 80), (90, 80)], key=str)


# -- 9
def slow_fingerprint(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = [w for w in "".join(" " if c in SPACE else c for c in t).split(" ") if w]
    if not words:
        return 0
    runs = [words[i:i + 3] for i in range(len(words) - 2)] or [words]
    h = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(docs, none):
    rows = simhash.simhash_near_dedup(docs).collect()
    want = {(i, f"{slow_fingerprint(t or ''):016x}") for i, t in ROWS}
    assert {(r.doc_id, r.fingerprint) for r in rows} == want and len(rows) == len(ROWS)
    assert {r.doc_id: r.component_id for r in rows if r.doc_id in (1, 2, 3, 7, 8, 9)} == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7}
    assert got(simhash.simhash_near_dedup(none)) == []
    assert simhash.one_of_each(docs).columns == docs.columns


@pytest.mark.parametrize("longest", [1, 3, 32])
def test_links_are_those_of_all_pairs(spark, longest):
    r = random.Random(4)
    fps = set()
    for _ in range(12):
        f = r.getrandbits(64)
        fps.add(f)
        for _ in range(12):
            f ^= sum(1 << b for b in r.sample(range(64), r.randint(1, 3)))
            fps.add(f)
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)]
    found = {(r.node, r.component) for r in components(
        simhash.links(spark.createDataFrame(signed, "fp long, node long"), 2, longest)).collect()}
    root = list(range(len(fps)))
    for _ in fps:
        for a, b in itertools.combinations(range(len(fps)), 2):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                root[a] = root[b] = min(root[a], root[b])
    linked = {i for i, x in enumerate(root) if root.count(x) > 1}
    assert found == {(i, root[i]) for i in linked}


# -- 10
def slow_pieces(ids, longest=2048):
    out, at = [], 0
    while at < len(ids):
        n = min(longest, 1 << ((len(ids) - at).bit_length() - 1))
        out.append((at, n, np.array(ids[at:at + n], "<u4").tobytes(), len(ids)))
        at += n
    return out


def test_packing(docs, none):
    lib = Tokenizer.from_file(TOKENIZER)
    lib.encode_special_tokens = True
    rows = packing.pack(docs, TOKENIZER).collect()
    want = [(i, *p) for i, t in ROWS for p in slow_pieces(lib.encode(t or "", add_special_tokens=False).ids + [1])]
    assert sorted([(r.doc_id, r.start, r.length, bytes(r.ids), r.doc_tokens) for r in rows], key=str) == sorted(want, key=str)
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.offset == 0 and 1 << r.bucket == r.length for r in rows)
    assert got(packing.pack(none, TOKENIZER)) == []


def test_tokenizer_random_texts():
    lib, r, own = Tokenizer.from_file(TOKENIZER), random.Random(6), packing.ChunkTokenizer(TOKENIZER)
    lib.encode_special_tokens = True
    texts = ["".join(r.choices(BITS, k=r.randint(0, 20))) for _ in range(2000)]
    for t, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids


def test_packing_worker_keeps_a_bounded_number_of_chunks():
    own, n, letters = packing.ChunkTokenizer(TOKENIZER), 100_000, str.maketrans("0123456789", "abcdefghij")
    for k in range(0, 8 * n, n):
        own.encode([" ".join([str(10 ** 6 + k + i) for i in range(n)]).translate(letters)])
        assert len(own.known) <= (1 << 19) + n


def test_packing_query_takes_added_tokens_as_the_library_does(spark, docs):
    lib = Tokenizer.from_file(TOKENIZER)
    assert lib.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    sf, more = new_folder(spark, "sf"), docs.limit(1).withColumn("doc_id", F.lit(99)).withColumn("text", F.lit("a <|endoftext|> b"))
    docs.unionByName(more).write.parquet(f"{sf}/documents.parquet")
    want = [(i, at, n, zlib.crc32(ids)) for i, t in [*ROWS, (99, "a <|endoftext|> b")]
            for at, n, ids, _ in slow_pieces(lib.encode(t or "", add_special_tokens=False).ids + [1])]
    assert got(QUERIES["op10_packing"](spark, sf).select("doc_id", "start", "length", "ids_crc32")) == sorted(want, key=str)


def test_buckets(spark, docs):
    folder = new_folder(spark, "buckets")
    packed = packing.pack(docs, TOKENIZER)
    packing.write_buckets(packed, folder)
    back = packing.read_buckets(spark, folder)
    assert got(back) == got(packed.select(*back.columns)) and len({r.length for r in back.select("length").distinct().collect()}) > 4
    for n in (1, 8, 2048):
        one = packing.read_buckets(spark, folder, n)
        assert got(one) == got(packed.where(F.col("length") == n).select(*back.columns))
        files = [f for f in one.inputFiles() if f"/bucket={n.bit_length() - 1}/" in f]
        assert files and len(one.inputFiles()) >= len(files)


# -- all
def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if model.score((r.text or "").encode()) >= 0.5)
    rows = [(i, t) for i, t, *_ in sorted(brute_lines(rows), key=lambda x: x[0])]
    fps = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    pairs = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if (fps[a] ^ fps[b]).bit_count() <= 2]
    while any(root[a] != root[b] for a, b in pairs):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    lib = library()
    want = [(i, *p) for n, (i, t) in enumerate(rows) if root[n] == n for p in slow_pieces(lib.encode_ordinary(t) + [1])]
    out = [(r.doc_id, r.start, r.length, bytes(r.ids), r.doc_tokens) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(out) == sorted(want)


def test_stages_take_odd_rows(spark, docs, none):
    own = docs.select("doc_id", "text", "lang", "source", "n_chars")
    model = quality.train(own, spark.read.parquet(f"{SF}/labels.parquet"))
    texts = lambda rows: sorted(((i, t or "") for i, t in rows), key=str)
    want = {"quality": [(i, t) for i, t in ROWS if model.score((t or "").encode()) >= 0.5],
            "line_dedup": [(i, t) for i, t, *_ in brute_lines(ROWS)],
            # of equal texts one row, the smallest id's; the row without an id
            # has a text of its own
            "near_dedup": [(1, None), *[r for r in ROWS if r[0] in (4, 5, 7, 10, 11, 12, 13)], ROWS[5], ROWS[10]]}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, own, SF)
        empty = stage(spark, own.limit(0), SF)
        assert empty.columns == out.columns and empty.count() == 0
        if name == "packing":
            lib = library()
            pieces = [(i, *p[:2]) for i, t in ROWS for p in slow_pieces(lib.encode_ordinary(t or "") + [1]) if i != 13]
            assert got(out.where("doc_id is null or doc_id <> 13").select("doc_id", "start", "length")) == sorted(pieces, key=str)
        else:
            assert out.columns == own.columns
            assert texts((r.doc_id, r.text) for r in out.collect()) == texts(want[name]), name


def near_rows(spark, rows, names="doc_id long, text string, _gone long, fp string, row int"):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], names)


def test_one_of_each_loses_no_text(spark):
    a, b = "one two three four five six seven", "entirely different words stand in this other text"
    pick = lambda rows: sorted([(r.doc_id, r.text) for r in simhash.one_of_each(near_rows(spark, rows)).collect()], key=str)
    assert pick([(1, a), (5, a), (5, b), (1, a)]) == [(1, a), (5, b)]
    assert pick([(None, a), (None, a), (None, b)]) == sorted([(None, a), (None, b)], key=str)
    assert pick([(None, a), (7, a), (None, b)]) == sorted([(7, a), (None, b)], key=str)
    # of equal ids and fingerprints the smallest text stays
    assert pick([(3, a.upper()), (3, a), (3, None), (3, "")]) == sorted([(3, a.upper()), (3, None)], key=str)
    assert pick([]) == []
    out = simhash.one_of_each(near_rows(spark, [(1, a), (1, a)]))
    assert out.columns == ["doc_id", "text", "_gone", "fp", "row"] and got(out) == [(1, a, 1, "x", 2)]


def test_a_doc_id_with_two_texts_joins_nothing(spark):
    a, b = "one two three four five six seven", "entirely different words stand in this other text"
    rows = simhash.simhash_near_dedup(near_rows(spark, [(1, a), (5, a), (5, b), (9, b), (None, b)])).collect()
    assert sorted([(r.doc_id, r.fingerprint == f"{slow_fingerprint(a):016x}", r.component_id) for r in rows], key=str) == sorted(
        [(1, True, 1), (5, True, 1), (5, False, 5), (9, False, 5), (None, False, 5)], key=str)


def test_rows_without_an_id_link_what_is_near_to_them(spark, monkeypatch):
    """A chain a - x - b, of which x has no doc_id, is one component."""
    prints = {b"a": 0b0, b"x": 0b11, b"b": 0b1111, b"far": 1 << 40 | 1 << 50 | 1 << 60}
    fps = spark.createDataFrame([(1, 0), (None, 3), (2, 15), (3, prints[b"far"])], "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, shingle: fps)
    assert got(simhash.simhash_near_dedup(fps).select("doc_id", "component_id")) == sorted(
        [(1, 1), (None, 1), (2, 1), (3, 3)], key=str)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert got(QUERIES[name](spark, SF).select(*cols)) == sorted(res.fetchall(), key=str)


def test_rounds_over_few_rows_write_few_files(spark, monkeypatch):
    """Many shuffle partitions make no more files than tasks run at once."""
    import acctrecon.llm.common as common

    folders = []
    monkeypatch.setattr(common, "new_folder", lambda s, name: folders.append(new_folder(s, name)) or folders[-1])
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert {r.component for r in components(edges).collect()} == {0}
        files = {f.rsplit("/", 1)[1].split("-")[0]: len(spark.read.parquet(f"{f}/rows").inputFiles()) for f in folders}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(files[x] for x in ("least", "large", "small")) <= spark.sparkContext.defaultParallelism


def test_words_at_line_ends_are_put_together(spark):
    """Of 400 pairs of words with a line break between them the tokenizer
    gets the words, and a full cache goes on with the words of the last texts."""
    names = ["Berg", "mer", "été", "ocean", "ß", "文字", "sol", "Keit", "ly", "x"]
    texts = ["a " + " ".join(f"{a}{m}\n{b}{n}" for a in names for b in names)
             for m, n in [(".", ","), ("", "!?"), ("'", "***"), ("%", "")]]
    library = Tokenizer.from_file(TOKENIZER)
    asked = []

    def many(wanted):
        asked.extend(wanted)
        return [bpe.packed(library.encode(t, add_special_tokens=False).ids) for t in wanted]

    known = bpe.Bounded(None, 60)
    for _ in range(3):
        assert bpe.encode_texts(texts, known, many) == many(texts)
        assert len(known) <= 60
        del asked[-len(texts):]
    assert len([t for t in asked if t != "a"]) < 60 and known.keys() >= set(names) - {"x"}
    tokenizer = packing.ChunkTokenizer(TOKENIZER, 60)
    assert tokenizer.encode(texts) == tokenizer.encode(texts) == many(texts)


def test_words_lose_their_punctuation_in_arrow():
    r = random.Random(14)
    bits = ["a", "Öl", "the", "日本", "文", "é", "1", "\n", "\t", "'s", ".", ",", "***", "。", "\x00", "🙂", "ª", "ʼ", "-", "ა"]
    chunks = sorted({"".join(r.choices(bits, k=r.randint(0, 4))) for _ in range(3000)})
    for some in (chunks, [], [""], ["***"], ["word"]):
        keys, pairs = bpe.without_tails(pa.array(some, pa.large_string()))
        parts = [tuple(keys[k] for k in pair if k < len(keys)) for pair in pairs.tolist()]
        words = [c.rstrip(bpe.PUNCTUATION) for c in some]
        assert parts == [(w, " " + c[len(w):]) if w.isalpha() and w != c else (c,) for c, w in zip(some, words)]
        assert len(set(keys)) == len(keys)
    lib, tokenizer = Tokenizer.from_file(TOKENIZER), packing.ChunkTokenizer(TOKENIZER, 100)
    lib.encode_special_tokens = True
    for _ in range(3):
        texts = [" ".join(r.choices(chunks, k=r.randint(0, 40))) for _ in range(200)]
        assert tokenizer.encode(texts) == [bpe.packed(lib.encode(t, add_special_tokens=False).ids) for t in texts]


def test_bpe_keeps_no_prefixes_of_words():
    """A worker's caches hold words and token pairs; words that are encoded
    together share their prefixes without a table."""
    lib, enc, r = library(), bpe.PrefixEncoder(bpe.read_ranks(RANKS)), random.Random(15)
    words = sorted({"".join(r.choices(["en", "tion", "qu", "é", "ssh", "x"], k=r.randint(3, 9))) for _ in range(4000)})
    worked, extend = [], enc.extend
    enc.extend = lambda data, last: worked.append(len(data) + 1 - len(last)) or extend(data, last)
    text = "first " + " ".join(words)
    assert np.frombuffer(enc.encode_many([text])[0], "<u4").tolist() == lib.encode_ordinary(text)
    kept = sum(len(x) for x in vars(enc).values() if isinstance(x, bpe.Bounded) and x is not enc.fits)
    assert kept <= len(words) + 5
    assert sum(worked) < 0.7 * sum(len(w.encode()) + 1 for w in words)
