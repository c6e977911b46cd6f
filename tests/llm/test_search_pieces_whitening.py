"""Ranked search, SentencePiece and whitening on small tables of odd rows,
against brute force and the library."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from acctrecon.llm import lexical, pieces, whitening
from acctrecon.llm.queries import PIECES

TEXTS = [None, "", " ", "\n\n", "The cat sat.", "the CAT, the cat", "cat cat cat cat dog", "dog-dog_dog9 é cafÉ café",
         "İstanbul K cat", "x" * 5000, "cat " * 3000, "  two  spaces  ", "日本語 テキスト cat", "\x00\x7f~", "same dog", "same dog"]


# -- ranked search
def brute_search(docs, items, k=10):
    sep = {chr(c) for c in range(128) if not chr(c).isalnum()}
    lower = {c: c + 32 for c in range(65, 91)}

    def terms(t):
        return "".join(" " if c in sep else c for c in (t or "")).translate(lower).split(" ")

    held = [(i, Counter(x for x in terms(t) if x)) for i, t in docs]
    n_docs, all_terms = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(x for _, c in held for x in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 100 - 75 + (75 * c.total() * n_docs) // max(all_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10 ** 9 * c[x]) // (1000 * c[x] + 8 * m))
                    for x in terms(text) if c[x])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("shard, k", [((1 << 14, 16 << 20), 10), ((3, 1 << 20), 10), ((3, 64), 2)])
def test_ranked_search(spark, monkeypatch, shard, k):
    monkeypatch.setattr(lexical, "SHARD", shard)
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "dog café"), (None, "cat"), (4, "the cat sat"), (4, "the cat sat")]
    items = [(1, "cat"), (2, "Dog dog the"), (3, None), (4, ""), (5, "nothing here"), (1, "café CAT cat x"), (None, "same"),
             (6, "the " * 50)]
    r = random.Random(3)
    words = ["the", "cat", "dog", "red", "fox", "café", "one", "two"]
    docs += [(100 + i, " ".join(r.choices(words, weights=[9, 3, 3, 2, 1, 1, 1, 1], k=r.randint(1, 30)))) for i in range(150)]
    items += [(10 + i, " ".join(r.choices(words, k=r.randint(1, 6)))) for i in range(20)]
    d = spark.createDataFrame([(*x, 1, "q") for x in docs], "doc_id long, text string, rank int, query string").repartition(5)
    q = spark.createDataFrame([(*x, 2) for x in items], "item_id long, text string, doc_id int")
    assert rows(lexical.ranked_search(d, q, k=k)) == brute_search(docs, items, k)
    if k == 2:
        monkeypatch.setattr(lexical, "BLOCK", 100)  # several blocks of queries
        assert rows(lexical.ranked_search(d, q, k=k)) == brute_search(docs, items, k)
        assert rows(lexical.ranked_search(d.limit(0), q)) == [] and rows(lexical.ranked_search(d, q.limit(0))) == []


def test_reading_stops_before_the_lists_end():
    n = 20000
    r = np.random.default_rng(0)
    rare, common = np.sort(r.choice(n, 12, replace=False)), np.arange(n)
    row = {"docs": np.arange(n, dtype="<i8").tobytes(), "known": np.ones(n, "?").tobytes(),
           "sizes": np.full(n, 50, "<i8").tobytes(), "terms": np.array([1, 2], "<i4").tobytes(),
           "ends": np.array([12, 12 + n], "<i4").tobytes(), "rows": np.concatenate([rare, common]).astype("<i4").tobytes(),
           "tf": np.concatenate([np.full(12, 3), np.where(np.isin(common, rare), 40, 1 + common % 3)]).astype("<i4").tobytes()}
    best = lexical.Best(10)
    read = lexical.Shard(row, n, 50 * n, {1: 7000, 2: 300}).search({1: 1, 2: 1}, best)
    assert [i for _, i in best.rows] == rare[:10].tolist() and read < n


# -- SentencePiece
@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def piece_table():
    return pieces.PieceTable(PIECES)


def test_encode_and_decode_documents(spark, library):
    texts = [*TEXTS, "<s> </s> <unk> <0x41>", "▁a▁▁b", "def f(x):\n\treturn x  # ok\r\n", "🙂é́", "z" * 100 + "\n" + "日" * 100]
    docs = spark.createDataFrame([(i, t, 1) for i, t in [*enumerate(texts), (None, "null id"), (4, "again"), (4, "again")]],
                                 "doc_id long, text string, ids int")
    encoded = pieces.encode_documents(docs, PIECES)
    want = [(r.doc_id, library.encode(r.text or "", add_eos=True)) for r in docs.collect()]
    assert rows(encoded) == sorted(want, key=str)
    decoded = pieces.decode_documents(encoded, PIECES)
    assert rows(decoded) == sorted([(i, ids, library.decode(ids)) for i, ids in want], key=str)
    assert rows(pieces.encode_documents(docs.limit(0), PIECES)) == []
    assert pieces.decode_documents(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PIECES).first().text == ""


def test_pieces_of_random_texts_and_ids(library, piece_table):
    r = random.Random(5)
    bits = ["a", "the", " ", "  ", "   ", "\n", "\t", "'s", "1", "é", "▁", "日本", "🙂", "...", "\r\n", "<s>", "return", " the", "　"]
    for _ in range(3000):
        t = "".join(r.choices(bits, k=r.randint(0, 14)))
        ids = library.encode(t)
        assert np.frombuffer(piece_table.encode(t), "<i4").tolist() == ids, t
        assert piece_table.decode(ids) == library.decode(ids), t
    for _ in range(3000):
        ids = [r.choice([0, 1, 2, r.randint(3, 258), r.randint(3, 258), 259, 28705, r.randint(259, 31999)])
               for _ in range(r.randint(0, 8))]
        assert piece_table.decode(ids) == library.decode(ids), ids


def test_every_prefix_has_the_last_token_of_its_own_encoding(library, piece_table):
    for text in ("▁unbelievabletion", "▁aaaaaaaaaaab", "▁▁▁▁▁▁x", "▁thththehehere"):
        last = piece_table.last_tokens(text)
        for n in range(1, len(text) + 1):
            ids = np.frombuffer(piece_table._word(text[:n])[0], "<i4")
            assert last[n] == ids[-1]


def test_pairs_are_judged_as_merging_judges_them(piece_table):
    r = random.Random(2)
    tokens = [i for i, s in enumerate(piece_table.spelling) if s in piece_table.whole]
    size, spelling = len(piece_table.spelling), piece_table.spelling
    for _ in range(4000):
        a, b = r.choice(tokens[:2500]), r.choice(tokens[:2500])
        assert piece_table._fits(a * size + b) == (piece_table._merged(spelling[a] + spelling[b])[0] == [spelling[a], spelling[b]])


# -- whitening
def dense(vectors):
    """vec_id -> (n, deviation, |whitened|), explained, by eigenvalues of the
    covariance."""
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in vectors}
    fit = np.array(sorted(set(map(tuple, x.values()))), dtype=object)
    n, total = len(fit), fit.sum(axis=0)
    centre = lambda v: np.array([float(n * a - s) / n for a, s in zip(v, total)])
    c = np.array([centre(v) for v in fit])
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1], axes[:, ::-1]
    m = min(16, int((values > 1e-18 * values[0]).sum()))
    return ({i: (n, int(sum((n * a - s) ** 2 for a, s in zip(v, total))), np.abs(centre(v) @ axes[:, :m] / np.sqrt(values[:m])))
             for i, v in x.items()}, values[:m] / values.sum())


def test_whitening(spark):
    r = np.random.default_rng(1)
    good = [(i, (r.normal(size=20) * (1 + np.arange(20))).tolist()) for i in range(300)]
    good += [(1000, good[0][1]), (1001, good[0][1]), (1002, [c + 1e-9 for c in good[1][1]])]
    odd = [(1, None), (2, []), (3, [1.0] * 19 + [None]), (4, [math.nan] * 20), (5, [math.inf] + [0.0] * 19), (6, [1e300] * 20)]
    schema = "vec_id long, embedding array<double>, label int, x int, dim string"
    table = spark.createDataFrame([(*v, 1, 2, "d") for v in [*good, *odd, (None, good[2][1])]], schema).repartition(40)
    got = whitening.whiten(table).collect()
    want, explained = dense(good)
    assert len(got) == 16 * (len(good) + 1) and len({x.identity_error for x in got}) == 1 and got[0].identity_error < 1e-10
    signs = {}
    for x in got:
        n, deviation, white = want[2 if x.vec_id is None else x.vec_id]
        assert (x.n, x.deviation) == (n, deviation)
        assert abs(abs(x.whitened) - white[x.component - 1]) < 1e-8 and abs(x.explained / explained[x.component - 1] - 1) < 1e-10
        signs.setdefault(x.vec_id, {})[x.component] = x.whitened
    assert signs[1000] == signs[0] == signs[1001]
    assert whitening.whiten(table.where("vec_id between 2 and 6 and x is null")).collect() == []


def test_whitening_of_few_and_of_mixed_lengths(spark):
    def run(vectors):
        return whitening.whiten(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect()

    assert run([(1, [1.0, 2.0])]) == [] and run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    two = run([(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, [5.0]), (4, [6.0]), (5, [8.0])])
    assert sorted((x.vec_id, x.component, x.n) for x in two) == [(1, 1, 2), (2, 1, 2), (3, 1, 3), (4, 1, 3), (5, 1, 3)]
    assert all(abs(abs(x.whitened) - 1) < 1e-12 for x in two if x.vec_id < 3)


@pytest.mark.parametrize("make", [
    lambda r: r.normal(size=(300, 40)), lambda r: np.repeat(np.eye(20) * 50, 3, axis=0), lambda r: np.vstack([np.eye(30), -np.eye(30)]),
    lambda r: r.normal(size=(200, 5)) @ r.normal(size=(5, 40)), lambda r: np.hstack([np.ones((50, 3)), r.normal(size=(50, 4))]),
    lambda r: r.normal(size=(300, 30)) @ np.diag([1] * 10 + [1e-3] * 10 + [1e-6] * 10), lambda r: r.normal(size=(9, 1))])
def test_solver_on_spread_tied_and_missing_values(make):
    x = make(np.random.default_rng(4)).astype(float)
    c, r = x - x.mean(axis=0), None
    for at in range(0, len(c), 7):
        r = whitening._fold(r, c[at:at + 7])
    values, axes, trace = whitening.principal(r, len(c))
    true = np.linalg.svd(c, compute_uv=False) ** 2 / len(c)
    assert len(values) == min(16, int((true > 1e-24 * true[0]).sum()))
    assert np.allclose(values, true[:len(values)], rtol=1e-10, atol=0) and abs(trace / true.sum() - 1) < 1e-12
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-10
    assert np.abs(c.T @ (c @ axes) / len(c) - axes * values).max() < 1e-12 * true[0]


def test_dqds_keeps_the_digits_of_small_values():
    a, b = 10.0 ** -np.arange(12), 0.5 * 10.0 ** -np.arange(11)
    found = whitening.dqds(a, b)
    # the product of the values is that of the diagonal
    assert abs(np.log(found).sum() - np.log(a).sum()) < 1e-12
    inverse = np.linalg.inv(np.diag(a) + np.diag(b, 1))
    assert abs(found[-1] * np.linalg.norm(inverse, 2) - 1) < 1e-12


def test_a_full_cache_of_words_keeps_those_that_come_up(spark):
    made = []
    words = pieces.Words(lambda w: (made.append(w) or w.encode(), True), 8)
    for k in range(40):
        assert words["often"] == b"often" and words[f"once{k}"] == f"once{k}".encode()
        assert len(words) + len(words.old) <= 8
    assert made.count("often") == 1 and len(made) == 41


def test_runs_decoded_together_are_as_the_library_has_them(piece_table):
    table = piece_table
    model, rng = SentencePieceProcessor(model_file=PIECES), random.Random(7)
    kinds = [*table.of_byte.values()] * 2 + [*sorted(table.control)] * 40 + [table.unknown] * 40
    texts = [t or "" for t in TEXTS] + ["ab \U0001F600 c", "\U0001F600", " x", "▁▁a"]
    runs = [[*model.encode(t), model.eos_id()] for t in texts] + [[], [table.end], [table.end] * 2]
    runs += [[rng.choice(kinds) if rng.random() < 0.3 else rng.randrange(len(table.spelling)) for _ in range(rng.randrange(1, 12))]
             for _ in range(3000)]
    runs += [[table.of_byte[b] for b in "é".encode()], [table.of_byte[0xC3], table.end, table.of_byte[0xA9]]]
    found = table.decode_many(np.array([i for r in runs for i in r], "<i4"), np.array(list(map(len, runs))))
    assert found == [table.decode(r) for r in runs]
    assert found == [model.decode(r) for r in runs]
    assert table.decode_many(np.array([], "<i4"), np.array([0, 0])) == ["", ""]
