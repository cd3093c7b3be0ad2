"""The n-gram model against a plain version, the network's gradients and accuracy, the pipeline, the queries."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect
from loadgauge.llm import ngram_lm, toxicity as tox
from loadgauge.llm.queries import QUERIES, SQL


def words_of(text):
    return [*(text or "").encode().lower().split(), "</s>"]


def plain_model(texts):
    """Probability of a word after another, and add-one word counts, from dictionaries."""
    tokens = [words_of(t) for t in texts]
    c = Counter(w for t in tokens for w in t)
    pairs = Counter(p for t in tokens for p in zip(["<s>", *t], t))
    before, n, v = Counter(b for _, b in pairs), sum(c.values()), len(c)
    of = lambda counts: ngram_lm.discounts([sum(x == k for x in counts.values()) for k in (1, 2, 3, 4)])
    d2, d1 = (0, *of(pairs)), (0, *of(before))
    stats = defaultdict(lambda: [0, 0, 0, 0])
    for (a, _), k in pairs.items():
        stats[a][0] += k
        stats[a][min(k, 3)] += 1
    kinds = Counter(min(x, 3) for x in before.values())
    mass = sum(d1[k] * kinds[k] for k in (1, 2, 3)) / len(pairs) if pairs else 1

    def p(a, b):
        alone = mass / (v + 1) + (max(before[b] - d1[min(before[b], 3)], 0) / len(pairs) if pairs else 0)
        if a not in stats:
            return alone
        s, k = stats[a], pairs[a, b]
        return max(k - d2[min(k, 3)], 0) / s[0] + sum(d2[i] * s[i] for i in (1, 2, 3)) / s[0] * alone

    return c, n, v, p


def test_tokens_are_the_words_in_order():
    """Each distinct word is hashed once; blanks of all kinds, other control and multi-byte characters, texts without words."""
    odd = "a\tB\x0bc\x0cD\re\x00f\x08g\x0eh\x1ci\x85j\u00a0k\u2003l ÄÖ \x7f"
    batches = [["", " \n "], ["x"], [" The  the\nTHE end ", "", odd, "x" * 70_000 + " y", "the a"], [""]]
    for texts in batches:
        for starts in (False, True):
            hashes, at, sizes = ngram_lm._tokens([t.encode() for t in texts], starts)
            words = [t.encode().lower().split() for t in texts]
            mark = [ngram_lm.START] if starts else []
            want = [x for w in words for x in [*mark, *map(ngram_lm.xxhash.xxh3_64_intdigest, w), ngram_lm.END]]
            assert hashes[at].tolist() == want and sizes.tolist() == [len(w) for w in words]
            assert hashes.tolist() == sorted(set(want))


@pytest.mark.parametrize("bits", [10, 21, 23, 40])
def test_rows_are_put_in_order_as_single_numbers(monkeypatch, bits):
    """Also columns that do not fit into one number together; sorts over several columns take several times as long."""
    monkeypatch.delattr(ngram_lm.np, "lexsort")
    rng = np.random.default_rng(bits)
    kinds = rng.integers(0, 1 << bits, (3, 9), np.uint64)
    kinds[:, 0] = (1 << bits) - 1
    columns = [k[rng.integers(0, 9, 5_000)] for k in kinds]
    rows, counts = Counter(zip(*(c.tolist() for c in columns))), rng.integers(1, 5, 5_000)
    sums = Counter()
    for *row, k in zip(*(c.tolist() for c in columns), counts.tolist()):
        sums[tuple(row)] += k
    for want, (made, n) in ((rows, ngram_lm._counted(columns, bits)), (sums, ngram_lm._in_order(columns, counts, bits))):
        assert list(zip(*(c.tolist() for c in made), n.tolist())) == [(*row, want[row]) for row in sorted(want)]
    none = np.zeros(0, np.uint64)
    assert not len(ngram_lm._counted([none, none], bits)[1]) and not len(ngram_lm._in_order([none, none], none, bits)[1])


@pytest.mark.parametrize("bucket", [2_000_000, 40])
def test_scores_equal_a_plain_model(docs_of, monkeypatch, bucket):
    monkeypatch.setattr(ngram_lm, "BUCKET", bucket)
    monkeypatch.setattr(ngram_lm, "WORD_BUCKET_BYTES", 64 << 20 if bucket > 40 else 300)
    rng = random.Random(2)
    texts = [" ".join(rng.choices([f"w{int(rng.paretovariate(0.7)) % 50}", "the", "The"], k=rng.randint(1, 40))) for _ in range(60)] + [None, "", " \n"]
    c, n, v, p = plain_model(texts)
    model = ngram_lm.fit(docs_of(texts), order=2)
    asked = [*texts, "never seen words here", "w1 the never w1"]
    got = {r[0]: tuple(r)[1:] for r in ngram_lm.score(docs_of(asked), model).select("row.doc_id", "n_tokens", "n_known", "base_score", "score").collect()}
    assert (model.tokens, model.words) == (n, v)
    for i, t in enumerate(asked):
        w = words_of(t)
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        whole = sum(math.log10(p(a, b)) for a, b in zip(["<s>", *w], w))
        assert got[i] == (len(w), sum(c[x] > 0 for x in w), pytest.approx(base), pytest.approx(whole))


def plain_triples(texts):
    """Log probability of a text by words, pairs and triples, from dictionaries."""
    tokens = [["<s>", *words_of(t)] for t in texts]
    c3 = Counter(x for t in tokens for x in zip(t, t[1:], t[2:]))
    c2 = Counter((b, w) for _, b, w in c3) + Counter((t[0], t[1]) for t in tokens)
    c1, v = Counter(w for _, w in c2), len({w for t in tokens for w in t[1:]})
    of = lambda counts: (0, *ngram_lm.discounts([sum(x == k for x in counts.values()) for k in (1, 2, 3, 4)]))
    d = {1: of(c1), 2: of(c2), 3: of(c3)}

    def step(counts, n, history, word, lower):
        after = [k for g, k in counts.items() if g[:-1] == history]
        if not after:
            return lower
        k = counts[(*history, word)]
        return (max(k - d[n][min(k, 3)], 0) + sum(d[n][min(x, 3)] for x in after) * lower) / sum(after)

    def score(text):
        w, total = ["<s>", *words_of(text)], 0.0
        for i in range(1, len(w)):
            mass = sum(d[1][min(k, 3)] for k in c1.values()) / len(c2)
            p = max(c1[w[i]] - d[1][min(c1[w[i]], 3)], 0) / len(c2) + mass / (v + 1)
            p = step(c2, 2, (w[i - 1],), w[i], p)
            total += math.log10(step(c3, 3, (w[i - 2], w[i - 1]), w[i], p) if i > 1 else p)
        return total

    return score


@pytest.mark.parametrize("bucket", [2_000_000, 400, 40])
def test_triples_equal_a_plain_model(docs_of, monkeypatch, bucket):
    monkeypatch.setattr(ngram_lm, "BUCKET", bucket)
    rng = random.Random(3)
    texts = [" ".join(rng.choices([f"w{int(rng.paretovariate(0.7)) % 20}", "the", "The"], k=rng.randint(1, 40))) for _ in range(40)] + [None, "", " \n"]
    plain, model = plain_triples(texts), ngram_lm.fit(docs_of(texts), order=3)
    asked = [*texts, "never seen words here", "w1 the never w1 the w1"]
    got = {r[0]: r.score for r in ngram_lm.score(docs_of(asked), model).select("row.doc_id", "score").collect()}
    assert got == {i: pytest.approx(plain(t)) for i, t in enumerate(asked)}
    assert bucket > 400 or model.often_buckets


@pytest.mark.parametrize("copies,order", [(4, 3), (4, 2), (7, 3), (1, 3)])
def test_copies_leave_all_scores_finite(docs_of, copies, order):
    """Many n-grams of one count: the formula's discounts leave (0, k) here."""
    rng = random.Random(6)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(300)], k=12)) for _ in range(30)] * copies
    texts += [" ".join(f"x{i}_{j}" for j in range(6)) for i in range(6) for _ in range(i % 3 + 1)]
    asked = [*texts, " ".join(texts[0].split()[:2]) + " unseen", "unseen unseen", "w1 w2 w3 w4", None]
    got = {r[0]: r.score for r in ngram_lm.score(docs_of(asked), ngram_lm.fit(docs_of(texts), order=order)).select("row.doc_id", "score").collect()}
    assert all(map(math.isfinite, got.values()))
    if order == 3:
        plain = plain_triples(texts)
        assert got == {i: pytest.approx(plain(t)) for i, t in enumerate(asked)}
    else:
        _, _, _, p = plain_model(texts)
        assert got == {i: pytest.approx(sum(math.log10(p(a, b)) for a, b in zip(["<s>", *words_of(t)], words_of(t)))) for i, t in enumerate(asked)}


def test_discounts_lie_inside():
    for n in ([0, 0, 0, 0], [5, 0, 1, 1], [10, 1, 30, 50], [1, 2, 3, 400], [100, 40, 20, 12], [7, 7, 0, 7], [7, 7, 7, 0]):
        assert all(0 < d < k for d, k in zip(ngram_lm.discounts(n), (1, 2, 3)))


def test_query_scores_by_triples(spark, small, monkeypatch):
    asked, real = [], ngram_lm.fit
    monkeypatch.setattr(ngram_lm, "fit", lambda docs, **how: asked.append(made := real(docs, **how)) or made)
    QUERIES["op1_lm_score"](spark, small)
    assert asked[0].order == 3 and asked[0].triple_buckets


def test_model_of_nothing(docs_of, empty):
    model = ngram_lm.fit(empty)
    assert (model.tokens, model.words) == (0, 0)
    assert ngram_lm.score(docs_of(["a b", None]), model).select("score").distinct().collect() == [(0.0,)]
    assert ngram_lm.score(empty, model).count() == 0


def test_folder_must_be_mounted():
    assert ngram_lm.local_folder("file:///a/b") == "/a/b" == ngram_lm.local_folder("/a/b")
    with pytest.raises(ValueError, match="mounted"):
        ngram_lm.local_folder("hdfs://a/b")


def test_gradients():
    rng = np.random.default_rng(0)
    net = tox.Network.fresh([b"a", b"b"])
    net.w = {k: x.astype(np.float64) for k, x in net.w.items()}
    table = rng.standard_normal((20, 6 * tox.STATE))
    ids, mask = rng.integers(0, 20, (3, tox.WINDOW)), np.arange(tox.WINDOW) < np.array([[32], [20], [0]])
    want = np.array([1.0, -2.0, 0.5])
    _, kept = net.forward(table, ids, mask, keep=True)
    g, dx = net.backward(want, mask, kept)
    loss = lambda: float((net.forward(table, ids, mask) * want).sum())

    def slope(array, at, step=1e-2):
        old = array[at]
        array[at] = old + step
        up = loss()
        array[at] = old - step
        down = loss()
        array[at] = old
        return (up - down) / (2 * step)

    for name, at in (("out", 3), ("att_v", 1), ("att", (2, 3)), ("state_f", (1, 5)), ("state_b", (4, 20)), ("out_b", 0)):
        assert g[name][at] == pytest.approx(slope(net.w[name], at), rel=0.05, abs=2e-3), name
    d_table = np.zeros_like(table)
    np.add.at(d_table, ids, dx)
    assert d_table[7, 30] == pytest.approx(slope(table, (7, 30)), rel=0.05, abs=2e-3)


def test_trigrams_stay_inside_words():
    rows, sizes = tox.trigram_rows([b"ab", b"c", b"xyz"])
    assert sizes.tolist() == [2, 1, 3] and len(rows) == 6
    assert rows[:2].tolist() == tox.trigram_rows([b"ab"])[0].tolist() and rows[3:].tolist() == tox.trigram_rows([b"xyz"])[0].tolist()


def test_windows_cover_every_word():
    for n in range(0, 200):
        covered = {i for s in tox.window_starts(n) for i in range(s, min(n, s + tox.WINDOW))}
        assert covered == set(range(n)) and len(tox.window_starts(n)) >= 1


@pytest.fixture(scope="module")
def toxic_docs(prose):
    bad = ("blorg", "zapfool", "grunk")
    rng = random.Random(4)
    texts = [prose(rng.randint(5, 300), i) for i in range(500)]
    for i in range(0, 500, 4):
        w = texts[i].split()
        for _ in range(max(2, len(w) // 15)):
            w.insert(rng.randrange(len(w) + 1), rng.choice(bad))
        texts[i] = " ".join(w)
    return texts


def test_finds_toxic_documents_and_leaves_others(spark, docs_of, empty, toxic_docs):
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (5, None), (99_999, 1)], "doc_id long, toxic int")
    docs = docs_of([*toxic_docs, None, "", " ".join(toxic_docs[1:400:4])])
    net = tox.fit(docs, labels)
    made = tox.toxicity(docs, net)
    got = {r[0]: r[1] for r in made.select("row.doc_id", "score").collect()}
    wrong = [i for i in range(400, 500) if (got[i] >= 0.5) != (i % 4 == 0)]
    assert len(wrong) <= 3
    assert all(0 <= s <= 1 for s in got.values()) and max(got[500], got[501]) < 0.5
    assert made.select("row.*").columns == docs.columns
    assert tox.fit(docs, labels.where("toxic = 0")) is None
    assert tox.toxicity(docs, None).where("score <> 0").count() == 0
    assert tox.toxicity(empty, net).count() == 0


def test_learns_from_the_windows_that_are_scored(monkeypatch, prose):
    cut, real = [], tox._Documents.cut
    monkeypatch.setattr(tox._Documents, "cut", lambda self, chosen: cut.extend(chosen) or real(self, chosen))
    monkeypatch.setattr(tox, "_logits", lambda net, docs, windows: np.arange(len(windows), dtype=np.float32) % 5)
    monkeypatch.setattr(tox, "STEPS", 1)
    texts = [prose(200, i).encode() for i in range(12)]
    tox.train(texts, [int(i % 3 == 0) for i in range(12)])
    assert {s for _, s in cut} == set(tox.window_starts(200).tolist())


def test_sample_takes_one_row_of_an_id(spark, table, monkeypatch):
    seen = []
    monkeypatch.setattr(tox, "train", lambda texts, y: seen.append((texts, y)))
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0)], "doc_id long, toxic int")
    tox.fit(table([(1, f"text {i % 3}", None) for i in range(30)] + [(2, None, None), (2, "", None)]), labels)
    [(texts, y)] = seen
    assert y == [1, 0] and texts[0] in (b"text 0", b"text 1", b"text 2") and texts[1] == b""


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, small, name):
    assert compare(spark, con, name, small) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name, columns", [
    ("op1_lm_score", "doc_id held_out n_tokens n_known train_tokens base_score score perplexity"), ("op5_byte_bpe", "doc_id n_tokens ids_sha256 decoded_sha256"),
    ("op7_toxicity", "doc_id held_out score predicted"), ("op9_token_count", "doc_id n_bytes n_tokens over_limit"),
    ("op4_secret_scan", "doc_id n_assign n_access n_hex base_sha256 spans"), ("op12_license_scan", "doc_id n_words n_base first_word last_word base_labels labels score"),
])
def test_one_row_per_document(spark, small, name, columns):
    got = QUERIES[name](spark, small).toPandas()
    ids = pq.read_table(f"{small}/documents.parquet")["doc_id"].to_pylist()
    assert list(got.columns) == columns.split() and sorted(got.doc_id) == sorted(ids)
    if "held_out" in got:
        folds, which = (7, 2) if name.startswith("op1") else (5, 0)
        assert all((zlib.crc32(str(i).encode()) % folds == which) == h for i, h in zip(got.doc_id, got.held_out))


def test_pipeline_stages_take_effect(spark, small):
    """Each stage against its operator on the stage's own input."""
    import corpus_pipeline as c
    from loadgauge.llm.byte_bpe import Bpe, read_ranks
    from loadgauge.session import stage

    docs = c.read(spark, small, "documents")
    columns, last = docs.columns, docs.count()
    for name, step in c.STAGES[:-1]:
        docs = stage(step(spark, docs, small), name)
        assert docs.columns == columns and 0 < docs.count() <= last
        last = docs.count()
    texts = [r.text for r in docs.collect()]
    plain = [t.translate({ord(x): None for x in " \t\n\x0b\x0c\r"}) for t in texts]
    assert len(set(plain)) == len(plain)
    made = c.STAGES[-1][1](spark, docs, small).collect()
    assert len(made) == last
    bpe = Bpe(read_ranks(c.public_tokenizers.path("byte_bpe_50k.tiktoken")))
    assert all(bytes(r.ids) == bpe.encode(r.text) and r.n_tokens == len(r.ids) // 4 for r in made)


def test_pipeline_decodes_what_it_encodes(spark, docs_of):
    import corpus_pipeline as c

    docs = docs_of(["a b", None, "", "\u00e9\u00e4 \U0001f600\n x", "tokens of some length " * 50])
    assert [r.round_trip for r in c.encode(spark, docs, "").select("round_trip").collect()] == [True] * 5
