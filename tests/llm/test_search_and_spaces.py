"""Lexical search, licence marks, whitening."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from loadgauge.llm import license_scan, whitening
from loadgauge.llm.lexical_search import ItemIndex, _blocks, ranked
from loadgauge.llm.queries import op13_embedding_whitening

ITEMS = [(1, "Alpha beta, beta gamma!"), (2, "é-Alpha rare"), (3, None), (4, "?!"), (None, "rare words"), (1, "Alpha beta, beta gamma!"), (5, "nowhere")]
TEXTS = ["alpha", "ALPHA beta", "beta alpha", None, "", "..", "gamma é rare", "rare rare rare " + "x " * 3000, "x " * 20_000 + "é", "alpha beta gamma"] + ["beta y z"] * 15


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def best(docs, items, top):
    counted = [(i, terms(t)) for i, t in docs]
    counted = [(i, len(t), Counter(t)) for i, t in counted if t]
    total, n = sum(s for _, s, _ in counted), len(counted)
    out = []
    for item, text in items:
        rows = []
        for i, size, c in counted:
            m = 100 - 90 + 90 * size * n // total
            w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in x for _, _, x in counted) + 1))) for t in set(terms(text)) if t in c}
            rows.append((-sum(w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in w), i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(x for x in rows if x[0] < 0)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block,top", [(150_000, 10), (3, 10), (1, 2)])
def test_search_equals_brute_force(spark, table, block, top):
    rows = [(None if i == 9 else i, t, "s") for i, t in enumerate(TEXTS + TEXTS[1:3])]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = ranked(table(rows).repartition(5), items, block=block, top=top)
    assert found.columns == ["item", "rank", "doc_id", "score"]
    got = sorted(((r["item"].item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=str)
    assert got == best([r[:2] for r in rows], ITEMS, top)


def test_search_of_empty_tables(spark, docs_of, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked(empty, items).count() == 0
    assert ranked(docs_of(TEXTS), items.limit(0)).count() == 0
    assert ranked(docs_of([None, ""]), items).count() == 0


def test_blocks_hold_whole_items(spark):
    pairs = spark.createDataFrame([(i, bytes([j])) for i in range(40) for j in range(1 + i % 3)] + [(99, bytes([j])) for j in range(30)], "rid long, term binary")
    blocks = [ItemIndex.of(b.toArrow()) for b in _blocks(pairs, 10)]
    assert sorted(r for b in blocks for r in b.rids.tolist()) == [*range(40), 99]
    assert all(len(b.postings) <= 10 or b.rids.tolist() == [99] for b in blocks)


def plain_marks(text):
    w, out = terms(text), []
    for phrases, kind in ((license_scan.BASE, "base"), (license_scan.NOTICES, "notice")):
        for phrase, label in phrases.items():
            p = phrase.split()
            out += [(i, kind, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return len(w), sorted(out)


MARKED = [
    None, "", "All rights\nRESERVED. all rights reserved", "under CC BY-NC 4.0", "the GNU Lesser General Public License, version 3", "all rights reserve all all rights reserved cc by cc by",
    "public domain cc0 CC0 é general public licensé", "Permission is hereby granted, free of charge", "x " * 50_000 + "All rights reserved", "license license mit license", "all  rights-reserved é" * 3,
]


def test_phrases_equal_brute_force(docs_of, empty):
    docs = docs_of(MARKED + MARKED[2:4])
    got = {r[0]: (r.n_words, [tuple(m) for m in r.marks]) for r in license_scan.license_marks(docs).select("row.doc_id", "n_words", "marks").collect()}
    assert got == {i: plain_marks(t) for i, t in enumerate(MARKED + MARKED[2:4])}
    made = license_scan.license_marks(docs)
    assert all((r.score > 0) == bool(r.marks) and 0 <= r.score <= 1 for r in made.collect())
    assert license_scan.license_marks(empty).count() == 0


@pytest.mark.parametrize(
    "text,labels,score",
    [
        ("SPDX-License-Identifier: MIT", "mit", 0.15),
        ("// spdx-license-identifier:(MIT OR GPL-3.0-or-later) AND Apache-2.0\nnext", "apache,gpl,mit", 0.2),
        ("License: GPL-2.0-only WITH Classpath-exception-2.0 or AGPL-3.0", "agpl,gpl", 0.525),
        ("License: MIT and GPL-2.0+ or BSD-3-Clause.", "bsd,gpl,mit", 0.2),
        ("License: BSD-3-Clause or MIT and GPL-2.0", "bsd,gpl,mit", 0.2),
        ("Licence = LicenseRef-Own", "other", 0.5),
        ("License: MIT AND (GPL-2.0", "mit", 0.15),
        ("License: (MIT\n OR ISC)", "isc,mit", 0.15),
        ("License: MIT\nOR GPL-2.0", "mit", 0.15),
        ("License: see the file", "", 0.0),
        ("License: GPL-2.0 with love", "gpl", 0.7),
        ("License: ) MIT", "", 0.0),
        ("license agreement: MIT", "", 0.0),
        ("é License-Expression: ((CC-BY-4.0))", "cc-by", 0.3),
        ("License: AND", "", 0.0),
    ],
)
def test_expressions(text, labels, score):
    _, marks, got = license_scan.scan(text.encode())
    assert ",".join(sorted({m[2] for m in marks if m[1] == "expression"})) == labels
    assert got == pytest.approx(score)


def test_long_expressions_take_linear_time():
    deep = b"License: " + b"(" * 200_000 + b"MIT" + b")" * 200_000
    assert license_scan.scan(deep)[1:] == ([(0, "expression", "mit")], 0.15)
    assert license_scan.scan(b"License: " * 100_000)[1] == []
    assert license_scan.scan(b"License: MIT" + b" OR MIT" * 100_000)[2] == 0.15


def by_hand(rows, k):
    kept = [(i, np.floor(256.0 * np.array(v, float)).astype(np.int64)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.unique(np.stack([x for _, x in kept]), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, [(i, int(((n * x - s) ** 2).sum()), (x - s / n) @ u / np.sqrt(e)) for i, x in kept], e / np.trace(v)


def test_whitening_equals_a_plain_one(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(6) * [5, 3, 2, 1.5, 1, 0.5]]) for i in range(300)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, None), (303, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (304, [float("nan")] * 6), (305, [float("inf")] * 6), (306, [1.0] * 5), (None, rows[1][1])]
    made, white = whitening.whitened(spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<float>, row int, x string").repartition(7))
    got = sorted(made.select("row.vec_id", "deviation", "whitened").collect(), key=lambda r: (r.vec_id is None, r.vec_id))
    n, want, explained = by_hand([r for r in rows if r[0] != 306], 4)
    assert white.n == n == 300 and white.explained == pytest.approx(explained) and white.identity_error < 1e-10
    assert [(r.vec_id, r.deviation) for r in got] == [w[:2] for w in want]
    signs = np.sign(np.array(got[0].whitened) * want[0][2])
    assert np.abs(np.array([r.whitened for r in got]) * signs - np.array([w[2] for w in want])).max() < 1e-9


@pytest.mark.parametrize("rows,n,components", [([], 0, 0), ([[1.0, 2.0]] * 3, 1, 0), ([None, [None]], 0, 0), ([[]], 1, 0), ([[0.0, 1.0], [1.0, 1.0], [0.0, 1.0]], 2, 1), ([[1e300, 0.0], [0.0, 1.0]], 2, None)])
def test_whitening_of_few_vectors(spark, rows, n, components):
    made, white = whitening.whitened(spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "x long, embedding array<double>"))
    got = made.collect()
    assert white.n == n and len(got) == sum(r is not None and None not in r for r in rows)
    assert components is None or all(len(r.whitened) == components for r in got)


def test_whitening_query(spark, small):
    got = op13_embedding_whitening(spark, small)
    rows = got.collect()
    assert {r.component for r in rows} == {1, 2, 3, 4} and len(rows) == 4 * spark.read.parquet(f"{small}/embeddings.parquet").count()
    assert max(r.identity_error for r in rows) < 1e-8


def test_pairs_of_equal_and_zero_eigenvalues():
    rng = np.random.default_rng(5)
    for want in ([3.0] * 6, [9.0] + [4.0] * 12 + [1.0], [5.0, 5.0, 0.0, 0.0, 0.0, 0.0], [0.0] * 4, [7.0], list(rng.random(90)), [1.0 + 1e-7 * i for i in range(40)]):
        turn, _ = np.linalg.qr(rng.standard_normal((len(want), len(want))))
        matrix = (turn * want) @ turn.T
        values, vectors = whitening.largest_pairs((matrix + matrix.T) / 2, 4)
        kept = [w for w in sorted(want, reverse=True)[:4] if w > 0]
        assert values == pytest.approx(kept) and np.allclose(vectors.T @ vectors, np.eye(len(kept)))
        assert np.allclose(matrix @ vectors, vectors * values)


def test_inertia_counts():
    a = np.diag([3.0, 2, 2, 0, -1])
    turn, _ = np.linalg.qr(np.random.default_rng(2).standard_normal((5, 5)))
    form = whitening.tridiagonal(turn @ a @ turn.T)
    assert [whitening.above(form, s) for s in (-2, -0.5, 0.5, 2.5, 4)] == [5, 4, 3, 1, 0]
