"""Exact and near duplicates, components, lines."""

import random
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loadgauge.llm import near_dup
from loadgauge.llm.components import components
from loadgauge.llm.exact_dedup import drop_copies, exact_dedup
from loadgauge.llm.line_dedup import line_dedup
from loadgauge.llm.near_dup import drop_near_copies, match_threshold, near_groups


def groups(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select("row.doc_id", *columns).collect()}


def test_exact_groups_and_choice(table):
    long = "ab" * 40_000
    got = exact_dedup(table([
        (1, "a b", None), (2, "a  b ", None), (3, "ab", None), (4, None, None), (5, "", None), (6, " \n", None), (7, long, None), (8, long + "\t", None),
        (9, long + "c", None), (10, "x" * 32, None), (11, "x" * 33, None), (12, "x" * 32, None), (13, "É", None), (14, "é", None),
    ]))
    assert groups(got, "keep_id", "group_size", "kept") == {
        1: (2, 3, False), 2: (2, 3, True), 3: (2, 3, False), 4: (6, 3, False), 5: (6, 3, False), 6: (6, 3, True), 7: (8, 2, False), 8: (8, 2, True),
        9: (9, 1, True), 10: (10, 2, True), 11: (11, 1, True), 12: (10, 2, False), 13: (13, 1, True), 14: (14, 1, True),
    }


def test_exact_repeated_rows_and_null_ids(table, empty):
    kept = drop_copies(table([(1, "a", "p"), (1, "a", "p"), (None, "a", "q"), (None, "b", "q"), (None, "b", "r")]))
    assert kept.columns == empty.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "b"), (1, "a")]
    assert drop_copies(empty).count() == 0


def test_components_of_a_path_a_star_and_a_cycle(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(2000, 2001), (2001, 2002), (2002, 2000), (5, 5)]
    random.Random(3).shuffle(edges)
    got = defaultdict(set)
    for r in components(spark.createDataFrame(edges, "a long, b long")).collect():
        got[r.root].add(r.node)
    assert sorted(map(len, got.values())) == [3, 200, 301]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_components(texts, size, percent):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: (len(s), find(i), find(i) == i) for i, s in enumerate(sets)}


@pytest.mark.parametrize("size, percent, block", [(3, 85, 256), (5, 80, 4)])
def test_near_groups_equal_brute_force(docs_of, prose, monkeypatch, size, percent, block):
    """Families whose members are edited more or less, so that many pairs lie on either side of the threshold."""
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "HOME_BYTES", 20_000)
    rng, texts = random.Random(5), [None, "", " ", "one", "One", "one two", "two one", "a b c", "A B C"]
    for family in range(6):
        base = prose(rng.choice((60, 150, 400)), family).split()
        for _ in range(25):
            rate = rng.choice((0, 0.005, 0.01, 0.03, 0.06))
            texts.append(" ".join(f"e{rng.random()}" if rng.random() < rate else w for w in base))
    got = groups(near_groups(docs_of(texts), size=size, percent=percent), "n_shingles", "component_id", "kept")
    assert got == brute_components(texts, size, percent)


def test_unlinked_family_ships_documents_not_pairs(docs_of, prose, monkeypatch):
    """A template whose texts are much alike but not enough: most pairs agree in enough places, none is a link."""
    monkeypatch.setattr(near_dup, "HOME_DOCS", 100, raising=False)
    shipped, real = [], near_dup.stage
    monkeypatch.setattr(near_dup, "stage", lambda df, name: shipped.append((name, made := real(df, name))) or made)
    rng, base, texts = random.Random(6), prose(40, 1).split(), []
    for i in range(400):
        w = list(base)
        for k in rng.sample(range(40), 2):
            w[k] = f"e{i}-{k}"
        texts.append(" ".join(w))
    texts += [texts[7] + " more", texts[300] + " more"]
    got = groups(near_groups(docs_of(texts), size=3, percent=85), "n_shingles", "component_id", "kept")
    assert got == brute_components(texts, 3, 85)
    [met] = [df for name, df in shipped if name.startswith("open-") and "members" in df.columns]
    lists = [c for c, kind in met.dtypes if kind == "array<bigint>"]
    elements = met.agg(sum(F.sum(F.size(c)) for c in lists)).first()[0]
    print("elements", elements)
    assert 400 <= elements < 400 * 40


def test_near_copies_null_ids_repeated_rows(table, empty, prose):
    a, b = prose(100, 1), prose(100, 2)
    rows = [(3, a, "p"), (3, a, "p"), (None, a + " more", "q"), (None, b, "q"), (None, b, "q"), (None, None, "r"), (None, "", "r")]
    kept = drop_near_copies(table(rows))
    assert kept.columns == empty.columns
    assert sorted((r.doc_id or 0, (r.text or "")[:5]) for r in kept.collect()) == sorted([(3, a[:5]), (0, b[:5]), (0, ""), (0, "")])
    assert drop_near_copies(empty).count() == 0


def test_match_threshold_loses_few():
    assert match_threshold(85) == 15 and match_threshold(80) < 15 and match_threshold(100) == near_dup.COORDINATES


def test_lines_by_spread(docs_of, empty):
    sites = [f"s{i}" for i in range(12)]
    texts = [f"own {i}\n  Shared Line \n\nshared by nine" if i < 9 else f"own {i}\nshared LINE" for i in range(12)] + [None, "", "shared line"]
    rows = docs_of(texts, sites)
    got = {r[0]: (r.n_lines, r.n_removed, r.text) for r in line_dedup(rows).select("row.doc_id", "n_lines", "n_removed", "text").collect()}
    assert got[0] == (4, 1, "own 0\n\nshared by nine") and got[11] == (2, 1, "own 11")
    assert got[12] == (1, 0, "") and got[13] == (1, 0, "") and got[14] == (1, 1, "")
    assert line_dedup(empty).count() == 0
    alone = line_dedup(rows.withColumn("source", F.lit(None).cast("string")))
    assert alone.agg(F.sum("n_removed")).first()[0] == 0


def test_many_sites_need_no_exact_count(docs_of):
    got = line_dedup(docs_of([f"mine {i}\nall" for i in range(300)], [f"s{i}" for i in range(300)]))
    assert {r.n_removed for r in got.select("n_removed").collect()} == {1}


def test_long_texts_take_linear_time(table):
    """Ten texts of 200,000 lines that go, and one that stays between any two of them."""
    body = "\n".join(f"line {i}\nown" if i % 1000 == 0 else f"line {i}" for i in range(200_000))
    start = time.monotonic()
    got = line_dedup(table([(i, body.replace("own", f"own {i}"), f"s{i}") for i in range(10)])).select("row.doc_id", "n_lines", "n_removed", "text").collect()
    assert time.monotonic() - start < 60
    assert all((r.n_lines, r.n_removed, r.text) == (200_200, 200_000, "\n".join([f"own {r.doc_id}"] * 200)) for r in got)
