"""Secrets, contamination, chat formatting."""

import hashlib
import re

import pytest

from loadgauge.llm import chat_format as chat
from loadgauge.llm.decontaminate import contamination, drop_contaminated, remove_spans
from loadgauge.llm.secret_scan import BASE, RULES, Rule, candidates, secret_spans, trigram_index, trigram_query

TEXTS = [
    None, "", "token=abc", "Password: 'hunter2hunter2' end", "API_KEY = \"abcdefgh\" apikey=12345678", "token=api_key: abcdefghij", "token=secret=abcdefgh12",
    "é AKIA" + "A" * 12 + " AKIAX akia" + "a" * 12, "0" * 31 + " " + "0" * 32 + "g" + "f" * 40, "ſecret=abcdefgh toKen=abcdefgh", "x" * 100_000 + " token=abcdefgh " + "a" * 60_000,
    "ghp_" + "a" * 36 + " -----BEGIN RSA PRIVATE KEY----- sk_live_" + "1" * 20, "😀 secret: 'aaaaaaaa' token: bbbbbbbb",
]


def brute(text):
    spans = []
    for order, (kind, pattern, flags, group, least) in enumerate([("assign", BASE[0].pattern, re.I | re.A, 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 0, 16), ("hex", "[0-9a-f]+", 0, 0, 32)]):
        spans += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text or "", flags) if len(m[group]) >= least]
    return sorted(spans)


def test_secret_spans_equal_brute_force(docs_of, empty):
    docs = docs_of(TEXTS + TEXTS[3:5])
    kinds = {r.kind for r in BASE}
    got = {r[0]: [tuple(s) for s in r.spans if s.kind in kinds] for r in secret_spans(docs).select("row.doc_id", "spans").collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS + TEXTS[3:5])}
    more = {s.kind for r in secret_spans(docs).collect() for s in r.spans}
    assert {"hosting", "private", "payment"} <= more
    assert secret_spans(empty).count() == 0


@pytest.mark.parametrize("digits", [21, 22, 43, 60])
def test_rules_of_more_trigrams_than_a_mask_holds(docs_of, digits):
    """63, 66, 129 and 180 trigrams: only a text that has all of them is a candidate, whichever one another text lacks."""
    literal = "".join(f"{i:02d}x" for i in range(digits)) + "yz"
    rule = Rule("long", literal)
    (need,) = trigram_query(rule.pattern)
    assert len(need) == 3 * digits
    texts = [f"a {literal} b", literal[1:], literal[:-1], literal.replace("10x", "10-"), None]
    docs, queries = docs_of(texts), {"long": [need], "short": trigram_query("token")}
    met = candidates(trigram_index(docs, sorted(need | queries["short"][0]), "text", "doc_id"), queries)
    assert [tuple(r) for r in met.collect()] == [(0, ["long"])]
    got = {r[0]: [(x.start, x.end) for x in r.spans] for r in secret_spans(docs, (rule,)).select("row.doc_id", "spans").collect()}
    assert got == {0: [(2, 2 + len(literal))], 1: [], 2: [], 3: [], 4: []}


def test_repeated_and_null_ids_are_searched_by_themselves(table):
    got = secret_spans(table([(1, "token=abcdefgh", "s"), (1, "nothing", "s"), (None, "x token=abcdefgh", "s"), (None, None, "s")]))
    assert sorted((r.row.text or "", len(r.spans)) for r in got.collect()) == [("", 0), ("nothing", 0), ("token=abcdefgh", 1), ("x token=abcdefgh", 1)]


def test_rules_without_trigrams_only(docs_of):
    got = secret_spans(docs_of(["0" * 40, None]), rules=(Rule("hex", "[0-9a-f]+", 0, 32),))
    assert sorted(len(r.spans) for r in got.collect()) == [0, 1]


def test_queries_name_what_a_match_needs():
    assert trigram_query("AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert trigram_query("[0-9a-f]+") == [frozenset()]
    assert trigram_query("(abc|abcd)?xyz") == [frozenset({"xyz"})]
    assert trigram_query("gh[pousr]_a") == sorted(({frozenset({f"gh{c}", f"h{c}_", f"{c}_a"}) for c in "pousr"}), key=sorted)
    hits = ["api_key=x", "apikey=x", "PASSWD: x", "password:x", "secret=x", "token=x"]
    ways = trigram_query(RULES[0].pattern)
    assert all(any(all(t in h.lower() for t in w) for w in ways) for h in hits)


ITEMS = [(1, " ".join(f"q{i}" for i in range(20))), (2, " ".join(f"q{i}" for i in range(5, 25))), (3, "tiny item"), (4, None), (5, "?!"), (None, "nameless one"), (1, "tiny item")]


def expected(text, items, window=13):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = cut(text), set(), set()
    for item, body in items:
        b = cut(body)
        n = min(window, len(b))
        for i in range(len(b) - n + 1 if b else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == b[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add("" if item is None else str(item))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block", [100_000, 3])
def test_contamination_equals_brute_force(spark, docs_of, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    run = " ".join(f"Q{i}," for i in range(30))
    texts = [None, "", "!!", run, "q0 q1 q2", "a Tiny-Item b", "x " * 500 + "tiny item", "Nameless\none é", " ".join(f"q{i}" for i in range(6, 18)), run + " z " + run, run]
    docs = docs_of(texts)
    got = {r[0]: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in contamination(docs, items, block=block).select("row.doc_id", "n_words", "n_hit", "items", "contaminated").collect()}
    assert got == {i: expected(t, ITEMS) for i, t in enumerate(texts)}
    clean = drop_contaminated(docs, items, block=block)
    assert clean.columns == docs.columns and clean.count() == sum(not expected(t, ITEMS)[3] for t in texts)


def test_one_block_of_the_benchmark_is_alive_at_a_time(spark, docs_of, monkeypatch):
    """A phrase that all items share goes over all blocks; each block's broadcast ends before the next begins."""
    items = spark.createDataFrame([(i, f"shared phrase {' '.join(f'i{i}w{j}' for j in range(i % 3))}".strip()) for i in range(60)], "item_id long, text string")
    made, alive, most = spark.sparkContext.broadcast, set(), []

    def broadcast(value):
        sent = made(value)
        alive.add(id(sent))
        most.append((len(alive), len(value.items)))
        end = sent.destroy
        sent.destroy = lambda *a: (alive.discard(id(sent)), end(*a))
        return sent

    monkeypatch.setattr(spark.sparkContext, "broadcast", broadcast)
    texts = ["a shared phrase b", "clean", None, "shared phrase i1w0", "shared phrase i2w0 i2w1 shared phrase"]
    got = {r[0]: (r.n_words, r.n_hit, r["items"]) for r in contamination(docs_of(texts), items, block=8).select("row.doc_id", "n_words", "n_hit", "items").collect()}
    assert got == {i: expected(t, items.collect())[:3] for i, t in enumerate(texts)}
    assert len(most) > 5 and max(n for n, _ in most) == 1 and not alive and max(size for _, size in most) <= 30


def test_spans_are_cut_out(spark, docs_of, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r[0]: r[1] for r in remove_spans(docs_of(["é a, Tiny item! b", None, "clean"]), items).select("row.doc_id", "text").collect()}
    assert got == {0: "é a, ! b", 1: "", 2: "clean"}
    assert contamination(empty, items).count() == 0
    none = contamination(docs_of(["a b"]), spark.createDataFrame([], "item_id long, text string")).first()
    assert (none.n_words, none.n_hit, none.contaminated) == (2, 0, False)


TURNS = [
    (1, 0, "system", "be ### nice </turn>\n### user: x"), (1, 1, "user", "\\h \\e \\b \\\\"), (1, 2, "assistant", "####</turn></turn>\\"), (1, 3, "assistant", None),
    (2, 5, "a:b\\c\n###", "x"), (2, 5, "a:b\\c\n###", "x"), (2, None, None, "first"), (None, 0, "assistant", "😀 ok"), (3, 0, "assistant", "y" * 50_000),
]


def test_formatting_is_reversible_and_masks_the_assistant(spark):
    made = chat.format_turns(spark.createDataFrame(TURNS, "c long, t long, role string, text string"), "c", "t")
    rows = made.select("*", chat.parse_turns(made.formatted).alias("turns"), chat.learned_text(made.formatted, made.loss).alias("learned")).collect()
    for r in rows:
        want = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in TURNS if c == r.conversation))
        assert [tuple(t) for t in r.turns] == [w[2:] for w in want]
        assert r.n_turns == len(want)
        assert r.learned == "".join(w[3] for w in want if w[2] == "assistant")
        assert all(0 <= s.start <= s.end <= len(r.formatted) for s in r.loss)
    assert len(rows) == 4
    assert chat.format_turns(spark.createDataFrame([], "c long, t long, role string, text string"), "c", "t").count() == 0


def test_layouts_of_tables(spark):
    plain = spark.createDataFrame([(1, "i", "", "o")], "extra int, instruction string, input string, output string")
    got = chat.canonical_turns(plain).first()
    assert got.layout == "instruction_input" and [tuple(t) for t in got.turns] == [("user", "i"), ("assistant", "o")]
    nested = spark.createDataFrame([([("human", "q"), ("gpt", "a")],), (None,)], "conversations array<struct<from:string,value:string>>")
    assert [[tuple(t) for t in r.turns] for r in chat.canonical_turns(nested).collect()] == [[("user", "q"), ("assistant", "a")], []]
    with pytest.raises(ValueError, match="no mapping"):
        chat.canonical_turns(spark.range(1))


def test_layouts_of_records(spark):
    records = [
        '{"messages":[{"role":"user","content":"q"},{"content":"a","role":"assistant"}],"n":1}', '{"prompt":"p","response":"r"}', '{"response":"r","prompt":"p","system":"s"}',
        '{"conversations":[{"from":"human","value":"q"}]}', '{"question":"q","answer":null}', '{"other":1}', "no json", None, "[1]", "{}",
    ]
    got = chat.canonical_records(spark.createDataFrame([(r,) for r in records], "raw string"), "raw").collect()
    assert [r.layout for r in got] == ["messages", "prompt_response", "system_prompt", "speakers", "question", *[None] * 5]
    assert [[tuple(t) for t in r.turns] for r in got[:3]] == [[("user", "q"), ("assistant", "a")], [("user", "p"), ("assistant", "r")], [("system", "s"), ("user", "p"), ("assistant", "r")]]
    assert [list(r.turns) for r in got[5:]] == [[]] * 5


def test_fingerprints_don_t_depend_on_order():
    assert chat.fingerprint(["b", "a"]) == chat.fingerprint(["a", "b"]) == hashlib.sha256(b"a\nb").hexdigest()
    assert len(chat.BY_FINGERPRINT) == len(chat.MAPPINGS)
