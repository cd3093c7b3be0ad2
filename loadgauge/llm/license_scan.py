"""Licence scan: an Aho-Corasick automaton over a text's words finds notice phrases and identifier tags; tags are followed by
licence expressions, which a shunting-yard parser turns into a value.

A mark restricts use by a number from 0 (none) to 1 (all rights reserved). ``or`` leaves the choice and takes the lesser number, ``and``
asks for both and takes the greater, ``with`` an exception takes a quarter off. A text's score is that of its most restrictive mark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import or_empty, pieces
from .decontaminate import _WORD

#: The phrases every scan looks for, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: More phrases, and the words of tags; a tag is one only if a colon or an equals sign follows.
NOTICES = {
    "mit license": "mit", "permission is hereby granted free of charge": "mit", "apache license": "apache", "apache software license": "apache",
    "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd", "isc license": "isc", "boost software license": "boost",
    "mozilla public license": "mpl", "eclipse public license": "epl", "lesser general public license": "lgpl", "library general public license": "lgpl",
    "affero general public license": "agpl", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "creative commons attribution": "cc-by",
    "cc0": "cc0", "public domain": "public-domain", "the unlicense": "public-domain",
}
TAGS = ("spdx license identifier", "license expression", "license", "licence")

#: How far a label restricts use.
RESTRICTION = {
    "public-domain": 0.05, "cc0": 0.05, "boost": 0.1, "isc": 0.15, "mit": 0.15, "bsd": 0.2, "apache": 0.2, "zlib": 0.15, "cc-by": 0.3,
    "other": 0.5, "mpl": 0.5, "epl": 0.5, "lgpl": 0.55, "cc-by-sa": 0.6, "gpl": 0.7, "agpl": 0.8, "cc-by-nd": 0.8, "cc-by-nc": 0.85, "reserved": 1.0,
}

#: Identifiers of expressions, lower case and without version: the label they stand for.
IDENTIFIERS = {
    "mit": "mit", "mit-0": "mit", "apache": "apache", "bsd": "bsd", "0bsd": "bsd", "isc": "isc", "bsl": "boost", "zlib": "zlib", "unlicense": "public-domain",
    "cc0": "cc0", "mpl": "mpl", "epl": "epl", "lgpl": "lgpl", "gpl": "gpl", "agpl": "agpl", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc",
    "cc-by-nc-sa": "cc-by-nc", "cc-by-nc-nd": "cc-by-nc", "cc-by-nd": "cc-by-nd",
}

_VERSION = re.compile(r"-(?:\d[\w.]*(?:-(?:clause|only|or-later|universal))?|clause)\+?$|\+$")
_TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9.+:_-]+)")
_INSIDE = re.compile(rb"[ \t\r\n]*([()]|[A-Za-z0-9.+:_-]+)")
_SIGN = re.compile(rb"[ \t]*[:=]")
_STRENGTH = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str | None:
    """The label an identifier of an expression stands for; own references are 'other', unknown ones None."""
    name = identifier.lower()
    if name.startswith(("licenseref-", "documentref-")):
        return "other"
    return IDENTIFIERS.get(name) or IDENTIFIERS.get(_VERSION.sub("", name))


@dataclass(frozen=True)
class Terms:
    """What an expression comes to."""

    labels: frozenset[str]
    restriction: float

    @staticmethod
    def joined(operator: str, a: Terms, b: Terms) -> Terms:
        if operator == "with":
            return Terms(a.labels, a.restriction * 0.75)
        pick = min if operator == "or" else max
        return Terms(a.labels | b.labels, pick(a.restriction, b.restriction))


def read_expression(text: bytes, at: int = 0) -> list[str]:
    """The tokens of the longest complete expression that starts at ``at``; line ends are passed over in parentheses only."""
    tokens: list[str] = []
    depth, complete, operand, exception = 0, 0, True, False
    while found := (_INSIDE if depth else _TOKEN).match(text, at):
        at, token = found.end(), found[1].decode()
        word = token.lower()
        if operand and token == "(" and not exception:
            depth += 1
        elif operand and ("exception" in word if exception else label_of(word.rstrip(".:"))):
            token, operand, exception = token.rstrip(".:"), False, False
        elif not operand and word in _STRENGTH and (word != "with" or tokens[-1] != ")"):
            operand, exception = True, word == "with"
        elif not operand and token == ")" and depth:
            depth -= 1
        else:
            break
        tokens.append(token)
        complete = len(tokens) if not depth and not operand else complete
        if token != found[1].decode():
            break  # a full stop ends the sentence, and the expression with it
    return tokens[:complete]


def evaluate(tokens: list[str]) -> Terms | None:
    """The value of a complete expression by two stacks, operators and values; None without tokens."""
    values: list[Terms] = []
    operators: list[str] = []

    def apply():
        b, a = values.pop(), values.pop()
        values.append(Terms.joined(operators.pop(), a, b))

    for token in tokens:
        word = token.lower()
        if word in _STRENGTH:
            while operators and operators[-1] != "(" and _STRENGTH[operators[-1]] >= _STRENGTH[word]:
                apply()
            operators.append(word)
        elif token == "(":
            operators.append(token)
        elif token == ")":
            while operators[-1] != "(":
                apply()
            operators.pop()
        elif operators and operators[-1] == "with":
            values.append(Terms(frozenset(), 0.0))
        else:
            label = label_of(token)
            values.append(Terms(frozenset([label]), RESTRICTION[label]))
    while operators:
        apply()
    return values[0] if values else None


@cache
def _automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    kinds = [(BASE, "base"), (NOTICES, "notice"), ({t: "" for t in TAGS}, "tag")]
    for phrase, label, kind in ((p, label, kind) for phrases, kind in kinds for p, label in phrases.items()):
        made.add_word(f" {phrase} ", (kind, label, len(phrase) + 1, phrase.count(" ") + 1))
    made.make_automaton()
    return made


def scan(text: bytes) -> tuple[int, list[tuple[int, str, str]], float]:
    """(words, marks, score): marks are (first word, kind, label) by place; the kinds are base, notice and expression."""
    plain = text.translate(_WORD)
    found = plain.split()
    line = b" " + b" ".join(found) + b" "
    hits = list(_automaton().iter(line.decode("latin-1")))
    if not hits:
        return len(found), [], 0.0
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    first = np.searchsorted(gaps, [end - size for end, (_, _, size, _) in hits]).tolist()
    marks, score, ends = [], 0.0, None
    for at, (_, (kind, label, _, n)) in zip(first, hits):
        if kind != "tag":
            marks.append((at, kind, label))
            score = max(score, RESTRICTION[label])
            continue
        if ends is None:
            inside = np.frombuffer(plain, np.uint8) != 0x20
            ends = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1
        sign = _SIGN.match(text, int(ends[at + n - 1]))
        if sign and (value := evaluate(read_expression(text, sign.end()))):
            marks += [(at, "expression", x) for x in sorted(value.labels)]
            score = max(score, value.restriction)
    return len(found), sorted(marks), score


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mark = pa.list_(pa.struct([("word", pa.int64()), ("kind", pa.string()), ("label", pa.string())]))
    for batch in pieces(batches, "text"):
        n, marks, scores = zip(*map(scan, batch.column("text").to_pylist()))
        listed = [[{"word": w, "kind": k, "label": x} for w, k, x in m] for m in marks]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(n, pa.int64()), pa.array(listed, mark), pa.array(scores, pa.float64())], names=["row", "n_words", "marks", "score"])


def license_marks(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as (row, n_words, marks, score); ``row`` has the columns named in ``keep``, or all.

    Words are runs of ASCII letters and digits and other characters beyond ASCII, A-Z in lower case, numbered from 0; a phrase may
    cross lines and punctuation. ``marks`` are (word, kind, label) in order of place: each place of a base phrase or notice phrase, and
    the labels of each licence expression at its tag. Expressions name known identifiers, or ``LicenseRef-...`` (label 'other');
    what follows the longest complete one is ordinary text. Null and empty texts have no words, no marks and the score 0,
    as have texts without marks. Repeated rows are scanned by themselves, an empty table gives no rows, and a text of any length is gone
    through once.
    """
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), or_empty(F.col(f"`{text}`")).cast("binary").alias("text"))
    kind = "array<struct<word:long,kind:string,label:string>>"
    return source.mapInArrow(_run, f"row {source.schema['row'].dataType.simpleString()}, n_words long, marks {kind}, score double")
