"""Token counts by rank-synchronous merging of ragged arrays.

The pieces of many texts lie in one array of symbols. In each round every piece applies the pair of lowest rank it has, all
pieces at once; pieces with no pair left leave the array with the number of their symbols. A piece's pairs of the same rank are merged
in one round, from the left where they overlap: what a merge gives takes part in later merges only.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import or_empty, pieces
from .pretokens import PUBLIC, splitter

#: Pieces a task remembers before it starts anew, bytes merged at once (one longer piece stays whole), bytes of a file that is broadcast.
REMEMBERED, SYMBOLS, LARGEST_FILE = 300_000, 4 << 20, 64 << 20

_NONE = np.int32(np.iinfo(np.int32).max)


class Merges:
    """The merges of a byte-level BPE file: pairs of symbols as sorted keys, with rank and result."""

    def __init__(self, source: str):
        file = json.loads(source)
        model, split = file["model"], file.get("pre_tokenizer") or {}
        plain = not file.get("normalizer") and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
        if model["type"] != "BPE" or not plain or model.get("ignore_merges") or model.get("dropout") or any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in file["added_tokens"]):
            raise ValueError("only plain byte-level BPE files are counted this way")
        vocabulary = model["vocab"]
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(order.astype(np.int32), _NONE)
        self.results = np.append(np.array([vocabulary[a + b] for a, b in pairs], np.int64)[order], 0)
        self.first = np.array([vocabulary[c] for c in byte_characters()], np.int64)
        self.special = sorted((x["content"] for x in file["added_tokens"]), key=len, reverse=True)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], _NONE), self.results[at]

    def count(self, words: list[bytes]) -> np.ndarray:
        """How many symbols are left of each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.zeros(len(words), np.int64)
        number = np.flatnonzero(sizes)
        sizes = sizes[number]
        symbol = self.first[np.frombuffer(b"".join(words), np.uint8)]
        last = np.zeros(len(symbol), bool)
        last[np.cumsum(sizes) - 1] = True
        rank, result = self._pairs(symbol, last)
        while len(number):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == _NONE
            counts[number[done]] = sizes[done]
            stays = np.repeat(~done, sizes)
            symbol, last, rank, result = symbol[stays], last[stays], rank[stays], result[stays]
            number, sizes, lowest = number[~done], sizes[~done], lowest[~done]
            if not len(number):
                break
            hit = rank == np.repeat(lowest, sizes)
            if (hit[1:] & hit[:-1]).any():
                hit = _every_other(hit, last)
            at = np.flatnonzero(hit)
            symbol[at] = result[at]
            last[at] = last[at + 1]
            kept = np.ones(len(symbol), bool)
            kept[at + 1] = False
            starts = np.cumsum(sizes) - sizes
            sizes = sizes - np.add.reduceat(hit.astype(np.int64), starts)
            symbol, last, rank, result = symbol[kept], last[kept], rank[kept], result[kept]
            at -= np.arange(len(at))
            before = at[at > 0] - 1
            changed = np.concatenate((at, before[~last[before]]))
            rank[changed], result[changed] = self._pairs(symbol, last, changed)
        return counts

    def _pairs(self, symbol: np.ndarray, last: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each symbol with the next one of its word."""
        at = np.arange(len(symbol)) if at is None else at
        after = np.minimum(at + 1, max(0, len(symbol) - 1))
        rank, result = self.look_up(symbol[at], symbol[after])
        rank[last[at]] = _NONE
        return rank, result


def _every_other(hit: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Of neighbouring hits in a word, those that a merge from the left takes: the first, the third and so on."""
    place = np.arange(len(hit))
    first = hit.copy()
    first[1:] &= ~hit[:-1] | last[:-1]
    return hit & ((place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0)


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: visible Latin-1 ones for themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class Counter:
    """Token counts of texts; pieces met before are not merged again."""

    def __init__(self, source: str):
        self.merges = Merges(source)
        self.special = re.compile("|".join(map(re.escape, self.merges.special))) if self.merges.special else None
        self.split = splitter(PUBLIC)
        self.place: dict[str, int] = {}
        self.counts = np.zeros(0, np.int64)

    def count(self, texts: list[str]) -> list[int]:
        if len(self.place) > REMEMBERED:
            self.place, self.counts = {}, np.zeros(0, np.int64)
        place, new, rows = self.place, [], []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            at = []
            for part in parts:
                for piece in self.split(part):
                    if (k := place.get(piece)) is None:
                        k = place[piece] = len(place)
                        new.append(piece)
                    at.append(k)
            rows.append((np.array(at, np.int64), len(parts) - 1))
        counted, held, size = [self.counts], [], 0
        for piece in new:
            held.append(raw := piece.encode())
            size += len(raw)
            if size > SYMBOLS:
                counted.append(self.merges.count(held))
                held, size = [], 0
        counted.append(self.merges.count(held))
        self.counts = np.concatenate(counted)
        return [int(self.counts[at].sum()) + special for at, special in rows]


_made: dict[int, Counter] = {}


def _run(sent, number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            if number not in _made:
                _made.clear()
                _made[number] = Counter(sent.value)
            texts = batch.column("text").to_pylist()
            counts = _made[number].count(texts)
            sizes = [len(x.encode()) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["row", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, file: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as (row, n_bytes, n_tokens); ``row`` has the columns named in ``keep``, or all.

    ``file`` is a byte-level BPE file of the tokenizers library. Its special tokens inside a text count as one token each, as that
    library does by default; none are added. Null and empty texts have no tokens; an empty table gives an empty result.
    """
    if Path(file).stat().st_size > LARGEST_FILE:
        raise ValueError(f"{file} is too large to send to every task")
    sent = docs.sparkSession.sparkContext.broadcast(Path(file).read_text(encoding="utf-8"))
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), or_empty(F.col(f"`{text}`")).alias("text"))
    return source.mapInArrow(_run(sent, sent._jbroadcast.id()), f"row {source.schema['row'].dataType.simpleString()}, n_bytes long, n_tokens long")
