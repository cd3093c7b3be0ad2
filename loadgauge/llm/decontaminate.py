"""Benchmark decontamination: test n-grams as a broadcast hash set, training texts scanned window by window.

The n-grams of the benchmark are made in Spark and counted before anything is broadcast. Up to ``BLOCK`` n-grams are one block;
a larger benchmark is cut into blocks by a hash of the n-gram and the texts are scanned once per block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .common import numbered, or_empty, pieces

#: Words of a window, and (n-gram, item) pairs broadcast at once, about 20 MB.
WINDOW, BLOCK = 13, 100_000

#: Bytes that part words, and the lower case of the rest.
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_WORD = bytes(_LOWER[c] if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))

_HITS = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and bytes of other characters, A-Z in lower case."""
    return text.translate(_WORD).split()


def _windows(size: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, items = [], []
            for text, item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words(text)
                for i in range(max(1, len(w) - size + 1) if w else 0):
                    grams.append(b" ".join(w[i : i + size]))
                    items.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.binary()), pa.array(items, pa.string())], names=["gram", "item"])

    return make


@dataclass
class GramTable:
    """The n-grams of a block: word numbers, and for each n-gram the slice of ``items`` it stands for."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    grams: dict[bytes, tuple[int, int]] = field(default_factory=dict)
    items: list[str] = field(default_factory=list)
    hashes: dict[int, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def of(rows: Iterator[tuple[bytes, list[str]]]) -> GramTable:
        table, by_length = GramTable(), {}
        for gram, items in rows:
            w = gram.split(b" ")
            ids = np.array([table.vocabulary.setdefault(x, len(table.vocabulary) + 1) for x in w], np.int64)
            table.grams[ids.tobytes()] = (len(table.items), len(table.items) + len(items))
            table.items.extend(items)
            by_length.setdefault(len(w), []).append(ids)
        table.hashes = {n: np.unique(_mixed(np.stack(rows).T)) for n, rows in by_length.items()}
        return table

    def find(self, w: list[bytes]) -> list[tuple[int, int, bytes]]:
        """(first word, word after the last, key) of every n-gram that occurs. A hash only picks places to look at."""
        ids = np.fromiter(map(self.vocabulary.get, w, repeat(0)), np.int64, len(w))
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        found = []
        for n, hashes in self.hashes.items():
            if len(w) < n:
                continue
            at = np.flatnonzero(known[n:] - known[:-n] == n)
            if len(at):
                at = at[np.isin(_mixed([ids[at + k] for k in range(n)]), hashes)]
            found += [(i, i + n, key) for i in at.tolist() if (key := ids[i : i + n].tobytes()) in self.grams]
        return found


def _mixed(columns) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = (out ^ np.asarray(c).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(table):
    """The first column of a batch is handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = table.value
        for batch in pieces(batches, "text"):
            n_words, n_hit, items, spans = [], [], [], []
            for text in batch.column("text").to_pylist():
                w = words(text)
                hits = found.find(w) if w else []
                runs = merged([h[:2] for h in hits])
                n_words.append(len(w))
                n_hit.append(sum(b - a for a, b in runs))
                items.append(sorted({x for key in {h[2] for h in hits} for x in found.items[slice(*found.grams[key])]}))
                spans.append([{"start": a, "end": b} for a, b in runs])
            kinds = {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string()), "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))}
            made = [pa.array(x, kind) for x, kind in zip((n_words, n_hit, items, spans), kinds.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=[batch.schema.names[0], *kinds])

    return run


def _union_of_blocks(found: DataFrame) -> DataFrame:
    """One row per document from its rows of several blocks: spans of different blocks can overlap."""

    def unite(key, table):
        runs = merged([(s["start"], s["end"]) for row in table["spans"].to_pylist() for s in row])
        items = sorted({x for row in table["items"].to_pylist() for x in row})
        row = {"rid": key[0].as_py(), "n_words": table["n_words"][0].as_py(), "n_hit": sum(b - a for a, b in runs), "items": items, "spans": [{"start": a, "end": b} for a, b in runs]}
        return pa.Table.from_pylist([row], schema=table.schema)

    return found.groupBy("rid").applyInArrow(unite, f"rid long, {_HITS}")


def benchmark_tables(benchmark: DataFrame, text: str, item_id: str, window: int, block: int) -> tuple[int, Iterator[GramTable]]:
    """The benchmark's n-grams in blocks of about ``block`` (n-gram, item) pairs, each small enough to broadcast, and how many blocks.

    Pairs are dealt by both parts, so that an n-gram that all items share is spread over the blocks as well. A block is made when
    it is asked for.
    """
    source = benchmark.select(or_empty(F.col(f"`{text}`")).cast("binary"), or_empty(F.col(f"`{item_id}`").cast("string")))
    grams = stage(source.mapInArrow(_windows(window), "gram binary, item string").distinct(), "benchmark-grams")
    blocks = max(1, -(-grams.count() // block))
    parts = grams.withColumn("block", F.pmod(F.xxhash64("gram", "item"), F.lit(blocks)))

    def make(b: int) -> GramTable:
        held = parts.where(F.col("block") == b).groupBy("gram").agg(F.sort_array(F.collect_list("item")).alias("items")).toArrow()
        return GramTable.of(zip(held["gram"].to_pylist(), held["items"].to_pylist()))

    return blocks, map(make, range(blocks))


def _by_blocks(rows: DataFrame, text: str, tables: Iterator[GramTable]) -> DataFrame:
    """(rid, the columns of hits) for the numbered rows: a block's hits are stored and its broadcast given up before the next block.

    Rows without a hit are stored once, for their words.
    """
    context = rows.sparkSession.sparkContext
    source = rows.select("rid", or_empty(F.col(f"row.`{text}`")).cast("binary").alias("text"))
    scans: list[DataFrame] = []
    for table in tables:
        sent = context.broadcast(table)
        scan = source.mapInArrow(_scan(sent), f"rid long, {_HITS}")
        scans.append(stage(scan.where("n_hit > 0") if scans else scan, "contamination-hits"))
        sent.destroy()
    united = _union_of_blocks(reduce(DataFrame.unionByName, (s.where("n_hit > 0") for s in scans)))
    return scans[0].where("n_hit = 0").join(united.select("rid"), "rid", "left_anti").unionByName(united)


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", window: int = WINDOW, block: int = BLOCK, keep: list[str] | None = None
) -> DataFrame:
    """Every row of ``docs`` as (row, n_words, n_hit, items, spans, contaminated); ``row`` has the columns named in ``keep``, or all.

    A document is contaminated if a twentieth of its words or more lie in windows of the benchmark. ``spans`` are runs of such
    words, numbered from 0, and ``items`` the ids of the items found, sorted as strings. Null and empty texts have no
    words and are clean. Items of fewer words than a window count as a whole, items without words not at all; a null item id
    reads as an empty string, and repeated items are one. Windows cross lines and punctuation.
    """
    blocks, tables = benchmark_tables(benchmark, item_text, item_id, window, block)
    if blocks == 1:
        row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row")
        source = docs.select(row, or_empty(F.col(f"`{text}`")).cast("binary").alias("text"))
        sent = docs.sparkSession.sparkContext.broadcast(next(tables))
        found = source.mapInArrow(_scan(sent), f"row {source.schema['row'].dataType.simpleString()}, {_HITS}")
    else:
        rows = numbered(docs, "contamination-rows")
        kept = rows.select("rid", F.struct(*[F.col(f"row.`{c}`") for c in keep or docs.columns]).alias("row"))
        found = kept.join(_by_blocks(rows, text, tables), "rid").drop("rid")
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The clean rows of ``docs``, with the input's columns."""
    return contamination(docs, benchmark, **how).where("NOT contaminated").select("row.*")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            raw, out, done = text.encode(), [], 0
            places = [m.span() for m in re.finditer(rb"\S+", raw.translate(_WORD))] if spans else []
            for s in spans:
                out.append(raw[done : places[s["start"]][0]])
                done = places[s["end"] - 1][1]
            texts.append(b"".join([*out, raw[done:]]).decode())
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """Every row of ``docs`` as (row, text): the text without the words, and what stands between them, of contaminated spans."""
    found = contamination(docs, benchmark, text=text, **how)
    data = found.select("row", or_empty(F.col(f"row.`{text}`")).alias("text"), "spans")
    return data.mapInArrow(_cut, f"row {data.schema['row'].dataType.simpleString()}, text string")
