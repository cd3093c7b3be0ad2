"""Ranked lexical search, reversed: the items are indexed and broadcast, the documents stream past them.

An inverted index over the items' terms is made in blocks of bounded size. Per block the documents are read twice: to count
in how many of them each of the block's terms stands, and to score each document's term counts against the postings. A task keeps
the best documents of each item in a heap of fixed length; heaps are merged in two steps, so no task sees all of them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .common import numbered, or_empty, pieces
from .decontaminate import words

#: Documents kept per item, (term, item) pairs broadcast at once (about 10 MB), scores held at once, groups that heaps are merged in first.
TOP, BLOCK, CELLS, MERGES = 10, 150_000, 2_000_000, 64
#: Rows of the statistics that count documents with terms and all of their terms; numbers of terms start at 0.
_DOCUMENTS, _TERMS = -1, -2


def gain(tf: np.ndarray, size: int, documents: int, terms: int) -> np.ndarray:
    """What ``tf`` occurrences are worth in a document of ``size`` terms, in millionths; less in long documents."""
    m = 100 - 90 + 90 * size * documents // terms
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def weight(documents: int, df: int) -> int:
    """Of a term that stands in ``df`` documents, in thousandths."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        ids, terms = [], []
        for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text").to_pylist()):
            found = sorted(set(words(text)))
            ids += [rid] * len(found)
            terms += found
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], names=["rid", "term"])


def _blocks(terms: DataFrame, block: int, depth: int = 0) -> Iterator[DataFrame]:
    """The (rid, term) pairs cut by item into parts of at most ``block``; only a single item may be larger, by its own text."""
    pairs, least, most = terms.agg(F.count(F.lit(1)), F.min("rid"), F.max("rid")).first()
    if pairs <= block or least == most:
        if pairs:
            yield terms
        return
    parts = -(-pairs * 3 // (block * 2)) + 1
    for part in range(parts):
        yield from _blocks(terms.where(F.pmod(F.xxhash64(F.lit(depth), "rid"), F.lit(parts)) == part), block, depth + 1)


@dataclass
class ItemIndex:
    """Term numbers, the numbers of the items of each term, and the row number of each item."""

    vocabulary: dict[bytes, int]
    starts: np.ndarray
    postings: np.ndarray
    rids: np.ndarray

    @staticmethod
    def of(pairs: pa.Table) -> ItemIndex:
        rids, item = np.unique(pairs["rid"].to_numpy(), return_inverse=True)
        names = pairs["term"].to_pylist()
        vocabulary: dict[bytes, int] = {}
        term = np.fromiter((vocabulary.setdefault(t, len(vocabulary)) for t in names), np.int64, len(names))
        starts = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=len(vocabulary)))))
        return ItemIndex(vocabulary, starts, item[np.argsort(term, kind="stable")], rids)

    def counts(self, text: bytes) -> tuple[int, np.ndarray, np.ndarray]:
        """All terms of a text, with repeats, and the known ones with their numbers of occurrences."""
        found = words(text)
        numbers = np.fromiter(map(self.vocabulary.get, found, repeat(-1)), np.int64, len(found))
        return len(found), *np.unique(numbers[numbers >= 0], return_counts=True)


def _statistics(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        df, documents, terms = np.zeros(len(index.vocabulary), np.int64), 0, 0
        for batch in pieces(batches, "text"):
            for text in batch.column("text").to_pylist():
                size, known, _ = index.counts(text)
                documents += size > 0
                terms += size
                df[known] += 1
        seen = np.flatnonzero(df)
        made = [np.concatenate((x, y)) for x, y in (((_DOCUMENTS, _TERMS), seen), ((documents, terms), df[seen]))]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in made], names=["term", "n"])

    return run


class Heaps:
    """The best ``top`` documents of each item seen so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, items: int, top: int):
        self.top, self.held, self.least = top, [[] for _ in range(items)], np.zeros(items, np.int64)

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        """A row of scores per document, a column per item."""
        row, item = np.nonzero((scores > 0) & (scores >= self.least))
        if not len(row):
            return
        rank = np.empty(len(ids), np.int64)
        rank[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))] = np.arange(len(ids))
        order = np.lexsort((rank[row], -scores[row, item], item))
        row, item = row[order], item[order]
        first = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1])))
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        for r, i in zip(row[place < self.top].tolist(), item[place < self.top].tolist()):
            heap, entry = self.held[i], (int(scores[r, i]), -math.inf if ids[r] is None else -ids[r])
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.top:
                self.least[i] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, int, int | None]]:
        for i, heap in enumerate(self.held):
            for score, low in heap:
                yield i, score, None if low == -math.inf else -low


def _best(sent, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weights, documents, terms = sent.value
        items, lengths = len(index.rids), np.diff(index.starts)
        heaps = Heaps(items, top)
        at_once = max(1, CELLS // items)

        def flush(ids, parts):
            scores = np.zeros(len(ids) * items, np.int64)
            row = np.repeat(np.arange(len(ids)), [len(known) for known, _ in parts])
            known, gains = (np.concatenate(x) for x in zip(*parts))
            # The places of every posting of every known term, term after term.
            n = lengths[known]
            place = np.arange(n.sum()) + np.repeat(index.starts[known] - np.cumsum(n) + n, n)
            np.add.at(scores, np.repeat(row * items, n) + index.postings[place], np.repeat(gains, n))
            heaps.add(scores.reshape(len(ids), items), ids)

        for batch in pieces(batches, "text"):
            ids, parts, cells = [], [], 0
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                size, known, tf = index.counts(text)
                if not len(known):
                    continue
                ids.append(doc)
                parts.append((known, weights[known] * gain(tf, size, documents, terms)))
                cells += int(lengths[known].sum())
                if len(ids) == at_once or cells > CELLS:
                    flush(ids, parts)
                    ids, parts, cells = [], [], 0
            if ids:
                flush(ids, parts)
        rid, score, doc = zip(*heaps.rows()) if any(heaps.held) else ((), (), ())
        made = [pa.array(index.rids[list(rid)], pa.int64()), pa.array(score, pa.int64()), pa.array(doc, pa.int64())]
        yield pa.RecordBatch.from_arrays(made, names=["rid", "score", "id"])

    return run


def _merged(heaps: DataFrame, top: int) -> DataFrame:
    """(rid, rank, id, score) from the tasks' heaps, first within groups of tasks, then over those."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    within = heaps.withColumn("rank", F.row_number().over(Window.partitionBy("rid", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = within.withColumn("rank", F.row_number().over(Window.partitionBy("rid").orderBy(*order)))
    return best.where(F.col("rank") <= top).select("rid", "rank", "id", "score")


def ranked(
    docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", top: int = TOP, block: int = BLOCK
) -> DataFrame:
    """(item, rank, doc_id, score): the ``top`` rows of ``docs`` for each row of ``items``, best first; ``item`` has the item's columns.

    Terms are runs of ASCII letters and digits and other characters beyond ASCII, A-Z in lower case. Null and empty texts have none: such
    documents are not counted, such items have no rows. A score adds up the gain times the weight of the item's distinct terms
    (:func:`gain`, :func:`weight`); documents of score 0 are left out, and equal scores come by ascending ``doc_id``, an integer,
    null ids last. Every row counts as a document or an item of its own, also repeated ones. Empty tables give no rows.
    """
    context = docs.sparkSession.sparkContext
    listed = numbered(items, "search-items")
    terms = listed.select("rid", or_empty(F.col(f"row.`{item_text}`")).cast("binary").alias("text")).mapInArrow(_item_terms, "rid long, term binary")
    terms = stage(terms, "search-terms")
    data = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), or_empty(F.col(f"`{text}`")).cast("binary").alias("text"))
    found = []
    for part in _blocks(terms, block):
        index = ItemIndex.of(part.toArrow())
        sent = context.broadcast(index)
        counted = data.select("text").mapInArrow(_statistics(sent), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        n = dict(zip(counted["term"].to_pylist(), counted["n"].to_pylist()))
        sent.destroy()
        documents = n.get(_DOCUMENTS, 0)
        weights = np.array([weight(documents, n.get(t, 0)) for t in range(len(index.vocabulary))], np.int64)
        sent = context.broadcast((index, weights, documents, n.get(_TERMS, 0)))
        heaps = data.mapInArrow(_best(sent, top), "rid long, score long, id long").withColumn("part", F.spark_partition_id() % MERGES)
        found.append(stage(_merged(heaps, top), "search-best"))
        sent.destroy()
    if not found:
        best = docs.sparkSession.createDataFrame([], "rid long, rank int, id long, score long")
    else:
        best = reduce(DataFrame.unionByName, found)
    return best.join(listed, "rid").select(F.col("row").alias("item"), "rank", F.col("id").alias("doc_id"), "score")
