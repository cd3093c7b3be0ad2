"""Near-duplicates by an inverted join over MinHash signature coordinates.

A document is posted under each of its (coordinate, value) pairs. Two documents whose signatures agree in ``matches`` places or more
share one of the ``COORDINATES - matches + 1`` rarest pairs of either, so only that prefix is posted; pairs that one document alone has
take places in the prefix and need no posting, and very common ones fall behind it. Lists are merged in two steps that skip what is
decided: first each document meets its lists' most central document; after those links are confirmed, only lists that still hold
several components are compared further, in blocks, and only across components. Every link is confirmed on full shingle sets: where
many pairs of one family are left, the documents travel to a block, never their pairs; a block goes through its pairs itself, leaves out those
that links have joined by then, and gives a spanning forest of its links.

``matches`` is set so that a pair at the similarity threshold has fewer with a probability below ``LOSS``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .common import WordHashes, numbered, or_empty, pieces
from .components import components

#: Coordinates of a signature, the chance to miss a pair at the threshold, documents of a list compared at once, bytes of sets and documents in a block.
COORDINATES, LOSS, BLOCK, HOME_BYTES, HOME_DOCS = 32, 1e-7, 512, 1 << 20, 1024

_U = np.uint64
_ODD = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]
_MULTIPLIERS = np.random.default_rng(7).integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * _U(2) + _U(1)
_PLACE = np.arange(COORDINATES, dtype=np.uint64)


def match_threshold(percent: int) -> int:
    """The most matches that a pair at the threshold reaches with a probability above 1 - LOSS."""
    p, below = percent / 100, 0.0
    for t in range(COORDINATES + 1):
        below += math.comb(COORDINATES, t) * p**t * (1 - p) ** (COORDINATES - t)
        if below > LOSS:
            return max(1, t)
    return COORDINATES


def shingles(text: bytes, size: int, words: dict) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; a text of fewer words is one shingle, one without words none."""
    w = text.lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
    n = min(size, len(w))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = (out ^ (out >> _U(31))) * _ODD[0] + h[k : len(h) - n + 1 + k] * _ODD[1 + k % 4]
    out ^= out >> _U(32)
    out *= _ODD[2]
    return np.unique(out ^ (out >> _U(29)))


def signature(found: np.ndarray) -> np.ndarray:
    """The least hash under each coordinate's order, with the coordinate's number in the low bits."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max)
    for i in range(0, len(found), 4096):
        least = np.minimum(least, (found[i : i + 4096, None] * _MULTIPLIERS).min(axis=0))
    return (least & ~_U(COORDINATES - 1)) | _PLACE


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in pieces(batches, "text"):
            counts, digests, keys = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, size, words)
                counts.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                keys.append(signature(found).astype(np.int64))
            keys = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1, dtype=np.int32) * COORDINATES), pa.array(np.concatenate(keys)))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), keys], names=["rid", "id", "n_shingles", "digest", "keys"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in pieces(batches, "text"):
            sets = [shingles(x, size, words).tobytes() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(sets, pa.binary())], names=["rep", "shingles"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "x"):
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, stored."""
    x = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
    return stage(pairs.join(x.hint("merge"), "a").join(y.hint("merge"), "b").mapInArrow(_confirm(percent), "a long, b long"), "links")


def _across(least: int, percent: int, homes: int):
    """The documents of a list's blocks that have a pair which agrees in ``least`` places, of different components and sizes that allow the threshold.

    One row for each pair of homes that a block's pairs fall in: (low, high, members).
    """

    def pairs_of(group: pa.Table) -> Iterator[pa.RecordBatch]:
        col = {n: group.column(n).to_numpy() for n in ("key", "rep", "root", "n_shingles", "posted", "home", "own", "low", "high")}
        keys = group.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
        low, high = col["low"][0], col["high"][0]
        a, b = np.flatnonzero(col["own"] == low), np.flatnonzero(col["own"] == high)
        same, before = np.zeros((len(a), len(b)), np.int8), np.zeros((len(a), len(b)), bool)
        place = int(col["key"][0]) & (COORDINATES - 1)
        for k in range(COORDINATES):
            equal = keys[a, k][:, None] == keys[b, k][None, :]
            same += equal
            if k < place:  # a pair is given by the first list that both are posted in
                before |= equal & ((col["posted"][a] >> k & 1)[:, None] & (col["posted"][b] >> k & 1)[None, :]).astype(bool)
        na, nb = col["n_shingles"][a][:, None], col["n_shingles"][b][None, :]
        ok = (same >= least) & ~before & (col["root"][a][:, None] != col["root"][b][None, :]) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
        if low == high:
            ok &= a[:, None] < b[None, :]
        i, j = np.nonzero(ok)
        if not len(i):
            return
        i, j = a[i], b[j]
        x, y = np.minimum(col["home"][i], col["home"][j]), np.maximum(col["home"][i], col["home"][j])
        combo = x * homes + y
        order = np.argsort(combo, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(combo[order])) + 1).tolist(), len(order)]
        rows = [order[s:e] for s, e in zip(cuts, cuts[1:])]
        members = [np.union1d(col["rep"][i[r]], col["rep"][j[r]]) for r in rows]
        yield pa.RecordBatch.from_arrays([pa.array([x[r[0]] for r in rows]), pa.array([y[r[0]] for r in rows]), pa.array(members, pa.list_(pa.int64()))], names=["low", "high", "members"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            col = [table.column(n).to_numpy() for n in ("key", "low", "high")]
            change = np.flatnonzero(sum((c[1:] != c[:-1]).astype(int) for c in col)) + 1
            edges = [0, *change.tolist(), len(table)]
            held[:] = [] if last else table.slice(edges[-2]).to_batches()
            for start, end in zip(edges, edges[1:] if last else edges[1:-1]):
                if end - start > 1:
                    yield from pairs_of(table.slice(start, end - start))

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                yield from cut(False)
        if held:
            yield from cut(True)

    return run


def _confirm_block(least: int, percent: int):
    """A spanning forest of the links between the documents of two homes, or within one, on full sets.

    A document meets those that agree with it in ``least`` places and that no link joins with it so far.
    """

    def run(key, group):
        group = group.sort_by("rep")
        reps, home, sizes = (group.column(n).to_numpy() for n in ("rep", "home", "n_shingles"))
        keys = group.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
        held = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        _, ids = np.unique(np.concatenate(held), return_inverse=True)
        own = np.split(ids, np.cumsum(sizes)[:-1])
        _, root = np.unique(group.column("root").to_numpy(), return_inverse=True)
        low, high = (np.flatnonzero(home == k.as_py()) for k in key)
        mark, links = np.zeros(int(ids.max()) + 1, bool), []
        for k, x in enumerate(low.tolist()):
            others = low[k + 1 :] if key[0] == key[1] else high
            n = sizes[others]
            others = others[(root[others] != root[x]) & (100 * np.minimum(n, sizes[x]) >= percent * np.maximum(n, sizes[x]))]
            others = others[(keys[others] == keys[x]).sum(axis=1) >= least]
            mark[own[x]] = True
            for o in others.tolist():
                if root[o] != root[x]:
                    both = int(np.count_nonzero(mark[own[o]]))
                    if 100 * both >= percent * (int(sizes[x]) + int(sizes[o]) - both):
                        root[root == root[o]] = root[x]
                        links.append((int(reps[x]), int(reps[o])))
            mark[own[x]] = False
        return pa.table({"a": pa.array([p for p, _ in links], pa.int64()), "b": pa.array([q for _, q in links], pa.int64())})

    return run


def _postings(classes: DataFrame, prefix: int) -> DataFrame:
    """(rep, key, weight, posted), stored: each class under those of its rarest ``prefix`` pairs that others have too.

    ``posted`` has their places as bits. ``weight`` is how often all its pairs occur: the original of a family of copies has the most.
    """
    exploded = classes.select("rep", F.explode("keys").alias("key"))
    shared = stage(exploded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-pairs")
    lists = exploded.join(shared.hint("merge"), "key").groupBy("rep").agg(F.sum("n").alias("weight"), F.sort_array(F.collect_list(F.struct("n", "key"))).alias("l"))
    posted = lists.select("rep", "weight", F.slice("l", F.lit(1), F.greatest(F.lit(0), prefix - (COORDINATES - F.size("l")))).alias("l"))
    places = F.expr(f"aggregate(l, 0L, (bits, x) -> bits | shiftleft(1L, cast(x.key & {COORDINATES - 1} as int)))")
    return stage(posted.select("rep", "weight", places.alias("posted"), F.inline("l")).select("rep", "key", "weight", "posted"), "postings")


def _candidates(pairs: DataFrame, classes: DataFrame, least: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in ``least`` places and whose sizes allow the threshold."""
    x = classes.select(F.col("rep").alias("a"), F.col("keys").alias("ka"), F.col("n_shingles").alias("na"))
    y = classes.select(F.col("rep").alias("b"), F.col("keys").alias("kb"), F.col("n_shingles").alias("nb"))
    both = pairs.join(x, "a").join(y, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    same = F.aggregate(F.zip_with("ka", "kb", lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, v: s + v)
    return both.where(same >= least).select("a", "b")


def class_links(rows: DataFrame, text: Column, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between class representatives that give the components of the similarity graph, no more of them than needed."""
    least = match_threshold(percent)
    posts = _postings(classes, COORDINATES - least + 1)
    wanted = posts.select(F.col("rep").alias("rid")).distinct()
    texts = rows.select("rid", text.cast("binary").alias("text")).join(wanted.hint("merge"), "rid")
    sets = stage(texts.mapInArrow(_sets(size), "rep long, shingles binary"), "shingle-sets")

    # First step: each list's most central document meets the others.
    leaders = posts.groupBy("key").agg(F.max(F.struct("weight", "rep")).alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    led = stage(posts.join(stage(leaders, "leaders"), "key"), "led-postings")
    first = led.where("leader.rep <> rep").select(F.col("rep").alias("a"), F.col("leader.rep").alias("b")).distinct()
    links = linked(_candidates(first, classes, least, percent), sets, percent)

    # Second step: lists that hold several components, in blocks. A document's home is the bucket of its most central leader's family;
    # a family with too many documents or too large sets for one block has several.
    roots = components(links)
    labelled = led.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("rep", "key", "posted", F.coalesce("root", "rep").alias("root"), "leader")
    mixed = labelled.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low_root"), F.max("root").alias("high_root")).where("low_root <> high_root").select("key", "n")
    open_ = stage(labelled.join(stage(mixed, "mixed-lists"), "key"), "open-postings")
    members = open_.groupBy("rep").agg(F.max("leader").alias("leader"), F.first("root").alias("root")).select("rep", F.col("leader.rep").alias("family"), "root").join(classes.select("rep", "keys", "n_shingles"), "rep")
    members = stage(members, "open-classes")
    parts = lambda shingles, docs: F.ceil(F.greatest(shingles * 8 / HOME_BYTES, docs / HOME_DOCS))
    families = stage(members.groupBy("family").agg(F.sum("n_shingles").alias("shingles"), F.count(F.lit(1)).alias("docs")), "families")
    homes = max(1, families.agg(parts(F.sum("shingles"), F.sum("docs"))).first()[0] or 0)
    slot = F.pmod(F.xxhash64("rep"), parts(F.col("shingles"), F.col("docs")))
    at_home = members.join(families, "family").select("rep", "root", "keys", "n_shingles", F.pmod(F.xxhash64("family", slot), F.lit(homes)).alias("home"))
    placed = open_.join(at_home.drop("root"), "rep").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    placed = placed.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "rep", "root", "n_shingles", "posted", "home", "keys")
    met = placed.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high").mapInArrow(_across(least, percent, homes), "low long, high long, members array<long>")
    met = stage(met, "open-members")
    needed = met.select("low", "high", F.explode("members").alias("rep")).distinct().join(at_home, "rep").join(sets, "rep")
    more = needed.groupBy("low", "high").applyInArrow(_confirm_block(least, percent), "a long, b long")
    return links.unionByName(stage(more, "more-links"))


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 5, percent: int = 80) -> DataFrame:
    """Every row of ``docs`` as (row, n_shingles, component_id, kept).

    Two documents are linked if the Jaccard similarity of their sets of ``size``-word shingles (A-Z in lower case, words parted by ASCII white
    space) is at least ``percent``/100. ``component_id`` is the smallest id that links lead to, null ids last; ``kept`` marks the row with
    that id, the first read if several rows have it. A document of fewer words is one shingle of all of them; null texts and
    texts without words have no shingles, are linked with nothing and kept. An empty table gives an empty result.
    """
    rows = numbered(docs, "near-rows")
    source = rows.select("rid", F.col(f"row.`{doc_id}`").alias("id"), or_empty(F.col(f"row.`{text}`")).cast("binary").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    signed = stage(source.mapInArrow(_sign(size), f"rid long, id {kind}, n_shingles long, digest binary, keys array<long>"), "signatures")
    # Documents with the same set are one class; the classes are what is compared.
    classes = signed.where("n_shingles > 0").groupBy("digest").agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"))
    classes = stage(classes, "classes")
    links = class_links(rows, or_empty(F.col(f"row.`{text}`")), classes, size, percent)
    roots = components(links).withColumnRenamed("node", "rep")
    joined = classes.join(roots, "rep", "left").where("copies > 1 OR root IS NOT NULL").select("digest", F.coalesce("root", "rep").alias("root"))
    members = stage(signed.select("rid", "id", "digest").join(stage(joined, "linked-classes"), "digest").select("rid", "id", "root"), "members")
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("rid"))
    first = stage(members.groupBy("root").agg(F.min(order).alias("first")), "first-of-component")
    named = members.join(first, "root").select("rid", F.col("first.id").alias("first_id"), F.col("first.rid").alias("first_rid"))
    found = signed.select("rid", "id", "n_shingles").join(named, "rid", "left")
    found = found.select("rid", "n_shingles", F.when(F.col("first_rid").isNull(), F.col("id")).otherwise(F.col("first_id")).alias("component_id"), (F.coalesce("first_rid", "rid") == F.col("rid")).alias("kept"))
    return rows.join(found, "rid").select("row", "n_shingles", "component_id", "kept")


def drop_near_copies(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that stay, with the input's columns."""
    return near_groups(docs, **how).where("kept").select("row.*")
