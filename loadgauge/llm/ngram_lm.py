"""Interpolated modified Kneser-Ney model over words, counted in Spark, kept as sorted hash arrays.

Words are counted first and get numbers, small ones for frequent words. Then a task turns texts into arrays of numbers, counts their triples and
sends one compressed array per bucket; the task that gets a bucket merges its arrays and writes them to the shared folder. Scoring tasks map
these files into memory and look up a batch's distinct n-grams in sorted order. Nothing but totals, counts of counts and the few words that
are very frequent comes to the driver. Files are written under another name and renamed, so a repeated task writes the same.

Triples and pairs are dealt by the first word; those of a very frequent word by the second one too, and triples of two such words by all
three, so no bucket grows with one word. A text's start counts as a word before the first. A bucket holds the hashes of its histories (two words) in
order, and after each the numbers of the words that follow it with their counts; the many histories that one word follows once are kept
apart, without counts. With order 3 pairs count by the distinct words before them, except those that start a text; a pair's count stands beside
the history that the pair is. With order 2 there are no histories, and pairs count as often as they occur.
"""

from __future__ import annotations

import json
import mmap
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import new_path
from .common import or_empty, pieces

#: Tokens counted before a task sends them on, tokens of a bucket, bytes of text per bucket of the word table, and files a scorer keeps open.
FLUSH, BUCKET, WORD_BUCKET_BYTES, OPEN_FILES = 2_000_000, 2_000_000, 64 << 20, 1024

_U = np.uint64
# No word holds a line feed.
START, END = (_U(xxhash.xxh3_64_intdigest(x)) for x in (b"\n<s>", b"\n</s>"))
#: Added to the numbers of buckets that hold histories; the rows with totals of triples and of these have numbers below -_FAR and -2 * _FAR.
_FAR = 1 << 40


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two."""
    x = a * _U(0x9E3779B97F4A7C15) + (b ^ (b >> _U(31))) * _U(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> _U(29))) * _U(0x165667B19E3779F9)
    x = (x ^ (x >> _U(32))) * _U(0x9E3779B97F4A7C15)
    return x ^ (x >> _U(29))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """By the high bits, so that buckets are ranges of the sorted hashes."""
    return ((hashes >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _among(words: np.ndarray, hot: np.ndarray) -> np.ndarray:
    return hot[np.minimum(np.searchsorted(hot, words), len(hot) - 1)] == words


def first_bucket(first: np.ndarray, buckets: int) -> np.ndarray:
    return bucket_of(mixed(first, np.zeros_like(first)), buckets)


def pair_bucket(first: np.ndarray, second: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    return np.where(_among(first, hot), bucket_of(mixed(first, second), buckets), first_bucket(first, buckets))


def triple_bucket(u: np.ndarray, v: np.ndarray, w: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    both = _among(u, hot) & _among(v, hot)
    return np.where(both, bucket_of(mixed(mixed(u, v), w), buckets), pair_bucket(u, v, hot, buckets))


def local_folder(uri: str) -> str:
    """The shared folder as tasks open it; it has to be mounted on all machines, as files in it are mapped into memory."""
    parsed = urlparse(uri)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"the model's folder must be a mounted path to be mapped into memory, not {uri}")
    return parsed.path


def _save(folder: str, name: str, **arrays: np.ndarray) -> None:
    """One file of several arrays: a line that describes them, then their bytes, each from a multiple of 8 on."""
    os.makedirs(folder, exist_ok=True)
    head = json.dumps([(k, a.dtype.str, a.shape) for k, a in arrays.items()]).encode()
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        out.write(len(head).to_bytes(8, "little") + head + b"\0" * (-len(head) % 8))
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
    os.replace(part, f"{folder}/{name}")


def _open(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped."""
    with open(f"{folder}/{name}", "rb") as file:
        held = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    size = int.from_bytes(held[:8], "little")
    at, arrays = 8 + size + -size % 8, {}
    for key, kind, shape in json.loads(held[8 : 8 + size]):
        n = int(np.prod(shape))
        arrays[key] = np.frombuffer(held, kind, n, at).reshape(shape)
        at += arrays[key].nbytes + -arrays[key].nbytes % 8
    return arrays


def _compact(counts: np.ndarray) -> np.ndarray:
    """The counts in the smallest type that holds them all."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers in few bytes: the low bytes of all, then the next ones, compressed."""
    x = _compact(x)
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    body = pa.Codec("zstd", 1).compress(planes, asbytes=True)
    return len(x).to_bytes(8, "little") + bytes([x.itemsize]) + len(body).to_bytes(8, "little") + body


def _unpacked(data: bytes, at: int) -> tuple[np.ndarray, int]:
    n, size, length = int.from_bytes(data[at : at + 8], "little"), data[at + 8], int.from_bytes(data[at + 9 : at + 17], "little")
    planes = pa.Codec("zstd").decompress(data[at + 17 : at + 17 + length], n * size, asbytes=True)
    x = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(f"<u{size}").ravel()
    return x.astype(np.uint64), at + 17 + length


def _pack(sorted_columns: list[np.ndarray], counts: np.ndarray) -> bytes:
    """Rows in order of their columns, as steps from row to row; a column starts anew where one before it changes."""
    out, fresh = [], np.zeros(len(counts), bool)
    fresh[:1] = True
    for c in sorted_columns:
        before = np.concatenate((c[:1] * _U(0), c[:-1]))
        out.append(_packed(np.where(fresh, c, c - before)))
        fresh = fresh | (c != before)
    return b"".join([*out, _packed(counts)])


def _unpack(data: bytes, columns: int) -> list[np.ndarray]:
    at, out, fresh = 0, [], None
    for _ in range(columns):
        step, at = _unpacked(data, at)
        if fresh is None:
            fresh = np.zeros(len(step), bool)
            fresh[:1] = True
        total = np.cumsum(step, dtype=np.uint64)
        first = np.flatnonzero(fresh)
        offset = np.repeat(total[first] - step[first], np.diff(np.append(first, len(step))))
        value = total - offset
        fresh = fresh | np.concatenate((fresh[:1], value[1:] != value[:-1]))
        out.append(value)
    return [*out, _unpacked(data, at)[0]]


def _in_order(columns: list[np.ndarray], counts: np.ndarray, bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows in order, and the sums of their counts. Columns are sorted as one number, those in front by their rank where they are too wide."""
    if not len(counts):
        return columns, counts
    key, width = columns[0], bits
    for c in columns[1:]:
        if width + bits > 64:
            fresh, back = _distinct(key)
            key, width = back.astype(np.uint64), len(fresh).bit_length()
        key, width = (key << _U(bits)) | c, width + bits
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return [c[order[first]] for c in columns], np.add.reduceat(counts[order], first)


def _counted(columns: list[np.ndarray], bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows in order, and how often each occurs."""
    if len(columns) * bits > 64 or not len(columns[0]):
        return _in_order(columns, np.ones(len(columns[0]), np.int64), bits)
    key = columns[0]
    for c in columns[1:]:
        key = (key << _U(bits)) | c
    key = np.sort(key)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    counts, key = np.diff(np.append(first, len(key))), key[first]
    return [(key >> _U(i * bits)) & _U((1 << bits) - 1) for i in reversed(range(len(columns)))], counts


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in order, and the sums of the values of each."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *[np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values]


def _tokens(texts: list[bytes], starts: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word hashes in order; which of these each token is, every text with its end, and with its start if ``starts``; each text's words."""
    flat = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
    # Not a blank, nor one of the five bytes from the tab on. The last byte is white, so edges come in pairs.
    inside = (flat - np.uint8(9) > 4) & (flat != 32)
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    offsets = np.zeros(len(edges) // 2 + 1, np.int32)
    np.cumsum(edges[1::2] - edges[::2], out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(flat[inside])]).dictionary_encode()
    _, ends, body = words.dictionary.buffers()
    kinds, body = np.frombuffer(ends or b"", np.int32)[: len(words.dictionary) + 1].tolist(), body.to_pybytes() if body else b""
    # Cut here, as to_pylist takes several times as long.
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(body[i:j]) for i, j in zip(kinds, kinds[1:])), np.uint64, len(words.dictionary))
    hashes = np.concatenate((hashes, [END, START] if starts else [END]))
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    sizes = np.diff(np.searchsorted(edges[::2], np.cumsum([len(t) + 1 for t in texts])), prepend=0)
    # Words move back by the starts and ends before them.
    more = 2 if starts else 1
    out = np.full(offsets.size - 1 + more * len(texts), rank[len(words.dictionary)])
    out[np.arange(offsets.size - 1) + np.repeat(np.arange(len(texts)) * more + more - 1, sizes)] = rank[words.indices.to_numpy()]
    if starts:
        out[np.cumsum(sizes + 2) - sizes - 2] = rank[-1]
    return hashes[order], out, sizes


def _token_arrays(batches: Iterator[pa.RecordBatch], starts: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes, which may repeat, and which of these each token of whole texts is; about FLUSH tokens at a time."""
    hashes, held, n, kinds = [], [], 0, 0
    for batch in pieces(batches, "text"):
        h, at, _ = _tokens(batch.column("text").to_pylist(), starts)
        hashes.append(h)
        held.append(at + kinds)
        n, kinds = n + len(at), kinds + len(h)
        if n >= FLUSH:
            yield np.concatenate(hashes), np.concatenate(held)
            hashes, held, n, kinds = [], [], 0, 0
    if held:
        yield np.concatenate(hashes), np.concatenate(held)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, in order of the keys, and which of these each key is."""
    order = np.argsort(keys)
    fresh = np.concatenate(([True], keys[order[1:]] != keys[order[:-1]]))[: len(keys)]
    back = np.empty(len(keys), np.int64)
    back[order] = np.cumsum(fresh) - 1
    return order[fresh], back


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each bucket, in their order; narrow numbers sort faster."""
    least = int(bucket.min(initial=0))
    order = np.argsort((bucket - least).astype(np.min_scalar_type(int(bucket.max(initial=0)) - least)), kind="stable")
    kept = bucket[order]
    edges = [0, *(np.flatnonzero(kept[1:] != kept[:-1]) + 1).tolist(), len(kept)] if len(kept) else [0]
    for i, j in zip(edges, edges[1:]):
        yield int(kept[i]), order[i:j]


_SENT = "bucket long, data binary, more binary"


def _sent(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    bucket, data, more = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(data, pa.binary()), pa.array(more, pa.binary())], names=["bucket", "data", "more"])


def _received(table: pa.Table, columns: int, bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The merged rows of a bucket's arrays."""
    parts = [_unpack(x, columns) for x in table["data"].to_pylist()]
    *rows, counts = [np.concatenate(x) for x in zip(*parts)]
    return _in_order(rows, counts.astype(np.int64), bits)


def _counts_of_counts(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


@dataclass(frozen=True)
class Model:
    """Where the arrays are and the few numbers that go with them; ``numbers`` are beyond all words': the start, what is before it, unknown."""

    folder: str
    tokens: int
    words: int
    word_buckets: tuple[int, ...]
    n_word_buckets: int
    numbers: tuple[int, int, int]
    pair_buckets: tuple[int, ...]
    n_buckets: int
    hot: np.ndarray
    hot_stats: np.ndarray
    pairs: int
    word_discounts: tuple[float, float, float]
    unseen_mass: float
    pair_discounts: tuple[float, float, float]
    order: int = 3
    triple_buckets: tuple[int, ...] = ()
    often_buckets: tuple[int, ...] = ()
    triple_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """The modified discounts for counts 1, 2 and 3 or more, from how many n-grams have the counts 1 to 4.

    A discount of nothing would leave no mass to the lower order, one of the whole count none to the n-gram, so where the formula gives
    these or more, as it does where copies abound, or where one of its counts is missing, a fixed discount stands in for it.
    """
    fixed = (0.5, 1.0, 1.5)
    if not all(n[:2]):
        return fixed
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] and n[k] else 0.0 for k in (1, 2, 3)]
    return tuple(d if 0 < d < k else f for d, k, f in zip(found, (1, 2, 3), fixed))


def discount_of(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array((0.0, *d))[np.minimum(c, 3)]


def _kinds(counts: np.ndarray) -> list[np.ndarray]:
    return [(counts == 1).astype(np.int64), (counts == 2).astype(np.int64), (counts >= 3).astype(np.int64)]


def _split(stats: np.ndarray) -> dict[str, np.ndarray]:
    """Columns of statistics, each in its smallest type."""
    return {f"s{i}": _compact(c) for i, c in enumerate(stats.T)}


class Numbers:
    """From word hashes to numbers, by the mapped word tables."""

    def __init__(self, folder: str, buckets: int, known: set[int], special: tuple[int, int, int]):
        self.start, _, self.unknown = special
        self.buckets, self.known, self.folder, self.open = buckets, known, folder, {}

    def table(self, b: int) -> dict[str, np.ndarray]:
        if b not in self.open:
            self.open[b] = _open(self.folder, f"words-{b}")
        return self.open[b]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        unique, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(unique), self.unknown, np.uint64)
        for b, rows in _by_bucket(bucket_of(unique, self.buckets)):
            if b in self.known:
                held = self.table(b)
                at = np.minimum(np.searchsorted(held["hash"], unique[rows]), len(held["hash"]) - 1)
                hit = held["hash"][at] == unique[rows]
                out[rows[hit]] = held["number"][at[hit]]
        out[unique == START] = self.start
        return out[back]


def fit(docs: DataFrame, text: str = "text", order: int = 3) -> Model:
    """Count the texts and write the arrays. Null and empty texts count with their end alone; no rows give a model that knows nothing."""
    if order not in (2, 3):
        raise ValueError(f"order {order}: the model holds pairs (2) or triples (3)")
    spark = docs.sparkSession
    folder = local_folder(new_path(spark, "ngram-model"))
    data = docs.select(or_empty(F.col(f"`{text}`")).cast("binary").alias("text"))
    size = data.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    nw = max(1, -(-size // WORD_BUCKET_BYTES))

    def count_words(batches):
        for h, at in _token_arrays(batches, False):
            keys, counts = _sums(h, np.bincount(at, minlength=len(h)))
            yield _sent([(b, keys[rows].tobytes(), _packed(counts[rows])) for b, rows in _by_bucket(bucket_of(keys, nw))])

    def merge_words(key, table):
        b = key[0].as_py()
        keys = np.frombuffer(b"".join(table["data"].to_pylist()), np.uint64)
        keys, counts = _sums(keys, np.concatenate([_unpacked(x, 0)[0] for x in table["more"].to_pylist()]).astype(np.int64))
        rank = np.empty(len(keys), np.uint64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(keys), dtype=np.uint64)
        number = rank * _U(nw) + _U(b)
        _save(folder, f"words-{b}", hash=keys, count=_compact(counts), number=_compact(number))
        return pa.table({"bucket": [b], "tokens": [int(counts.sum())], "words": [len(keys)], "hot": [number[counts >= BUCKET // 4].tobytes()]})

    sent = data.mapInArrow(count_words, _SENT).groupBy("bucket")
    found = sent.applyInArrow(merge_words, "bucket long, tokens long, words long, hot binary").collect()
    tokens, words = sum(r.tokens for r in found), sum(r.words for r in found)
    word_buckets = tuple(sorted(r.bucket for r in found))
    beyond = max((r.words for r in found), default=0) * nw
    special = start, none, _ = beyond, beyond + 1, beyond + 2
    bits = (beyond + 2).bit_length()
    hot = np.unique(np.concatenate([np.array([start, none], np.uint64), *[np.frombuffer(r.hot, np.uint64) for r in found]]))
    n = max(1, -(-order * tokens // (2 * BUCKET)))

    def numbered_texts(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distinct numbers in order, and which of these each token is."""
        numbers = Numbers(folder, nw, set(word_buckets), special)
        for h, at in _token_arrays(batches, True):
            known, back = np.unique(numbers(h), return_inverse=True)
            yield known, back.astype(np.uint64)[at]

    # The start has the greatest number of a text's; what is before it comes after.
    def count_pairs(batches):
        for known, h in numbered_texts(batches):
            inside = np.flatnonzero(h != len(known) - 1)
            (v, w), counts = _counted([h[inside - 1], h[inside]], len(known).bit_length())
            v, w = known[v], known[w]
            yield _sent([(b, _pack([v[rows], w[rows]], counts[rows]), b"") for b, rows in _by_bucket(pair_bucket(v, w, hot, n))])

    def count_triples(batches):
        for known, h in numbered_texts(batches):
            known = np.append(known, _U(none))
            inside = np.flatnonzero(h != len(known) - 2)
            v, w = h[inside - 1], h[inside]
            u = np.where(v == len(known) - 2, _U(len(known) - 1), h[inside - 2])
            (u, v, w), counts = _counted([u, v, w], len(known).bit_length())
            u, v, w = known[u], known[v], known[w]
            yield _sent([(b, _pack([u[rows], v[rows], w[rows]], counts[rows]), b"") for b, rows in _by_bucket(triple_bucket(u, v, w, hot, n))])

    def merge_triples(key, table):
        b = key[0].as_py()
        (u, v, w), counts = _received(table, 3, bits)
        heads = u == none
        head_rows, head_counts = [v[heads], w[heads]], counts[heads]
        u, v, w, counts = (x[~heads] for x in (u, v, w, counts))
        first = np.flatnonzero(np.concatenate(([True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])))) if len(u) else np.zeros(0, np.int64)
        length = np.diff(np.append(first, len(u)))
        history = mixed(u[first], v[first])
        stats = np.stack([np.add.reduceat(x, first) if len(first) else x[:0] for x in (counts, *_kinds(counts))], axis=1)
        single = (length == 1) & (counts[first] == 1)
        by_hash = np.argsort(history)
        alone, more = by_hash[single[by_hash]], by_hash[~single[by_hash]]
        rows = np.repeat(first[more] - np.cumsum(length[more]) + length[more], length[more]) + np.arange(length[more].sum())
        starts = np.concatenate(([0], np.cumsum(length[more])))
        _save(
            folder, f"triples-{b}", single=history[alone], single_next=_compact(w[first[alone]]), history=history[more], start=_compact(starts),
            next=_compact(w[rows]), count=_compact(counts[rows]), **_split(stats[more]),
        )
        both = _among(u[first], hot) & _among(v[first], hot)
        (x, y), times = _in_order([v, w], np.ones(len(v), np.int64), bits)
        (x, y), times = _in_order([np.concatenate((x, head_rows[0])), np.concatenate((y, head_rows[1]))], np.concatenate((times, head_counts)), bits)
        out = [(to, _pack([x[r], y[r]], times[r]), b"") for to, r in _by_bucket(pair_bucket(x, y, hot, n))]
        often, parted = history[both], stats[both]
        out += [(_FAR + to, often[r].tobytes(), parted[r].tobytes()) for to, r in _by_bucket(bucket_of(often, n))]
        return pa.Table.from_batches([_sent([*out, (-_FAR - 1 - b, np.array([len(u), *_counts_of_counts(counts)], np.int64).tobytes(), b"")])])

    def merge_often(b, table):
        keys = np.frombuffer(b"".join(table["data"].to_pylist()), np.uint64)
        keys, *stats = _sums(keys, *np.frombuffer(b"".join(table["more"].to_pylist()), np.int64).reshape(-1, 4).T)
        _save(folder, f"often-{b}", history=keys, **_split(np.stack(stats, axis=1)))
        return pa.Table.from_batches([_sent([(-2 * _FAR - 1 - b, b"", b"")])])

    def merge_pairs(key, table):
        b = key[0].as_py()
        if b < 0:
            return table.select(["bucket", "data", "more"])
        if b >= _FAR:
            return merge_often(b - _FAR, table)
        (v, w), counts = _received(table, 2, bits)
        pair, left, beside = mixed(v, w), np.ones(len(v), bool), {}
        if os.path.exists(f"{folder}/triples-{b}"):
            held = _open(folder, f"triples-{b}")
            for name in ("single", "history"):
                known = held[name]
                beside[name] = np.zeros(len(known), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, pair), len(known) - 1)
                    hit = known[at] == pair
                    beside[name][at[hit]] = counts[hit]
                    left &= ~hit
        rest = np.flatnonzero(left)[np.argsort(pair[left])]
        before, *stats = _sums(v, counts, *_kinds(counts))
        stats, often = np.stack(stats, axis=1), _among(before, hot)
        _save(
            folder, f"pairs-{b}", pair=pair[rest], count=_compact(counts[rest]), before=_compact(before[~often]), **_split(stats[~often]),
            **{f"{name}_count": _compact(x) for name, x in beside.items()},
        )
        seen, times = np.unique(w, return_counts=True)
        out = [(to, _pack([seen[r]], times[r]), b"") for to, r in _by_bucket((seen % _U(nw)).astype(np.int64))]
        total = np.array([len(v), *_counts_of_counts(counts)], np.int64).tobytes()
        hot_rows = np.column_stack((before[often].astype(np.int64), stats[often])).tobytes()
        return pa.Table.from_batches([_sent([*out, (-1 - b, total, hot_rows)])])

    def merge_seen(key, table):
        b = key[0].as_py()
        if b < 0:
            return table.select(["bucket", "data", "more"])
        (seen,), times = _received(table, 1, 64)
        number = _open(folder, f"words-{b}")["number"]
        known = np.zeros(len(number), np.int64)
        known[np.argsort(number)[(seen // _U(nw)).astype(np.int64)]] = times
        _save(folder, f"continuations-{b}", count=_compact(known))
        sums = np.array([0, *_counts_of_counts(known), int((known >= 3).sum())], np.int64).tobytes()
        return pa.Table.from_batches([_sent([(b, sums, b"")])])

    counted = data.mapInArrow(count_pairs, _SENT)
    if order == 3:
        counted = data.mapInArrow(count_triples, _SENT).groupBy("bucket").applyInArrow(merge_triples, _SENT)
    parts = counted.groupBy("bucket").applyInArrow(merge_pairs, _SENT).groupBy("bucket").applyInArrow(merge_seen, _SENT).collect()
    often_buckets = tuple(sorted(-2 * _FAR - 1 - r.bucket for r in parts if r.bucket < -2 * _FAR))
    triples = [r for r in parts if -2 * _FAR <= r.bucket < -_FAR]
    ends = [r for r in parts if -_FAR <= r.bucket < 0]

    def added(rows, width: int) -> np.ndarray:
        return np.sum([np.frombuffer(r.data, np.int64) for r in rows] or [np.zeros(width, np.int64)], axis=0)

    triple_sums, pair_sums, word_sums = added(triples, 5), added(ends, 5), added([r for r in parts if r.bucket >= 0], 6)
    rows = np.concatenate([np.frombuffer(r.more, np.int64).reshape(-1, 5) for r in ends] or [np.zeros((0, 5), np.int64)])
    hot_stats = np.zeros((len(hot), 4), np.int64)
    np.add.at(hot_stats, np.searchsorted(hot, rows[:, 0].astype(np.uint64)), rows[:, 1:])
    d, pairs = discounts(word_sums[1:5].tolist()), int(pair_sums[0])
    mass = float(np.dot(d, (word_sums[1], word_sums[2], word_sums[5]))) / pairs if pairs else 1.0
    return Model(
        folder, tokens, words, word_buckets, nw, special, tuple(sorted(-1 - r.bucket for r in ends)), n, hot, hot_stats, pairs, d, mass,
        discounts(pair_sums[1:].tolist()), order, tuple(sorted(-_FAR - 1 - r.bucket for r in triples)), often_buckets, discounts(triple_sums[1:].tolist()),
    )


def _hits(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are known, and where."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = np.flatnonzero(known[at] == keys)
    return hit, at[hit]


def _stats(held: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    return np.stack([held[f"s{i}"][at] for i in range(4)], axis=1)


def _places(values: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted value stands or would stand among values[low:high], which are in order."""
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        less = values[middle] < wanted[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
        open_ = open_[low[open_] < high[open_]]
    return low


@dataclass
class Pairs:
    """Per pair: its count; as a history the statistics of what follows, whether both words are very frequent, the bucket, the one word that follows
    once or, of several, where they stand."""

    counts: np.ndarray
    stats: np.ndarray
    both: np.ndarray
    bucket: np.ndarray
    only: np.ndarray
    single: np.ndarray
    span: np.ndarray


class Scorer:
    """Log probabilities from the mapped arrays."""

    def __init__(self, model: Model):
        self.m, self.files = model, {}
        self.start, _, self.unknown = model.numbers
        self.known = {"words": set(model.word_buckets), "pairs": set(model.pair_buckets), "triples": set(model.triple_buckets), "often": set(model.often_buckets)}
        self.known["continuations"] = self.known["words"]

    def file(self, name: str, b: int) -> dict[str, np.ndarray]:
        if (name, b) not in self.files:
            if len(self.files) >= OPEN_FILES:
                self.files.clear()
            self.files[name, b] = _open(self.m.folder, f"{name}-{b}")
        return self.files[name, b]

    def each(self, name: str, bucket: np.ndarray) -> Iterator[tuple[int, dict[str, np.ndarray], np.ndarray]]:
        """The files that hold the buckets, and the rows of each; keys come in order, so that the files are read in order."""
        for b, rows in _by_bucket(bucket):
            if b in self.known[name]:
                yield b, self.file(name, b), rows

    def word_tables(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts, continuation counts and numbers."""
        counts, continued, numbers = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.full(len(words), self.unknown, np.uint64)
        for b, held, rows in self.each("words", bucket_of(words, self.m.n_word_buckets)):
            hit, at = _hits(held["hash"], words[rows])
            counts[rows[hit]], numbers[rows[hit]] = held["count"][at], held["number"][at]
            continued[rows[hit]] = self.file("continuations", b)["count"][at]
        numbers[words == START] = self.start
        return counts, continued, numbers

    def before(self, words: np.ndarray) -> np.ndarray:
        """For each word before another: how many tokens follow it, and how many words follow it once, twice, more often."""
        found = np.zeros((len(words), 4), np.int64)
        for _, held, rows in self.each("pairs", first_bucket(words, self.m.n_buckets)):
            hit, at = _hits(held["before"], words[rows])
            found[rows[hit]] = _stats(held, at)
        often = _among(words, self.m.hot)
        found[often] = self.m.hot_stats[np.searchsorted(self.m.hot, words[often])]
        return found

    def pairs(self, v: np.ndarray, w: np.ndarray, keys: np.ndarray) -> Pairs:
        """What is known of pairs and, as histories, of the words after them, by one look-up."""
        m = self.m
        bucket = pair_bucket(v, w, m.hot, m.n_buckets)
        both = _among(v, m.hot) & _among(w, m.hot)
        found = Pairs(np.zeros(len(v), np.int64), np.zeros((len(v), 4), np.int64), both, bucket, np.zeros(len(v), np.uint64), np.zeros(len(v), bool), np.zeros((2, len(v)), np.int64))
        for b, held, rows in self.each("pairs", bucket):
            hit, at = _hits(held["pair"], keys[rows])
            found.counts[rows[hit]] = held["count"][at]
            if "single_count" not in held:
                continue
            triples = self.file("triples", b)
            hit, at = _hits(triples["single"], keys[rows])
            there = rows[hit]
            found.counts[there], found.stats[there], found.only[there], found.single[there] = held["single_count"][at], (1, 1, 0, 0), triples["single_next"][at], True
            hit, at = _hits(triples["history"], keys[rows])
            there = rows[hit]
            found.counts[there], found.stats[there], found.span[:, there] = held["history_count"][at], _stats(triples, at), (triples["start"][at], triples["start"][at + 1])
        # What follows two frequent words is dealt over buckets, its statistics are summed up in a place of their own.
        found.stats[both], found.single[both], found.span[:, both] = 0, False, 0
        for _, held, rows in self.each("often", np.where(both, bucket_of(keys, m.n_buckets), -1)):
            hit, at = _hits(held["history"], keys[rows])
            found.stats[rows[hit]] = _stats(held, at)
        return found

    def triple_counts(self, pairs: Pairs, history: np.ndarray, keys: np.ndarray, w: np.ndarray, v: np.ndarray, u: np.ndarray) -> np.ndarray:
        """Of the words w after the pairs numbered ``history``, in order of these; ``keys``, u and v are those of the pairs."""
        m = self.m
        found = (pairs.single[history] & (pairs.only[history] == w)).astype(np.int64)
        low, high = pairs.span[:, history]
        for _, held, rows in self.each("triples", np.where(low < high, pairs.bucket[history], -1)):
            self._follow(found, held, rows, low[rows], high[rows], w)
        both = np.flatnonzero(pairs.both[history])
        for _, held, rows in self.each("triples", triple_bucket(u[history[both]], v[history[both]], w[both], m.hot, m.n_buckets)):
            rows = both[rows]
            hit, at = _hits(held["single"], keys[history[rows]])
            found[rows[hit]] = held["single_next"][at] == w[rows[hit]]
            hit, at = _hits(held["history"], keys[history[rows]])
            self._follow(found, held, rows[hit], held["start"][at].astype(np.int64), held["start"][at + 1].astype(np.int64), w)
        return found

    @staticmethod
    def _follow(found: np.ndarray, held: dict[str, np.ndarray], rows: np.ndarray, low: np.ndarray, high: np.ndarray, w: np.ndarray) -> None:
        place = _places(held["next"], low, high, w[rows])
        there = np.flatnonzero(place < high)
        there = there[held["next"][place[there]] == w[rows[there]]]
        found[rows[there]] = held["count"][place[there]]

    @staticmethod
    def _left(stats: np.ndarray, d: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens follow a history, at least 1, and what the discounts leave to the lower order."""
        total = np.maximum(stats[:, 0], 1)
        return total, np.where(stats[:, 0] > 0, stats[:, 1:] @ np.array(d) / total, 1.0)

    def score(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        m = self.m
        unique, place, sizes = _tokens(texts, True)
        sizes = sizes + 1
        counts, continued, numbers = self.word_tables(unique)
        inside = np.ones(len(place), bool)
        inside[np.cumsum(sizes + 1) - sizes - 1] = False
        inside = np.flatnonzero(inside)
        base = np.log10((counts + 1) / (m.tokens + m.words + 1))
        alone = np.full(len(unique), m.unseen_mass / (m.words + 1))
        if m.pairs:
            alone = alone + np.maximum(continued - discount_of(continued, m.word_discounts), 0) / m.pairs
        at, back = _distinct(numbers)
        total, left = (x[back] for x in self._left(self.before(numbers[at]), m.pair_discounts))
        before, this = place[inside - 1], place[inside]
        v, w = numbers[before], numbers[this]
        # The probability of a word is the same wherever the words before it are; so each distinct one is worked out once.
        keys = mixed(v, w)
        at, of = _distinct(keys)
        first, second, keys, before, this_word = v[at], w[at], keys[at], before[at], this[at]
        pairs = self.pairs(first, second, keys)
        p = np.maximum(pairs.counts - discount_of(pairs.counts, m.pair_discounts), 0) / total[before] + left[before] * alone[this_word]
        log_p = np.log10(p)[of]
        if m.order == 3:
            total, left = self._left(pairs.stats, m.triple_discounts)
            later = np.flatnonzero(v != self.start)
            history, w = of[later - 1], w[later]
            # In order of the histories, so that files are read in order.
            at, back = _distinct((history.astype(np.uint64) << _U(self.unknown.bit_length())) | w)
            history, lower = history[at], p[of[later[at]]]
            c = self.triple_counts(pairs, history, keys, w[at], second, first)
            p = np.maximum(c - discount_of(c, m.triple_discounts), 0) / total[history] + left[history] * lower
            log_p[later] = np.log10(p)[back]
        starts = np.cumsum(sizes) - sizes
        add = lambda x: np.add.reduceat(x, starts)
        return {"n_tokens": sizes, "n_known": add((counts > 0).astype(np.int64)[this]), "base_score": add(base[this]), "score": add(log_p)}


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as (row, n_tokens, n_known, base_score, score, perplexity).

    Scores are log10 probabilities of the whole text with its end; ``base_score`` is that of add-one word counts. Null and empty texts
    are the end alone. An empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ("n_tokens", "n_known", "base_score", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in pieces(batches, "text"):
            scorer = scorer or Scorer(sent.value)
            made = scorer.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), *[pa.array(made[n]) for n in names]], names=["row", *names])

    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), or_empty(F.col(f"`{text}`")).cast("binary").alias("text"))
    schema = f"row {source.schema['row'].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double"
    return source.mapInArrow(run, schema).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id reads as an empty text."""
    return F.pmod(F.crc32(or_empty(doc_id.cast("string")).cast("binary")), F.lit(folds))
