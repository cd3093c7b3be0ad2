"""Byte-level BPE by longest matches and backtracking.

Bytes stand as Latin-1 characters, so that one Aho-Corasick automaton over the vocabulary finds all tokens in a piece. From
the left the longest token is tried, then the shorter ones that are prefixes of it; a token may follow another only if the merges of
the two side by side would leave both as they are. A place that leads nowhere is never tried again, so the work is linear in the
piece's length, and the only token sequence whose neighbours are all compatible is the one that merging gives.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import or_empty, pieces
from .pretokens import PUBLIC, splitter

#: Entries a task remembers of pieces and of token pairs before it starts anew, and bytes of a vocabulary file that is broadcast.
REMEMBERED, LARGEST_FILE = 300_000, 64 << 20

_NEVER = 1 << 40
_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    if Path(path).stat().st_size > LARGEST_FILE:
        raise ValueError(f"{path} is too large to send to every task")
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class Bpe:
    """Encoder and decoder of a vocabulary of ranks that holds all single bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PUBLIC):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"no token for the bytes {missing[:5]}")
        self.found = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.found.add_word(token.decode("latin-1"), (rank, len(token)))
        self.found.make_automaton()
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.split = splitter(pattern)
        self._shorter: dict[int, int] = {}
        self._edges: dict[int, tuple[list, list]] = {}
        self._fits: dict[int, bool] = {}
        self._pieces: dict[str, bytes] = {}

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix, or -1."""
        if (known := self._shorter.get(token)) is None:
            whole = self.token[token]
            known = self._shorter[token] = next((r for k in range(len(whole) - 1, 0, -1) if (r := self.ranks.get(whole[:k])) is not None), -1)
        return known

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts that the last merge puts together."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min((self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == _NEVER:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(parts) if len(parts) == 2 else None

    def edges(self, token: int) -> tuple[list, list]:
        """What stands at the token's left and at its right end while it is built up: (bytes, from rank, until rank)."""
        if (known := self._edges.get(token)) is None:
            known = ([], [])
            for side, spine in enumerate(known):
                part, until = self.token[token], _NEVER
                while True:
                    halves = self._halves(part)
                    born = self.ranks[part] if halves else -1
                    spine.append((part, born, until))
                    if not halves:
                        break
                    part, until = halves[side], born
            self._edges[token] = known
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether merging leaves the two tokens apart: nothing at the seam is merged while both ends of it stand.

        Of equal ranks the leftmost is merged first, so the seam loses against the left token and wins against the right one.
        """
        if len(self._fits) > REMEMBERED:
            self._fits.clear()
        known = True
        for x, born_x, until_x in self.edges(left)[1]:
            for y, born_y, until_y in self.edges(right)[0]:
                if (m := self.ranks.get(x + y)) is not None and (m := max(m, born_x, born_y)) < until_x and m <= until_y:
                    known = False
        self._fits[left << 32 | right] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        longest = [0] * len(piece)
        for end, (rank, size) in self.found.iter(piece.decode("latin-1")):
            longest[end - size + 1] = rank
        sizes, fits, last = self.sizes, self._fits, len(piece)
        closed, out, at, tried = set(), [], 0, longest[0]
        while at < last:
            end = at + sizes[tried]
            if end not in closed:
                fit = fits.get(out[-1] << 32 | tried) if out else True
                if fit is None:
                    fit = self.fits(out[-1], tried)
                if fit:
                    out.append(tried)
                    at = end
                    tried = longest[at] if at < last else -1
                    continue
            tried = self.shorter(tried)
            if tried < 0:
                closed.add(at)
                tried = out.pop()
                at -= sizes[tried]
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        known, out = self._pieces, []
        for piece in self.split(text):
            if (ids := known.get(piece)) is None:
                if len(known) > REMEMBERED:
                    known.clear()
                made = self.encode_piece(piece.encode())
                ids = _PACK[len(made)](*made) if len(made) < 32 else np.array(made, "<u4").tobytes()
                if len(piece) < 64:
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_made: dict[int, Bpe] = {}


def _worker(sent, pattern: str) -> Bpe:
    """One encoder for each vocabulary in a worker process, kept from task to task."""
    if sent.id not in _made:
        _made.clear()
        _made[sent.id] = Bpe(sent.ranks.value, pattern)
    return _made[sent.id]


class _Sent:
    def __init__(self, ranks):
        self.ranks, self.id = ranks, ranks._jbroadcast.id()

    def __reduce__(self):
        return _sent, (self.ranks, self.id)


def _sent(ranks, number):
    out = _Sent.__new__(_Sent)
    out.ranks, out.id = ranks, number
    return out


def _run(sent, pattern: str, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in pieces(batches, "text"):
            bpe = bpe or _worker(sent, pattern)
            ids = [bpe.encode(x) for x in batch.column("text").to_pylist()]
            columns = {"row": batch.column("row"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
            if decode:
                columns["decoded"] = pa.array([bpe.decode(x) for x in ids], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str = PUBLIC, text: str = "text", keep: list[str] | None = None, decode: bool = False) -> DataFrame:
    """Every row of ``docs`` as (row, n_tokens, ids) and with ``decode`` also ``decoded``, the bytes the ids stand for.

    ``row`` has the columns named in ``keep``, or all. ``ids`` are little-endian unsigned 32-bit integers. Special tokens are
    ordinary text. Null and empty texts give no tokens; an empty table gives an empty result.
    """
    sent = _Sent(docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path)))
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), or_empty(F.col(f"`{text}`")).alias("text"))
    schema = f"row {source.schema['row'].dataType.simpleString()}, n_tokens long, ids binary"
    return source.mapInArrow(_run(sent, pattern, decode), schema + ", decoded binary" * decode)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """The rows with a column ``decoded``: the bytes that ``ids`` stand for; null ids give null."""
    sent = _Sent(encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: token for token, rank in sent.ranks.value.items()}
        for batch in pieces(batches, "ids"):
            out = [None if x is None else b"".join(map(token.__getitem__, np.frombuffer(x, "<u4").tolist())) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.binary())], names=["row", "decoded"])

    source = encoded.select(F.struct("*").alias("row"), F.col(f"`{ids}`").alias("ids"))
    return source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, decoded binary").select("row.*", "decoded")
