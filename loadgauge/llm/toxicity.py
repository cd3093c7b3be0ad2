"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word comes in twice: as a vector of its own, if the sample has it often, and as the mean of its character trigrams' vectors. Windows of
``WINDOW`` words overlap by half; each is read in both directions and pooled by attention, and a document is as toxic as its most toxic
window. In training a document stands for the window that scores highest so far, so a long clean document has to be clean throughout.

The network is fitted on a bounded sample of labelled documents (``SAMPLE``); texts are scored whole, everywhere, in tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import or_empty, pieces
from .decontaminate import words

#: Labelled documents the network is fitted on, by label: the first in order of a hash of their ids.
SAMPLE = {1: 1200, 0: 3600}
#: Words of a window and between the starts of two; sizes of a word's two vectors, of a direction's state, of the attention.
WINDOW, STEP, WORD, CHARS, STATE, ATTENTION = 32, 16, 8, 8, 8, 8
#: Sample documents a word must be in to have a vector of its own; rows of the trigram table; passes, more if they
#: would have fewer steps; windows in a step.
OFTEN, TRIGRAMS, EPOCHS, STEPS, BATCH = 5, 1 << 14, 10, 300, 128
#: Share of the clean windows in a step that are cut short.
SHORTER = 0.15
#: How much the words' vectors shrink in a step, as a share of the step's rate.
DECAY = 2.0
#: Windows run at once, and words a task remembers.
CHUNK, REMEMBERED = 2048, 250_000


def trigram_rows(vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the words' trigrams, one word after the other, and how many each word has; a word's ends count as characters."""
    sizes = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))
    flat = np.frombuffer(b"\x02" + b"\x03\x02".join(vocabulary) + b"\x03", np.uint8).astype(np.uint32)
    h = flat[:-2] * np.uint32(0x9E3779B1) ^ flat[1:-1] * np.uint32(0x85EBCA77) ^ flat[2:] * np.uint32(0xC2B2AE3D)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    starts = np.cumsum(sizes + 2) - sizes - 2
    inside = np.ones(len(h), bool)
    for back in (1, 2):  # trigrams across two words
        inside[(starts[1:] - back)] = False
    return (h >> np.uint32(18)).astype(np.int64)[inside], sizes


def window_starts(n: int) -> np.ndarray:
    """Starts of the windows over ``n`` words; a text without words has one empty window."""
    return np.arange(0, max(1, n - WINDOW + STEP), STEP)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """The weights by name and the numbers of the words that have vectors of their own (0: the rest)."""

    w: dict[str, np.ndarray]
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    scale: tuple[float, float] = (1.0, 0.0)

    @staticmethod
    def fresh(vocabulary: list[bytes], seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, by=None: (rng.standard_normal(shape) * (by or shape[0] ** -0.5)).astype(np.float32)
        w = {"word": draw(len(vocabulary) + 1, WORD, by=0.1), "chars": draw(TRIGRAMS, CHARS, by=0.1), "in": draw(WORD + CHARS, 6 * STATE), "in_b": np.zeros(6 * STATE, np.float32)}
        w |= {f"state_{d}": draw(STATE, 3 * STATE) for d in "fb"}
        w |= {"att": draw(2 * STATE, ATTENTION), "att_b": np.zeros(ATTENTION, np.float32), "att_v": draw(ATTENTION), "out": draw(2 * STATE), "out_b": np.zeros(1, np.float32)}
        w["word"][0] = 0
        return Network(w, {x: i + 1 for i, x in enumerate(vocabulary)})

    def vectors(self, rows: np.ndarray, sizes: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The input vectors of words, from their trigrams and own numbers."""
        chars = np.zeros((len(sizes), CHARS), np.float32)
        if len(rows):
            chars = np.add.reduceat(self.w["chars"][rows], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
        return np.concatenate((self.w["word"][own], chars), axis=1).astype(np.float32)

    def projected(self, vocabulary: list[bytes]) -> np.ndarray:
        """What words add to the gates of both directions: (words, 6 * STATE)."""
        rows, sizes = trigram_rows(vocabulary)
        own = np.fromiter((self.vocabulary.get(x, 0) for x in vocabulary), np.int64, len(vocabulary))
        return self.vectors(rows, sizes, own) @ self.w["in"] + self.w["in_b"]

    def forward(self, table: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows: rows of ``table`` (rows, 6 * STATE) by ids (windows, WINDOW), and a mask. With ``keep`` also what backward() needs."""
        n, saved = len(ids), []
        full = mask.all(axis=0)
        both = np.empty((WINDOW, n, 2 * STATE), np.float32)
        ids, live = np.ascontiguousarray(ids.T), np.ascontiguousarray(mask.T)
        for d, name in enumerate("fb"):
            u, h, steps = self.w[f"state_{name}"], np.zeros((n, STATE), np.float32), {}
            half = np.ascontiguousarray(table[:, 3 * STATE * d : 3 * STATE * (d + 1)])
            for t in range(WINDOW) if d == 0 else range(WINDOW - 1, -1, -1):
                a, g = half[ids[t]], h @ u
                zr = a[:, : 2 * STATE] + g[:, : 2 * STATE]
                np.negative(zr, out=zr)
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                z, r = zr[:, :STATE], zr[:, STATE:]
                c = np.tanh(a[:, 2 * STATE :] + r * g[:, 2 * STATE :])
                new = c + z * (h - c)
                if not full[t]:
                    new = np.where(live[t, :, None], new, h)
                if keep:
                    steps[t] = (h, z, r, c, g[:, 2 * STATE :])
                both[t, :, STATE * d : STATE * (d + 1)] = h = new
            saved.append(steps)
        hidden = np.tanh(both.reshape(-1, 2 * STATE) @ self.w["att"] + self.w["att_b"]).reshape(WINDOW, n, ATTENTION)
        weight = np.where(live, np.exp(np.clip(hidden @ self.w["att_v"], -30, 30)), np.float32(0))
        share = weight / np.maximum(weight.sum(axis=0), np.float32(1e-9))
        pooled = (share[:, :, None] * both).sum(axis=0)
        logit = pooled @ self.w["out"] + self.w["out_b"]
        return (logit, (saved, both, hidden, share, pooled)) if keep else logit

    def backward(self, d_logit: np.ndarray, mask: np.ndarray, kept) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weights behind the inputs, and of what each window's words add to the gates."""
        saved, both, hidden, share, pooled = kept
        g = {"out": pooled.T @ d_logit, "out_b": np.array([d_logit.sum()])}
        d_pooled = d_logit[:, None] * self.w["out"]
        d_both = share[:, :, None] * d_pooled
        d_share = (both * d_pooled).sum(axis=2)
        d_score = share * (d_share - (share * d_share).sum(axis=0))
        d_hidden = d_score[:, :, None] * self.w["att_v"] * (1 - hidden**2)
        flat = d_hidden.reshape(-1, ATTENTION)
        g |= {"att_v": (hidden * d_score[:, :, None]).sum(axis=(0, 1)), "att": both.reshape(-1, 2 * STATE).T @ flat, "att_b": flat.sum(axis=0)}
        d_both += d_hidden @ self.w["att"].T
        dx = np.zeros((len(mask), WINDOW, 6 * STATE), np.float32)
        for d, name in enumerate("fb"):
            u, du, dh = self.w[f"state_{name}"], np.zeros((STATE, 3 * STATE)), np.zeros((len(mask), STATE), np.float32)
            for t in range(WINDOW - 1, -1, -1) if d == 0 else range(WINDOW):
                h, z, r, c, gc = saved[d][t]
                dh = dh + d_both[t, :, STATE * d : STATE * (d + 1)]
                live = mask[:, t, None]
                dn = np.where(live, dh, 0)
                dc = dn * (1 - z) * (1 - c**2)
                dz, dr = dn * (h - c) * z * (1 - z), dc * gc * r * (1 - r)
                dx[:, t, 3 * STATE * d : 3 * STATE * (d + 1)] = np.concatenate((dz, dr, dc), axis=1)
                dg = np.concatenate((dz, dr, dc * r), axis=1)
                du += h.T @ dg
                dh = np.where(live, dn * z, dh) + dg @ u.T
            g[f"state_{name}"] = du
        return g, dx


class _Adam:
    """Adam; the weights named in ``decay`` also shrink a little in each step, so that what few documents have weighs less."""

    def __init__(self, w: dict[str, np.ndarray], rate: float, decay: dict[str, float]):
        self.w, self.rate, self.decay, self.n = w, rate, decay, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.n += 1
        fix = self.rate * (1 - 0.999**self.n) ** 0.5 / (1 - 0.9**self.n)
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.v[k] += 0.001 * (d * d - self.v[k])
            self.w[k] -= fix * self.m[k] / (np.sqrt(self.v[k]) + 1e-7)
            if k in self.decay:
                self.w[k] *= 1 - self.rate * self.decay[k]


def _summed(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(at, rows[:, k], n) for k in range(rows.shape[1])], axis=1).astype(np.float32)


class _Documents:
    """Texts as word numbers, and the windows over them."""

    def __init__(self, texts: list[bytes]):
        place: dict[bytes, int] = {}
        self.ids = [np.array([place.setdefault(w, len(place)) for w in words(t)], np.int64) for t in texts]
        self.vocabulary = list(place)
        self.windows = [(d, int(s)) for d, x in enumerate(self.ids) for s in window_starts(len(x))]

    def cut(self, chosen: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers and mask of the windows (document, start)."""
        ids, mask = np.zeros((len(chosen), WINDOW), np.int64), np.zeros((len(chosen), WINDOW), bool)
        for k, (d, s) in enumerate(chosen):
            part = self.ids[d][s : s + WINDOW]
            ids[k, : len(part)], mask[k, : len(part)] = part, True
        return ids, mask


def train(texts: list[bytes], toxic: list[int], seed: int = 1) -> Network:
    """Fit on documents; a fifth is set aside to turn logits into probabilities."""
    rng = np.random.default_rng(seed)
    docs, y = _Documents(texts), np.array(toxic, np.float32)
    spread = Counter(i for x in docs.ids for i in np.unique(x).tolist())
    often = [w for i, w in enumerate(docs.vocabulary) if spread[i] >= OFTEN]
    net = Network.fresh(often, seed)
    rows, sizes = trigram_rows(docs.vocabulary) if docs.vocabulary else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    starts = np.cumsum(sizes) - sizes
    own = np.fromiter((net.vocabulary.get(x, 0) for x in docs.vocabulary), np.int64, len(docs.vocabulary))
    aside = rng.random(len(y)) < 0.2 if len(y) >= 200 else np.zeros(len(y), bool)
    adam = _Adam(net.w, 0.01, {"word": DECAY, "chars": DECAY})
    of = np.array([d for d, _ in docs.windows])
    ends = np.searchsorted(of, np.arange(len(y) + 1))
    learn, part = np.flatnonzero(~aside), max(1e-3, float(y.mean()))
    epochs = max(EPOCHS, -(-STEPS * BATCH // (2 * len(learn))))
    for epoch in range(epochs):
        chosen = [docs.windows[rng.integers(ends[d], ends[d + 1])] for d in learn if epoch == 0 or y[d] == 0]
        if epoch:
            best = _best(_logits(net, docs, docs.windows), of, len(y))
            chosen += [docs.windows[best[d]] for d in learn]
        order = rng.permutation(len(chosen))
        for k in range(0, len(order), BATCH):
            picked = [chosen[i] for i in order[k : k + BATCH]]
            ids, mask = docs.cut(picked)
            # A part of a clean window is clean.
            short = np.flatnonzero((y[[d for d, _ in picked]] == 0) & (rng.random(len(picked)) < SHORTER))
            mask[short] &= np.arange(WINDOW) < rng.integers(1, WINDOW, len(short))[:, None]
            unique, back = np.unique(ids, return_inverse=True)
            at = np.concatenate([np.arange(a, a + n) for a, n in zip(starts[unique], sizes[unique])]) if len(unique) and len(rows) else np.zeros(0, np.int64)
            alone = np.where(rng.random(len(unique)) < 0.3, 0, own[unique]) if len(own) else np.zeros(len(unique), np.int64)
            size = sizes[unique] if len(sizes) else np.zeros(len(unique), np.int64)
            vectors = net.vectors(rows[at], size, alone) if len(at) else np.zeros((len(unique), WORD + CHARS), np.float32)
            logit, kept = net.forward(vectors @ net.w["in"] + net.w["in_b"], back.reshape(ids.shape), mask, keep=True)
            want = y[[d for d, _ in picked]]
            weight = np.where(want > 0, 0.5 / part, 0.5 / (1 - part)) if part < 1 else np.ones(len(want))
            d_logit = ((_sigmoid(logit) - want) * weight / len(want)).astype(np.float32)
            g, dx = net.backward(d_logit, mask, kept)
            d_in = _summed(back.reshape(-1), dx.reshape(-1, 6 * STATE), len(unique))
            g |= {"in": vectors.T @ d_in, "in_b": d_in.sum(axis=0)}
            d_vec = d_in @ net.w["in"].T
            g["word"] = _summed(alone, d_vec[:, :WORD], len(net.w["word"]))
            g["word"][0] = 0
            if len(at):
                share = np.repeat(d_vec[:, WORD:] / np.maximum(size, 1)[:, None], size, axis=0)
                g["chars"] = _summed(rows[at], share, TRIGRAMS)
            adam.step(g)
        adam.rate *= 0.1 ** (1 / epochs)
    logits = _logits(net, docs, docs.windows)
    top = logits[_best(logits, of, len(y))]
    use = aside if aside.any() and 0 < y[aside].sum() < aside.sum() else np.ones(len(y), bool)
    net.scale = _calibrated(top[use], y[use])
    return net


def _logits(net: Network, docs: _Documents, windows: list[tuple[int, int]]) -> np.ndarray:
    table = net.projected(docs.vocabulary) if docs.vocabulary else np.zeros((1, 6 * STATE), np.float32)
    # Windows that aren't full come last, so that the others need no mask.
    lengths = np.array([min(WINDOW, len(docs.ids[d]) - s) for d, s in windows])
    order, out = np.argsort(-lengths, kind="stable"), np.empty(len(windows), np.float32)
    for k in range(0, len(order), CHUNK):
        part = order[k : k + CHUNK]
        out[part] = net.forward(table, *docs.cut([windows[i] for i in part]))
    return out


def _best(logits: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """For each document the number of its highest window; ``of`` is in order and has every document."""
    order = np.lexsort((-logits, of))
    return order[np.searchsorted(of[order], np.arange(n))]


def _calibrated(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift for a probability, by Newton steps with a small pull to slope 1."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * logit + b)
        g = np.array([((p - y) * logit).sum() + 0.1 * (a - 1), (p - y).sum() + 0.01 * b])
        q = p * (1 - p)
        h = np.array([[(q * logit**2).sum() + 0.1, (q * logit).sum()], [(q * logit).sum(), q.sum() + 0.01]])
        move = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = max(0.05, a - move[0]), b - move[1]
    return float(a), float(b)


class Scorer:
    """Scores of whole texts; words met before are not projected again."""

    def __init__(self, net: Network):
        self.net, self.place, self.table = net, {}, np.zeros((1024, 6 * STATE), np.float32)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if len(self.place) > REMEMBERED:
            self.place = {}
        place, known, rows = self.place, len(self.place), []
        for t in texts:
            rows.append(np.array([place.setdefault(w, len(place)) for w in words(t)], np.int64))
        if new := list(place)[known:] if known else list(place):
            if len(place) > len(self.table):
                self.table = np.concatenate((self.table[:known], np.zeros((2 * len(place) - known, 6 * STATE), np.float32)))
            for k in range(0, len(new), 1 << 16):
                part = new[k : k + (1 << 16)]
                self.table[known + k : known + k + len(part)] = self.net.projected(part)
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.concatenate([*rows, np.zeros(WINDOW, np.int64)])
        begin = np.cumsum(sizes) - sizes
        counts = -(-np.maximum(1, sizes - WINDOW + STEP) // STEP)
        of = np.repeat(np.arange(len(rows)), counts)
        first = np.cumsum(counts) - counts
        offset = (np.arange(len(of)) - first[of]) * STEP
        start, left = begin[of] + offset, sizes[of] - offset
        logits, span = np.empty(len(of), np.float32), np.arange(WINDOW)
        order = np.argsort(-np.minimum(left, WINDOW), kind="stable")  # windows that aren't full come last, the others need no mask
        for k in range(0, len(order), CHUNK):
            part = order[k : k + CHUNK]
            ids = flat[np.minimum(start[part, None] + span, len(flat) - 1)]
            logits[part] = self.net.forward(self.table, ids, span < left[part, None])
        a, b = self.net.scale
        return np.where(sizes > 0, _sigmoid(a * np.maximum.reduceat(logits, first).astype(float) + b), 0.0)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", sample: dict[int, int] | None = None) -> Network | None:
    """Fit on the sample of labelled documents. Without documents of both labels there is nothing to learn: None.

    Null ids and labels are left out; of several labels of an id the highest counts, of several rows the text with the lowest hash. The sample's
    texts come to the driver: at most the sum of ``sample`` documents, found by a broadcast of their ids.
    """
    ids = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).alias("label"))
    bounds = sample or SAMPLE
    parts = [ids.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(n) for k, n in sorted(bounds.items())]
    wanted = parts[0].unionByName(parts[1])
    found = docs.select(F.col(f"`{doc_id}`").alias("id"), or_empty(F.col(f"`{text}`")).cast("binary").alias("text")).join(F.broadcast(wanted), "id")
    found = found.groupBy("id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("label").alias("label"))
    table = found.toArrow().sort_by([("id", "ascending"), ("text", "ascending")])
    y = table.column("label").to_pylist()
    return train(table.column("text").to_pylist(), y) if len(set(y)) == 2 else None


def toxicity(docs: DataFrame, net: Network | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as (row, score): 0 to 1, higher is more toxic. Texts without words, null ones too, have 0; without a network all have."""
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row")
    if net is None:
        return docs.select(row, F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in pieces(batches, "text"):
            scorer = scorer or Scorer(sent.value)
            made = scorer.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made, pa.float64())], names=["row", "score"])

    source = docs.select(row, or_empty(F.col(f"`{text}`")).cast("binary").alias("text"))
    return source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, score double")
