"""A bidirectional gated recurrent network with attention pooling, in NumPy.

A word's input is its own embedding (words seen in training) plus the mean embedding of its hashed character
trigrams.  Two gated recurrent layers read a window of words in both directions, attention pools their states, a
logistic unit gives the window's logit.  A document's logit is that of its highest window, and an epoch of training
takes the highest window of every document: words of two documents or more get embeddings, the first embedding
dimension starts from log odds, so the first epoch already takes windows with telling words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from relearn.llm import words as W

WINDOW, STRIDE = 32, 16
EMBED, HIDDEN, ATTEND = 12, 8, 8
TRIGRAMS = 1 << 12
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Model:
    vocabulary: np.ndarray            # sorted hashes of the words with an embedding
    p: dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def trigrams(s: W.Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character trigrams (bytes, with word ends) of the words ``at``, and each word's first one."""
    length = s.end[at] - s.start[at]
    first = np.r_[0, np.cumsum(length)]
    within = np.arange(first[-1]) - np.repeat(first[:-1], length)
    place = np.repeat(s.start[at], length) + within
    last = within == np.repeat(length, length) - 1
    mid = _LOWER[s.data[place]].astype(np.uint64)
    before = np.where(within == 0, np.uint64(1), _LOWER[s.data[np.maximum(place - 1, 0)]].astype(np.uint64))
    after = np.where(last, np.uint64(2), _LOWER[s.data[np.minimum(place + 1, len(s.data) - 1)]].astype(np.uint64))
    code = (before << np.uint64(16)) | (mid << np.uint64(8)) | after
    return (W.mix(code) % np.uint64(TRIGRAMS)).astype(np.int64), first


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers (windows x WINDOW), mask and document of every window; -1 words beyond a short document's end."""
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1), 0)
    doc = np.repeat(np.arange(len(n)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(k * STRIDE, np.maximum(n[doc] - WINDOW, 0))     # the last window ends with the document
    at = first[doc][:, None] + start[:, None] + np.arange(WINDOW)
    mask = at < first[doc + 1][:, None]
    return np.where(mask, at, first[doc][:, None]), mask, doc


def inputs(model: Model, s: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a slice: number of each word, word row (0: none), trigram buckets and first ones, and vectors."""
    _, at, number = np.unique(s.hash, return_index=True, return_inverse=True)
    h = s.hash[at]
    row = np.zeros(len(h), np.int64)
    if len(model.vocabulary) and len(h):
        k = np.minimum(np.searchsorted(model.vocabulary, h), len(model.vocabulary) - 1)
        row = np.where(model.vocabulary[k] == h, k + 1, 0)
    grams, first = trigrams(s, at)
    x = model.p["word"][row]
    if len(h):
        x = x + np.add.reduceat(model.p["gram"][grams], first[:-1]) / np.diff(first)[:, None].astype(np.float32)
    return number, row, grams, first, x


def _layer(p: dict, side: str, gates: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
    """States of one direction; ``gates`` (windows, WINDOW, 3 HIDDEN) are in reading order."""
    n, u = len(gates), p[f"u_{side}"]
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((n, WINDOW, HIDDEN), np.float32)
    for t in range(WINDOW):
        g, r = gates[:, t], h @ u
        zr = _sigmoid(g[:, :2 * HIDDEN] + r[:, :2 * HIDDEN])
        z, reset = zr[:, :HIDDEN], zr[:, HIDDEN:]
        new = np.tanh(g[:, 2 * HIDDEN:] + reset * r[:, 2 * HIDDEN:])
        m = mask[:, t:t + 1]
        if keep is not None:
            keep.append((h, z, reset, new, r[:, 2 * HIDDEN:], m))
        h = h + m * ((1 - z) * (new - h))
        out[:, t] = h
    return out


def forward(p: dict, x: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logits of windows; ``at`` numbers the rows of ``x`` (a vector per distinct word)."""
    mask = mask.astype(np.float32)
    states = []
    for side, step in (("f", 1), ("b", -1)):
        gates = (x @ p[f"w_{side}"] + p[f"c_{side}"])[at[:, ::step]]
        kept = None if keep is None else keep.setdefault(side, [])
        states.append(_layer(p, side, gates, mask[:, ::step], kept)[:, ::step])
    h = np.concatenate(states, 2)
    a = np.tanh(h @ p["attend"] + p["attend_c"])
    e = a @ p["attend_v"] - 1e4 * (1 - mask)
    e = np.exp(e - e.max(1, keepdims=True))
    alpha = e / e.sum(1, keepdims=True)
    pooled = (alpha[:, :, None] * h).sum(1)
    if keep is not None:
        keep |= {"h": h, "a": a, "alpha": alpha, "pooled": pooled, "mask": mask}
    return pooled @ p["out"] + p["out_c"]


def backward(p: dict, x: np.ndarray, at: np.ndarray, keep: dict, d: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the parameters and of ``x``, from the gradient ``d`` of the logits."""
    g = {"out": keep["pooled"].T @ d, "out_c": d.sum(keepdims=True)}
    d_pool = d[:, None] * p["out"]
    h, a, alpha = keep["h"], keep["a"], keep["alpha"]
    d_h = alpha[:, :, None] * d_pool[:, None]
    d_alpha = (h * d_pool[:, None]).sum(2)
    d_e = alpha * (d_alpha - (alpha * d_alpha).sum(1, keepdims=True))
    g["attend_v"] = np.einsum("ntk,nt->k", a, d_e)
    d_a = d_e[:, :, None] * p["attend_v"] * (1 - a * a)
    g["attend"], g["attend_c"] = np.einsum("nti,ntk->ik", h, d_a), d_a.sum((0, 1))
    d_h = d_h + d_a @ p["attend"].T
    d_x = np.zeros_like(x)
    for k, (side, step) in enumerate((("f", 1), ("b", -1))):
        d_out = d_h[:, ::step, k * HIDDEN:(k + 1) * HIDDEN]
        u = p[f"u_{side}"]
        d_u, carry = np.zeros_like(u), np.zeros((len(at), HIDDEN), np.float32)
        d_gates = np.zeros((len(at), WINDOW, 3 * HIDDEN), np.float32)
        for t in range(WINDOW - 1, -1, -1):
            before, z, reset, new, r_new, m = keep[side][t]
            total = carry + d_out[:, t]
            d_new = total * m * (1 - z) * (1 - new * new)
            d_z = -total * m * (new - before) * z * (1 - z)
            d_r = d_new * r_new * reset * (1 - reset)
            d_rec = np.concatenate([d_z, d_r, d_new * reset], 1)
            d_gates[:, t] = np.concatenate([d_z, d_r, d_new], 1)
            d_u += before.T @ d_rec
            carry = total * (1 - m * (1 - z)) + d_rec @ u.T
        flat, rows = d_gates.reshape(-1, 3 * HIDDEN), at[:, ::step].ravel()
        g[f"u_{side}"], g[f"c_{side}"] = d_u, flat.sum(0)
        g[f"w_{side}"] = x[rows].T @ flat
        np.add.at(d_x, rows, flat @ p[f"w_{side}"].T)
    return g, d_x


def document_logits(model: Model, s: W.Words, most: int = 1 << 14) -> np.ndarray:
    """The highest window logit of every document of a slice (-inf without words); ``most`` windows at a time."""
    out = np.full(s.n_docs, -np.inf)
    at, mask, doc = windows(s.first)
    if len(at):
        number, _, _, _, x = inputs(model, s)
        for i in range(0, len(at), most):
            np.maximum.at(out, doc[i:i + most], forward(model.p, x, number[at[i:i + most]], mask[i:i + most]))
    return out


def start(vocabulary: np.ndarray, seed: int) -> Model:
    rng = np.random.Generator(np.random.PCG64(seed))
    init = lambda *shape, scale=0.3: (scale * rng.standard_normal(shape)).astype(np.float32)
    p = {"word": init(len(vocabulary) + 1, EMBED, scale=0.05), "gram": init(TRIGRAMS, EMBED, scale=0.05),
         "attend": init(2 * HIDDEN, ATTEND), "attend_c": init(ATTEND), "attend_v": init(ATTEND), "out": init(2 * HIDDEN), "out_c": init(1)}
    for side in "fb":
        p |= {f"w_{side}": init(EMBED, 3 * HIDDEN), f"u_{side}": init(HIDDEN, 3 * HIDDEN), f"c_{side}": np.zeros(3 * HIDDEN, np.float32)}
    return Model(vocabulary, p)


@dataclass
class Highest:
    """The highest window of each document: word rows and mask (documents x WINDOW) and, word by word, its trigram
    buckets with their shares of the word's trigrams."""
    doc: np.ndarray       # document numbers
    rows: np.ndarray
    mask: np.ndarray
    first: np.ndarray     # of the flattened words: each one's first bucket, one more at the end
    grams: np.ndarray
    share: np.ndarray

    def take(self, at: np.ndarray) -> Highest:
        word = (at[:, None] * WINDOW + np.arange(WINDOW)).ravel()
        size = self.first[word + 1] - self.first[word]
        first = np.r_[0, np.cumsum(size)]
        cells = np.repeat(self.first[word] - first[:-1], size) + np.arange(first[-1])
        return Highest(self.doc[at], self.rows[at], self.mask[at], first, self.grams[cells], self.share[cells])


def highest(model: Model, s: W.Words, by_odds: bool, most: int = 1 << 14) -> Highest:
    """The highest windows of a slice's documents that have words; ``by_odds``: by the largest log odds of a word
    (first embedding dimension), for an untrained network."""
    at, mask, doc = windows(s.first)
    number, row, grams, first, x = inputs(model, s)
    parts = [slice(i, i + most) for i in range(0, len(at), most)]
    logits = [(x[number[at[k]], 0] * mask[k]).max(1) if by_odds else forward(model.p, x, number[at[k]], mask[k]) for k in parts]
    order = np.lexsort((np.concatenate(logits), doc)) if parts else np.zeros(0, np.int64)
    top = order[np.r_[doc[order][1:] != doc[order][:-1], True]] if parts else order
    chosen, mask = number[at[top]], mask[top]
    words, which = np.unique(chosen, return_inverse=True)
    length = first[words + 1] - first[words]
    begin = np.r_[0, np.cumsum(length)]
    of = np.repeat(np.arange(len(words)), length)
    cells, count = np.unique(of * TRIGRAMS + grams[np.repeat(first[words] - begin[:-1], length) + np.arange(begin[-1])], return_counts=True)
    bounds = np.searchsorted(cells, np.arange(len(words) + 1) * TRIGRAMS)
    which = which.ravel()
    size = (bounds[1:] - bounds[:-1])[which]
    ends = np.r_[0, np.cumsum(size)]
    flat = np.repeat(bounds[which] - ends[:-1], size) + np.arange(ends[-1])
    share = count / np.maximum(length[cells // TRIGRAMS], 1)
    return Highest(doc[top], row[chosen], mask, ends, cells[flat] % TRIGRAMS, share[flat].astype(np.float32))


def documents_with(s: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What the documents of a slice contain, each pair once: (document, word hash) and (document, trigram bucket)."""
    words, at, number = np.unique(s.hash, return_index=True, return_inverse=True)
    pairs = np.unique(s.doc() * max(len(words), 1) + number)
    word, doc = pairs % max(len(words), 1), pairs // max(len(words), 1)
    grams, first = trigrams(s, at)
    length = np.diff(first)
    cells = np.unique(np.repeat(np.arange(len(words)), length) * TRIGRAMS + grams)      # a word's buckets, each once
    bounds = np.searchsorted(cells, np.arange(len(words) + 1) * TRIGRAMS)
    size = np.diff(bounds)[word]
    ends = np.cumsum(size)
    in_doc, in_gram, i = [], [], 0
    while i < len(word):                                              # some pairs at a time
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + (1 << 20), "right")))
        start = np.cumsum(size[i:j]) - size[i:j]
        flat = np.repeat(bounds[word[i:j]] - start, size[i:j]) + np.arange(size[i:j].sum())
        found = np.unique(np.repeat(doc[i:j], size[i:j]) * TRIGRAMS + cells[flat] % TRIGRAMS)
        in_doc.append(found // TRIGRAMS)
        in_gram.append(found % TRIGRAMS)
        i = j
    both = np.unique(np.concatenate(in_doc) * TRIGRAMS + np.concatenate(in_gram)) if in_doc else np.zeros(0, np.int64)
    return doc, words[word], both // TRIGRAMS, both % TRIGRAMS


def from_counts(labels: np.ndarray, words: tuple[np.ndarray, np.ndarray, np.ndarray], grams: tuple[np.ndarray, np.ndarray, np.ndarray], seed: int = 7) -> Model:
    """An untrained model whose first embedding dimension is the log odds of a word's and a trigram's documents.

    ``words`` are hashes, ``grams`` buckets, each with the numbers of documents, and of those of label 1, that have it."""
    positive, n = max(labels.sum(), 1), max(len(labels) - labels.sum(), 1)
    odds = lambda a, b: np.log((a + 0.5) / (positive + 1)) - np.log((b + 0.5) / (n + 1))
    order = np.argsort(words[0])
    model = start(words[0][order], seed)
    seen, hits = words[1][order], words[2][order]
    model.p["word"][1:, 0] = np.clip(0.5 * odds(hits, seen - hits), -2, 2)
    g_seen, g_hits = np.zeros(TRIGRAMS), np.zeros(TRIGRAMS)
    g_seen[grams[0]], g_hits[grams[0]] = grams[1], grams[2]
    model.p["gram"][:, 0] = np.clip(0.5 * odds(g_hits, g_seen - g_hits), -2, 2) * (g_seen > 0)
    return model


class Adam:
    """Steps on batches of highest windows; keeps the moments between epochs."""

    def __init__(self, model: Model, rate: float = 0.01, seed: int = 7):
        self.p, self.rate, self.step = model.p, rate, 0
        self.m1, self.m2 = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
        self.rng = np.random.Generator(np.random.PCG64(seed))

    def epoch(self, tops: Highest, labels: np.ndarray, batch: int) -> None:
        """One step for every ``batch`` windows in random order; ``labels`` are those of the windows."""
        order = self.rng.permutation(len(labels))
        for i in range(0, len(order), batch):
            self._update(tops.take(order[i:i + batch]), labels[order[i:i + batch]].astype(np.float32))

    def _update(self, b: Highest, y: np.ndarray) -> None:
        p, n = self.p, len(y)
        weighted = np.add.reduceat(p["gram"][b.grams] * b.share[:, None], b.first[:-1])
        x = p["word"][b.rows.ravel()] + weighted
        keep: dict = {}
        at = np.arange(n * WINDOW).reshape(n, WINDOW)
        logit = forward(p, x, at, b.mask, keep)
        g, d_x = backward(p, x, at, keep, (_sigmoid(logit) - y) / n)
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        np.add.at(g["word"], b.rows.ravel(), d_x)
        np.add.at(g["gram"], b.grams, np.repeat(d_x, np.diff(b.first), axis=0) * b.share[:, None])
        g["word"][0] = 0
        self.step += 1
        for k in p:
            self.m1[k] += 0.1 * (g[k] - self.m1[k])
            self.m2[k] += 0.01 * (g[k] * g[k] - self.m2[k])
            p[k] -= (self.rate * (self.m1[k] / (1 - 0.9 ** self.step)) / (np.sqrt(self.m2[k] / (1 - 0.99 ** self.step)) + 1e-6)).astype(np.float32)
