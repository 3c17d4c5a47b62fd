"""Quality classifier: a byte-level convolutional network in numpy.

Each byte is embedded; learned filters slide over the bytes (windows that
overlap by half); their activations are pooled over chunks of the text that
overlap by half and together cover all of it; a dense layer judges every
chunk, its outputs are max-pooled over the text and combined into one
probability. Nothing but the bytes enters the score.

The filters are learned on windows of a bounded sample of labelled texts; the
last step, from the pooled outputs of whole texts to a probability, is fitted
on whole texts that the filters were not learned from.

Results at the edges: a null text is an empty one and scores like an empty
chunk; texts shorter than a chunk are padded with zero bytes. Without rows of
both labels to learn from, every score is the share of label 1 among them (0.5
if there are none). Repeated rows get equal scores; an empty table gives an
empty result. Only the id and the text are read, so names may clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from lendgrade.llm import learning
from lendgrade.llm.common import score_partitions

#: Bounds of the learning sample: documents by label, characters of one.
LEARN_ROWS, LEARN_CHARS = {0: 1500, 1: 2500}, 60_000
#: Bytes of a window step (windows are two), windows of a half chunk.
STEP, HALF = 4, 64
EMBED, FILTERS, HIDDEN = 8, 32, 16
#: Half chunks worked on at a time: bounds the memory of a long text.
BLOCK = 2_048


class ByteNet:
    """Parameters and passes of the network."""

    NAMES = ("emb", "w0", "w1", "b", "v", "c", "u", "d")

    def __init__(self, rng: np.random.Generator):
        f = np.float32
        self.emb = rng.normal(0, 0.5, (256, EMBED)).astype(f)
        self.emb[0] = 0
        self.w0 = rng.normal(0, (2 * STEP * EMBED) ** -0.5, (STEP * EMBED, FILTERS)).astype(f)
        self.w1 = rng.normal(0, (2 * STEP * EMBED) ** -0.5, (STEP * EMBED, FILTERS)).astype(f)
        self.b = np.zeros(FILTERS, f)
        self.v = rng.normal(0, (2 * FILTERS) ** -0.5, (2 * FILTERS, HIDDEN)).astype(f)
        self.c = np.zeros(HIDDEN, f)
        self.u = rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(f)
        self.d = np.zeros(1, f)
        self.scale = np.array([1.0, 0.0])  # of the logit, for whole texts

    def halves(self, data: np.ndarray, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Greatest and mean activation of each filter in each half chunk of
        ``data``, whose length is a multiple of a half chunk's bytes. ``last``:
        the half chunks in which texts end, with zero bytes; the window over
        their last step does not read on into the next text."""
        n = len(data) // (STEP * HALF)
        top, mean = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.float32)
        for i in range(0, n, BLOCK):
            j = min(n, i + BLOCK)
            piece = data[i * STEP * HALF : (j * HALF + 1) * STEP]
            if j == n:
                piece = np.concatenate([piece, np.zeros(STEP, np.uint8)])
            x = self.emb[piece].reshape(-1, STEP * EMBED)
            a = x[:-1] @ self.w0
            a += x[1:] @ self.w1
            a += self.b
            np.maximum(a, 0, out=a)
            a = a.reshape(j - i, HALF, FILTERS)
            if last is not None:  # zero bytes embed as zero: the bias alone is left
                a[last[(last >= i) & (last < j)] - i, -1] = np.maximum(self.b, 0)
            top[i:j], mean[i:j] = a.max(axis=1), a.mean(axis=1)
        return top, mean

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """The network's output for whole texts."""
        size = STEP * HALF
        count = np.array([max(1, -(-(len(t) + STEP) // size)) for t in texts], dtype=np.int64)
        data = np.frombuffer(b"".join(t.ljust(c * size, b"\0") for t, c in zip(texts, count.tolist())), dtype=np.uint8)
        top, mean = self.halves(data, np.cumsum(count) - 1)
        # a chunk is a half with the next one; the last half of a text stands with itself
        nxt = np.arange(1, len(top) + 1)
        nxt[np.cumsum(count) - 1] -= 1
        x = np.concatenate([np.maximum(top, top[nxt]), (mean + mean[nxt]) / 2], axis=1)
        h = np.maximum(x @ self.v + self.c, 0)
        pooled = np.maximum.reduceat(h, np.cumsum(count) - count, axis=0)
        return pooled @ self.u + self.d[0]

    def probabilities(self, texts: list[str]) -> np.ndarray:
        z = self.logits([t.encode("utf-8", "replace") for t in texts]).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(z * self.scale[0] + self.scale[1], -30, 30)))

    # ------------------------------------------------------------ learning

    def gradients(self, data: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted logistic loss of windows: ``data`` has one window
        of a whole number of half chunks per row."""
        n, size = data.shape
        m = size // (STEP * HALF)
        x = self.emb[np.concatenate([data, np.zeros((n, STEP), np.uint8)], axis=1)].reshape(n, -1, STEP * EMBED)
        x0, x1 = x[:, :-1].reshape(-1, STEP * EMBED), x[:, 1:].reshape(-1, STEP * EMBED)
        a = np.maximum(x0 @ self.w0 + x1 @ self.w1 + self.b, 0).reshape(n * m, HALF, FILTERS)
        where = a.argmax(axis=1)
        top = np.take_along_axis(a, where[:, None], axis=1)[:, 0].reshape(n, m, FILTERS)
        mean = a.mean(axis=1).reshape(n, m, FILTERS)
        left = top[:, :-1] >= top[:, 1:]
        z = np.concatenate([np.maximum(top[:, :-1], top[:, 1:]), (mean[:, :-1] + mean[:, 1:]) / 2], axis=2)
        h = np.maximum(z @ self.v + self.c, 0)
        best = h.argmax(axis=1)
        pooled = np.take_along_axis(h, best[:, None], axis=1)[:, 0]
        p = 1 / (1 + np.exp(-np.clip(pooled @ self.u + self.d[0], -30, 30)))
        g = ((p - y) * weight).astype(np.float32)
        out = {"u": pooled.T @ g, "d": np.array([g.sum()], np.float32)}
        dh = np.zeros_like(h)
        np.put_along_axis(dh, best[:, None], (g[:, None] * self.u * (pooled > 0))[:, None], axis=1)
        out["v"] = z.reshape(-1, 2 * FILTERS).T @ dh.reshape(-1, HIDDEN)
        out["c"] = dh.sum(axis=(0, 1))
        dz = dh @ self.v.T
        dtop, dmean = np.zeros_like(top), np.zeros_like(mean)
        dtop[:, :-1] += dz[..., :FILTERS] * left
        dtop[:, 1:] += dz[..., :FILTERS] * ~left
        dmean[:, :-1] += dz[..., FILTERS:] / 2
        dmean[:, 1:] += dz[..., FILTERS:] / 2
        da = np.repeat((dmean / HALF).reshape(n * m, 1, FILTERS), HALF, axis=1)
        np.put_along_axis(da, where[:, None], np.take_along_axis(da, where[:, None], axis=1) + dtop.reshape(n * m, 1, FILTERS), axis=1)
        da = (da * (a > 0)).reshape(-1, FILTERS)
        out["w0"], out["w1"], out["b"] = x0.T @ da, x1.T @ da, da.sum(axis=0)
        dx = np.zeros_like(x)
        dx[:, :-1] += (da @ self.w0.T).reshape(n, -1, STEP * EMBED)
        dx[:, 1:] += (da @ self.w1.T).reshape(n, -1, STEP * EMBED)
        flat = dx[:, :-1].reshape(-1, EMBED)
        byte = data.reshape(-1)
        out["emb"] = np.stack([np.bincount(byte, weights=flat[:, k], minlength=256) for k in range(EMBED)], axis=1).astype(np.float32)
        out["emb"][0] = 0
        return out


def learn(texts: list[str], y: np.ndarray, epochs: int = 6, window: int = 2048, seed: int = 11) -> ByteNet | float:
    """A network from labelled texts; the share of label 1 if one is missing."""
    if not (y == 1).any() or not (y == 0).any():
        return float(y.mean()) if len(y) else 0.5
    rng = np.random.default_rng(seed)
    net = ByteNet(rng)
    raw = [t.encode("utf-8", "replace") for t in texts]
    rest = np.arange(len(raw))
    enough = min((y == 1).sum(), (y == 0).sum()) >= 40
    train = rest[rest % 4 != 3] if enough else rest
    weight = np.where(y == 1, 0.5 / (y[train] == 1).sum(), 0.5 / (y[train] == 0).sum()) * len(train)
    m = {k: 0.0 for k in net.NAMES}
    v = {k: 0.0 for k in net.NAMES}
    batch, t = 64, 0
    epochs = max(epochs, int(np.ceil(150 * batch / len(train))))
    for epoch in range(epochs):
        rate = 0.006 * (1 - 0.9 * epoch / epochs)
        for at in np.array_split(rng.permutation(train), max(1, len(train) // batch)):
            data = np.zeros((len(at), window), np.uint8)
            for k, i in enumerate(at):
                # a share of short windows, as short texts are few in the sample
                short = (int(rng.integers(4, 300)) if y[i] else int(rng.integers(64, 400))) if rng.random() < (0.3 if y[i] else 0.2) else window
                s = int(rng.integers(0, max(1, len(raw[i]) - short + 1)))
                piece = np.frombuffer(raw[i][s : s + short], np.uint8)
                data[k, : len(piece)] = piece
            size = STEP * HALF
            data = data[:, : max(2 * size, -(-int((data != 0).any(axis=0).nonzero()[0].max(initial=0) + 1) // size) * size)]
            t += 1
            for k, g in net.gradients(data, y[at], weight[at] / len(at)).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                setattr(net, k, (getattr(net, k) - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32))
            net.emb[0] = 0
    judge = rest[rest % 4 == 3] if enough else rest
    z = np.concatenate([net.logits([raw[i] for i in judge[a : a + 64]]) for a in range(0, len(judge), 64)]).astype(np.float64)
    scale = learning.logistic(z[:, None] / 10, y[judge].astype(float))
    net.scale = np.array([scale[0] / 10, scale[1]])
    return net


def fit_labelled(docs: DataFrame, labels: DataFrame, wanted, label: str = "quality", key: str = "doc_id", text: str = "text", rows: dict[int, int] | None = None, max_chars: int = LEARN_CHARS) -> ByteNet | float:
    """A network from a bounded sample of the labelled documents (``rows`` of
    each label at most, of ``max_chars`` characters at most)."""
    return learn(*learning.sample(docs, labels, label, wanted, rows or LEARN_ROWS, max_chars, key, text))


def score(docs: DataFrame, model: ByteNet | float, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and ``score``, the probability of label 1, of every
    whole text. The network sent to the executors has a fixed size."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[str]):
        own = sent.value
        if isinstance(own, float):
            return [(own,)] * len(texts)
        return [(float(p),) for p in own.probabilities(texts)]

    return score_partitions(docs, run, text, keep or [], "score double")
