"""Toxic spans by a linear-chain conditional random field.

Tokens (words) are tagged toxic or clean. The features of a token are its
lower-case word, its prefixes and its last letters; neighbouring tags are tied
by transition weights. Forward-backward marginals give every token's
probability; runs of probable tokens are the offending offsets, and the
marginals of a text are aggregated to one score.

Only documents carry labels, so the token labels to learn from are derived
first: cues, words or prefixes that few clean documents hold and that together
cover the toxic ones, mark the tokens of toxic documents; all tokens of clean
documents are clean. Copies of a document count once among the cues' carriers.
The tokens learned from are those near a cue, at ``hits`` places of a document
at most, evenly over all of its cues, and ``anywhere`` words in a row drawn
from it; the tokens of a score are all of a text.

For two tags the forward and backward recursions are fractional-linear maps
of the odds, which contract. They are iterated for all tokens of a step at
once until no odds move by more than 1e-9, at most once per token of the
longest text, which is the exact recursion.

Results at the edges: a null, empty or wordless text scores what the model
gives a text without toxic tokens. Without toxic or without clean examples all
scores are 0. Repeated rows get equal scores. An empty table gives an empty
result. Labels, language, source and id are never inputs of a score; only the
id and the text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame

from lendgrade.llm import learning
from lendgrade.llm.common import score_partitions

WORD = re.compile(r"\w+")
#: Bounds of the learning sample: documents by label, characters of one.
LEARN_ROWS, LEARN_CHARS = {1: 1500, 0: 3000}, 60_000
#: Bounds of what is learned of one: windows around cues, words of the window
#: drawn anywhere in it.
LEARN_HITS, LEARN_WORDS = 200, 64
#: Words kept by a worker with their emission odds.
CACHE_WORDS = 500_000
PREFIXES, SUFFIX = range(2, 9), 4


def features(word: str) -> list[str]:
    """Feature names of a token: word, prefixes, ending."""
    w = word.lower()
    out = [f"w{w}"]
    out += [f"p{w[:k]}" for k in PREFIXES if len(w) >= k]
    if len(w) > SUFFIX:
        out.append(f"s{w[-SUFFIX:]}")
    return out


def odds(emission: np.ndarray, first: np.ndarray, trans: tuple[float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Forward odds R and backward odds B of the toxic tag of every token of
    a run of chains; ``first`` marks where a chain begins.

    ``emission``: odds of the token alone; ``trans``: factors of clean-toxic,
    toxic-clean and toxic-toxic (clean-clean is 1).
    """
    up, down, stay = trans
    e = emission
    r = e.copy()
    last = np.append(first[1:], True)
    while True:
        prev = r[:-1]
        new = e.copy()
        new[1:] *= np.where(first[1:], 1.0, (stay * prev + up) / (down * prev + 1.0))
        moved = np.abs(new - r).max(initial=0) / (1 + r.max(initial=0)) if len(r) else 0
        still = np.all(np.abs(new - r) <= 1e-9 * np.maximum(r, 1e-12))
        r = new
        if still or moved == 0:
            break
    b = np.ones_like(e)
    while True:
        x = (e * b)[1:]
        new = np.ones_like(e)
        new[:-1] = np.where(last[:-1], 1.0, (stay * x + down) / (up * x + 1.0))
        still = np.all(np.abs(new - b) <= 1e-9 * np.maximum(b, 1e-12))
        b = new
        if still:
            break
    return r, b


class Crf:
    """Weights of the field, and of the score of a text."""

    def __init__(self, weights: dict[str, float], bias: float, trans: tuple[float, float, float], score: np.ndarray):
        self.weights, self.bias, self.trans, self.score = weights, bias, trans, score

    def emission(self, word: str) -> float:
        get = self.weights.get
        return float(np.exp(np.clip(self.bias + sum(get(f, 0.0) for f in features(word)), -30, 30)))


class _Known(dict):
    """Emission odds by word, computed when first met; bounded."""

    def __init__(self, model: Crf):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self.model.emission(word)
        if len(word) <= 48:
            self[word] = value
        return value


def marginals(model: Crf, texts: list[str], known: _Known) -> tuple[np.ndarray, np.ndarray]:
    """Probability of the toxic tag for every word of the texts, and where
    each text's words begin."""
    words = [WORD.findall(t) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    e = np.concatenate([np.fromiter(map(known.__getitem__, w), dtype=np.float64, count=len(w)) for w in words]) if words else np.zeros(0)
    first = np.zeros(len(e), dtype=bool)
    first[starts[:-1][starts[:-1] < len(e)]] = True
    r, b = odds(e, first, model.trans)
    x = r * b
    return x / (1 + x), starts


def aggregate(p: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per text: the greatest marginal's log-odds and the log of their sum."""
    n = len(starts) - 1
    top, total = np.full(n, 1e-9), np.zeros(n)
    full = np.flatnonzero(np.diff(starts))
    if len(full):
        at = starts[:-1][full]
        top[full] = np.clip(np.maximum.reduceat(p, at), 1e-9, 1 - 1e-9)
        total[full] = np.add.reduceat(p, at)
    return np.column_stack([np.log(top / (1 - top)) / 10, np.log(total + 1e-3)])


def learn(texts: list[str], y: np.ndarray, seed: int = 7, hits: int = LEARN_HITS, anywhere: int = LEARN_WORDS) -> Crf | None:
    """A model from whole texts and their labels; None without both labels."""
    if not (y == 1).any() or not (y == 0).any():
        return None
    same: dict[str, str] = {}  # one object for all occurrences of a word
    words = [[same.setdefault(w, w) for w in WORD.findall(t)] for t in texts]
    del same
    cues = _cues(words, y)
    index: dict[str, int] = {}
    kinds: dict[str, int] = {}  # distinct words
    flat, owner = [], []  # features of the distinct words
    cue_kind: list[bool] = []

    def kind(w: str) -> int:
        k = kinds.get(w)
        if k is None:
            k = kinds[w] = len(kinds)
            own = features(w)
            cue_kind.append(any(f in cues for f in own))
            for f in own:
                flat.append(index.setdefault(f, len(index)))
                owner.append(k)
        return k

    # windows around what looks like a cue, and one anywhere in each text
    rng = np.random.default_rng(seed)
    rest = np.arange(len(texts))
    train = rest[rest % 10 < 6] if min((y == 1).sum(), (y == 0).sum()) >= 40 else rest
    tokens, tags, first = [], [], []
    is_cue: dict[str, bool] = {}
    for i in train:
        w = words[i]
        hit = []
        for t, x in enumerate(w):
            c = is_cue.get(x)
            if c is None:
                c = is_cue[x] = any(f in cues for f in features(x))
            if c:
                hit.append(t)
        some = hit if len(hit) <= hits else [hit[k] for k in np.linspace(0, len(hit) - 1, hits).astype(int)]
        spans = [(max(0, t - 8), min(len(w), t + 9)) for t in some]
        if w:
            t = int(rng.integers(0, max(1, len(w) - anywhere)))
            spans.append((t, min(len(w), t + anywhere)))
        end = -1
        for a, b in sorted(spans):
            a = max(a, end)
            for t in range(a, b):
                k = kind(w[t])
                tokens.append(k)
                tags.append(int(y[i] == 1 and cue_kind[k]))
                first.append(t == a and a != end)
            end = max(end, b)
    model = _fit(np.array(tokens), np.array(tags, dtype=float), np.array(first, dtype=bool), np.array(flat), np.array(owner), list(index), len(kinds))
    # the score of a text, on texts whose tokens were not learnt where there are enough
    judge = rest[rest % 10 >= 6] if len(train) < len(texts) else rest
    known = _Known(model)
    feats = np.concatenate([aggregate(*marginals(model, [texts[i] for i in judge[a : a + 200]], known)) for a in range(0, len(judge), 200)])
    model.score = learning.logistic(feats, y[judge].astype(float))
    return model


def _cues(words: list[list[str]], y: np.ndarray) -> set[str]:
    """Features that mark toxic tokens: chosen one by one for the toxic texts
    they newly cover, among those rare in clean texts. Texts that share their
    least word-triple hash count as copies of one."""
    carriers: dict[str, set[int]] = {}
    clean: Counter[str] = Counter()
    seen: list[set[int]] = [set(), set()]  # signs met in clean and in toxic texts

    def own(w: list[str], label: int) -> set[str]:
        low = [x.lower() for x in w]
        sign = min((zlib.crc32(" ".join(t).encode()) for t in zip(low, low[1:], low[2:])), default=zlib.crc32(" ".join(low).encode()))
        if sign in seen[label]:
            return set()
        seen[label].add(sign)
        return {f for x in set(low) for f in features(x) if f[0] == "w" or len(f) > 3}

    for i in np.flatnonzero(y == 1):
        for f in own(words[i], 1):
            carriers.setdefault(f, set()).add(i)
    need = 3 if len(seen[1]) >= 30 else 2
    carriers = {f: c for f, c in carriers.items() if len(c) >= need}
    for i in np.flatnonzero(y == 0):  # of clean texts only what could be a cue
        clean.update(f for f in own(words[i], 0) if f in carriers)
    toxic, cleans = max(1, len(seen[1])), max(1, len(seen[0]))
    fit = {}
    for f, c in carriers.items():
        lift = ((len(c) + 0.1) / toxic) / ((clean[f] + 0.5) / cleans)
        if lift >= 6:
            fit[f] = c
    chosen: set[str] = set()
    covered: set[int] = set()
    import heapq

    heap = [(-(len(c) - 2.0 * clean[f] * toxic / cleans), f[0] == "w", len(f), f) for f, c in fit.items()]
    heapq.heapify(heap)
    while heap:
        gain, *_, f = heapq.heappop(heap)
        now = -(len(fit[f] - covered) - 2.0 * clean[f] * toxic / cleans)
        if now > -need + 0.5:
            continue
        if heap and now > heap[0][0]:
            heapq.heappush(heap, (now, f[0] == "w", len(f), f))
            continue
        chosen.add(f)
        covered |= fit[f]
    # rare clean use of the same strength: all features as clear as the chosen
    return chosen | {f for f, c in fit.items() if len(c) >= max(need, 0.02 * toxic) and clean[f] == 0}


def _fit(tokens, tags, first, flat, owner, names, kinds, rounds: int = 150, penalty: float = 2e-3) -> Crf:
    """Weights of greatest penalised likelihood, by Adam on the exact gradient
    (expected minus observed counts)."""
    n = len(names)
    theta = np.zeros(n + 4)  # features, bias, log factors of the transitions
    theta[n] = -3.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    link = ~first[1:] if len(first) else first
    y0, y1 = tags[:-1], tags[1:]
    seen = np.array([((1 - y0) * y1)[link].sum(), (y0 * (1 - y1))[link].sum(), (y0 * y1)[link].sum()])
    scale = 1.0 / max(1.0, tags.sum())
    for k in range(1, rounds + 1):
        logit = np.bincount(owner, weights=theta[flat], minlength=kinds) + theta[n]
        e = np.exp(np.clip(logit, -30, 30))[tokens]
        up, down, stay = np.exp(np.clip(theta[n + 1 :], -8, 8))
        r, b = odds(e, first, (up, down, stay))
        x = r * b
        miss = x / (1 + x) - tags
        by_kind = np.bincount(tokens, weights=miss, minlength=kinds)
        grad = np.empty_like(theta)
        grad[:n] = np.bincount(flat, weights=by_kind[owner], minlength=n)
        grad[n] = miss.sum()
        eb = (e * b)[1:]
        pairs = np.stack([np.ones_like(eb), up * eb, down * r[:-1], stay * r[:-1] * eb])
        share = pairs / pairs.sum(axis=0)
        grad[n + 1 :] = share[1:][:, link].sum(axis=1) - seen
        grad = grad * scale + penalty * np.append(theta[:n], np.zeros(4)) + 1e-3 * np.append(np.zeros(n + 1), theta[n + 1 :])
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        theta -= 0.15 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    weights = {f: float(w) for f, w in zip(names, theta[:n]) if abs(w) > 1e-2}
    return Crf(weights, float(theta[n]), tuple(float(t) for t in np.exp(np.clip(theta[n + 1 :], -8, 8))), np.zeros(3))


_KNOWN: dict[int, tuple[Crf, _Known]] = {}


def tag_texts(model: Crf, texts: list[str], known: _Known, spans: bool = True) -> list[tuple[float, list[tuple[int, int]]]]:
    """Score and offending character ranges of each text."""
    p, starts = marginals(model, texts, known)
    x = aggregate(p, starts)
    score = 1 / (1 + np.exp(-np.clip(np.column_stack([x, np.ones(len(x))]) @ model.score, -30, 30)))
    out = []
    for i, t in enumerate(texts):
        runs: list[tuple[int, int]] = []
        hit = np.flatnonzero(p[starts[i] : starts[i + 1]] >= 0.5) if spans else ()
        if len(hit):
            wanted, before = set(hit.tolist()), -2
            for k, w in enumerate(WORD.finditer(t)):
                if k in wanted:
                    if before == k - 1:
                        runs[-1] = (runs[-1][0], w.end())
                    else:
                        runs.append(w.span())
                    before = k
        out.append((float(score[i]), runs))
    return out


def fit_labelled(docs: DataFrame, labels: DataFrame, wanted, label: str = "toxic", key: str = "doc_id", text: str = "text", rows: dict[int, int] | None = None, max_chars: int = LEARN_CHARS, hits: int = LEARN_HITS, anywhere: int = LEARN_WORDS) -> Crf | None:
    """A model from a bounded sample of the labelled documents (``rows`` of
    each label at most, of ``max_chars`` characters at most); ``hits`` and
    ``anywhere`` bound what is learned of one document."""
    return learn(*learning.sample(docs, labels, label, wanted, rows or LEARN_ROWS, max_chars, key, text), hits=hits, anywhere=anywhere)


def score(docs: DataFrame, model: Crf | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, ``score`` and ``spans`` (start and stop characters of
    toxic runs) of every whole text. The model's size is bounded by that of
    its learning sample."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[str]):
        own = sent.value
        if own is None:
            return [(0.0, [])] * len(texts)
        if _KNOWN.get(0, (None,))[0] is not own:
            _KNOWN[0] = (own, _Known(own))
        return [(s, [{"start": a, "stop": b} for a, b in r]) for s, r in tag_texts(own, texts, _KNOWN[0][1])]

    return score_partitions(docs, run, text, keep or [], "score double, spans array<struct<start:int,stop:int>>")
