"""Quality rules by labelling the lines of a text as a sequence.

Every line that holds a word is tagged content or boilerplate by a
linear-chain conditional random field over features of its shape (words,
capitals, symbols, digits, odd words, repeats, cue words); Viterbi decoding
finds the best sequence of tags of the whole text. A text is kept if no plain
rule fails it and the words of its content lines are at least ``share`` of its
words.

The plain rules: fewer than ``LEAST_WORDS`` words, or more than half of the
words inside three-word windows that the text holds twice or more.

Only documents carry labels, so the tags to learn from are derived: lines of
low-quality documents are boilerplate, those of good ones content unless they
hold one of ``PHRASES``. Cue words are those that stand in boilerplate lines
far more often than in content lines. The field is fitted on a bounded sample
(``LEARN_ROWS``, ``LEARN_CHARS``, chains of ``CHAIN`` lines); tagging, counts and
verdicts cover all lines of whole texts.

Results at the edges: words are runs of other characters than space and
U+0009 to U+000D; a null, empty or wordless text has counts of 0, a content
share of 0 and fails the plain rules. Without labelled documents of both kinds
all lines are content, so the plain rules decide. A text of one very long line
is one line. Repeated rows get equal verdicts; an empty table gives an empty
result. Only the kept columns and the text are read, so columns of other names
do not clash.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from lendgrade.llm import learning
from lendgrade.llm.common import score_partitions

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, REPEATED = 50, 50
#: Bounds of the learning sample: documents by label, characters of one, lines
#: of one chain, cue words.
LEARN_ROWS, LEARN_CHARS, CHAIN, CUES = {1: 1500, 0: 1500}, 60_000, 64, 500
#: Phrases that mark boilerplate in good documents too.
PHRASES = ("all rights reserved", "click here", "cookie", "copyright", "licensed under", "log in", "privacy policy", "sign up", "subscribe", "terms of")

_SPACE, _UPPER, _DIGIT, _SYMBOL, _OTHER, _END = 1, 2, 4, 8, 16, 32

#: Edges of the bucketed features of a line, by name.
EDGES = {
    "words": (3, 6, 13, 41),
    "upper": (0.15, 0.5),
    "symbols": (1e-9, 0.02, 0.08),
    "digits": (1e-9, 0.1, 0.3),
    "odd": (1e-9, 0.1, 0.3, 0.6),
    "length": (2.5, 4, 8, 14),
    "repeated": (1e-9, 0.5),
    "cues": (1, 2),
    "ends": (1,),
    "seen": (1,),
}
SIZES = [len(e) + 1 for e in EDGES.values()]
OFFSETS = np.concatenate([[0], np.cumsum(SIZES)[:-1]])


@cache
def _kinds() -> np.ndarray:
    """Flags of every code point."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for c in range(0x110000):
        group = unicodedata.category(chr(c))
        if group == "Lu":
            table[c] = _UPPER
        elif group == "Nd":
            table[c] = _DIGIT
        elif group[0] in "PSCZ":
            table[c] = _OTHER
    table[[32, *range(9, 14)]] = _SPACE
    table[[ord(c) for c in SYMBOLS]] = _SYMBOL | _OTHER
    table[[ord(c) for c in ".,;:!?"]] = _END | _OTHER
    return table


class Lines:
    """The lines with a word of one text: where they are, their words and
    bucketed features, and the counts of the plain rules."""

    def __init__(self, text: str, cues: dict[str, int] | set[str] = frozenset()):
        words = WORD.findall(text)
        self.n_words = len(words)
        self.word_chars = sum(map(len, words))
        self.n_symbols = sum(map(text.count, SYMBOLS))
        self.spans = np.zeros((0, 2), dtype=np.int64)
        self.words = np.zeros(0, dtype=np.int64)
        self.buckets = np.zeros((0, len(EDGES)), dtype=np.int64)
        self.n_dup_lines = self.n_repeat_words = 0
        if not words:
            return
        index: dict[str, int] = {}
        ids = np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=len(words))
        covered = repeated_windows(ids, len(index))
        self.n_repeat_words = int(covered.sum())
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = _kinds()[code]
        blank = (kind & _SPACE) > 0
        begin = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))  # of words
        breaks = np.flatnonzero(code == 10)
        of_line = np.searchsorted(breaks, begin)  # the line of every word
        full, first = np.unique(of_line, return_index=True)
        start = np.concatenate([[0], breaks + 1])[full]
        stop = np.concatenate([breaks, [len(code)]])[full]
        self.spans = np.column_stack([start, stop])
        self.words = np.diff(np.append(first, len(words)))

        def per_line(flags: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(flags)])
            return total[stop] - total[start]

        # odd: anything but letters, digits and one closing mark at the end of a word
        closing = (kind & _END) > 0
        closing &= np.concatenate([blank[1:], [True]]) & ~np.concatenate([[True], (kind[:-1] & (_OTHER | _SPACE)) > 0])
        odd = ((kind & _OTHER) > 0) & ~closing
        odd_words = np.add.reduceat(odd, begin, dtype=np.int64) > 0 if len(begin) else odd
        letters = per_line((kind & ~np.uint8(_UPPER)) == 0)
        hits = np.array([w.strip(".,;:!?").lower() in cues for w in index])[ids] if cues else np.zeros(len(ids), dtype=bool)
        seen, dup = set(), np.zeros(len(full), dtype=np.int64)
        for k, (a, b) in enumerate(self.spans.tolist()):
            line = text[a:b]
            dup[k] = line in seen
            seen.add(line)
        self.n_dup_lines = int(dup.sum())
        chars = np.maximum(1, per_line(~blank))
        tail = np.array([kind[b - 1 - _trailing(blank, a, b)] & _END for a, b in self.spans.tolist()]) > 0
        values = {
            "words": self.words,
            "upper": per_line((kind & _UPPER) > 0) / np.maximum(1, letters),
            "symbols": per_line((kind & _SYMBOL) > 0) / chars,
            "digits": per_line((kind & _DIGIT) > 0) / chars,
            "odd": np.add.reduceat(odd_words, first, dtype=np.int64) / self.words,
            "length": chars / self.words,
            "repeated": np.add.reduceat(covered, first, dtype=np.int64) / self.words,
            "cues": np.add.reduceat(hits, first, dtype=np.int64),
            "ends": tail,
            "seen": dup,
        }
        self.buckets = np.column_stack([np.searchsorted(edges, values[name], side="right") for name, edges in EDGES.items()])

    def emission(self, weights: np.ndarray) -> np.ndarray:
        """What the lines add to the score of the boilerplate tag."""
        return weights[self.buckets + OFFSETS].sum(axis=1) + weights[-1]


def _trailing(blank: np.ndarray, a: int, b: int) -> int:
    """Blank characters at the end of the line [a, b), which holds a word."""
    n = 0
    while blank[b - 1 - n]:
        n += 1
    return n


def repeated_windows(ids: np.ndarray, kinds: int, width: int = 3) -> np.ndarray:
    """Which words lie in a window of ``width`` words found twice or more."""
    covered = np.zeros(len(ids), dtype=bool)
    n = len(ids) - width + 1
    if n < 2:
        return covered
    key, size = ids[:n], kinds
    for k in range(1, width):
        if size * kinds >= 2**62:  # number the keys anew, so that they stay within 64 bits
            key = np.unique(key, return_inverse=True)[1]
            size = int(key.max()) + 1
        key, size = key * kinds + ids[k : k + n], size * kinds
    _, of, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = counts[of] > 1
    for k in range(width):
        covered[k : k + n] |= twice
    return covered


class Field:
    """Weights of the buckets (the bias last), what a tag adds after another
    (content-content is 0), and the cue words."""

    def __init__(self, weights: np.ndarray, after: tuple[float, float, float], cues: set[str]):
        self.weights, self.after, self.cues = weights, after, cues


def viterbi(score: list[float], after: tuple[float, float, float]) -> list[bool]:
    """Which lines the best sequence tags boilerplate, ties to content.

    ``score`` is what each line adds for boilerplate; ``after`` what the steps
    content-boilerplate, boilerplate-content and boilerplate-boilerplate add.
    """
    if not score:
        return []
    enter, leave, stay = after
    lead = score[0]  # best sequence ending in boilerplate less best ending in content
    back: list[tuple[bool, bool]] = []  # tag before, if this one is content, boilerplate
    for s in score[1:]:
        from_content, from_boiler = lead + leave > 0.0, lead + stay > enter
        back.append((from_content, from_boiler))
        lead = s + (lead + stay if from_boiler else enter) - (lead + leave if from_content else 0.0)
    tag = lead > 0.0
    tags = [tag]
    for choice in reversed(back):
        tag = choice[tag]
        tags.append(tag)
    tags.reverse()
    return tags


def _marginals(s: np.ndarray, there: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of boilerplate of every line of padded chains, and expected
    numbers of the three kinds of steps, by the forward-backward recursions."""
    n, length = s.shape
    enter, leave, stay = after
    fore = np.zeros((length, n, 2))
    back = np.zeros((length, n, 2))
    fore[0, :, 1] = s[:, 0]
    for t in range(1, length):
        a0, a1 = fore[t - 1, :, 0], fore[t - 1, :, 1]
        fore[t, :, 0] = np.logaddexp(a0, a1 + leave)
        fore[t, :, 1] = np.logaddexp(a0 + enter, a1 + stay) + s[:, t]
    for t in range(length - 2, -1, -1):
        b0, b1 = back[t + 1, :, 0], back[t + 1, :, 1] + s[:, t + 1]
        on = there[:, t + 1]
        back[t, :, 0] = np.where(on, np.logaddexp(b0, b1 + enter), 0.0)
        back[t, :, 1] = np.where(on, np.logaddexp(b0 + leave, b1 + stay), 0.0)
    both = fore + back
    p = 1 / (1 + np.exp(np.clip(both[:, :, 0] - both[:, :, 1], -500, 500))).T
    whole = np.logaddexp(both[0, :, 0], both[0, :, 1])
    steps = []
    for x, y, w in ((0, 1, enter), (1, 0, leave), (1, 1, stay)):
        log = fore[:-1, :, x] + w + back[1:, :, y] + (s.T[1:] if y else 0.0) - whole
        steps.append(np.where(there.T[1:], np.exp(np.minimum(log, 0.0)), 0.0).sum())
    return p, np.array(steps)


def learn(texts: list[str], y: np.ndarray, rounds: int = 200, penalty: float = 1e-3, tie: float = 0.05) -> Field | None:
    """The field of greatest penalised likelihood, by Adam on the exact
    gradient; None without documents of both labels.

    ``tie`` is the penalty of the steps between tags. It is the larger one: the
    derived tags hardly change within a document, which would make a line
    follow its neighbours against its own shape.
    """
    if not (y == 1).any() or not (y == 0).any():
        return None
    marks = re.compile("|".join(map(re.escape, PHRASES)), re.IGNORECASE)
    count: tuple[Counter, Counter] = (Counter(), Counter())
    tagged = []
    for text, good in zip(texts, y.tolist()):
        tags = []
        for line in text.split("\n"):
            words = WORD.findall(line)
            if words:
                tags.append(not good or bool(marks.search(line)))
                count[tags[-1]].update({w.strip(".,;:!?").lower() for w in words})
        tagged.append(tags)
    lines = (max(1, sum(len(t) - sum(t) for t in tagged)), max(1, sum(map(sum, tagged))))
    lift = {w: (c / lines[1]) / ((count[0][w] + 0.5) / lines[0]) for w, c in count[1].items() if c >= 5 and w}
    cues = set(sorted((w for w in lift if lift[w] >= 8), key=lambda w: (-count[1][w], w))[:CUES])
    buckets, tags, lengths = [], [], []
    for text, own in zip(texts, tagged):
        found = Lines(text, cues).buckets
        for a in range(0, len(own), CHAIN):
            buckets.append(found[a : a + CHAIN])
            tags.append(own[a : a + CHAIN])
            lengths.append(len(tags[-1]))
    n = len(lengths)
    there = np.arange(max(lengths))[None, :] < np.array(lengths)[:, None]
    at = np.concatenate(buckets) + OFFSETS
    truth = np.concatenate(tags).astype(float)
    padded = np.zeros(there.shape)
    padded[there] = truth
    linked = there[:, 1:]
    old, new = padded[:, :-1], padded[:, 1:]
    seen = np.array([((1 - old) * new)[linked].sum(), (old * (1 - new))[linked].sum(), (old * new)[linked].sum()])
    width = int(sum(SIZES)) + 1
    theta = np.zeros(width + 3)
    ridge = np.append(np.full(width, penalty), np.full(3, tie))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    s = np.zeros((n, there.shape[1]))
    for k in range(1, rounds + 1):
        s[there] = theta[at].sum(axis=1) + theta[width - 1]
        p, steps = _marginals(s, there, theta[width:])
        miss = p[there] - truth
        grad = np.zeros_like(theta)
        grad[: width - 1] = np.bincount(at.ravel(), weights=np.repeat(miss, at.shape[1]), minlength=width - 1)
        grad[width - 1] = miss.sum()
        grad[width:] = steps - seen
        grad = grad / len(truth) + ridge * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        theta -= 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return Field(theta[:width], tuple(theta[width:].tolist()), cues)


def fit_labelled(docs: DataFrame, labels: DataFrame, wanted, label: str = "quality", key: str = "doc_id", text: str = "text", rows: dict[int, int] | None = None, max_chars: int = LEARN_CHARS) -> Field | None:
    """A field from a bounded sample of the labelled documents."""
    return learn(*learning.sample(docs, labels, label, wanted, rows or LEARN_ROWS, max_chars, key, text))


def label_lines(model: Field | None, text: str) -> tuple[Lines, np.ndarray]:
    """The lines of a text and which of them are boilerplate."""
    lines = Lines(text, model.cues if model else frozenset())
    if model is None:
        return lines, np.zeros(len(lines.words), dtype=bool)
    return lines, np.array(viterbi(lines.emission(model.weights).tolist(), model.after), dtype=bool)


def judge(docs: DataFrame, model: Field | None, share: float = 0.5, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, the counts of the plain rules, ``base_failed``, the
    words in content lines, ``kept`` and the character ranges of runs of
    content lines, for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[str]):
        for t in texts:
            lines, boiler = label_lines(sent.value, t)
            failed = lines.n_words < LEAST_WORDS or 100 * lines.n_repeat_words > REPEATED * lines.n_words
            content = int(lines.words[~boiler].sum())
            kept = not failed and content >= share * lines.n_words
            yield lines.n_words, lines.word_chars, lines.n_symbols, lines.n_dup_lines, lines.n_repeat_words, failed, content, kept, runs(lines.spans, boiler)

    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return score_partitions(docs, run, text, keep or [], f"{counts}, base_failed boolean, content_words long, kept boolean, content array<struct<start:int,stop:int>>")


def runs(spans: np.ndarray, boiler: np.ndarray) -> list[dict[str, int]]:
    """Ranges of neighbouring content lines."""
    keep = ~boiler
    begin = np.flatnonzero(keep & ~np.concatenate([[False], keep[:-1]])) if len(keep) else []
    end = np.flatnonzero(keep & ~np.concatenate([keep[1:], [False]])) if len(keep) else []
    return [{"start": int(spans[a, 0]), "stop": int(spans[b, 1])} for a, b in zip(begin, end)]
