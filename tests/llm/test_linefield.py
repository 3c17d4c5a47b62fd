"""Line labelling against enumeration and plain counts."""

import itertools
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendgrade.llm import linefield, registry

TEXTS = [
    None,
    "",
    " \n\t\n",
    "one",
    "a b c a b c",
    "x y\nx y\n\nx y \nz",
    "§ 12 $5 | a|b <tag> & more.\r\nÄ É ß ü w.",
    "the same line again\nthe same line again\nOTHER!! LINE!!\nthe same line again",
    " ".join(f"w{i}" for i in range(60)) + ".",
    " ".join(["loop around here"] * 40),
]


def plain(text):
    """The counts of the plain rules, written out."""
    text = text or ""
    words = re.findall(r"[^ \t\n\x0b\x0c\r]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines, dup = [], 0
    for line in text.split("\n"):
        if re.search(r"[^ \t\n\x0b\x0c\r]", line):
            dup += line in lines
            lines.append(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside)


def test_counts_of_the_plain_rules_and_edges(spark):
    rows = [(i, t, "extra", i) for i, t in enumerate(TEXTS)] + [(1, TEXTS[8], "extra", 0)]
    df = spark.createDataFrame(rows, "doc_id int, text string, n_words string, kept int")
    got = linefield.judge(df, None, keep=["doc_id"]).collect()
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted((i, *plain(t)) for i, t, *_ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)
    assert linefield.judge(df.limit(0), None, keep=["doc_id"]).count() == 0


def test_repeated_windows_of_many_kinds_of_words():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 4, 200)
    few = linefield.repeated_windows(ids, 4)
    # kinds so many that keys are numbered anew
    assert (linefield.repeated_windows(ids, 2**40) == few).all()


@pytest.mark.parametrize("seed", range(20))
def test_viterbi_and_marginals_are_those_of_all_sequences(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 8))
    s, after = rng.normal(0, 2, n), rng.normal(0, 1, 3)
    step = {(0, 0): 0.0, (0, 1): after[0], (1, 0): after[1], (1, 1): after[2]}
    value = {tags: sum(s[i] for i in range(n) if tags[i]) + sum(step[p] for p in zip(tags, tags[1:])) for tags in itertools.product((0, 1), repeat=n)}
    assert linefield.viterbi(s.tolist(), tuple(after.tolist())) == [bool(t) for t in max(value, key=value.get)]
    padded = np.zeros((2, 9))  # beside a longer chain
    padded[0, :n] = s
    there = np.arange(9)[None, :] < np.array([[n], [9]])
    p, _ = linefield._marginals(padded, there, after)
    weight = {k: np.exp(v) for k, v in value.items()}
    total = sum(weight.values())
    for i in range(n):
        assert np.isclose(p[0, i], sum(w for k, w in weight.items() if k[i]) / total)
    _, steps = linefield._marginals(padded[:1], there[:1], after)
    want = [sum(w * sum(q == kind for q in zip(k, k[1:])) for k, w in weight.items()) / total for kind in ((0, 1), (1, 0), (1, 1))]
    assert np.allclose(steps, want)


def test_ties_go_to_content():
    assert linefield.viterbi([0.0, 0.0], (0.0, 0.0, 0.0)) == [False, False]


def test_boilerplate_lines_inside_a_text_are_cut_out():
    good = [f"The {a} of the {b} was seen near the old {a} yesterday.\nIt {b} and then went home by the {a}." for a in ("river", "house", "garden") for b in ("runs", "sings", "falls")]
    bad = [f"{a}!! {b}!! {a}!! BUY!! NOW!!\nBEST!! {b}!! OFFER!!" for a in ("DEAL", "CASH", "WIN") for b in ("HERE", "TODAY", "FAST")]
    model = linefield.learn(good + bad, np.array([1] * 9 + [0] * 9))
    text = good[0] + "\nBEST!! DEAL!! NOW!!\n" + good[4]
    lines, boiler = linefield.label_lines(model, text)
    assert boiler.tolist() == [False, False, True, False, False]
    assert [text[r["start"] : r["stop"]] for r in linefield.runs(lines.spans, boiler)] == [good[0], good[4]]
    assert linefield.learn(good, np.ones(9)) is None


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = registry.op12_quality_rules(spark, sf).join(registry.table(spark, sf, "labels"), "doc_id").where("pmod(crc32(cast(cast(doc_id as string) as binary)), 3) = 1 and not base_failed")
    share = {r.quality: r.share for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] >= 0.98 and share[0] <= 0.1
