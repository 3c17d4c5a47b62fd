"""The field's recursions, held-out accuracy, spans and edge rows."""

import zlib

import numpy as np

from lendgrade.llm import learning, registry, toxicity


def test_marginals_match_the_plain_recursion():
    rng = np.random.default_rng(1)
    up, down, stay = 0.3, 0.8, 2.5
    lengths = [1, 2, 7, 40, 1]
    e = np.exp(rng.normal(-1, 2, sum(lengths)))
    first = np.zeros(len(e), dtype=bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    r, b = toxicity.odds(e, first, (up, down, stay))
    got, at = r * b / (1 + r * b), 0
    t = np.array([[1.0, up], [down, stay]])
    for n in lengths:
        f = np.stack([np.ones(n), e[at : at + n]], axis=1)
        alpha, beta = [f[0]], [np.ones(2)]
        for k in range(1, n):
            alpha.append((alpha[-1] @ t) * f[k])
        for k in range(n - 1, 0, -1):
            beta.append(t @ (f[k] * beta[-1]))
        post = np.array(alpha) * np.array(beta[::-1])
        assert np.allclose(got[at : at + n], post[:, 1] / post.sum(axis=1), atol=1e-7)
        at += n


def test_late_passages_are_learned_from():
    clean = [f"word{i} of some plain text number {i * 7} and more of it" for i in range(60)]
    toxic = [f"word{i} of an idiot text number {i * 5} you clown and more" for i in range(40)]
    long = " ".join(["plain " * 20 + "idiot"] * 400) + " zebra"
    model = toxicity.learn([long, *toxic, *clean], np.array([1] * 41 + [0] * 60))
    assert "wzebra" in model.weights


def test_learning_spans_and_cases():
    clean = [f"word{i} of some plain text number {i * 7} and more of it" for i in range(60)]
    toxic = [f"word{i} of an idiot text number {i * 5} you clown and more" for i in range(40)]
    model = toxicity.learn(toxic + clean, np.array([1] * 40 + [0] * 60))
    text = "What an Idiot, CLOWN he was; of some plain text"
    (score, spans), (other, none), (empty, _) = toxicity.tag_texts(model, [text, clean[3], ""], toxicity._Known(model))
    assert score > 0.5 > other and none == [] and empty < 0.3
    assert any("Idiot" in text[a:b] for a, b in spans)
    assert toxicity.learn(clean, np.zeros(60, dtype=int)) is None


def test_held_out_accuracy(spark, sf_small):
    sf = sf_small.replace("sf0.001", "sf0.1")
    docs = {r.doc_id: r.text for r in registry.table(spark, sf, "documents").select("doc_id", "text").collect()}
    labels = [(r.doc_id, r.toxic) for r in registry.table(spark, sf, "labels").where("toxic is not null").collect()]
    held = lambda k: zlib.crc32(str(k).encode()) % 4 == 2
    train = [(k, y) for k, y in labels if not held(k)]
    model = toxicity.learn([docs[k] for k, _ in train], np.array([y for _, y in train]))
    test = [(k, y) for k, y in labels if held(k)]
    scores = [s for s, _ in toxicity.tag_texts(model, [docs[k] for k, _ in test], toxicity._Known(model), spans=False)]
    hit = np.array(scores) >= registry.TOXIC_FROM
    y = np.array([y for _, y in test], dtype=bool)
    assert hit[y].mean() >= 0.85 and hit[~y].mean() <= 0.04


def test_query_and_edge_rows(spark, sf_small, odd_docs, no_docs, own_labels):
    got = registry.op10_toxicity_crf(spark, sf_small)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 200
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    model = toxicity.fit_labelled(odd_docs, own_labels, learning.fold(own_labels.doc_id, 4) != 9)
    scored = toxicity.score(odd_docs, model, keep=["doc_id"]).collect()
    assert model is None and [r.score for r in scored] == [0.0] * 9
    assert toxicity.score(no_docs, model, keep=["doc_id"]).collect() == []


def test_scores_and_spans_against_all_sequences():
    """Marginals, the aggregate and the offending ranges of short texts, from
    the weights of all tag sequences."""
    import itertools

    model = toxicity.Crf({"wbad": 5.0, "pwor": 2.0, "sords": 0.5}, -2.0, (0.4, 0.7, 3.0), np.array([1.2, 0.8, -0.1]))
    up, down, stay = model.trans
    for text in ("", "a clean one", "so bad words here", "Bad bad", "bad. fine words bad", "one two worse words, bad end"):
        words = list(toxicity.WORD.finditer(text))
        odds = [model.emission(w.group()) for w in words]
        p = np.zeros(len(words))
        total = 0.0
        for tags in itertools.product((0, 1), repeat=len(words)):
            weight = np.prod([o for o, t in zip(odds, tags) if t]) if words else 1.0
            for a, b in zip(tags, tags[1:]):
                weight *= {(0, 0): 1.0, (0, 1): up, (1, 0): down, (1, 1): stay}[a, b]
            total += weight
            p += weight * np.array(tags)
        p /= total
        top = min(max(max(p, default=0.0), 1e-9), 1 - 1e-9)
        z = model.score[0] * np.log(top / (1 - top)) / 10 + model.score[1] * np.log(p.sum() + 1e-3) + model.score[2]
        spans = []
        for i, w in enumerate(words):
            if p[i] >= 0.5:
                spans = [*spans[:-1], (spans[-1][0], w.end())] if i and p[i - 1] >= 0.5 else [*spans, w.span()]
        ((score, runs),) = toxicity.tag_texts(model, [text], toxicity._Known(model))
        assert abs(score - 1 / (1 + np.exp(-z))) < 1e-6 and runs == spans, text
