"""Gradients, held-out accuracy and edge rows of the byte network."""

import zlib

import numpy as np

from lendgrade.llm import learning, quality, registry


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    net = quality.ByteNet(rng)
    for k in net.NAMES:
        setattr(net, k, getattr(net, k).astype(np.float64))
    data = rng.integers(1, 256, (5, 3 * quality.STEP * quality.HALF)).astype(np.uint8)
    y, weight = np.array([0, 1, 1, 0, 1]), np.array([0.4, 1.0, 0.7, 1.3, 0.2])

    def loss():
        z = []
        for row in data:
            top, mean = net.halves(row)
            x = np.concatenate([np.maximum(top[:-1], top[1:]), (mean[:-1] + mean[1:]) / 2], axis=1)
            z.append(np.maximum(x @ net.v + net.c, 0).max(axis=0) @ net.u + net.d[0])
        z = np.array(z)
        return float((weight * (np.logaddexp(0, z) - y * z)).sum())

    grads = net.gradients(data, y, weight)
    for k in ("u", "d", "v", "c", "w0", "b", "emb"):
        p = getattr(net, k)
        at = tuple(int(i) for i in np.unravel_index(np.abs(grads[k]).argmax(), p.shape))
        old, step = p[at], 1e-3
        p[at] = old + step
        high = loss()
        p[at] = old - step
        low = loss()
        p[at] = old
        assert abs((high - low) / (2 * step) - grads[k][at]) <= 0.05 * abs(grads[k][at]) + 1e-3, k


def plain_probability(net, text):
    """The forward pass window by window, written out."""
    data = text.encode("utf-8", "replace")
    size = quality.STEP * quality.HALF
    halves = max(1, -(-(len(data) + quality.STEP) // size))
    data = data.ljust(halves * size, b"\0")
    tops, means = [], []
    for i in range(halves):
        acts = []
        for k in range(quality.HALF):
            at = i * size + k * quality.STEP
            act = net.b.astype(float).copy()
            for w, begin in ((net.w0, at), (net.w1, at + quality.STEP)):
                for place, byte in enumerate(data[begin : begin + quality.STEP]):
                    act += net.emb[byte].astype(float) @ w[place * quality.EMBED : (place + 1) * quality.EMBED]
            acts.append(np.maximum(act, 0))
        tops.append(np.max(acts, axis=0))
        means.append(np.mean(acts, axis=0))
    hidden = []
    for i in range(halves):  # half chunks overlap pairwise; the last stands alone
        j = min(i + 1, halves - 1)
        x = np.concatenate([np.maximum(tops[i], tops[j]), (means[i] + means[j]) / 2])
        hidden.append(np.maximum(x @ net.v + net.c, 0))
    z = np.max(hidden, axis=0) @ net.u + net.d[0]
    return 1 / (1 + np.exp(-(z * net.scale[0] + net.scale[1])))


def test_forward_pass_against_plain_loops():
    net = quality.ByteNet(np.random.default_rng(11))
    net.scale = np.array([1.7, -0.3])
    size = quality.STEP * quality.HALF
    rng = np.random.default_rng(12)
    letters = np.array(list("abcdefgh ÄÖé漢\n!0"))
    texts = ["", "a", *["".join(rng.choice(letters[:9], n)) for n in (size - quality.STEP, size - quality.STEP + 1, size, size + 1, 3 * size + 5)], "".join(rng.choice(letters, 400))]
    got = net.probabilities(texts)
    for text, p in zip(texts, got):
        assert abs(p - plain_probability(net, text)) < 1e-5, len(text)


def test_whole_texts_count():
    net = quality.ByteNet(np.random.default_rng(0))
    text = "plain words " * 2000
    alone = net.probabilities([text])[0]
    assert net.probabilities([text + "\x07\x08!!###" * 40])[0] != alone  # the end is read
    assert abs(net.probabilities(["", text, "x"])[1] - alone) < 1e-6  # whatever stands beside it


def test_held_out_accuracy(spark, sf_small):
    sf = sf_small.replace("sf0.001", "sf0.1")
    docs = {r.doc_id: r.text for r in registry.table(spark, sf, "documents").select("doc_id", "text").collect()}
    labels = [(r.doc_id, r.quality) for r in registry.table(spark, sf, "labels").where("quality is not null").collect()]
    held = lambda k: zlib.crc32(str(k).encode()) % 3 == 1
    train = [(k, y) for k, y in labels if not held(k)]
    net = quality.learn([docs[k] for k, _ in train], np.array([y for _, y in train]))
    test = [(k, y) for k, y in labels if held(k)]
    p = np.concatenate([net.probabilities([docs[k] for k, _ in test[i : i + 50]]) for i in range(0, len(test), 50)])
    y = np.array([y for _, y in test], dtype=bool)
    assert (p >= 0.5)[y].mean() >= 0.98 and (p < 0.5)[~y].mean() >= 0.9


def test_query_and_edge_rows(spark, sf_small, odd_docs, no_docs, own_labels):
    rows = registry.op1_quality_classifier(spark, sf_small).collect()
    assert len(rows) == 200
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    wanted = learning.fold(own_labels.doc_id, 3) != 9
    share = quality.fit_labelled(odd_docs, own_labels, wanted)  # id 3 has both labels, id 1 alone is left
    assert share == 1.0 and {r.score for r in quality.score(odd_docs, share, keep=["doc_id"]).collect()} == {1.0}
    assert quality.fit_labelled(no_docs, own_labels, wanted) == 0.5
    net = quality.ByteNet(np.random.default_rng(0))
    got = quality.score(odd_docs, net, keep=["doc_id"]).collect()
    assert len(got) == 9 and all(0 <= r.score <= 1 for r in got)
    assert quality.score(no_docs, net, keep=["doc_id"]).collect() == []
