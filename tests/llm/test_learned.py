import numpy as np
import pytest
from pyspark.sql import functions as F

from wagerlens.llm import lang_id, quality_pu

SCHEMA = "doc_id long, text string, lang string, score double"


def test_gradients_equal_finite_differences():
    net = lang_id.ByteGru.fresh(["a", "b", "c"], hidden=4, width=3, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    codes, lengths = lang_id.side_by_side([b"hello", b"abc", "é".encode(), b"z"])
    target, weight = np.array([2, 0, 1, 1]), np.array([1.0, 2.0, 0.5, 1.0])
    _, g = net.gradients(codes, lengths, target, weight)
    r = np.random.default_rng(3)
    for k, v in net.p.items():
        for _ in range(6):
            at = tuple(r.integers(0, s) for s in v.shape)
            if k == "E":
                at = (at[0], ord("l"))
            keep, eps = v[at], 1e-5
            v[at] = keep + eps
            up = net.gradients(codes, lengths, target, weight)[0]
            v[at] = keep - eps
            down = net.gradients(codes, lengths, target, weight)[0]
            v[at] = keep
            assert abs((up - down) / (2 * eps) - g[k][at]) < 1e-6 * max(1, abs(g[k][at])), k


def plain_probabilities(net, raw, chunk, context):
    """The network byte by byte, with one state each way, from its definition."""

    def step(d, h, code):
        a = net.p[f"W{d}"].astype(float) @ net.p["E"][:, code] + net.p[f"b{d}"]
        q = net.p[f"U{d}"].astype(float) @ h
        k = len(h)
        z, r = (1 / (1 + np.exp(-(a[j : j + k] + q[j : j + k]))) for j in (0, k))
        new = np.tanh(a[2 * k :] + r * q[2 * k :])
        return (1 - z) * new + z * h

    parts, total = -(-len(raw) // chunk), 0
    for j in range(parts):
        lo, hi = len(raw) * j // parts, len(raw) * (j + 1) // parts
        forth, back = {}, {}
        h = np.zeros(net.hidden)
        for i in range(max(0, lo - context), hi):
            forth[i] = h = step("f", h, raw[i])
        h = np.zeros(net.hidden)
        for i in range(min(len(raw), hi + context) - 1, lo - 1, -1):
            back[i] = h = step("b", h, raw[i])
        for i in range(lo, hi):
            e = np.exp(net.p["Wo"] @ np.concatenate([forth[i], back[i]]) + net.p["bo"])
            total = total + e / e.sum()
    return total / len(raw)


def test_stretches_equal_the_plain_network():
    net = lang_id.ByteGru.fresh(["a", "b", "c"], hidden=5, width=3, seed=4)
    texts = [b"", b"x", "Grün ist die Heide, und der Tag war lang.".encode(), b"the cat " * 30, b"one two three four five six seven"]
    got = net.text_probabilities(texts, chunk=21, context=6, side=4)
    assert not got[0].any()
    for raw, row in zip(texts[1:], got[1:], strict=True):
        assert np.allclose(row, plain_probabilities(net, raw, 21, 6), atol=1e-5)


def test_labels_of_positions_depend_on_the_words_around():
    net = lang_id.ByteGru.fresh(["a", "b"], hidden=6, width=4, seed=2)
    first, second = (net.position_probabilities(*lang_id.side_by_side([raw])) for raw in (b"green house far", b"house green far"))
    assert np.abs(first[:5] - second[6:11]).max() > 1e-4  # the word green


EN = "the and of to in that is was for with as his on be at by this had not are but from"
DE = "der die und das nicht von sie ist des sich mit dem dass er es ein ich auf so eine"


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for i in range(160):
        words = (EN if i % 2 else DE).split()
        rows.append((i, " ".join(words[(i * j + j * j) % len(words)] for j in range(6, 40)), "en" if i % 2 else "de", 0.5))
    rows += [(900, None, "en", None), (901, "", None, 1.0), (902, "12 ... !!", "de", 0.1), (None, "the and of the", None, None), (903, "the " * 60_000, "de", 0.0), (1, rows[1][1], "en", 0.5)]
    return spark.createDataFrame(rows, SCHEMA)


def test_language_held_out(docs):
    held = F.col("doc_id") % 4 == 3
    net = lang_id.learn(docs, ~held)
    assert net.labels == ["de", "en"]
    out = lang_id.identify(docs.select("doc_id", "text"), net).collect()
    assert len(out) == 166
    got = {r.doc_id: r for r in out}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(160))
    assert [got[i].lang_pred for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "en", "en"]
    assert all(0 <= r.score <= 1 for r in out)
    for i in (7, 8):  # byte by byte
        raw = docs.filter(f"doc_id = {i}").first().text.encode()
        assert abs(got[i].score - plain_probabilities(net, raw, lang_id.CHUNK, lang_id.CONTEXT).max()) < 1e-5
    # columns of the same names are replaced, others kept
    assert lang_id.identify(docs, net).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert lang_id.identify(docs.limit(0), net).count() == 0
    # nothing to learn from
    again = lang_id.identify(docs.select("doc_id", "text", "lang"), None).filter("lang_pred = 'und'")
    assert again.count() == 166
    assert lang_id.learn(docs.limit(0), F.lit(True)) is None
    # texts are taken whole, up to the bound on bytes
    assert lang_id.learn(docs, F.lit(True), most_bytes=10, steps=1) is None


def test_quality_held_out(spark):
    r = np.random.default_rng(2)
    words = [f"w{i}" for i in range(400)]
    rows, marks = [], []
    for i in range(600):
        bad = i % 4 == 0
        body = " ".join(r.choice(words, 80))
        rows.append((i, ("### BUY NOW ### " * 30) if bad else body, "s", 1))
        if i % 3:
            marks.append((i, 0 if bad else 1, 0))
    rows += [(1000, None, None, None), (1001, "", "s", 1), (None, "w1 w2", "s", 1), (1002, "word " * 50_000, "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality string, score int")
    labels = spark.createDataFrame([*marks, (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    held = F.col("doc_id") % 5 == 0
    net = quality_pu.learn(docs.select("doc_id", "text"), labels, ~held, steps=400)
    out = {x.doc_id: x for x in quality_pu.score(docs.select("doc_id", "text"), net).collect()}
    assert len(out) == 604 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in out.values())
    right = [out[i].predicted == (i % 4 != 0) for i in range(600) if i % 5 == 0]
    assert np.mean(right) > 0.97
    assert out[1000].score == out[1001].score
    assert quality_pu.learn(docs, labels.limit(0), F.lit(True)) is None
    assert quality_pu.score(docs.select("doc_id", "text").limit(0), net).count() == 0


def test_risk_and_its_gradient():
    r = np.random.default_rng(8)
    xp, xu = r.standard_normal((40, 5)), r.standard_normal((60, 5)) + 0.4
    net = quality_pu.PuNet.fresh(xu, 3, r)

    def plain(prior):
        loss = {}
        for name, x in (("p", xp), ("u", xu)):
            loss[name, 1], loss[name, -1] = ([], [])
            for row in x:
                t = net.logits(row[None])[0]
                for sign in (1, -1):
                    loss[name, sign].append(np.log(1 + np.exp(-sign * t)))
        mean = {k: sum(v) / len(v) for k, v in loss.items()}
        return prior * mean["p", 1], mean["u", -1] - prior * mean["p", -1]

    for prior, below in ((0.3, False), (3.0, True)):  # a prior over 1 makes the estimate negative
        right, wrong, g = net.risk(xp, xu, prior)
        assert np.allclose((right, wrong), plain(prior)) and (wrong < 0) == below
        for k in ("W", "b", "w", "c"):
            at = tuple(r.integers(0, n) for n in net.p[k].shape)
            keep, eps, sides = net.p[k][at], 1e-5, []
            for step in (eps, -eps):
                net.p[k][at] = keep + step
                a, b = plain(prior)
                sides.append(-b if below else a + b)
            net.p[k][at] = keep
            assert abs((sides[0] - sides[1]) / (2 * eps) - g[k][at]) < 1e-6


def test_prior_from_positives_and_unlabelled():
    r = np.random.default_rng(4)
    for share in (0.2, 0.5, 0.85):
        positive = r.standard_normal((3000, 4)) + 2.5
        rest = r.standard_normal((4000, 4))
        unlabelled = np.where((r.random(4000) < share)[:, None], r.standard_normal((4000, 4)) + 2.5, rest)
        assert abs(quality_pu.estimated_prior(positive, unlabelled) - share) < 0.07


def test_clashing_columns_are_replaced(spark):
    rows = spark.createDataFrame([(1, "a b", "kept", "x", 7)], "doc_id long, text string, trusted string, Score string, predicted int")
    net = quality_pu.PuNet.fresh(np.ones((2, quality_pu.N_FEATURES)), 2, np.random.default_rng(1))
    for out in (quality_pu.score(rows, net), quality_pu.score(rows, None)):
        assert out.columns == ["doc_id", "text", "trusted", "score", "predicted"] and out.first().trusted == "kept"
