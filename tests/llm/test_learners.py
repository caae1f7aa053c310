"""The learners of language ID and toxicity against slow versions: every split tried, exact SVM optima, predictions by hand."""

import math
from itertools import combinations

import numpy as np
import pytest

from lakesmith.llm import language, toxicity

RIDGE, LEAST, RATE = 1.0, 4.0, 0.15


def grown(rows, x, g, h, depth):
    """A tree as nested (feature, cut, left, right) or a leaf value: each node tries every value of every feature."""
    gs, hs = sum(g[i] for i in rows), sum(h[i] for i in rows)
    value = -RATE * gs / (hs + RIDGE)
    if depth == 0 or not rows:
        return value
    best, chosen = 1e-6, None
    for f in range(x.shape[1]):
        for cut in sorted({x[i, f] for i in rows})[:-1]:
            left = [i for i in rows if x[i, f] <= cut]
            gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
            if hl < LEAST or hs - hl < LEAST:
                continue
            gain = gl**2 / (hl + RIDGE) + (gs - gl) ** 2 / (hs - hl + RIDGE) - gs**2 / (hs + RIDGE)
            if gain > best:
                best, chosen = gain, (f, cut, left)
    if chosen is None:
        return value
    f, cut, left = chosen
    right = [i for i in rows if x[i, f] > cut]
    return f, cut, grown(left, x, g, h, depth - 1), grown(right, x, g, h, depth - 1)


def dropped(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("rounds", [1, 4])
def test_trees_equal_exhaustive_splits(rounds):
    rng = np.random.default_rng(rounds)
    x = np.stack([rng.integers(0, 9, 400), rng.integers(0, 5, 400), rng.integers(0, 12, 400), np.full(400, 3)], 1).astype(float)
    y = (x[:, 0] + 2 * x[:, 1] * (x[:, 2] > 4) + rng.normal(0, 2, 400) > 8).astype(float)
    margin = np.full(400, math.log((y.sum() + 0.5) / (400 - y.sum() + 0.5)))
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        trees.append(grown(list(range(400)), x, (p - y).tolist(), (p * (1 - p)).tolist(), 3))
        margin = margin + np.array([dropped(trees[-1], row) for row in x])
    model = toxicity.Trees.fit(x, y, rounds=rounds, rate=RATE, least=LEAST, ridge=RIDGE)
    assert np.allclose(model.margin(x), margin, atol=1e-9) and len(set(np.round(margin, 6))) > 4


def test_isotonic_equals_the_min_max_formula():
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 40, 200).astype(float), rng.integers(0, 2, 200).astype(float)
    at, p = toxicity.isotonic(x, y)
    for v in sorted(set(x)):
        mean = lambda lo, hi: y[(x >= lo) & (x <= hi)].mean()
        expect = max(min(mean(lo, hi) for hi in set(x) if hi >= v) for lo in set(x) if lo <= v)
        assert abs(np.interp(v, at, p) - expect) < 1e-9


def exact_svm(x, y, c=20.0):
    """The optimum by Newton's steps: the loss is quadratic wherever the same rows are inside the margin."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    w = np.zeros(x.shape[1])

    def loss(w):
        return 0.5 * w @ w + c * (weight * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()

    for _ in range(200):
        inside = y * (x @ w) < 1
        xa, wa = x[inside], weight[inside]
        goal = np.linalg.solve(np.eye(len(w)) + 2 * c * xa.T @ (xa * wa[:, None]), 2 * c * xa.T @ (wa * y[inside]))
        step = 1.0
        while step > 1e-9 and loss(w + step * (goal - w)) > loss(w):
            step /= 2
        if np.abs(goal - w).max() < 1e-10:
            break
        w = w + step * (goal - w)
    return w, loss


def test_svm_reaches_the_optimum():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(120, 15))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 0.2, 120) > 0.1, 1, -1)
    best, loss = exact_svm(x, y)
    got = language.fit_svm(x.astype(np.float32), y).astype(float)
    assert loss(got) <= 1.001 * loss(best) and np.abs(got - best).max() < 0.02 * np.abs(best).max()


def slow_features(text):
    """Square roots of the counts of hashed trigrams, of length one; what is no a-z of ASCII is a space."""
    codes = [b if b >= 128 or chr(b) in "abcdefghijklmnopqrstuvwxyz" else 32 for b in b" " + text.lower().encode() + b"  "]
    counts: dict[int, int] = {}
    for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
        if (a, b, c) != (32, 32, 32):
            k = ((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 20
            counts[k] = counts.get(k, 0) + 1
    length = math.sqrt(sum(counts.values()))
    return {k: math.sqrt(n) / length for k, n in counts.items()}


def slow_language(model, text):
    x = slow_features(text)
    value = lambda w: float(w[-1]) + sum(v * float(w[k]) for k, v in x.items())
    margins = {f: value(w) for f, w in model.families.items()}
    family = max(margins, key=margins.get)
    own = model.languages[family]
    tally = {lang: [0, 0.0] for lang in own}
    for a, b in combinations(own, 2):
        m = value(model.pairs[a, b])
        tally[a if m > 0 else b][0] += 1
        tally[a][1] += m
        tally[b][1] -= m
    return max(own, key=lambda lang: tally[lang])


def test_language_decisions_equal_those_by_hand():
    rng = np.random.default_rng(12)
    stems = {"en": "the and with this from have", "de": "der und nicht sein auch über", "nl": "het een van niet zijn wordt", "fr": "les des pour dans être avec", "es": "los para como esta pero más", "ru": "что это как для они был", "xx": "zz qq ww"}
    rows = [(lang, " ".join(rng.choice(s.split(), 9))) for lang, s in stems.items() for _ in range(25)]
    model = language.LanguageModel.fit(language.features([t for _, t in rows]), [lang for lang, _ in rows])
    assert set(model.languages) == {"germanic", "romance", "slavic", "xx"} and set(model.pairs) == {("de", "en"), ("de", "nl"), ("en", "nl"), ("es", "fr")}
    everything = " ".join(stems.values()).split()
    mixed = [" ".join(rng.choice(everything, int(n))) for n in rng.integers(1, 12, 150)]
    texts = [t for _, t in rows] + mixed + ["Über, 12 THE zijn!"]
    got, scores = model.predict(language.features(texts))
    assert got == [slow_language(model, t) for t in texts]
    assert np.mean([g == lang for g, (lang, _) in zip(got, rows, strict=False)]) > 0.97 and len(set(got[len(rows) :])) >= 5
    assert ((scores >= 0) & (scores <= 1)).all()


def test_workers_forget_what_other_operators_remember():
    from lakesmith.llm import common

    made = []
    one, two = (common.lasting(lambda name, k=k: made.append((k, name)) or name) for k in (1, 2))
    try:
        one("a"), two("a"), one("a")
        common.give_back(keep=one)
        one("a"), two("a")
        common.give_back()
        one("a")
        assert made == [(1, "a"), (2, "a"), (2, "a"), (1, "a")]
    finally:
        common.LASTING.remove(one)
        common.LASTING.remove(two)
