"""The ordinal classifier beside plain loops: features and scores of texts, and the optimum of its objective."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from quadloom.llm import quality

TEXTS = [
    "A plain text, with words. And words AGAIN!!",
    "same line\nsame line\nother # line $ 5 %",
    "",
    None,
    " \t\n ",
    "I I I a b Ünï ÜBER 漢字!! (x)",
    "WORD " * 40 + "end",
    "one two three four five six seven eight nine ten eleven twelve",
]


def plain_features(text, buckets):
    """The set of buckets that a text has."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")

    def bucket(name):
        return xxhash.xxh64_intdigest(name) % buckets

    counts = {
        "capitals": sum(w != w.lower() and w == w.upper() for w in words),
        "signs": sum(bool(re.search(r"[#*$%&|<>]", w)) for w in words),
        "calls": sum(w.endswith("!!") for w in words),
        "letters": sum(len(w) == 1 for w in words),
        "distinct": len(set(words)),
    }
    forms = {name: math.ceil(10 * n / max(len(words), 1)) for name, n in counts.items()}
    forms["lines"] = math.ceil(10 * len(set(lines)) / max(len(lines), 1))
    forms["length"] = math.ceil(math.log2(len(words) + 1))
    found = {bucket(w.lower().strip(".,;:!?\"'()[]{}#*$%&|<>-")) for w in words}
    return found | {bucket(f"{name}={step}") for name, step in forms.items()}


def test_features_and_scores():
    buckets = 1 << 20
    owner, bucket = quality.features(pa.array(TEXTS, pa.string()), buckets)
    for i, text in enumerate(TEXTS):
        assert set(bucket[owner == i].tolist()) == plain_features(text, buckets)
    rng = random.Random(2)
    some = sorted(rng.sample(sorted(set().union(*(plain_features(t, buckets) for t in TEXTS))), 25))
    model = quality.Model(np.array(some), np.array([rng.uniform(-2, 2) for _ in some]), np.array([-0.5, 0.75]), buckets)
    weight = dict(zip(some, model.weights.tolist(), strict=True))
    wanted = [sum(weight.get(b, 0.0) for b in plain_features(t, buckets)) for t in TEXTS]
    got = quality.score(model, pa.array(TEXTS, pa.string()))
    assert got == pytest.approx(wanted)
    above = quality.tails(got, model.thresholds)
    for row, s in zip(above.tolist(), wanted, strict=True):
        assert row == pytest.approx([1 / (1 + math.exp(c - s)) for c in (-0.5, 0.75)])


def objective(x, y, weights, cuts, penalty):
    score = x @ weights
    edges = np.concatenate([[-np.inf], cuts, [np.inf]])
    p = 1 / (1 + np.exp(score - edges[y + 1])) - 1 / (1 + np.exp(score - edges[y]))
    return -np.log(np.maximum(p, 1e-300)).mean() + penalty * np.abs(weights).sum()


def plain_fit(x, y, penalty, rounds=20_000, step=0.2):
    """Small proximal steps, one after the other, for weights and thresholds."""
    weights, cuts = np.zeros(x.shape[1]), np.array([-1.0, 1.0])
    for _ in range(rounds):
        score = x @ weights
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        upper, lower = (1 / (1 + np.exp(np.clip(score - edges[y + i], -500, 500))) for i in (1, 0))
        mass = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper), lower * (1 - lower)
        gradient = x.T @ ((du - dl) / mass) / len(y)
        pull = [np.where(y == g, -du / mass, np.where(y == g + 1, dl / mass, 0)).mean() for g in range(2)]
        weights = weights - step * gradient
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * penalty, 0)
        cuts = cuts - step * np.array(pull)
    return weights, cuts


def test_fit_reaches_the_optimum():
    rng = np.random.default_rng(4)
    n, k = 240, 12
    x = (rng.random((n, k)) < 0.3).astype(float)
    truth = rng.normal(0, 1.5, k)
    noisy = x @ truth + rng.logistic(0, 1, n)
    y = np.digitize(noisy, np.quantile(noisy, [0.3, 0.6]))
    best = plain_fit(x, y, 2e-3)
    wanted = objective(x, y, *best, 2e-3)
    # the rounds that the query takes, and more of them
    for rounds, off, apart in ((quality.Plan().rounds, 5e-3, 0.15), (3_000, 1e-3, 0.05)):
        plan = quality.Plan(buckets=k, least=1, penalty=2e-3, rounds=rounds)
        model = quality.fit([np.flatnonzero(r) for r in x], y, plan)
        weights = np.zeros(k)
        weights[model.buckets] = model.weights
        assert objective(x, y, weights, model.thresholds, plan.penalty) == pytest.approx(wanted, abs=off)
        a, b = (quality.tails(x @ w, c) for w, c in ((weights, model.thresholds), best))
        assert np.abs(a - b).max() < apart
