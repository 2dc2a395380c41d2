"""Language mixtures against expectation-maximisation written out word by word."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from shoplens.llm import language_id as li


def plain_mixture(likes):
    """Shares of one document; ``likes``: a list of log-likelihoods per language for each word."""
    words, languages = len(likes), len(likes[0])
    alone = [sum(w[j] for w in likes) for j in range(languages)]
    best = max(range(languages), key=lambda j: (alone[j], -j))
    wins = [sum(w[j] == max(w) for w in likes) for j in range(languages)]
    order = sorted(range(languages), key=lambda j: (j != best, -wins[j], j))
    shares, score = {best: 1.0}, alone[best]
    penalty = li.PENALTY * math.log(max(words, 2))
    if sum(map(max, likes)) - score <= penalty:
        return shares
    for k in range(2, languages + 1):
        chosen = order[:k]
        part = [0.0] + [float(wins[j]) for j in chosen[1:]]
        part[0] = max(words - sum(part), 1)
        part = [(p + 0.5) / (sum(part) + 0.5 * k) for p in part]
        for _ in range(li.ROUNDS):
            new = [0.0] * k
            for w in likes:
                mass = [p * math.exp(w[j] - max(w[i] for i in chosen)) for p, j in zip(part, chosen)]
                for i, m in enumerate(mass):
                    new[i] += m / sum(mass) / words
            part = new
        found = sum(
            max(w[i] for i in chosen) + math.log(sum(p * math.exp(w[j] - max(w[i] for i in chosen)) for p, j in zip(part, chosen)))
            for w in likes
        ) - (k - 1) * penalty
        if found <= score:
            break
        shares, score = dict(zip(chosen, part)), found
    return shares


def test_shares_equal_plain_expectation_maximisation():
    draw = random.Random(3)
    documents, languages = [], 4
    for _ in range(60):
        kinds = draw.sample(range(languages), draw.randint(1, 3))
        documents.append([
            [(0.0 if j == kind else -6.0) + draw.gauss(-20, 1.5) for j in range(languages)]
            for kind in (draw.choice(kinds) for _ in range(draw.randint(3, 60)))
        ])
    likes = np.array([w for d in documents for w in d], dtype=np.float32)
    at = np.cumsum([0, *map(len, documents)])[:-1]
    found = li.mixtures(likes, at)
    exact = [[list(map(float, w)) for w in likes[a : a + len(d)]] for a, d in zip(at, documents)]
    several = 0
    for row, words in zip(found, exact):
        shares = plain_mixture(words)
        several += len(shares) > 1
        assert row == pytest.approx([shares.get(j, 0.0) for j in range(languages)], abs=2e-3)
    assert several > 15


def test_texts_without_a_letter_are_undetermined(spark):
    table = spark.createDataFrame([("the house is here", "en"), ("das haus ist hier", "de")] * 20, "text string, lang string")
    model = li.LanguageModel.fit(table)
    texts = ["́̈ ̀", "123 !?", "", None, "é house", "́ house"]
    named, score, _ = model.predict(pa.array(texts))
    assert named[:4] == [li.UNKNOWN] * 4 and not score[:4].any()
    assert named[4] != li.UNKNOWN and named[5] == "en"
    assert model.predict(pa.array(["́"]))[0] == [li.UNKNOWN]
