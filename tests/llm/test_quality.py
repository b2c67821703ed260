"""The classifier against a plain version, and scores that do not depend on how the rows are dealt."""

import math
import random
import struct

import numpy as np
import pyarrow as pa

from stratalake.llm import quality


def rows_of_text(n):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdeé", k=rng.randrange(1, 6))) for _ in range(80)]
    texts = [rng.choice([" ", "!! ", " | "]).join(rng.choices(words, k=rng.randrange(120))) for _ in range(n)]
    return list(enumerate([*texts, None, "", "x" * 50_000]))


def test_scores_are_the_same_bits_however_rows_are_dealt(spark):
    rng = np.random.default_rng(1)
    model = quality.Model(rng.normal(size=1 << quality.BITS), 0.1)
    docs = spark.createDataFrame(rows_of_text(300), "doc_id long, text string")
    seen = set()
    for n in (1, 7, 40):
        found = quality.score(docs.repartition(n), model).select("doc_id", "score").collect()
        seen.add(tuple(sorted((r.doc_id, struct.pack(">d", r.score)) for r in found)))
    assert len(seen) == 1


def plain_weight(z, n):
    if abs(z) <= quality.L1:
        return 0.0
    return (math.copysign(quality.L1, z) - z) / ((quality.BETA + math.sqrt(n)) / quality.ALPHA + quality.L2)


def test_updates_are_those_of_a_plain_version():
    rng = random.Random(8)
    ftrl, z, n = quality.Ftrl(6), [0.0] * 65, [0.0] * 65
    for _ in range(400):
        places = sorted(rng.sample(range(64), rng.randrange(1, 12))) + [64]
        values, label = [rng.uniform(0, 1) for _ in places[:-1]] + [1.0], float(rng.random() < 0.5)
        ftrl.update(np.array(places), np.array(values), label)
        w = [plain_weight(z[i], n[i]) for i in places]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, values))))
        for i, x, wi in zip(places, values, w):
            g = (p - label) * x
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * wi
            n[i] += g * g
    np.testing.assert_allclose(ftrl.weights(np.arange(65)), [plain_weight(a, b) for a, b in zip(z, n)], rtol=1e-6, atol=1e-9)


def test_features_are_scaled_counts_of_single_words_and_pairs():
    (at, to, places, values, first), = quality.features(pa.array(["a b a b", "", None, "A B a b"]))
    assert (at, to) == (0, 4) and np.diff(first).tolist()[1:3] == [0, 0]
    # a and b twice, "a b" twice, "b a" once
    assert sorted(values[first[0] : first[1]]) == sorted(x / math.sqrt(13) for x in (2, 2, 2, 1))
    assert places[first[0] : first[1]].tolist() == places[first[3] : first[4]].tolist()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = quality.train(none, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert quality.score(none, model).count() == 0
