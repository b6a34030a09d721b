"""The class language model against plain Python: counts, classes, probabilities, scores."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import class_lm, queries
from claimloom.llm.common import fold_of
from edge import docs, nothing


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def held_out():
    return fold_of("doc_id", 7) == 2


def checked(model, found, rows):
    """``rows``: (doc_id, text, held out) of ``found``'s documents."""
    counts = Counter()
    for _, text, held in rows:
        if not held:
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    assert (model.total, model.distinct) == (total, distinct)
    place = {w: i + 1 for i, w in enumerate(model.words.words)}
    rest = {bytes(r["word"]): (r["n"], r["cls"]) for r in model.rest.collect()}
    sizes, types = Counter(), Counter(model.classes[model.words.first_shape :].tolist())
    cls = {w: 0 if w is None else model.classes[place[w]] if w in place else rest[w][1] for w in counts}
    for w, n in counts.items():
        sizes[cls[w]] += n
        types[cls[w]] += 1
    assert all(math.isclose(model.tokens[c], sizes[c]) and model.types[c] == types[c] for c in range(len(model.tokens)))
    assert np.allclose((10.0**model.moves).sum(axis=1), 1)

    def score(text):
        out, before = 0.0, 0
        for w in tokens(text):
            like = model.classes[model.words.first_shape + class_lm.shape_of(w)] if w is not None and w not in place else 0 if w is None else model.classes[place[w]]
            own = cls.get(w, like)
            out += model.moves[before, own] + math.log10((counts[w] + class_lm.EMIT) / (sizes[own] + class_lm.EMIT * types[own]))
            before = like
        return out

    want = sorted(
        (
            (doc, held, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens(t)), 5), round(score(t), 5))
            for doc, t, held in rows
        ),
        key=str,
    )
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in found.select(*names).collect()), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], atol=2e-5)


@pytest.mark.parametrize("local, moved", [(1 << 17, 1 << 13), (3000, 200), (0, 0)])
def test_documents(spark, local, moved, monkeypatch):
    """All words travel, most are rows of a table, all are."""
    monkeypatch.setattr(class_lm, "EXCHANGED", moved)
    given = queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    model, encoded = class_lm.learn_classes(given, ~held_out(), classes=24, local=local)
    found = class_lm.score_texts(given, model, encoded).withColumn("held_out", held_out())
    checked(model, found, [tuple(r) for r in given.withColumn("held", held_out()).collect()])


def test_edge_rows(spark):
    given = docs(spark).select("doc_id", "text", "score", "id")
    model, encoded = class_lm.learn_classes(given, ~held_out(), classes=8, local=20)
    found = class_lm.score_texts(given, model, encoded).withColumn("held_out", held_out())
    assert found.columns == ["doc_id", "id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "held_out"]
    checked(model, found, [tuple(r) for r in given.select("doc_id", "text", held_out()).collect()])


def test_nothing_to_learn_from(spark):
    given = nothing(spark).select("doc_id", "text")
    model, encoded = class_lm.learn_classes(given, ~held_out(), classes=8)
    assert class_lm.score_texts(given, model, encoded).collect() == []
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model, encoded = class_lm.learn_classes(some, F.lit(False), classes=8)
    rows = class_lm.score_texts(some, model, encoded).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]


def test_classes_follow_the_order_of_words(spark):
    """Words that stand in the same places share a class, and the score knows which order is usual."""
    first, second = [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)]
    rows = [(k, " ".join(f"{first[(k * 7 + j * 3) % 20]} {second[(k * 11 + j) % 20]}" for j in range(30))) for k in range(200)]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    model, encoded = class_lm.learn_classes(given, F.lit(True), classes=5)
    cls = dict(zip(model.words.words, model.classes[1:].tolist(), strict=False))
    assert not {cls[w.encode()] for w in first} & {cls[w.encode()] for w in second}
    found = class_lm.score_texts(given, model, encoded).agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > 0.85 * found[1]
    swapped = spark.createDataFrame([(1, "a1 b2 a3 b4"), (3, "a1 a3 b2 b4")], "doc_id long, text string")
    words = spark.sparkContext.broadcast(model.words)
    coded = class_lm.encode_texts(swapped, F.lit(False), "doc_id", "text", words)
    scores = [r["score"] for r in class_lm.score_texts(swapped, model, coded).orderBy("doc_id").collect()]
    assert scores[0] > scores[1]
