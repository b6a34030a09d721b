"""Texts of several MB beside short ones, through every operator."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import alignment, class_lm, exact_dedup, langid, line_dedup, media_avi, merkle, mixing, packing, quality_cnn, queries, sharding
from claimloom.llm import common

tokenizers = pytest.importorskip("tokenizers")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    r = random.Random(8)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) + r.choice(["", "", ",", "."]) for _ in range(3000)]
    long = " ".join(r.choice(words) + r.choice(["", "", "", "\n"]) for _ in range(600_000))
    return {1: long, 2: long.replace(" ", "\n"), 3: "short text", 4: "é" * 2_000_000, 5: "z" * 3_000_000, 6: "a b " * 800_000}


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "s", "en") for i, t in texts.items()], "doc_id long, text string, source string, lang string").repartition(3)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_exact(docs, texts):
    assert all(len(t) > 1_000_000 for i, t in texts.items() if i != 3)
    got = by_id(exact_dedup.exact_dedup(docs, carry=False))
    assert {i: r["keep_id"] for i, r in got.items()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6}
    assert got[4]["text_sha256"] == hashlib.sha256(texts[4].encode()).hexdigest()


def test_shards_and_mixture(docs, texts):
    shards = by_id(sharding.extendible_shards(docs, limit_bytes=1 << 20))
    assert {i: r["bytes"] for i, r in shards.items()} == {i: len(t.encode()) for i, t in texts.items()}
    tokens = by_id(mixing.mix_sources(docs))
    assert {i: r["tokens"] for i, r in tokens.items()} == {i: len(t.split()) for i, t in texts.items()}


def test_lines(docs, texts):
    got = by_id(line_dedup.dedup_lines(docs))
    assert {i: r["n_lines"] for i, r in got.items()} == {i: t.count("\n") + 1 for i, t in texts.items()}
    assert got[1]["clean_text"] == texts[1] and got[4]["n_removed"] == 0


def test_languages(spark, docs, texts):
    model = langid.train(spark.read.parquet(f"{SMALL}/documents.parquet"), F.lit(True), max_docs=100)
    got = by_id(langid.predict_languages(docs, model))
    scores = langid._Scorer(model)
    for i, t in texts.items():
        total = sum(n * model.word_scores(w) for w, n in Counter(langid.letters_of(t)).items())
        found, n = scores.total(t)
        assert np.allclose(found, total) and n == len(langid.letters_of(t))
        assert got[i]["lang_pred"] == model.predict(total, n)[0]


def test_quality(docs, texts):
    got = by_id(quality_cnn.score_quality(docs, quality_cnn.new_network()))
    assert {i: r["score"] for i, r in got.items()} == {i: pytest.approx(quality_cnn.score_texts(quality_cnn.new_network(), [t.encode()])[0]) for i, t in texts.items()}


def test_pieces(docs, texts):
    path = queries.tokenizer_path()
    whole = tokenizers.Tokenizer.from_file(path)
    got = packing.pack(docs, path).collect()
    for i in (1, 3, 6):
        ids = whole.encode(texts[i], add_special_tokens=False).ids + [1]
        pieces = {r["start"]: r["ids_crc32"] for r in got if r["doc_id"] == i}
        assert pieces == {at: zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes()) for at in range(0, len(ids), 4096)}
    assert {r["doc_id"] for r in got} == set(texts)


def test_media(docs, texts):
    got = by_id(media_avi.decode_media(media_avi.encode_media(docs)))
    assert {i: r["payload_sha256"] for i, r in got.items()} == {i: hashlib.sha256(media_avi.payload_of(t.encode())).hexdigest() for i, t in texts.items()}


def test_aligned(docs, texts):
    sentencepiece = pytest.importorskip("sentencepiece")
    first, second = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")
    a, b = tokenizers.Tokenizer.from_file(first), sentencepiece.SentencePieceProcessor(model_file=second)
    got = by_id(alignment.align_tokenizers(docs, first, second))
    assert {i: (r["n_a"], r["n_b"]) for i, r in got.items()} == {i: (len(a.encode(" " + t).ids), len(b.encode(t))) for i, t in texts.items()}
    assert all(max(r["n_a"], r["n_b"]) <= r["n_links"] and r["n_groups"] <= min(r["n_a"], r["n_b"]) for r in got.values())


def test_scored(docs, texts):
    model, encoded = class_lm.learn_classes(docs, F.col("doc_id") < 4, classes=16)
    got = by_id(class_lm.score_texts(docs, model, encoded))
    known = {w for i in (1, 2, 3) for w in texts[i].encode().lower().split()}
    for i, t in texts.items():
        words = t.encode().lower().split()
        assert (got[i]["n_tokens"], got[i]["n_known"]) == (len(words) + 1, sum(w in known for w in words) + 1)
    assert got[1]["train_tokens"] == sum(len(texts[i].split()) + 1 for i in (1, 2, 3))


def test_manifest(docs, texts):
    got = by_id(merkle.merkle_manifest(docs, fields=("doc_id", "text")))
    assert all(r["verified"] for r in got.values())
    assert got[4]["leaf"] == hashlib.sha256(f"1:4{len(texts[4].encode())}:{texts[4]}".encode()).hexdigest()


def test_slices(monkeypatch):
    monkeypatch.setattr(common, "SLICE", 5)
    for text in ("", "abc", "one two three  four\n\nfive", "x" * 40, "x" * 40 + " y"):
        parts = list(common.slices(text))
        assert "".join(parts) == text and [w for p in parts for w in p.split()] == text.split()
