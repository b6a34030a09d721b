"""Language identification, quality, media, packing: held-out accuracy, round trips, brute force."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.llm import langid, media_avi, packing, quality_cnn, queries
from claimloom.llm.common import fold_of
from edge import docs, nothing, rows

SMALL = "/root/testdata/sf0.01"
tokenizers = pytest.importorskip("tokenizers")


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_language_held_out(spark):
    got = queries.op8_langid(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) for r in got) and len(held) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.97


def brute_language(model, text):
    words = langid.letters_of(text or "")
    if not words:
        return "und"
    total = np.zeros(len(model.langs))
    for w in words:
        if w in model.words.index:
            total += model.words.rows[model.words.index[w]]
            continue
        for n in (5, 4, 3, 2, 1):
            at = [model.grams[n].index[g] for g in langid.grams_of(w, n) if n in model.grams and g in model.grams[n].index]
            if at:
                total += model.grams[n].rows[at].mean(axis=0)
                break
    return model.langs[int(np.argmax(total))]


def test_language_backoff_and_edges(spark):
    model = langid.train(spark.read.parquet(f"{SMALL}/documents.parquet"), F.lit(True), max_docs=200, max_entries=500)
    got = langid.predict_languages(docs(spark), model)
    assert got.columns == [c for c in docs(spark).columns if c not in ("score", "lang_pred")] + ["lang_pred", "score"]
    for r in got.collect():
        assert r["lang_pred"] == brute_language(model, r["text"]) and 0 <= r["score"] <= 1
    kinds = {r["doc_id"]: r["lang_pred"] for r in got.where("doc_id in (6, 7, 8, 15)").collect()}
    assert set(kinds.values()) == {"und"}
    none = langid.train(nothing(spark), F.lit(True))
    assert {r["lang_pred"] for r in langid.predict_languages(docs(spark), none).collect()} == {"und"}
    assert langid.predict_languages(nothing(spark), model).count() == 0


def test_numerals_are_no_letters(spark):
    model = langid.train(spark.read.parquet(f"{SMALL}/documents.parquet"), F.lit(True), max_docs=200)
    texts = ["² ½", "Ⅷ", "٣", "_", "²", "the ² house½of the people"]
    got = langid.predict_languages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got[:5]] == ["und"] * 5 and got[5]["lang_pred"] in model.langs
    assert langid.letters_of(texts[5]) == ["the", "house", "of", "the", "people"]
    assert langid.letters_of("Ünï²cøde") == ["ünï", "cøde"]


def test_language_learns_every_language(spark):
    """More than a thousand languages, most with one document, and fewer documents to draw than languages."""
    word = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(3)) * 2
    given = [(i, f"l{i:04}", " ".join([word(i)] * 5)) for i in range(1003)]
    given += [(2000 + i, f"l{i % 5:04}", " ".join([word(i % 5)] * 5)) for i in range(500)]
    df = spark.createDataFrame(given, "doc_id long, lang string, text string")
    for most in (8000, 100):
        model = langid.train(df, F.lit(True), max_docs=most, sizes=(1, 2))
        assert model.langs == [f"l{i:04}" for i in range(1003)]
        assert langid.predict_languages(df, model).where("lang_pred <> lang").count() == 0


def test_quality_held_out(spark):
    got = queries.op3_quality(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r["quality"] == r["predicted"] for r in got) / len(got)
    assert right >= 0.97 and all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
    bad = [r for r in got if r["quality"] == 0]
    assert sum(r["predicted"] == 0 for r in bad) / len(bad) >= 0.85


def brute_quality(net, text):
    n, width = max(1, len(text)), quality_cnn.WIDTH
    blocks = max(1, -(-(len(text) + width - 1) // quality_cnn.BLOCK))
    data = np.zeros(blocks * quality_cnn.BLOCK + width, np.uint8)
    data[: len(text)] = np.frombuffer(text, np.uint8)
    act = np.array([net.embed[data[i : i + width]].reshape(-1) @ net.filters for i in range(n)])
    ends = [min(n, k * quality_cnn.BLOCK + 2 * quality_cnn.BLOCK) for k in range(blocks)]
    chunks = [act[k * quality_cnn.BLOCK : e] for k, e in zip(range(blocks), ends, strict=True) if k * quality_cnn.BLOCK < n]
    h = np.array([np.maximum(c.max(axis=0) + net.bias, 0) for c in chunks])
    if len(chunks) < blocks:  # a last block that holds only padding adds a chunk without an answer
        h = np.concatenate([h, np.zeros((blocks - len(chunks), quality_cnn.FILTERS))])
    z = np.concatenate([h.mean(axis=0), h.max(axis=0)]) @ net.head + net.offset[0]
    return 1 / (1 + np.exp(-z))


def test_quality_network_sees_whole_texts():
    net = quality_cnn.new_network()
    texts = [b"", b"x", b"hello world " * 200, bytes(range(256)) * 5, b"a" * 251, b"b" * 252, b"c" * 256, b"d" * 5000]
    got = quality_cnn.score_texts(net, texts)
    assert got == pytest.approx([brute_quality(net, t) for t in texts], rel=1e-4)
    late = b"a" * 9000 + b"$$$$ !!!! zzzz"
    assert quality_cnn.score_texts(net, [late])[0] != quality_cnn.score_texts(net, [b"a" * 9014])[0]


def test_quality_gradients():
    """One step of training goes down the loss that numbers give."""
    texts, labels = [b"aaaa bbbb " * 40, b"#### $$$$ " * 40] * 10, [1, 0] * 10
    net = quality_cnn.fit(texts, labels, rounds=8, batch=4)
    got = quality_cnn.score_texts(net, texts)
    assert (got[::2] > 0.9).all() and (got[1::2] < 0.1).all()


def test_quality_edges(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 18)] + [(None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    net = quality_cnn.learn_quality(docs(spark), labels, fold_of("doc_id", 5) != 0)
    got = quality_cnn.score_quality(docs(spark), net).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert quality_cnn.learn_quality(nothing(spark), labels.limit(0), F.lit(True)) is None
    assert {r["score"] for r in quality_cnn.score_quality(docs(spark), None).collect()} == {0.5}
    assert quality_cnn.score_quality(nothing(spark), net).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=6000), min_size=1, max_size=4))
def test_media_round_trip(texts):
    payloads = [media_avi.payload_of(t) for t in texts]
    files = media_avi.encode_avis(payloads)
    back = media_avi.decode_avis(files)
    assert [p for p, _ in back] == payloads and all(len(p) % 64 == 0 and p for p in payloads)
    assert all(np.allclose(h.sum(axis=1), 1) for p, h in back)
    assert files == [media_avi.encode_avis([p])[0] for p in payloads]


def test_media_frames_are_lossless_jpeg():
    """A plain decoder, bit by bit and sample by sample, gives the payload back."""
    payload = media_avi.payload_of(bytes(range(256)) * 20 + b"\xff" * 700)
    data = media_avi.encode_avis([payload])[0]
    frames, size = media_avi.parse_avi(data)
    codes = {c: s for s, c in media_avi._codes(media_avi.CODE_LENGTHS).items()}
    out = b""
    for at, n in frames:
        rows_, begin = media_avi.parse_jpeg(data, at, n)
        bits = "".join(f"{x:08b}" for x in data[begin : at + n - 2].replace(b"\xff\0", b"\xff"))
        pos, got = 0, []
        for i in range(rows_ * 64):
            code, k = 0, 0
            while (code, k) not in codes:
                code, k, pos = code * 2 + int(bits[pos]), k + 1, pos + 1
            s = codes[code, k]
            extra = int(bits[pos : pos + s] or "0", 2)
            pos += s
            diff = extra if s == 0 or extra >> (s - 1) else extra - (1 << s) + 1
            ahead = 128 if i == 0 else got[-1] if i % 64 else got[i - 64]
            got.append((ahead + diff) & 0xFF)
        assert data[at : at + 2] == b"\xff\xd8" and data[at + n - 2 : at + n] == b"\xff\xd9"
        out += bytes(got)
    assert out[:size] == payload and size == len(payload)


def test_shots():
    calm, loud = np.eye(16)[0], np.eye(16)[9]
    assert media_avi.shots(np.array([calm] * 10 + [loud] * 10)) == [(0, 10), (10, 20)]
    assert media_avi.shots(np.array([calm] * 5)) == [(0, 5)] and media_avi.shots(np.array([calm])) == [(0, 1)]


def test_media_edges(spark):
    media = media_avi.encode_media(docs(spark))
    got = media_avi.decode_media(media).withColumn("feature", media_avi.feature_of()).collect()
    want = Counter()
    for r in rows():
        p = media_avi.payload_of((r[1] or "").encode())
        want[r[0], len((r[1] or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got) == want
    assert media_avi.clip_rows(media_avi.decode_media(media)).where("end_s <= start_s").isEmpty()
    assert media_avi.encode_media(nothing(spark)).count() == 0
    none = media_avi.decode_media(spark.createDataFrame([(1, 0, None)], "doc_id long, n_bytes long, media binary")).first()
    assert none["payload_sha256"] is None and none["clips"] is None


def test_damaged_and_foreign_media(spark):
    """Each gives a row that says why, beside whole files that are read; no task fails."""
    payload = media_avi.payload_of(bytes(range(256)) * 40)
    whole = media_avi.encode_avis([payload])[0]
    frames, _ = media_avi.parse_avi(whole)
    at, n = frames[1]
    flip = lambda i, x=0xFF: whole[:i] + bytes([whole[i] ^ x]) + whole[i + 1 :]
    table, size = whole.index(b"\xff\xc4", at), whole.index(b"\xff\xc3", at)
    bad = {
        "empty": b"", "text": b"no film", "riff": b"RIFF\x04\0\0\0WAVE", "head": whole[:40], "half": whole[: len(whole) // 2], "last": whole[:-9], "first byte": flip(0),
        "image": flip(at), "image end": flip(at + n - 1), "table": flip(table + 6), "width": flip(size + 8, 1), "lossy": flip(size + 1, 3), "index": flip(len(whole) - 8, 0x40), "comment": whole.replace(
            b"payload=1", b"payload=9"
        ),
    }
    given = [(k, 0, v) for k, v in bad.items()] + [("whole", len(payload), whole), ("null", 0, None)]
    got = {r["doc_id"]: r for r in media_avi.decode_media(spark.createDataFrame(given, "doc_id string, n_bytes long, media binary").coalesce(1)).collect()}
    for k, data in bad.items():
        assert got[k]["payload_sha256"] is None and got[k]["clips"] is None and got[k]["error"], k
        assert (got[k]["media_bytes"], got[k]["media_sha256"]) == (len(data), hashlib.sha256(data).hexdigest())
    assert got["whole"]["payload_sha256"] == hashlib.sha256(payload).hexdigest() and got["whole"]["error"] is None
    assert got["null"]["error"] is None and got["null"]["media_sha256"] is None


def test_media_without_index_or_comment():
    payload = media_avi.payload_of(b"some text " * 700)
    whole = media_avi.encode_avis([payload])[0]
    index, comment = whole.index(b"idx1"), whole.index(b"ICMT")
    for other in (whole[:index] + b"JUNK" + whole[index + 4 :], whole[:comment] + b"ISFT" + whole[comment + 4 :]):
        (back, histograms), plain = media_avi.read_avis([other])[0], media_avi.decode_avis([whole])[0]
        assert back.rstrip(b"\0") == payload.rstrip(b"\0") and len(histograms) == len(plain[1])


def test_ids_are_the_tokenizers():
    path = queries.tokenizer_path()
    whole = tokenizers.Tokenizer.from_file(path)
    texts = [r[1] or "" for r in rows()] + [
        "It's the DOG's, isn't it?!", "a<|endoftext|>b", "x\x1cy z", "İstanbul ΑΣ ΣΑΣ", "é café,", "naïve... 12,3  q", "ﬁ ǅ ß. Ǆ!",
        "'s 't a's.", "foo_bar. (x) [y]", "« mot ». Puis", "bell\x07. x", "x². y½, z", "a\xa0. b", "ªº µ ŉ."
    ]
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.encode_texts(texts, path)]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aB'sé.,!-_0ß \n\tİΣ́Å#»«\x07²½µ\x85\xa0"), max_size=24), max_size=4))
def test_ids_of_any_text(texts):
    path = queries.tokenizer_path()
    whole = packing.WordIds(path).tokenizer if path not in packing._word_ids else packing._word_ids[path].tokenizer
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.encode_texts(texts, path)]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 256), st.integers(0, 40), max_size=60))
def test_any_plan_is_whole(counts):
    plan = packing.plan_packing(counts, capacity=256, classes=16)
    back = Counter()
    for seq, m in plan:
        assert sum(seq) <= 256 and m > 0
        for n in seq:
            back[n] += m
    assert back == Counter({k: v for k, v in counts.items() if v})


def test_nnls_is_least_squares():
    r = np.random.default_rng(1)
    a, b = r.random((12, 30)), r.random(12)
    x = packing.nnls(a, b)
    slope = a.T @ (a @ x - b)
    assert (x >= 0).all() and slope.min() > -1e-7 and np.abs(slope[x > 1e-9]).max() < 1e-7


def test_packing_edges(spark):
    got = packing.pack(docs(spark), queries.tokenizer_path(), capacity=256).collect()
    whole = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    want = Counter()
    for r in rows():
        ids = whole.encode(r[1] or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 256)):
            part = ids[at : at + 256]
            want[r[0], k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 256
    assert packing.pack(nothing(spark), queries.tokenizer_path()).count() == 0


def test_packing_is_tight(spark):
    got = queries.op7_packing(spark, SMALL)
    used, total = got.select("sequence_id").distinct().count(), got.agg(F.sum("length")).first()[0]
    assert used <= 1.01 * -(-total // 4096) + 1
