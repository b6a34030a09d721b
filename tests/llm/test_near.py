"""The Jaccard join and the pipeline against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimloom.llm import common
from claimloom.llm import jaccard_join as jj
from claimloom.llm import queries
from claimloom.llm import shingles as shingles_of
from claimloom.llm.components import connected_components
from edge import docs, nothing, rows


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(given, k, num, den):
    """Every pair."""
    sets = [shingles(t, k) for _, t in given]
    up = list(range(len(given)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(given)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(given):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return Counter((doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(given))


def ask(spark, given, **how):
    out = jj.jaccard_components(spark.createDataFrame(given, "doc_id long, text string"), sketch_bits=12, **how)
    return Counter(tuple(r) for r in out.select("doc_id", "n_shingles", "component_id").collect())


@pytest.mark.parametrize(("k", "num"), [(4, 85), (5, 80), (1, 60)])
def test_families(spark, k, num):
    """Copies with few and many edits, some linked only through others, and texts that share a passage."""
    r = random.Random(k)
    words = [f"w{i}" for i in range(3000)]
    given, at = [], 0
    passage = [r.choice(words) for _ in range(60)]
    for size in (40, 90, 150):
        base = [r.choice(words) for _ in range(size)]
        for edits in [0, 1, 1, 2, 2, 3, 4, 5, 6, 8, 12] * 2:
            w = list(base)
            for _ in range(edits):
                p = r.randrange(len(w))
                w[p : p + 1] = r.choice([[], [r.choice(words)], [r.choice(words), w[p]]])
            given.append((at, " ".join(w)))
            at += 1
    for _ in range(25):
        given.append((at, " ".join(passage + [r.choice(words) for _ in range(r.choice([3, 10, 40]))])))
        at += 1
    assert ask(spark, given, shingle=k, num=num, den=100) == brute(given, k, num, 100)


def test_copies_without_their_original(spark):
    """Many copies, each with edits of its own, linked with few others: the bound must not lose links."""
    r = random.Random(9)
    words = [f"w{i}" for i in range(2000)]
    base = [r.choice(words) for _ in range(150)]
    given = []
    for i in range(120):
        w = list(base)
        for _ in range(r.choice([2, 3, 3, 4])):
            w[r.randrange(len(w))] = r.choice(words)
        given.append((i, " ".join(w)))
    assert ask(spark, given, shingle=4, num=85, den=100) == brute(given, 4, 85, 100)


def test_large_lists_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jj, "LIST_BLOCK", 10)
    test_copies_without_their_original(spark)


def test_shuffled_texts(spark, monkeypatch):
    monkeypatch.setattr(jj, "BROADCAST_PAIRS", 0)
    test_families(spark, 4, 85)


def test_frequent_tokens_in_lanes(spark, monkeypatch):
    """Lists of frequent tokens dealt over lanes, and hubs dealt over many."""
    monkeypatch.setattr(jj, "HOT_LIST", 3)
    monkeypatch.setattr(jj, "LANE_PAIRS", 5)
    r = random.Random(12)
    words = [f"w{i}" for i in range(4000)]
    base = [r.choice(words) for _ in range(60)]
    given = []
    for i in range(150):
        w = list(base)
        for _ in range(r.choice([1, 2, 3, 8])):
            w[r.randrange(len(w))] = r.choice(words)
        given.append((i, " ".join(w)))
    given += [(1000 + i, " ".join(base[:20] + [r.choice(words) for _ in range(40)])) for i in range(60)]
    out = jj.jaccard_components(spark.createDataFrame(given, "doc_id long, text string"), shingle=4, num=85, sketch_bits=16)
    assert Counter(tuple(x) for x in out.collect()) == brute(given, 4, 85, 100)
    order = jj.Prefixes(np.full(1 << 16, 1, np.uint32) + (np.arange(1 << 16) == 7) * np.uint32(1000), 85, 100)
    tokens = np.array([7 << 48, 8 << 48], np.uint64)
    assert order.lanes(tokens)[0] > 1 and order.lanes(tokens)[1] == 0


def test_long_texts(spark):
    """Texts of several MB and words without end: parts of fixed size, the same sets."""
    r = random.Random(2)
    words = [f"word{i}" for i in range(50_000)]
    long = [r.choice(words) for _ in range(400_000)]
    near = list(long)
    for at in range(0, len(near), 40):
        near[at] = "changed"
    far = [r.choice(words) for _ in range(300_000)]
    given = [
        (1, " ".join(long)), (2, "  " + "\n".join(near)), (3, " ".join(far)), (4, "x" * 3_000_000), (5, " " + "X" * 3_000_000 + " "),
        (6, "x" * 2_999_999), (7, ("y" * 70_000 + " ") * 40)
    ]
    assert all(len(t) > 2_500_000 for _, t in given)
    assert ask(spark, given, shingle=4, num=80, den=100) == brute(given, 4, 80, 100)


def test_parts_of_any_size(monkeypatch):
    """Sets don't depend on where parts end."""
    r = random.Random(4)
    texts = [
        " ".join(r.choice(["a", "bb", "Ccc", "d" * r.randint(1, 50)]) for _ in range(r.randint(0, 200))) + r.choice(["", " ", "  "]) for _ in range(80)
    ] + ["x" * 3000, "   ", "", "x" * 100 + " " + "y" * 900]
    data = [t.encode() for t in texts]
    given = np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])])
    for k in (1, 5):
        monkeypatch.setattr(shingles_of, "PART_BYTES", 1 << 18)
        want = [x.tolist() for x in shingles_of.shingle_sets(*given, k)]
        for size in (1, 2, 7, 64, 333):
            monkeypatch.setattr(shingles_of, "PART_BYTES", size)
            assert [x.tolist() for x in shingles_of.shingle_sets(*given, k)] == want


def test_edge_rows(spark):
    df = docs(spark)
    got = Counter(tuple(r) for r in jj.jaccard_components(df, shingle=4, num=85, sketch_bits=12).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute([(r[0], r[1]) for r in rows()], 4, 85, 100)
    assert jj.jaccard_components(nothing(spark), sketch_bits=12).count() == 0
    left = jj.keep_first(df, shingle=4, num=85, sketch_bits=12)
    assert left.columns == df.columns and {6, 7, 8} <= {r["doc_id"] for r in left.collect()}


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(70)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(71)} | {i: 1000 for i in range(1000, 1200)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_small_table(spark):
    given = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = Counter(tuple(r) for r in queries.op4_jaccard(spark, "/root/testdata/sf0.001").select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute(given, 4, 85, 100)


def test_pipeline_stage_by_stage(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = df.columns
        stage(spark, df, sf).write.parquet(str(tmp_path / name))
        new = spark.read.parquet(str(tmp_path / name))
        if name != "sequences":
            assert new.columns == before
        kept[name] = [r["doc_id"] for r in new.select("doc_id").collect()]
        if name == "exact_copies":
            norm = {}
            for r in df.collect():
                norm.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r["text"]), []).append((-len(r["text"]), r["doc_id"]))
            assert sorted(kept[name]) == sorted(min(v)[1] for v in norm.values())
        if name == "near_copies":
            want = brute([(r["doc_id"], r["text"]) for r in df.collect()], 5, 80, 100)
            assert sorted(kept[name]) == sorted(k[0] for k in want if k[0] == k[2])
        if name == "mixture":
            assert set(kept[name]) == set(kept["near_copies"])
        df = new
    assert set(kept["sequences"]) == set(kept["mixture"])
    assert df.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").isEmpty()


def test_pipeline_leaves_little(spark, tmp_path, monkeypatch):
    """run() gives every kept document's pieces, and deletes what its stages wrote on their way."""
    sf = "/root/testdata/sf0.001"
    kept = []
    monkeypatch.setattr(corpus_pipeline, "write_table", lambda df, tag: kept.append(common.write_table(df, tag)) or kept[-1])
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path))
    out = corpus_pipeline.run(spark, sf)
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").isEmpty()
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == {r["doc_id"] for r in kept[-1].select("doc_id").collect()}
    left = [p.name for p in tmp_path.iterdir() if p.name.startswith("claimloom-")]
    assert sorted(n.split("-")[1] for n in left) == ["mixture", "pieces"]


def test_pipeline_on_edge_rows(spark):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs(spark), "")
        assert name == "sequences" or out.columns == docs(spark).columns, name
        assert out.collect()
        assert stage(spark, nothing(spark), "").count() == 0
    assert {r["doc_id"] for r in corpus_pipeline.language(spark, docs(spark), "").collect()}.isdisjoint({6, 7, 8, 15})
