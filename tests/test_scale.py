"""Plans that must not strain under a hot key: places, segments, cursors, components, views, retrieval, duplicates."""

import hashlib
import random
from itertools import product
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimloom.operators import blocks, clusters, delta, merge, ranking, resolve, retrieval, saving, views
from claimloom.plans.store import Store
from claimloom.schemas import CLAIM, LT
from test_store import ask, claim, table


@pytest.fixture(autouse=True, scope="module")
def small_plans(spark):
    """Many small jobs: they are not planned anew while they run, nor compiled."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN", "spark.sql.shuffle.partitions": "2"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def fixed_plans(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", before[0])
    spark.conf.set("spark.sql.shuffle.partitions", before[1])


def test_places_in_a_group_of_all_rows(spark, fixed_plans, monkeypatch):
    kept = []
    monkeypatch.setattr(ranking, "saved", lambda df: kept.append(saving.saved(df)) or kept[-1])
    rows = spark.range(8000).select(F.when(F.col("id") < 7900, "hot").when(F.col("id") < 7990, "small").alias("g"), (F.col("id") * 7919 % 8000).alias("v"))
    got = ranking.grouped_rank(rows, ["g"], [F.col("v").desc()], "at").collect()
    for g in ("hot", "small", None):
        own = sorted((r for r in got if r["g"] == g), key=lambda r: r["at"])
        assert [r["at"] for r in own] == list(range(len(own))) and [r["v"] for r in own] == sorted((r["v"] for r in own), reverse=True)
    sizes = [r["count"] for r in kept[0].groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_no_list_is_longer_than_its_bound(spark):
    rows = table(spark, *[claim(i, f"c{i:04d}", subject="hot" if i % 10 else f"s{i}") for i in range(500)])
    got = merge.entity_segments(rows, 40).collect()
    assert max(len(r["items"]) for r in got) == 40
    whole = {r["subject"]: r["claim_ids"] for r in merge.entities(rows).collect()}
    for subject, ids in whole.items():
        assert [i for r in sorted((r for r in got if r["subject"] == subject), key=lambda r: r["segment"]) for i in r["items"]] == ids
    assert {r["home"] for r in merge.route_segments(rows, 40).collect()} == {LT}


def test_cursor_of_more_lines_than_a_row_holds(spark):
    rows = [(f"p{i % 97:03d}/{i}", None if i % 5 == 0 else str(i)) for i in range(1000)]
    found = spark.createDataFrame(random.Random(1).sample(rows, 1000), "path string, content_hash string")
    lines = [f"{p}:{h}" for p, h in sorted(rows, key=lambda r: r[0])]
    digest = lambda xs: hashlib.sha256("\n".join(xs).encode()).hexdigest()
    assert delta.cursor_hash(found).first()["cursor"] == "cursor-v1:" + digest(lines)[:16]
    level = lines
    while len(level) > 16:
        level = [digest(level[i : i + 16]) for i in range(0, len(level), 16)]
    assert delta.cursor_hash(found, run=16).first()["cursor"] == "cursor-v2:" + digest(level)[:16]
    empty = spark.createDataFrame([], "path string, content_hash string")
    assert delta.cursor_hash(empty).first()["cursor"] == "cursor-v1:" + digest([])[:16]


@pytest.mark.parametrize("shape", ["chain", "star", "random", "loops"])
def test_rounds_of_components_shrink(spark, shape):
    r = random.Random(5)
    edges = {
        "chain": [(i, i + 1) for i in range(300)], "star": [(500, i) for i in range(300)], "loops": [(i, i) for i in range(9)],
        "random": [(r.randrange(400), r.randrange(400)) for _ in range(350)],
    }[shape]
    least = {i: i for i in range(501)}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        least[b] = a
    sizes = []
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in shared.glob("claimloom-saved-*")}
    got = clusters.merge_components(spark.createDataFrame(edges, "src long, dst long"), spark.range(501), sizes)
    assert {x["id"]: x["component"] for x in got.collect()} == {i: root(i) for i in range(501)}
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) == len(sizes) <= 8
    left = {p.name for p in shared.glob("claimloom-saved-*") if any(p.iterdir())} - before
    assert len(left) <= 1  # the labels


def test_a_view_is_the_same_bytes_in_parts(spark, tmp_path):
    rows = table(
        spark, *[claim(i, f"c{i}", subject=f"s{i % 5}", type=["fact", "lesson", "decision"][i % 3], text=f"text {i}\n  ") for i in range(60)]
    )
    blocks = sorted(views.memory_view(rows).collect(), key=lambda r: (r["section_ord"], r["row_ord"]))
    lines, now = [], None
    for r in blocks:
        if r["section"] != now:
            now = r["section"]
            lines += [f"## {now}", ""]
        lines += [r["block"], ""]
    want = views.view_head(LT, "2025-03-01T10:00:00Z", "UTC") + "\n" + "\n".join(lines).rstrip() + "\n"
    assert views.view_text(views.memory_view(rows), LT, "2025-03-01T10:00:00Z", "UTC") == want and len(now) > 0
    store = Store(spark, str(tmp_path))
    assert store.write_view("views/x.md", views.view_head(LT, "2025-03-01T10:00:00Z", "UTC"), views.view_lines(views.memory_view(rows)))
    assert store.read_text("views/x.md") == want and store.names("views") == ["x.md"]
    none = views.memory_view(spark.createDataFrame([], CLAIM))
    assert not store.write_view("views/x.md", "head\n", views.view_lines(none)) and store.read_text("views/x.md") == "head\n"


def notes(n, seed=0):
    """Claims whose texts all share a word, and a few more words by frequency."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    kinds = [("fact", "LTMEMORY.md"), ("lesson", "PLAYBOOKS.md"), ("method", "PLAYBOOKS.md")]
    out = []
    for i in range(n):
        kind, home = r.choice(kinds)
        said = ["operator", *(r.choice(words[: 10 ** r.randint(0, 2)]) for _ in range(r.randint(0, 4))), f"unique{i % (n - n // 5)}"]
        out.append(
            claim(
                i, f"c{i:05d}", subject=r.choice(["alpha", "beta beta2", f"topic{i % 7}", None]), predicate=r.choice(["uses", "sees w1", "w2 w3", None]), type=kind,
                primary_home=home, text=" ".join(said), updated_at=r.choice(["", "2025-01-01T00:00:00Z", f"2025-01-{i % 28 + 1:02d}T00:00:00Z", "2025-02-20T00:00:00Z"])
            )
        )
    return out


def asked(n, seed=1):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    return [
        (
            f"q{i}", r.choice(["alpha", "beta", f"topic{i % 7}", "none"]), r.choice([["operator"], ["w1x", "w12"], [], None]),
            " ".join(["operator", *(r.choice(words) for _ in range(r.randint(0, 5))), *[f"unique{r.randrange(300)}"] * r.randint(0, 2)]),
            r.choice(["fact", "lesson", "odd"]), r.choice(["LTMEMORY.md", "PLAYBOOKS.md", None])
        ) for i in range(n)
    ]


@pytest.mark.parametrize("now", [None, "2025-03-01T00:00:00Z"])
def test_rarest_first_finds_the_same(spark, now):
    """Whatever counts as common, rows are those of looking up all keys."""
    prior, asks = table(spark, *notes(300)), ask(spark, *asked(25))
    at = None if now is None else F.lit(now)
    rows = lambda most: sorted(map(str, retrieval.ranked_priors(asks, prior, at, keep=4, common=most).collect()))
    want = rows(1 << 40)
    assert all(rows(common) == want for common in ([1, 40] if now is None else [5])) and len(want) > 60


def test_pairs_grow_with_asks_and_not_with_claims(spark):
    """A word in all texts, an equal subject of a third of them: pairs of claims ten times as many are no more."""
    def pairs(n):
        prior = retrieval.claim_features(table(spark, *[claim(i, f"c{i}", subject="alpha" if i % 3 == 0 else f"t{i}", text=f"operator unique{i}") for i in range(n)]))
        looks = [c for c in prior.columns if c.startswith("c_")]
        sizes = {"c_subject_n": F.size("c_subject_tokens"), "c_n": F.size("c_tokens"), "c_predicate_n": F.size("c_predicate_tokens")}
        kinds = prior.withColumn("look", F.xxhash64(*looks)).withColumn("look2", F.xxhash64(F.lit(1), *looks)).select("look", "look2", *looks).withColumns(sizes)
        asks = retrieval.cluster_features(ask(spark, *[(f"q{i}", "alpha", ["operator"], f"operator unique{i}", "fact", "LTMEMORY.md") for i in range(20)]))
        asks = asks.withColumnRenamed("cluster_id", "ask").withColumn("ask2", F.col("ask"))
        common = retrieval.common_keys(kinds, 50)
        seen = retrieval.common_views(kinds, common)
        best = asks.select("ask", "ask2", F.lit(1.5).alias("beat"), F.lit(True).alias("border"))
        return retrieval.rare_pairs(asks, kinds, common).count() + retrieval.common_pairs(asks, seen, common, best, None).count()

    few, many = pairs(200), pairs(2000)
    assert few <= 20 * 4 and many <= few


def brute_duplicates(new, prior):
    """By all pairs, with the operator's own keys."""
    both = resolve.with_keys(new).alias("n").crossJoin(resolve.with_keys(resolve.active(prior)).alias("p"))
    tokens = lambda side: resolve.duplicate_tokens(F.col(f"{side}.text"))
    objects = lambda side: resolve.subject_key(F.col(f"{side}.object"))
    same = lambda c: F.when(F.col(f"n.{c}") == F.col(f"p.{c}"), 1.0).otherwise(0.0)
    score = same("n_subject") * 0.4 + same("n_predicate") * 0.2 + F.lit(0.2) + resolve.jaccard(tokens("n"), tokens("p")) * 0.2
    score = score + F.when((objects("n") != "") & (objects("n") == objects("p")), 0.1).otherwise(0.0)
    kept = both.where((F.col("n.n_home") == F.col("p.n_home")) & (F.col("n.n_subject") != "") & (F.col("n.n_predicate") != "") & (F.col("n.n_home") != "")).withColumn("s", score)
    best = kept.where("s >= 0.8").groupBy(F.col("n.id").alias("id")).agg(F.min(F.struct((-F.col("s")).alias("s"), F.col("p.ord").alias("ord"), F.col("p.id").alias("t"))).alias("b"))
    reuse = resolve.exact_reuse(new, prior).select("id")
    return {(r["id"], r["b"]["t"], round(-r["b"]["s"], 3)) for r in best.join(reuse, "id", "left_anti").collect()}


def test_duplicates_equal_all_pairs(spark):
    r = random.Random(4)
    words = ["common", *(f"w{i}" for i in range(12))]

    def some(n, name, predicates):
        out = []
        for i, (s, o) in enumerate(product(["cat", "dog", ""], ["home", "Homes", "yard", None])):
            for k in range(n):
                said = " ".join(["common", *r.sample(words, r.randint(0, 6))])
                out.append(
                    claim(
                        len(out), f"{name}{i}-{k}", subject=s, object=o, predicate=r.choice(predicates), text=r.choice([said, "", said]),
                        status=r.choice(["resolved", "resolved", "stale"])
                    )
                )
        return table(spark, *out)

    new, prior = some(6, "n", ["moves", "walks", "jumps", ""]), some(8, "p", ["moves", "relocates", "sees", ""])
    got = {tuple(x) for x in resolve.probable_duplicates(new, prior).select("id", "target_id", "score").collect()}
    assert got == brute_duplicates(new, prior) and len(got) > 10


def test_a_common_first_word_makes_no_pairs(spark):
    """All claims of one subject, home and object begin with the same words; the alphabetical prefix met on these."""
    def sets(n, start):
        rows = [("h", "s", "o", sorted(["aaa", "aab", *(f"x{(start + i) * 7 + k}" for k in range(4))]), (i, f"c{i}")) for i in range(n)]
        return spark.createDataFrame(rows, "n_home string, n_subject string, n_object string, tokens array<string>, who struct<ord:long,id:string>")

    asks, theirs = sets(60, 0).drop("who"), sets(200, 0)
    alphabetical = asks.withColumn("t", F.explode(F.slice("tokens", 1, 4))).join(theirs.withColumn("t", F.explode(F.slice("tokens", 1, 4))), "t")
    before, after = alphabetical.count(), resolve.meeting(asks, theirs).count()
    assert before >= 60 * 200 and after <= 60 * 4
    assert {(tuple(r["tokens"]), r["who"]["id"]) for r in resolve.half_alike(asks, theirs).collect()} == {(tuple(r["tokens"]), r["who"]["id"]) for r in theirs.limit(60).collect()}


def test_sets_that_share_a_little_are_not_paired(spark):
    """Leading tokens that many sets share: a pair for each shared one went through the shuffle, with both sets."""
    r = random.Random(3)
    sets = [sorted(r.sample([f"x{i}" for i in range(90)], r.randint(8, 24))) for _ in range(150)]
    near = [sorted([*s[:-1], f"new{i}"]) for i, s in enumerate(sets[:20])]
    who = "n_home string, n_subject string, n_object string, tokens array<string>, who struct<ord:long,id:string>"
    theirs = spark.createDataFrame([("h", "s", "o", s, (i, f"c{i}")) for i, s in enumerate([*sets, ["lone"]])], who)
    asks = spark.createDataFrame([("h", "s", "o", s, (i, "")) for i, s in enumerate([*near, *sets[100:], ["alone"]])], who).drop("who")
    alike = lambda a, b: 2 * len(set(a) & set(b)) >= len(set(a) | set(b))
    want = {(tuple(a), tuple(b)) for a in [*near, *sets[100:]] for b in sets if alike(a, b)}
    met = [(tuple(x["tokens"]), tuple(x["p_tokens"])) for x in resolve.meeting(asks, theirs).collect()]
    assert want <= set(met) and len(want) == 70 and len(met) <= 12 * len(want)


def test_a_long_cursor_is_one_digest(spark):
    """Of more lines than a row holds it was a tree's."""
    n = delta.CURSOR_RUN + 5000
    found = spark.range(n).select(F.format_string("p%06d", F.col("id")).alias("path"), F.concat(F.lit("h"), F.col("id").cast("string")).alias("content_hash"))
    want = hashlib.sha256("\n".join(f"p{i:06d}:h{i}" for i in range(n)).encode()).hexdigest()[:16]
    assert [r["cursor"] for r in delta.cursor_hash(found.orderBy(F.desc("path"))).collect()] == [f"cursor-v1:{want}"]


@pytest.mark.parametrize("now", [None, "2025-03-01T00:00:00Z"])
def test_blocks_find_what_keys_find(spark, monkeypatch, now):
    """However claims and clusters are dealt over blocks."""
    prior, asks = table(spark, *notes(300)), ask(spark, *asked(25))
    at = None if now is None else F.lit(now)
    rows = lambda **how: sorted((r["cluster_id"], r["rank"], r["claim_id"], r["score"]) for r in retrieval.ranked_priors(asks, prior, at, keep=4, **how).collect() if r["rank"] or how.get("border", True))
    want = rows(common=1 << 40)
    key = lambda got: [(c, k, i, None if s is None else round(s, 9)) for c, k, i, s in got]
    assert key(rows()) == key(want)
    assert key(rows(border=False)) == [r for r in key(want) if r[1]]
    monkeypatch.setattr(blocks, "MOST", 1200)
    assert key(rows()) == key(want)
