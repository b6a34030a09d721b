"""Exact deduplication, sharding, mixing, line deduplication, URL filters."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from claimloom.llm import exact_dedup as xd
from claimloom.llm import line_dedup, mixing, queries, sharding, url_filters
from edge import docs, nothing, rows

SPACE = re.compile(r"[\x20\x09-\x0D]")


def brute_dedup(given):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(given):
        groups[SPACE.sub("", text or "")].append((-len(text or ""), doc is None, doc if doc is not None else 0, i, doc))
    out = Counter()
    for norm, members in groups.items():
        keep = min(members)
        for k, m in enumerate(sorted(members)):
            out[m[4], keep[4], len(members), k == 0, hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_exact_dedup(spark, hot, monkeypatch):
    df = docs(spark)
    given = [(r[0], r[1]) for r in rows()]
    if hot:  # many copies of one text, past the limit of hot texts
        many = spark.range(1000, 1400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "so many copies").otherwise("so  many copies").alias("text"))
        df = df.unionByName(many, allowMissingColumns=True)
        given += [(i, "so many copies" if i % 2 == 0 else "so  many copies") for i in range(1000, 1400)]
    got = Counter(tuple(r) for r in xd.exact_dedup(df, carry=False).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert got == brute_dedup(given)
    left = xd.drop_copies(df)
    assert left.columns == df.columns and left.count() == sum(1 for k in got if k[3])


def test_exact_dedup_columns(spark):
    out = xd.exact_dedup(docs(spark))
    assert [c for c in out.columns if c not in xd.OUT] == [c for c in docs(spark).columns if c != "keep_id"]
    assert xd.exact_dedup(nothing(spark)).count() == 0 and xd.drop_copies(nothing(spark)).count() == 0


def test_shards_fit(spark):
    sized = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    got = sharding.extendible_shards(sized, limit_bytes=2000, slack_bits=1)
    by = {
        (r["depth"], r["prefix"]): r for r in got.groupBy("depth", "prefix").agg(
            F.sum("bytes").alias("b"), F.first("shard_bytes").alias("s"), F.count("*").alias("n")
        ).collect()
    }
    assert got.count() == 3000 and all(r["b"] == r["s"] <= 2000 for r in by.values())
    total = {}
    for (d, p), r in by.items():  # each split was needed: the bucket above is too large
        for up in range(d):
            total[up, p >> (d - up)] = total.get((up, p >> (d - up)), 0) + r["b"]
    assert all(b > 2000 for b in total.values())
    assert all((u, p >> (d - u)) not in by for d, p in by for u in range(d))


def test_shards_of_edge_rows(spark):
    got = sharding.extendible_shards(docs(spark), limit_bytes=1000).collect()
    assert len(got) == len(rows()) and {r["doc_id"] for r in got} == {r[0] for r in rows()}
    assert sharding.extendible_shards(nothing(spark)).count() == 0
    whole = sharding.extendible_shards(docs(spark), limit_bytes=1 << 30)
    assert {(r["depth"], r["prefix"]) for r in whole.collect()} == {(0, 0)}


def test_equal_ids_are_chained(spark):
    same = spark.range(500).select(F.lit(7).cast("long").alias("doc_id"), F.repeat(F.lit("y"), (F.col("id") % 10).cast("int")).alias("text"))
    got = sharding.extendible_shards(same, limit_bytes=100)
    pages = got.groupBy("overflow").agg(F.sum("bytes").alias("b"), F.max("shard_bytes").alias("s")).collect()
    assert got.count() == 500 and len(pages) > 1 and all(p["b"] == p["s"] <= 100 for p in pages)


def test_written_shards(spark, tmp_path):
    sharding.write_shards(docs(spark).where("doc_id is not null").dropDuplicates(["doc_id"]), str(tmp_path / "s"), limit_bytes=5000)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 17


def mixed(spark, **how):
    spread = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, "big").when(F.col("id") < 3800, "mid").otherwise("small").alias("source"),
        F.repeat(F.lit("w "), 10).alias("text")
    )
    return mixing.mix_sources(spread, block_tokens=500, **how)


def entropy(p):
    return -sum(x * math.log2(x) for x in p if x)


def test_mixing_reaches_its_target(spark):
    got = mixed(spark, target_entropy=0.9, max_repeats=100.0, budget=100_000)
    use = {r["source"]: (r["t"], r["w"]) for r in got.groupBy("source").agg(F.sum("tokens").alias("t"), F.max("weight").alias("w")).collect()}
    assert sum(w for _, w in use.values()) == pytest.approx(1)
    assert entropy([w for _, w in use.values()]) == pytest.approx(0.9 * math.log2(3), abs=1e-6)
    for t, w in use.values():  # within one document of the budget
        assert 0 <= t - w * 100_000 <= 10 + 1e-6
    # The same exponent for all: log weights are linear in log shares.
    p = {"big": 0.75, "mid": 0.2, "small": 0.05}
    a = [math.log(use[x][1] / use[y][1]) / math.log(p[x] / p[y]) for x, y in (("big", "mid"), ("mid", "small"))]
    assert a[0] == pytest.approx(a[1], abs=1e-9) and 0 < a[0] < 1


def test_mixing_repetition_limit(spark):
    got = mixed(spark, target_entropy=1.0, max_repeats=2.0, budget=40_000)
    use = {r["source"]: r["n"] for r in got.groupBy("source").agg((F.sum("tokens")).alias("n")).collect()}
    assert use["small"] / 2000 <= 2.0 + 10 / 2000 + 1e-6 and use["small"] > 3900
    times = {r["n"] for r in got.where("source = 'small'").groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert times <= {1, 2, 3} and max(times) >= 2


def test_mixing_drops_nothing_by_default(spark):
    got = mixed(spark)
    assert got.select("doc_id").distinct().count() == 4000
    order = got.where("epoch = 0 and source = 'small'").orderBy("start").collect()
    assert [r["start"] for r in order] == list(range(0, 2000, 10))
    assert [r["doc_id"] for r in order] != sorted(r["doc_id"] for r in order)


def test_mixing_edge_rows(spark):
    got = mixing.mix_sources(docs(spark))
    assert {r["doc_id"] for r in got.collect()} == {r[0] for r in rows()}
    again = mixing.repeat_rows(docs(spark))
    assert again.columns == docs(spark).columns and again.count() == got.count()
    assert {r["source"] for r in again.collect()} == {None, "s1", "s2", ""}
    assert mixing.mix_sources(nothing(spark)).count() == 0 and mixing.repeat_rows(nothing(spark)).count() == 0
    only_empty = docs(spark).where("text = ''")
    assert mixing.mix_sources(only_empty).count() == only_empty.count()


def brute_lines(given, k=3):
    seen, out = {}, {}
    order = sorted({(i is None, i if i is not None else 0, t or "") for i, t in given if t})
    place = {}
    for none, i, t in order:
        ls = t.split("\n")
        for at in range(len(ls) - k + 1):
            place.setdefault(tuple(ls[at : at + k]), []).append((none, i, t, at))
    for where in place.values():
        first = min(where, key=lambda x: (x[0], x[1], x[3]))
        for x in where:
            if x is not first:
                start = max(x[3], first[3] + k) if x[:3] == first[:3] else x[3]
                seen.setdefault(x[:3], set()).update(range(start, x[3] + k))
    for i, t in given:
        ls = (t or "").split("\n")
        gone = seen.get((i is None, i if i is not None else 0, t or ""), set())
        out[i, t] = (len(ls), len(gone), "\n".join(x for n, x in enumerate(ls) if n not in gone))
    return out


def test_line_dedup(spark):
    given = [(r[0], r[1]) for r in rows() if r[0] is not None]
    got = line_dedup.dedup_lines(docs(spark).where("doc_id is not null"))
    want = brute_lines(given)
    assert {(r["doc_id"], r["text"]): (r["n_lines"], r["n_removed"], r["clean_text"]) for r in got.collect()} == want
    assert want[12, rows()[11][1]][2] == "same line a\nsame line b\nsame line c"
    assert want[13, rows()[12][1]][2] == "x\ny"
    assert got.columns == [c for c in docs(spark).columns if c != "n_lines"] + line_dedup.OUT
    assert line_dedup.dedup_lines(docs(spark)).count() == len(rows()) and line_dedup.dedup_lines(nothing(spark)).count() == 0


def test_line_dedup_is_linear(spark):
    """Four times the lines take about four times as long (a look at the whole text for each line would take 16)."""

    def took(n):
        texts = [(i, "\n".join(["a shared line", "and another", "and a third", *(f"line {i} {k}" for k in range(n))])) for i in range(2)]
        df = spark.createDataFrame(texts, "doc_id long, text string")
        started = time.perf_counter()
        got = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
        assert got[0]["n_removed"] == 0 and got[1]["n_removed"] == 3 and got[1]["clean_text"] == texts[1][1].split("\n", 3)[3]
        return time.perf_counter() - started

    took(100)
    few = took(8_000)
    assert took(32_000) < 8 * few + 4


def test_cascade_is_exact(spark):
    every = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = every.where("key like '%7'").unionByName(spark.createDataFrame([(None,), ("absent",)], "key string"))
    cascade = url_filters.build_cascade(listed, every.unionByName(every.limit(5)))
    flag = url_filters.member_flag(spark, cascade)
    arrays = every.select("key", *[F.array(h).alias(n) for h, n in zip(url_filters.key_hashes(F.col("key")), ("a", "b"), strict=True)])
    wrong = arrays.where(F.get(flag("a", "b"), F.lit(0)) != F.col("key").like("%7"))
    assert wrong.isEmpty() and len(cascade.levels) > 2 and cascade.size < 20_000
    assert url_filters.member_by_join(every, listed).count() == 2000
    with pytest.raises(ValueError, match="member_by_join"):
        url_filters.build_cascade(listed, every, max_bytes=16)


URLS = [
    "http://a.example.com/en/x?q#f", "https://WWW.Example.com/en/", "http://www.example.com/en", "https://x.net/es/1", "x.net/es/", None,
    "", "ftp://net", "http://fr.net?/fr/", "http://net/fr/", "http://badexample.com/en/", "http://a.net#x/es/", "http://u:p@h.org:80/en/",
    "://com/"
]


def test_urls(spark):
    rules = [("com", "/", False), ("example.com", "/en/", True), ("www.example.com", "/en/", False), ("net", "/es/", True), ("net", "/fr/", True)]
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judge_urls(df, rules).collect()}
    for i, u in enumerate(URLS):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        fits = [(len(h + p), h + p, b) for h, p, b in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits, default=(0, None, False))
        assert got[i] == (host, path, rule[1], "block" if rule[2] else "allow"), u
    # Filters above the limit: the same rows by a join.
    joined = url_filters.judge_urls(df.unionByName(df), rules, max_bytes=1)
    assert Counter(tuple(r) for r in joined.collect()) == Counter({(i, *v): 2 for i, v in got.items()})
    assert joined.columns == url_filters.judge_urls(df, rules).columns == ["page_id", "host", "path", "rule", "verdict"]
    assert url_filters.judge_urls(df.limit(0), rules).count() == 0 and url_filters.judge_urls(df, []).where("verdict = 'allow' and rule is null").count() == len(URLS)


def spark_hash(*values):
    out = 42
    for v, size in values:
        out = xxhash.xxh64(int(v).to_bytes(size, "little", signed=True), out).intdigest()
    return out - (1 << 64) if out >> 63 else out


def brute_mixing(given, target, most, seed, block_tokens, group):
    """given: (id, source, tokens). The rows of mix_sources without a budget, from its statement: the budget is the
    least that uses every source once; the exponent the largest that reaches the entropy and keeps the repeats of that
    budget within ``most``, the latter first."""
    tokens = Counter()
    for _, s, t in given:
        tokens[s] += t
    total = sum(tokens.values())

    def plan(a):
        powers = {s: (t / total) ** a for s, t in tokens.items()}
        weights = {s: x / sum(powers.values()) for s, x in powers.items()}
        budget = max(tokens[s] / weights[s] for s in weights)
        return weights, {s: weights[s] * budget / tokens[s] for s in weights}

    def flat(a):
        return entropy(list(plan(a)[0].values())) >= target * math.log2(len(tokens)) - 1e-12

    def calm(a):
        return max(plan(a)[1].values()) <= most * (1 + 1e-12)

    def bisect(good, bad, holds):
        if holds(bad):
            return bad
        for _ in range(60):
            mid = (good + bad) / 2
            good, bad = (mid, bad) if holds(mid) else (good, mid)
        return good

    weights, repeats = plan(max(bisect(0.0, 1.0, flat), bisect(1.0, 0.0, calm)))
    out = set()
    for s, r in repeats.items():
        blocks = max(1, math.ceil(tokens[s] / block_tokens))
        rows = [(i, t, spark_hash((seed, 4), (i, 8)) % blocks) for i, x, t in given if x == s]
        for e in range(math.ceil(r - 1e-9)):
            start = 0
            place = lambda x: (spark_hash((seed, 4), (e, 4), (x, 8)), x)  # noqa: B023, E731
            for b in sorted({b for _, _, b in rows}, key=lambda b: (place(b // group), place(b))):  # noqa: B023
                for i, t, _ in sorted((x for x in rows if x[2] == b), key=lambda x: place(x[0])):  # noqa: B023
                    if e + 1 <= r + 1e-9 or start < (r - e) * tokens[s]:
                        out.add((i, s, e, b, start))
                    start += t
    return out


def test_mixing_by_brute_force(spark, monkeypatch):
    given = [(i, ["big", "mid", "small"][(i % 10 > 6) + (i % 10 > 8)], i % 7 + 1) for i in range(900)]
    df = spark.createDataFrame([(i, s, " ".join(["w"] * t)) for i, s, t in given], "doc_id long, source string, text string")
    for target, most, group in ((0.97, 50.0, 4096), (1.0, 1.7, 4096), (0.97, 50.0, 4)):
        monkeypatch.setattr(mixing, "GROUP", group)
        got = mixing.mix_sources(df, target_entropy=target, max_repeats=most, block_tokens=100, seed=17)
        assert {(r["doc_id"], r["source"], r["epoch"], r["block"], r["start"]) for r in got.collect()} == brute_mixing(given, target, most, 17, 100, group)


def test_mixing_of_skewed_sources(spark):
    docs_ = queries.table(spark, "/root/testdata/sf0.001", "documents")
    found = queries.mixing_skewed(spark, "/root/testdata/sf0.001").collect()
    shares = {r["doc_id"]: r["source"] for r in found}
    given = [(r["doc_id"], shares[r["doc_id"]], len((r["text"] or "").split())) for r in docs_.select("doc_id", "text").collect()]
    assert {(r["doc_id"], r["source"], r["epoch"], r["block"], r["start"]) for r in found} == brute_mixing(given, 0.9, 4.0, 17, 1 << 20, 4096)
    assert max(r["repeats"] for r in found) > 1.5 and {r["decided_by"] for r in found} <= {"entropy", "repeats"}


def test_mixing_limit_holds_or_is_named(spark):
    """Skewed shares at random: no source is above the limit unless the result says that the budget asks for it."""
    r = random.Random(5)
    for k in range(6):
        sizes = [(f"s{i}", max(1, int(r.paretovariate(0.4) * 100)) % 10**9) for i in range(r.choice([1, 2, 7, 40]))]
        total, most = sum(t for _, t in sizes), r.choice([1.0, 1.5, 4.0])
        budget = None if k % 2 == 0 else total * r.choice([0.5, 1.0, 3.0])
        plan = mixing.mixing_plan(spark.createDataFrame(sizes, "_source string, _tokens long"), budget, r.choice([0.5, 0.9, 1.0]), most, 1 << 20).collect()
        over = max(x["_r"] for x in plan) > most * (1 + 1e-9)
        assert {x["_by"] for x in plan} <= {"budget"} if over else "budget" not in {x["_by"] for x in plan}
        assert over == (budget is not None and budget > most * total * (1 + 1e-9))
        if budget is None:
            assert min(x["_r"] for x in plan) >= 1 - 1e-9


@pytest.mark.parametrize("sizes", [[1000] + [60] * 30 + [1] * 100, [9000] + [10] * 20])
def test_mixing_repetition_limit_by_default(spark, sizes):
    """A hot source with small ones beside it: nothing is dropped, and no document is used more than four times."""
    given = [(s * 10_000 + i, f"s{s}", "w") for s, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(given, "doc_id long, source string, text string")
    got = Counter((r["source"], r["doc_id"]) for r in mixing.mix_sources(df, max_repeats=4.0).select("source", "doc_id").collect())
    assert len(got) == len(given) and max(got.values()) == 4
    uses = Counter()
    for (s, _), n in got.items():
        uses[s] += n
    # The limit binds: the least source is repeated four times, and the exponent gives the others theirs.
    a = 1 - math.log(4) / math.log(max(sizes) / min(sizes))
    for s, n in enumerate(sizes):
        assert 0 <= uses[f"s{s}"] - n * (max(sizes) / n) ** (1 - a) <= 1 + 1e-6 * n
    assert Counter(r["doc_id"] for r in mixing.repeat_rows(df).collect()) == Counter({i: n for (_, i), n in got.items()})


def test_many_cells_are_not_sent_to_every_task(spark, monkeypatch):
    """The size of a table's files says little of what a broadcast of it takes."""
    monkeypatch.setattr(sharding, "FEW_CELLS", 4)
    got = sharding.extendible_shards(docs(spark), limit_bytes=1000)
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().toString()
    monkeypatch.undo()
    assert sorted(map(str, got.collect())) == sorted(map(str, sharding.extendible_shards(docs(spark), limit_bytes=1000).collect()))
