"""New claims against prior ones: exact reuse, probable duplicates, routes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.dates import epoch
from claimloom.functions.text import blank, duplicate_tokens, home_key, jaccard, predicate_key, short_hash, subject_key
from claimloom.operators.blocks import in_blocks, lists, ranges
from claimloom.operators.saving import saved
from claimloom.schemas import AFFINITY, INACTIVE, ROUTE_SCORES

THRESHOLD = 0.80
# Weights of subject, predicate, home and text, and what equal objects add.
W_SUBJECT, W_PREDICATE, W_HOME, W_TEXT, OBJECT_BONUS = 0.4, 0.2, 0.2, 0.2, 0.1
KEYS = ["n_subject", "n_predicate", "n_home"]


def active(claims: DataFrame) -> DataFrame:
    """Claims not superseded, stale or to be retired; a null status is active."""
    return claims.where(~F.coalesce("status", F.lit("")).isin(INACTIVE))


def with_keys(claims: DataFrame) -> DataFrame:
    return claims.withColumns({"n_subject": subject_key(F.col("subject")), "n_predicate": predicate_key(F.col("predicate")), "n_home": home_key(F.col("primary_home"))})


def signature() -> Column:
    return F.concat_ws("|", *[F.coalesce(k, F.lit("")) for k in KEYS])


def stable_id(subject: Column, predicate: Column, text: Column, home: Column) -> Column:
    return short_hash(F.concat_ws("|", *[blank(c) for c in (subject, predicate, text, home)]), "cl-")


def _full(df: DataFrame, keys: list[str]) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) != "")
    return df.where(cond)


def exact_reuse(new: DataFrame, prior: DataFrame) -> DataFrame:
    """(id, target_id): the active prior claim of the same normalised subject, predicate and home, the last updated,
    then the least id.

    The winner of a key does not depend on the new claim, so priors are reduced to one a key before the join.
    """
    win = F.min(F.struct((-epoch(F.col("updated_at"))).alias("e"), blank(F.col("id")).alias("i")))
    best = _full(with_keys(active(prior)), KEYS).groupBy(*KEYS).agg(win["i"].alias("target_id"))
    return _full(with_keys(new), KEYS).join(best, KEYS).select("id", "target_id")


GROUP = ["n_home", "n_subject", "n_object"]


def probable_duplicates(new: DataFrame, prior: DataFrame) -> DataFrame:
    """(id, target_id, score, dominant): the most alike active prior claim of the same home scoring THRESHOLD or more,
    the first by ``ord`` at a tie; for claims without exact reuse, so claims that have one get no row.

    Without an equal subject no sum reaches the threshold. With it and the home, and with another predicate (an equal one
    is exact reuse), what is missing comes from equal tokens, or from an equal object and tokens of a similarity of one
    half. Of prior claims with equal tokens only the first of each object, and of all, can win, so these are found
    without pairs. The others come from ``half_alike``. Both sides are saved, so that keys and tokens are made once; equal
    sets of tokens are told by two hashes, so the sets themselves are shuffled once.
    """
    def looks(df: DataFrame) -> DataFrame:
        added = df is new
        df = _full(with_keys(df), KEYS if added else ["n_home", "n_subject"])
        df = df.withColumns({"n_object": subject_key(F.col("object")), "tokens": F.array_sort(duplicate_tokens(F.col("text")))})
        return _hashed(df.select("id", *([] if added else ["ord"]), *KEYS, "n_object", "tokens")).withColumn("n", F.size("tokens"))

    sets = ["set1", "set2"]
    same = [*KEYS, "n_object", *sets]
    known = saved(looks(active(prior)))
    mine = saved(looks(new).join(_full(known, KEYS).select(*KEYS).distinct(), KEYS, "left_anti"))
    asks = saved(mine.groupBy(*same).agg(F.first("n").alias("n")))
    # Prior claims that differ in predicate alone score alike beside another predicate.
    theirs = saved(known.groupBy(*GROUP, *sets).agg(F.min(F.struct("ord", "id")).alias("who")))
    equal = ["n_home", "n_subject", *sets]
    filled = asks.where("n > 0")
    any_object = theirs.groupBy(*equal).agg(F.min("who").alias("who"))
    found = filled.join(any_object, equal).select(*same, "who", _duplicate_score(F.lit(1.0), F.lit(0.0)))
    found = found.unionByName(filled.where("n_object <> ''").join(theirs, [*GROUP, *sets]).select(*same, "who", _duplicate_score(F.lit(1.0), F.lit(OBJECT_BONUS))))
    of_object = lambda df, *more: df.where("n_object <> '' and n > 0").groupBy(*GROUP, *sets).agg(F.first("tokens").alias("tokens"), *more).drop(*sets)
    alike = half_alike(saved(of_object(mine)), saved(of_object(known, F.min(F.struct("ord", "id")).alias("who"))))
    found = found.unionByName(asks.join(_hashed(alike), [*GROUP, *sets]).select(*same, "who", _duplicate_score(F.col("text"), F.lit(OBJECT_BONUS))))
    top = found.where(F.col("score") >= THRESHOLD).groupBy(*same).agg(F.min(F.struct((-F.col("score")).alias("s"), "who")).alias("best"))
    best = top.select(*same, F.col("best.who.id").alias("target_id"), F.bround(-F.col("best.s"), 3).alias("score"))
    # The subject's 0.4 is never below another signal's weight.
    return mine.select("id", *same).join(best, same).select("id", "target_id", "score", F.lit("subject").alias("dominant"))


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("set1", F.xxhash64("tokens")).withColumn("set2", F.xxhash64(F.lit(1), "tokens"))


def _duplicate_score(text: Column, bonus: Column) -> Column:
    """Of claims of one subject and home and of different predicates."""
    return (F.lit(1.0 * W_SUBJECT) + F.lit(0.0 * W_PREDICATE) + F.lit(1.0 * W_HOME) + text * W_TEXT + bonus).alias("score")


#: Counters of tokens; those that share one count together, which changes an order and no result.
COUNTERS = 1 << 18


def _prefixes(sets: DataFrame, counts: np.ndarray) -> DataFrame:
    """(k1, k2, group, size, head, last): of each set the hashes of its leading tokens, rarest first, and what the last of
    them is in that order. Sets that share half of their union share half of either, so one of the first
    n - ceil(n / 2) + 1 in any common order."""
    def lead(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values, at = lists(pa.chunked_array([batch.column("hashes")]))
            sizes = np.diff(at)
            order = _order(values, counts)
            order = order[np.lexsort((order, np.repeat(np.arange(len(sizes)), sizes)))]
            leading = np.minimum(sizes, sizes // 2 + 1)
            kept = order[ranges(at[:-1], leading)]
            ends = np.cumsum(leading)
            heads = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array((kept & 0xFFFFFFFF).astype(np.uint32).view(np.int32)))
            columns = [*(batch.column(c) for c in ("k1", "k2", "group")), pa.array(sizes, pa.int32()), heads, pa.array(kept[ends - 1], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "group", "size", "head", "last"])

    return sets.mapInArrow(lead, "k1 long, k2 long, group long, size int, head array<int>, last long")


def _order(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return (counts[hashes & (COUNTERS - 1)].astype(np.int64) << 32) + (hashes.astype(np.int64) & 0xFFFFFFFF)


def _alike_heads(mine: pa.Table, other: pa.Table, counts: np.ndarray) -> pa.Table:
    """The pairs that can share half of their union. Tokens that both have and that aren't counted lie behind the lesser
    of their two last leading ones, so what is left there of either bounds them."""
    value = lambda t, c: t.column(c).to_numpy()
    (words, at), (p_words, p_at) = lists(mine.column("head")), lists(other.column("head"))
    size, last, p_size, p_last = value(mine, "size"), value(mine, "last"), value(other, "size"), value(other, "last")
    p_behind = p_size - np.diff(p_at)
    by_word = np.argsort(p_words, kind="stable")
    owner = np.repeat(np.arange(len(p_size)), np.diff(p_at))[by_word]
    order = _order(words, counts)
    known, first, count = np.unique(p_words[by_word], return_index=True, return_counts=True)
    place = np.minimum(np.searchsorted(known, words), len(known) - 1)
    met = known[place] == words
    lefts, rights = [], []
    for i in range(len(size)):
        here = place[at[i] : at[i + 1]][met[at[i] : at[i + 1]]]
        shared = np.bincount(owner[ranges(first[here], count[here])], minlength=len(p_size))
        n, behind = size[i], size[i] - (at[i + 1] - at[i])
        can = np.flatnonzero(shared)
        p_n = p_size[can]
        before = np.searchsorted(order[at[i] : at[i + 1]], p_last[can], side="right")
        rest = np.where(last[i] <= p_last[can], behind, np.minimum(p_behind[can], n - before))
        can = can[(3 * (shared[can] + rest) >= n + p_n) & (n <= 2 * p_n) & (p_n <= 2 * n)]
        lefts.append(np.full(len(can), i))
        rights.append(can)
    left, right = pa.array(np.concatenate(lefts)), pa.array(np.concatenate(rights))
    return pa.table({"k1": mine.column("k1").take(left), "k2": mine.column("k2").take(left), "p1": other.column("k1").take(right), "p2": other.column("k2").take(right)})


def meeting(asks: DataFrame, theirs: DataFrame) -> DataFrame:
    """Sets of tokens (``tokens`` and ``p_tokens`` with ``who``) of one group that can share half of their union: they
    share enough leading tokens, and sizes differ by twice at most. Tokens are compared by hashes that say the group too,
    in blocks (``in_blocks``), so no pair is shuffled that can't be alike; equal hashes of different tokens only add pairs.
    """
    keyed = lambda df: df.withColumn("k1", F.xxhash64(*GROUP, "tokens")).withColumn("k2", F.xxhash64(F.lit(1), *GROUP, "tokens"))
    mine, other = keyed(asks), keyed(theirs)
    hashed = lambda df: df.where(F.size("tokens") > 0).select("k1", "k2", F.xxhash64(*GROUP).alias("group"), F.transform("tokens", lambda t: F.hash(*GROUP, t)).alias("hashes"))
    counter = F.explode("hashes").alias("h")
    rows = hashed(other).select(counter).groupBy(F.col("h").bitwiseAND(COUNTERS - 1).alias("h")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts = np.zeros(COUNTERS, np.int32)
    counts[rows.column("h").to_numpy()] = np.minimum(rows.column("n").to_numpy(), 1 << 30)
    heads = [saved(_prefixes(hashed(df), counts)) for df in (mine, other)]
    met = saved(in_blocks(*heads, lambda a, b: _alike_heads(a, b, counts), "k1 long, k2 long, p1 long, p2 long", F.size("head"), [F.col("k1")], F.col("group")))
    p_rows = other.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("tokens").alias("p_tokens"), "who")
    return mine.join(met, ["k1", "k2"]).drop("k1", "k2").join(p_rows, ["p1", "p2"]).select(*GROUP, "tokens", "p_tokens", "who")


def half_alike(asks: DataFrame, theirs: DataFrame) -> DataFrame:
    """(group, tokens, who, text): for each set of ``asks`` the most similar one of ``theirs`` in its group, of those with
    a Jaccard similarity of one half or more; the first at a tie."""
    text = jaccard(F.col("tokens"), F.col("p_tokens"))
    scored = meeting(asks, theirs).withColumn("text", text).where(F.col("text") >= 0.5)
    best = scored.groupBy(*GROUP, "tokens").agg(F.min(F.struct((-F.col("text")).alias("t"), "who")).alias("best"))
    return best.select(*GROUP, "tokens", F.col("best.who").alias("who"), (-F.col("best.t")).alias("text"))


def dispositions(new: DataFrame, prior: DataFrame) -> DataFrame:
    """New claims with disposition, target, reason and final id. Claims that name an id of their own (``claim_id``
    neither null nor ``<new>``) keep it."""
    reuse = exact_reuse(new, prior).withColumnRenamed("target_id", "_reuse")
    open_ = new.join(reuse.select("id"), "id", "left_anti")
    likely = probable_duplicates(open_, prior).select("id", F.col("target_id").alias("_likely"), F.col("score").alias("_score"), F.col("dominant").alias("_dominant"))
    joined = with_keys(new.join(reuse, "id", "left").join(likely, "id", "left"))
    named = F.lit(False)
    if "claim_id" in new.columns:
        named = F.coalesce(~F.col("claim_id").isin("<new>", ""), F.lit(False))
    made = stable_id(F.col("subject"), F.col("predicate"), F.col("text"), F.col("primary_home"))
    kind = F.when(named, "new_claim").when(F.col("_reuse").isNotNull(), "reuse_existing").when(F.col("_likely").isNotNull(), "probable_duplicate").otherwise("new_claim")
    reason = F.when(named, F.lit(None)).when(F.col("_reuse").isNotNull(), "exact_normalized_match").when(
        F.col("_likely").isNotNull(), F.concat(F.lit("composite_"), F.format_string("%.2f", "_score"), F.lit("_"), "_dominant")
    ).otherwise("no_candidates_above_threshold")
    final = F.when(named, F.col("claim_id") if "claim_id" in new.columns else None).otherwise(F.coalesce("_reuse", made))
    return joined.select(
        *new.columns, kind.alias("disposition"), F.when(~named, F.coalesce("_reuse", "_likely")).alias("duplicate_target"),
        reason.alias("duplicate_reason"), signature().alias("normalization_signature"), final.alias("final_id")
    )


def route_state(kind: Column, home: Column) -> dict[str, Column]:
    """state, score and suggested home of a type in a home, by lookup tables."""
    table = lambda values: F.create_map(*[F.lit(x) if not isinstance(x, list) else F.array(*[F.lit(y) for y in x]) for kv in values.items() for x in kv])
    strong = F.try_element_at(table({k: v[0] for k, v in AFFINITY.items()}), blank(kind))
    acceptable = F.try_element_at(table({k: v[1] for k, v in AFFINITY.items()}), blank(kind))
    impossible = F.try_element_at(table({k: v[2] for k, v in AFFINITY.items()}), blank(kind))
    has = lambda a: F.coalesce(F.array_contains(a, blank(home)), F.lit(False))
    state = F.when(strong.isNull(), "suspicious").when(has(impossible), "impossible").when(
        strong.eqNullSafe(home), "strong"
    ).when(has(acceptable), "acceptable").otherwise("suspicious")
    score = F.try_element_at(table(ROUTE_SCORES), state)
    return {"route_state": state, "route_score": score, "route_suggested": F.when(state != "strong", strong)}


def with_routes(claims: DataFrame) -> DataFrame:
    return claims.withColumns(route_state(F.col("type"), F.col("primary_home")))
