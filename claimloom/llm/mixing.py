"""Mixing sources to target weights: temperature, k-section of the exponent, budgeted block permutations.

DataFrame operations only. Only ids, sources and token counts are shuffled, never texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import text_of, write_table

#: Blocks of a group. An epoch permutes a source's groups, and the blocks in each: no window holds all blocks.
GROUP = 4096
SECTIONS, ROUNDS = 64, 5


def word_count(text: Column) -> Column:
    """Tokens are taken as words: runs without ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_shares(sized: DataFrame) -> DataFrame:
    """A row per source with its tokens ``_t``."""
    return sized.groupBy("_source").agg(F.sum("_tokens").alias("_t"))


def find_exponent(sources: DataFrame, total: int, budget: float | None, target_entropy: float, max_repeats: float) -> tuple[float, str]:
    """The exponent in [0, 1] of the weights p^a / sum(p^a), and what decided it.

    It is the largest one whose weights reach the target entropy ("shares" if the sources' own do, else "entropy"),
    raised where some source would else be repeated more than ``max_repeats`` times by the budget that will be spent
    ("repeats": the entropy yields to the limit). Without a budget that is the least that needs every source once, so a
    source is repeated (p_max / p)^(1 - a) times and exponent 1 always keeps a limit of 1 or more. A budget can ask for
    more than the limit allows whatever the exponent: then exponent 1, which repeats all sources alike, is as near as
    it gets ("budget": the limit yields).

    Each round evaluates 64 exponents in one aggregation over the sources, so 5 rounds narrow the interval as 30
    bisection steps would; the driver sees 130 rows a round, whatever the number of sources.
    """
    p = F.col("_t") / F.lit(float(total))
    live = sources.where("_t > 0").select(p.alias("_p"))
    most = math.log2(max(1, live.count()))
    ent, rep, held = (0.0, 1.0), (0.0, 1.0), True
    for _ in range(ROUNDS):
        grids = [lo + (hi - lo) * i / SECTIONS for lo, hi in (ent, rep) for i in range(SECTIONS + 1)]
        at = live.withColumn("_a", F.explode(F.array(*[F.lit(a) for a in sorted(set(grids))])))
        power = F.pow("_p", "_a")
        z = F.sum(power)
        each = F.pow("_p", F.col("_a") - 1)
        repeats = F.max(each) / F.min(each) if budget is None else F.max(each) / z * (budget / total)
        got = at.groupBy("_a").agg((F.log2(z) - F.col("_a") * F.sum(power * F.log2("_p")) / z).alias("h"), repeats.alias("r")).collect()
        flat = {x["_a"]: x["h"] >= target_entropy * most - 1e-12 for x in got}
        calm = {x["_a"]: x["r"] <= max_repeats * (1 + 1e-12) for x in got}
        held = calm.get(1.0, held)
        g = [a for a in sorted(flat) if ent[0] <= a <= ent[1]]
        ok = [a for a in g if flat[a]]
        ent = (1.0, 1.0) if flat.get(1.0) else (max(ok, default=0.0), min((a for a in g if a > max(ok, default=0.0)), default=1.0))
        g = [a for a in sorted(calm) if rep[0] <= a <= rep[1]]
        ok = [a for a in g if calm[a]]
        least = min(ok, default=1.0)
        rep = (0.0, 0.0) if calm.get(0.0) else (max((a for a in g if a < least), default=0.0), least)
    if not held:
        return 1.0, "budget"
    if rep[1] > ent[0]:
        return rep[1], "repeats"
    return ent[0], "shares" if ent[0] == 1.0 else "entropy"


def mixing_plan(sized: DataFrame, budget: float | None, target_entropy: float, max_repeats: float, block_tokens: int) -> DataFrame:
    """A row per source: tokens, weight, repeats ``_r`` (its target tokens over its tokens), number of blocks, and
    what decided the exponent (null where no source has a token)."""
    sources = write_table(source_shares(sized), "sources")
    total = sources.agg(F.sum("_t")).first()[0] or 0
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_t") / block_tokens)).cast("long").alias("_blocks")
    if not total:
        return sources.select("_source", "_t", F.lit(0.0).alias("_w"), F.lit(1.0).alias("_r"), blocks, F.lit(None).cast("string").alias("_by"))
    wanted = None if budget is None else float(budget or total)
    a, by = find_exponent(sources, total, wanted, target_entropy, max_repeats)
    p = F.when(F.col("_t") > 0, F.pow(F.col("_t") / F.lit(float(total)), F.lit(a))).otherwise(0.0)
    z = sources.agg(F.sum(p)).first()[0]
    weighed = sources.withColumn("_w", p / F.lit(z))
    if wanted is None:
        # No budget: the least one that needs every source once, so nothing is left out.
        wanted = float(weighed.where("_t > 0").agg(F.max(F.col("_t") / F.col("_w"))).first()[0])
    repeats = F.when(F.col("_t") > 0, F.col("_w") * F.lit(wanted) / F.col("_t")).otherwise(1.0)
    # Repeats that differ from a whole number by rounding errors are that number.
    near = F.when(F.abs(repeats - F.round(repeats)) < 1e-9, F.round(repeats)).otherwise(repeats)
    return weighed.select("_source", "_t", "_w", near.alias("_r"), blocks, F.lit(by).alias("_by"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", budget: float | None = None,
    target_entropy: float = 0.9, max_repeats: float = 4.0, block_tokens: int = 1 << 20, seed: int = 17
) -> DataFrame:
    """The mixture, a row for each time a document is used: id, source, tokens, weight of the source, epoch,
    block, start (tokens of the source's epoch before this row), repeats (how often the plan uses the source's tokens)
    and decided_by (see ``find_exponent``): "repeats" means that the entropy is missed for the limit's sake, "budget"
    that the limit is, since the budget is above ``max_repeats`` times all tokens.

    Source shares are raised to the exponent of ``find_exponent`` (``target_entropy`` is a part of the largest
    possible entropy) and normalised to weights. ``budget`` tokens are dealt by these weights; by default the
    least budget for which every document is used at least once, so that mixing repeats (each source's tokens
    ``max_repeats`` times at most) but drops nothing.
    A source with weight w gets w * budget tokens: whole epochs, then a part of one. Each epoch permutes the
    source's blocks (those of each GROUP, and the groups) and the rows inside each block by a hash; the last epoch
    takes rows in that order while less than the budget has been dealt, so a source ends at most one row above its
    budget.

    A null source is a source of its own; null and empty texts have 0 tokens; a source without tokens is used
    once. Rows with equal ids are rows of their own. An empty table gives no rows. A hot source only means
    more blocks of about ``block_tokens``: no window holds more rows than one block has, or GROUP blocks, or one row for
    each group of a source.
    """
    sized = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(text_of(text_col)).alias("_tokens"))
    sized = write_table(sized, "sized")
    plan = mixing_plan(sized, budget, target_entropy, max_repeats, block_tokens)
    used = _permuted(sized, plan, seed)
    return used.select(
        F.col("_id").alias(id_col), F.col("_source").alias(source_col), F.col("_tokens").alias("tokens"), F.col("_w").alias("weight"),
        F.col("_epoch").alias("epoch"), F.col("_block").alias("block"), F.col("_start").alias("start"), F.col("_r").alias("repeats"),
        F.col("_by").alias("decided_by")
    )


def _permuted(sized: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    plan = write_table(plan, "plan")
    # (none, value) stands for the source, so that a null joins like any value.
    key = [F.col("_source").isNull().alias("_none"), F.coalesce("_source", F.lit("")).alias("_key")]
    right = plan.select(*key, "_t", "_w", "_r", "_blocks", "_by")
    rows = sized.select("*", *key).join(right, ["_none", "_key"]).withColumn("_block", F.pmod(F.xxhash64(F.lit(seed), "_id"), "_blocks"))
    epochs = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil("_r").cast("int") - 1))
    rows = rows.where("_r > 0").withColumn("_epoch", F.explode(epochs))
    home = ["_none", "_key", "_epoch"]
    inside = Window.partitionBy(*home, "_block").orderBy(F.xxhash64(F.lit(seed), "_epoch", "_id"), "_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_cum", F.sum("_tokens").over(inside) - F.col("_tokens"))
    sums = sized.select("*", *key).join(right, ["_none", "_key"]).withColumn(
        "_block", F.pmod(F.xxhash64(F.lit(seed), "_id"), "_blocks")
    ).groupBy("_none", "_key", "_block", "_r").agg(F.sum("_tokens").alias("_bt"))
    blocks = sums.where("_r > 0").withColumns({"_epoch": F.explode(epochs), "_group": F.floor(F.col("_block") / GROUP)})
    grouped = Window.partitionBy(*home, "_group")
    blocks = blocks.withColumn("_in", F.sum("_bt").over(grouped.orderBy(F.xxhash64(F.lit(seed), "_epoch", "_block"), "_block")) - F.col("_bt"))
    groups = blocks.groupBy(*home, "_group").agg(F.sum("_bt").alias("_gt"))
    order = Window.partitionBy(*home).orderBy(F.xxhash64(F.lit(seed), "_epoch", "_group"), "_group")
    groups = groups.select(*home, "_group", (F.sum("_gt").over(order) - F.col("_gt")).alias("_ahead"))
    starts = blocks.join(groups, [*home, "_group"]).select(*home, "_block", (F.col("_ahead") + F.col("_in")).alias("_before"))
    placed = rows.join(starts, [*home, "_block"]).withColumn("_start", F.col("_before") + F.col("_cum"))
    part = (F.col("_r") - F.col("_epoch")) * F.col("_t")
    return placed.where((F.col("_r") - F.col("_epoch") >= 1) | (F.col("_start") < part) | (F.col("_t") == 0))


def repeat_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture uses its id (see ``mix_sources``); columns as given.

    Rows that share an id share its uses evenly, the first of them taking what is left over.
    """
    uses = mix_sources(docs, id_col, source_col, text_col, **how).groupBy(F.col(id_col).alias("_uid")).agg(F.count(F.lit(1)).alias("_uses"))
    key = lambda c: [F.col(c).isNull().alias("_none"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("_key")]
    joined = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), *key(id_col)).join(uses.select(*key("_uid"), "_uses"), ["_none", "_key"])
    same = Window.partitionBy("_none", "_key")
    many = joined.withColumn("_n", F.count(F.lit(1)).over(same)).withColumn("_rank", F.row_number().over(same.orderBy(F.xxhash64("_doc"))))
    times = F.floor(F.col("_uses") / F.col("_n")) + F.when(F.col("_rank") <= F.col("_uses") % F.col("_n"), 1).otherwise(0)
    return many.withColumn("_again", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).select("_doc.*")
