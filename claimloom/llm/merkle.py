"""A Merkle manifest of a dataset: leaf, proof and root for every row, by higher-order functions over fixed-size blocks.

Rows are ranked inside their group by range partition, and cut into blocks of ``run ** levels`` leaves. A block is one
row with an ordered array, whose levels collapse with ``transform`` over a ``sequence`` of ``slice``s; its root is a
leaf of the next round, until each group has one node left. The groups' roots are the leaves of a last tree. Proofs come
back the same way: a round's blocks get the steps from their own root up, and hand each entry those below it in front.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import drop_tables, write_table

RUN, LEVELS = 8, 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = "array<struct<l:string,r:string>>"


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(*values: Column) -> Column:
    """The digest of a row's values: ``-`` for null, else the number of bytes, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return _digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _fixed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column as one that is computed once a row: what stands above a generator doesn't evaluate its input anew."""
    return df.withColumn(name, F.explode(F.array(value)))


def _ranked(rows: DataFrame, order: list[str], tag: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (written) with ``pos`` from 0 inside ``g`` and the group's size ``n``; and the table to delete afterwards.

    Rows are dealt by range and written, so the partitions are fixed; a partition's rows are numbered in it and the
    numbers of those before are added. A group may hold all rows: it is spread over many partitions.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Equal rows differ in their place in the written table, so they too are spread.
    keys = ["g", *order, "_tie"]
    dealt = write_table(
        rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()), tag
    )
    counts = dealt.groupBy("g", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy("g")
    firsts = counts.select(
        F.col("g").alias("_g"), F.col("_part").alias("_p"),
        (F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows")).alias("_first"),
        F.sum("_rows").over(whole).alias("n")
    )
    numbered = dealt.withColumn("_rn", F.row_number().over(Window.partitionBy("g", "_part").orderBy(*order, "_tie")))
    joined = numbered.join(firsts, (F.col("g") == F.col("_g")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn("pos", F.col("_first") + F.col("_rn") - 1).drop("_g", "_p", "_part", "_rn", "_first", "_tie"), dealt


def _next_level(level: str, run: int) -> Column:
    """The digests of every ``run`` consecutive nodes of an array that isn't empty."""
    starts = F.sequence(F.lit(1), F.size(level), F.lit(run))
    return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(level, i, run), ""), 256))


def _blocks(nodes: DataFrame, run: int, levels: int, carry: Sequence[str]) -> DataFrame:
    """(g, n, pos, own, lv0 ..): blocks of ``run ** levels`` nodes of a group and the hashes of their levels; the last
    has the root alone. ``n`` and ``pos`` are now of the blocks."""
    size = run**levels
    entry = F.struct("pos", "hash", *carry)
    out = nodes.groupBy("g", "n", F.floor(F.col("pos") / size).alias("block")).agg(F.sort_array(F.collect_list(entry)).alias("own"))
    out = _fixed(out, "lv0", F.transform("own", lambda x: x["hash"]))
    for k in range(levels):
        collapsed = F.when((F.col("n") > size) | (F.size(f"lv{k}") > 1), _next_level(f"lv{k}", run)).otherwise(F.col(f"lv{k}"))
        out = _fixed(out, f"lv{k + 1}", collapsed)
    return out.select("g", F.ceil(F.col("n") / size).alias("n"), (F.col("n") > size).alias("many"), F.col("block").alias("pos"), "own", *[f"lv{k}" for k in range(levels + 1)])


def _proofs(blocks: DataFrame, above: DataFrame, run: int, levels: int, carry: Sequence[str]) -> DataFrame:
    """(g, pos, hash, carry, steps, top): for every entry of a block its siblings at each level of the block, left and
    right of it, then those ``above`` has for the block; ``top`` is what it has for the root."""
    rest = above.select(F.col("g").alias("_g"), F.col("pos").alias("_pos"), F.col("steps").alias("_steps"), "top")
    joined = blocks.join(rest, (F.col("g") == F.col("_g")) & (F.col("pos") == F.col("_pos")))
    out = joined.select("g", "many", "_steps", "top", *[f"lv{k}" for k in range(levels)], F.posexplode("own").alias("_i", "_e"))
    steps = []
    for k in range(levels):
        at = F.floor(F.col("_i") / run**k)  # the entry's ancestor in this level
        first = F.floor(at / run) * run
        left, right = F.slice(f"lv{k}", (first + 1).cast("int"), (at - first).cast("int")), F.slice(f"lv{k}", (at + 2).cast("int"), (first + run - 1 - at).cast("int"))
        step = F.array(F.struct(F.array_join(left, "").alias("l"), F.array_join(right, "").alias("r")))
        steps.append(F.when(F.col("many") | (F.size(f"lv{k}") > 1), step).otherwise(F.array().cast(STEP)))
    return out.select("g", F.col("_e.pos").alias("pos"), *[F.col("_e")[c].alias(c) for c in ("hash", *carry)], F.concat(*steps, "_steps").alias("steps"), "top")


def _tree(nodes: DataFrame, most: int, run: int, levels: int, carry: Sequence[str] = ()) -> tuple[DataFrame, list[DataFrame]]:
    """The tree over each group's nodes (g, n, pos, hash): every node with its steps to the group's root ``top``.
    ``most`` is the largest group's number of nodes. Also the tables written, a block a row."""
    rounds, now = [], nodes
    while not rounds or most > 1:
        blocks = write_table(_blocks(now, run, levels, () if rounds else carry), "merkle")
        rounds.append(blocks)
        now = blocks.select("g", "n", "pos", F.element_at(f"lv{levels}", 1).alias("hash"))
        most = -(-most // run**levels)
    above = now.select("g", "pos", F.array().cast(STEP).alias("steps"), F.col("hash").alias("top"))
    for k in range(len(rounds) - 1, -1, -1):
        above = _proofs(rounds[k], above, run, levels, () if k else carry)
    return above, rounds


def merkle_manifest(
    docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id", group_col: str = "lang",
    text_col: str = "text", tampered: Column | None = None, run: int = RUN, levels: int = LEVELS
) -> DataFrame:
    """A row per row of ``docs``: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of the ``fields`` (see ``leaf_of``). The leaves of a group of ``group_col`` ascend by id, null
    ids first, equal ids by their leaf; while more than one node is left, every ``run`` consecutive ones become the
    digest of their joined hex digests. A group's last node is its subroot, a lone leaf itself; subroots, null group
    first and then by the bytes of the group's name, make the root in the same way. ``proof_sha256`` is the digest of
    the siblings on a leaf's way to the root. ``folded_root`` is computed anew from the leaf and these siblings; where
    ``tampered`` (a condition on ``docs``) holds, the leaf is that of the text with A-Z in lower case.

    Null values count as such (``-``), an empty text is no null. Rows that are equal in all fields each have a place of
    their own. An empty table gives no rows. Other columns of ``docs`` have no effect, and none is carried along. Only
    digests and ids are shuffled; a block holds ``run ** levels`` of them, whatever the size of a group.
    """
    changed = [F.translate(F.col(c), UPPER, LOWER) if c == text_col else F.col(c) for c in fields]
    other = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf_of(*changed))
    group = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    leaves = write_table(docs.select(group.alias("g"), F.col(id_col).alias("id"), leaf_of(*[F.col(c) for c in fields]).alias("hash"), other.alias("other")), "leaves")
    nodes, dealt = _ranked(leaves, ["id", "hash"], "ranked")
    sizes = dealt.groupBy("g").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("groups")).first()
    drop_tables(leaves)
    rows, used = _tree(nodes, sizes["most"] or 0, run, levels, ("id", "other"))
    # A block's table has a group's last node once, however many blocks the group had.
    last = used[-1].select("g", F.element_at(f"lv{levels}", 1).alias("hash"))
    tops = write_table(last.select(F.lit("").alias("g"), F.col("g").alias("name"), "hash"), "subroots")
    top_nodes, _ = _ranked(tops, ["name"], "ranked")
    upper, _ = _tree(top_nodes, sizes["groups"], run, levels, ("name",))
    upper = upper.select(F.col("name").alias("_g"), F.col("steps").alias("_upper"), F.col("top").alias("root"))
    found = rows.join(upper, F.col("g") == F.col("_g"))
    found = _fixed(found.select("id", "hash", "other", F.col("top").alias("subroot"), "root", F.concat("steps", "_upper").alias("steps")), "steps", F.col("steps"))
    proof = F.sha2(F.array_join(F.transform("steps", lambda x: F.concat(x["l"], x["r"])), ""), 256)
    folded = F.aggregate("steps", F.coalesce("other", "hash"), lambda at, x: F.sha2(F.concat(x["l"], at, x["r"]), 256))
    out = found.select(F.col("id").alias(id_col), F.col("hash").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
