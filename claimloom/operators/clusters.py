"""Survivors grouped by their merge hints."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.text import entity_mentions, short_hash
from claimloom.operators.saving import forget, saved
from claimloom.schemas import DEFAULT_HOME, UNKNOWN_TYPE


def merge_components(edges: DataFrame, nodes: DataFrame, sizes: list[int] | None = None) -> DataFrame:
    """(id, component) for every node: the least id it is connected with through ``edges`` (src, dst) whose ends are
    both nodes.

    By contraction. In a round each node that has a smaller neighbour points to its least one; pointers are followed to
    their ends, the ends replace the nodes in the edges, and edges inside a component go. Only nodes that still have
    edges take part in a round, so rounds shrink; the rounds' pointers are followed one after the other at last. What a
    round leaves are its pointers alone. ``sizes`` gets the number of edges of each round.
    """
    ids = nodes.select("id").distinct()
    inside = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    now, rounds = saved(_undirected(inside)), []
    while (count := now.count()) > 0:
        if sizes is not None:
            sizes.append(count)
        both = now.select("src", "dst").unionByName(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        pointers = _followed(saved(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.col("src")).alias("to"))))
        to = lambda end, pointers=pointers: pointers.select(F.col("node").alias(end), F.col("to").alias(f"new_{end}"))
        moved = now.join(to("src"), "src").join(to("dst"), "dst").select(F.col("new_src").alias("src"), F.col("new_dst").alias("dst"))
        after = saved(_undirected(moved))
        forget(now)
        rounds.append(pointers)
        now = after
    forget(now)
    if not rounds:
        return ids.withColumn("component", F.col("id"))
    # Nodes of a round are ends of the round before.
    whole = rounds[-1]
    for earlier in reversed(rounds[:-1]):
        later = whole.select(F.col("node").alias("to"), F.col("to").alias("_end"))
        whole = earlier.join(later, "to", "left").select("node", F.coalesce("_end", "to").alias("to"))
    labels = saved(ids.join(whole.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("to", "id").alias("component")))
    forget(*rounds)
    return labels


def _undirected(edges: DataFrame) -> DataFrame:
    """Each pair once, the greater id first; without loops."""
    return edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()


def _followed(pointers: DataFrame) -> DataFrame:
    """Pointers to the ends of the ways of pointers: each step doubles how far they go."""
    while True:
        further = pointers.select(F.col("node").alias("to"), F.col("to").alias("_next"))
        after = saved(pointers.join(further, "to").select("node", F.col("_next").alias("to"), (F.col("_next") != F.col("to")).alias("moved")))
        forget(pointers)
        if after.where("moved").isEmpty():
            return after
        pointers = after.drop("moved")
        pointers._saved_at = after._saved_at


def cluster_ids(components: DataFrame) -> DataFrame:
    """(component, cluster_id, members): the id is a hash of the sorted members."""
    members = F.array_sort(F.collect_list("id"))
    return components.groupBy("component").agg(short_hash(F.array_join(members, "|"), "clust-").alias("cluster_id"), F.count(F.lit(1)).alias("members"))


def first_mode(rows: DataFrame, group: str, value: str, order: list[str], out: str) -> DataFrame:
    """The most frequent non-null value of each group; at a tie the one seen first by ``order``."""
    counted = rows.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(group, value).agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct(*order)).alias("_first")
    )
    best = Window.partitionBy(group).orderBy(F.desc("_n"), "_first")
    return counted.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").select(group, F.col(value).alias(out))


def shared_entities(members: DataFrame, group: str) -> DataFrame:
    """(group, entities): mentions that every member (id, text) has, sorted."""
    sizes = members.groupBy(group).agg(F.countDistinct("id").alias("_size"))
    mentions = members.select(group, "id", F.explode(F.array_distinct(entity_mentions(F.col("text")))).alias("entity")).distinct()
    everywhere = mentions.groupBy(group, "entity").agg(F.count(F.lit(1)).alias("_n")).join(sizes, group).where("_n = _size")
    found = everywhere.groupBy(group).agg(F.array_sort(F.collect_list("entity")).alias("entities"))
    return sizes.select(group).join(found, group, "left").select(group, F.coalesce("entities", F.array().cast("array<string>")).alias("entities"))


def build_clusters(survivors: DataFrame) -> DataFrame:
    """Clusters of survivors: cluster_id, candidates (sorted by id) and cluster_hints."""
    nodes = survivors.select(F.col("candidate_id").alias("id"))
    edges = survivors.select(F.col("candidate_id").alias("src"), F.explode("merge_candidate_ids").alias("dst"))
    labels = merge_components(edges, nodes)
    members = survivors.join(labels.withColumnRenamed("id", "candidate_id"), "candidate_id")
    shape = F.struct(
        "candidate_id", "text", "type_hint", "source_refs", F.col("verdict").alias("pass_1_verdict"),
        F.col("rationale").alias("pass_1_rationale"), "compress_target"
    )
    grouped = members.groupBy("component").agg(F.array_sort(F.collect_list(shape)).alias("candidates"))
    slim = members.select("component", F.col("candidate_id").alias("id"), "text", "type_hint", "source_refs")
    kinds = first_mode(slim, "component", "type_hint", ["id"], "proposed_type")
    refs = slim.select("component", "id", F.posexplode("source_refs").alias("pos", "ref")).withColumn("source", F.col("ref.source"))
    subjects = first_mode(refs, "component", "source", ["id", "pos"], "shared_subject")
    home = F.create_map(*[F.lit(x) for kv in DEFAULT_HOME.items() for x in kv])
    joined = grouped.join(cluster_ids(labels), "component").join(
        shared_entities(slim, "component"), "component"
    ).join(kinds, "component", "left").join(subjects, "component", "left")
    kind = F.coalesce("proposed_type", F.lit(UNKNOWN_TYPE))
    hints = F.struct(
        F.col("entities").alias("shared_entities"), "shared_subject", kind.alias("proposed_type"),
        F.try_element_at(home, kind).alias("proposed_primary_home"), F.array().cast("array<string>").alias("contradiction_candidates")
    )
    return joined.select("cluster_id", "candidates", hints.alias("cluster_hints"))
