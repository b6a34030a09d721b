"""The Merkle manifest against plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from claimloom.llm.merkle import merkle_manifest
from edge import docs, nothing

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def changed():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 0


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, low):
    out = ""
    for k in FIELDS:
        v = row[k]
        if v is not None:
            v = str(v) if k != "text" or not low else "".join(c.lower() if "A" <= c <= "Z" else c for c in v)
        out += "-" if v is None else f"{len(v.encode())}:{v}"
    return digest(out)


def tree(nodes, run):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + run])) for i in range(0, len(levels[-1]), run)])
    return levels


def way(levels, i, run):
    out = []
    for nodes in levels[:-1]:
        first = i // run * run
        out.append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + run])))
        i //= run
    return out


def brute(rows, run=8):
    groups, out = {}, []
    for r in rows:
        groups.setdefault((r["lang"] is not None, (r["lang"] or "").encode()), []).append(r)
    for own in groups.values():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, False)))
    trees = {g: tree([leaf(r, False) for r in own], run) for g, own in groups.items()}
    top = tree([trees[g][-1][0] for g in sorted(groups)], run)
    for j, g in enumerate(sorted(groups)):
        for i, r in enumerate(groups[g]):
            steps = way(trees[g], i, run) + way(top, j, run)
            now = leaf(r, r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0)
            for left, right in steps:
                now = digest(left + now + right)
            root = top[-1][0]
            out.append((r["doc_id"], leaf(r, False), trees[g][-1][0], root, digest("".join(a + b for a, b in steps)), now, now == root))
    return sorted(out, key=str)


def many(spark):
    """A hot group, many small ones, a lone leaf, ties of ids, rows repeated whole."""
    given = [(i % 50, None if i % 7 == 0 else "X" * (i % 3), ["a", "é", None, "zz", ""][i % 5] if i < 200 else "hot", i % 4, "s") for i in range(800)]
    given += [(None, None, None, None, None)] * 20 + [(1, "T", "lone", 1, "q")] + [(i, "Aa", f"lang{i}", None, "") for i in range(70)]
    return spark.createDataFrame(given, "doc_id long, text string, lang string, n_chars long, source string")


@pytest.mark.parametrize("run, levels", [(8, 3), (8, 1), (2, 2)])
def test_manifest(spark, run, levels):
    given = many(spark)
    got = merkle_manifest(given, tampered=changed(), run=run, levels=levels)
    assert sorted(map(tuple, got.collect()), key=str) == brute([r.asDict() for r in given.collect()], run)


def test_edge_rows(spark):
    given = docs(spark)
    rows = [r.asDict() for r in given.collect()]
    assert sorted(map(tuple, merkle_manifest(given, tampered=changed()).collect()), key=str) == brute(rows)
    assert all(r["verified"] for r in merkle_manifest(given).collect())
    assert merkle_manifest(nothing(spark)).collect() == []


def test_one_group_is_spread(spark):
    """All rows in one group and with one id: the blocks' leaves come from many partitions."""
    given = spark.range(4000).select(F.lit(1).alias("doc_id"), F.col("id").cast("string").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    got = merkle_manifest(given)
    assert got.agg(F.min("verified"), F.countDistinct("subroot"), F.countDistinct("proof_sha256")).first() == (True, 1, 4000)
