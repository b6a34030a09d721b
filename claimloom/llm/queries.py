"""The queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import class_lm, langid, media_avi, quality_cnn
from claimloom.llm.common import drop_tables, fold_of
from claimloom.llm.alignment import align_tokenizers
from claimloom.llm.exact_dedup import exact_dedup
from claimloom.llm.jaccard_join import jaccard_components
from claimloom.llm.line_dedup import dedup_lines
from claimloom.llm.merkle import merkle_manifest
from claimloom.llm.mixing import mix_sources
from claimloom.llm.packing import pack
from claimloom.llm.sharding import extendible_shards
from claimloom.llm.url_filters import judge_urls

#: (host, path, blocked)
URL_RULES = [("com", "/", False), ("example.com", "/en/", True), ("www.example.com", "/en/", False), ("net", "/es/", True), ("net", "/fr/", True)]
SHARD_BYTES = 64 << 20
#: A limit at which small tables split too, so that splits are held against SQL.
SMALL_SHARD_BYTES = 64 << 10
CAPACITY = 4096
QUALITY_CUT = 0.3


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The vocabulary file, where this machine has it; another place can be given to the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def mixing_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents under sources of very different sizes, so that the exponent is below 1 and small sources repeat."""
    at = F.crc32(F.col("doc_id").cast("string")) % 100
    source = F.when(at < 70, "web").when(at < 94, "books").when(at < 99, "code").otherwise("notes")
    return mix_sources(table(spark, sf_dir, "documents").withColumn("source", source))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible_shards(table(spark, sf_dir, "documents"), limit_bytes=SHARD_BYTES)


def sharding_small_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible_shards(table(spark, sf_dir, "documents"), limit_bytes=SMALL_SHARD_BYTES)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = quality_cnn.learn_quality(docs, table(spark, sf_dir, "labels"), fold_of("doc_id", 5) != 0)
    scored = quality_cnn.score_quality(docs.select("doc_id", "text"), net)
    return scored.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), shingle=4, num=85, den=100)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("clean_text").alias("clean_md5"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), carry=False)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), CAPACITY)


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, fold_of("doc_id", 4) != 2)
    found = langid.predict_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = media_avi.decode_media(media_avi.encode_media(table(spark, sf_dir, "documents")))
    return read.withColumn("feature", media_avi.feature_of()).drop("clips", "error")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, encoded = class_lm.learn_classes(docs, fold_of("doc_id", 7) != 2)
    found = class_lm.score_texts(docs, model, encoded)
    drop_tables(encoded)
    return found.withColumn("held_out", fold_of("doc_id", 7) == 2)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"), tampered=F.crc32(F.col("doc_id").cast("string")) % 3 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_mixing, op2_sharding, op3_quality, op4_jaccard, op5_line_dedup, op6_exact_dedup, op7_packing, op8_langid, op9_media, op10_url_filters, op11_alignment, op12_class_lm, op13_merkle]
    return {f.__name__: f for f in found} | {"pipeline": pipeline, "sharding_small_limit": sharding_small_limit, "mixing_skewed": mixing_skewed}


OP2_SQL = """
WITH RECURSIVE sized AS (
  SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS k,
         CAST(strlen(coalesce(text, '')) AS BIGINT) AS b
  FROM documents),
node AS (
  SELECT 0 AS depth, CAST(0 AS BIGINT) AS prefix, doc_id, k, b,
         sum(b) OVER () AS sb, count(*) OVER () AS sn, min(k) OVER () AS lo, max(k) OVER () AS hi
  FROM sized
  UNION ALL
  SELECT depth + 1, k >> (60 - depth - 1), doc_id, k, b,
         sum(b) OVER w, count(*) OVER w, min(k) OVER w, max(k) OVER w
  FROM node WHERE sb > LIMIT_BYTES AND lo < hi AND depth < 60
  WINDOW w AS (PARTITION BY k >> (60 - depth - 1)))
SELECT doc_id, b AS bytes, depth, prefix, CAST(0 AS BIGINT) AS overflow, CAST(sb AS BIGINT) AS shard_bytes, sn AS shard_docs
FROM node WHERE sb <= LIMIT_BYTES OR lo = hi
"""

OP5_SQL = r"""
WITH line AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
one AS (
  SELECT doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS l FROM line),
win AS (
  SELECT doc_id, pos, l AS l1, lead(l, 1) OVER w AS l2, lead(l, 2) OVER w AS l3 FROM one
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
three AS (
  SELECT doc_id, pos, l1 || chr(10) || l2 || chr(10) || l3 AS k FROM win WHERE l3 IS NOT NULL),
ranked AS (
  SELECT doc_id, pos, row_number() OVER w AS rn, first_value(doc_id) OVER w AS fd, first_value(pos) OVER w AS fa
  FROM three WINDOW w AS (PARTITION BY k ORDER BY doc_id, pos)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(CASE WHEN fd = doc_id THEN greatest(pos, fa + 3) ELSE pos END, pos + 3)) AS pos
  FROM ranked WHERE rn > 1),
left_over AS (
  SELECT o.doc_id, o.pos, o.l, g.pos IS NOT NULL AS cut FROM one o LEFT JOIN gone g ON o.doc_id = g.doc_id AND o.pos = g.pos)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE cut) AS n_removed,
       md5(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (WHERE NOT cut), '')) AS clean_md5
FROM left_over GROUP BY doc_id
"""

OP6_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id)
"""

OP10_SQL = r"""
WITH rules(rhost, rpath, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fit AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC) AS rn
  FROM parts LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fit WHERE rn = 1
"""

# crc32 has no function there: a bit at a time over the digits' bytes.
OP13_SQL = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang, text,
         concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
         xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda a, x: CASE WHEN xor(a, x) & 1 = 1 THEN xor(xor(a, x) >> 1, 3988292384) ELSE xor(a, x) >> 1 END)) % 3 = 0 AS changed
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(text) || ':' || CASE WHEN changed THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS cur
  FROM f),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes AS (
  SELECT 0 AS lvl, lang, pos, n, leaf AS h FROM ranked
  UNION ALL
  SELECT lvl + 1, lang, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lvl, lang, pos // 8, n),
tops AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper_nodes AS (
  SELECT 0 AS lvl, pos, n, subroot AS h FROM tops
  UNION ALL
  SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM upper_nodes WHERE n > 1 GROUP BY lvl, pos // 8, n),
low AS (
  SELECT r.lang, r.pos, x.lvl,
         coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (WHERE x.pos < r.pos // (8 ** x.lvl)::BIGINT), '') AS l,
         coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (WHERE x.pos > r.pos // (8 ** x.lvl)::BIGINT), '') AS r
  FROM ranked r JOIN nodes x ON x.lang IS NOT DISTINCT FROM r.lang AND x.n > 1 AND x.pos // 8 = r.pos // (8 ** (x.lvl + 1))::BIGINT
  GROUP BY ALL),
high AS (
  SELECT t.lang, x.lvl,
         coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (WHERE x.pos < t.pos // (8 ** x.lvl)::BIGINT), '') AS l,
         coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (WHERE x.pos > t.pos // (8 ** x.lvl)::BIGINT), '') AS r
  FROM tops t JOIN upper_nodes x ON x.n > 1 AND x.pos // 8 = t.pos // (8 ** (x.lvl + 1))::BIGINT
  GROUP BY ALL),
below AS (SELECT lang, pos, list(l || '|' || r ORDER BY lvl) AS steps FROM low GROUP BY lang, pos),
above AS (SELECT lang, list(l || '|' || r ORDER BY lvl) AS steps FROM high GROUP BY lang),
ways AS (
  SELECT r.doc_id, r.leaf, r.cur, t.subroot, (SELECT h FROM upper_nodes WHERE n = 1) AS root,
         list_concat(coalesce(b.steps, []), coalesce(a.steps, [])) AS steps
  FROM ranked r JOIN tops t ON t.lang IS NOT DISTINCT FROM r.lang
  LEFT JOIN below b ON b.lang IS NOT DISTINCT FROM r.lang AND b.pos = r.pos
  LEFT JOIN above a ON a.lang IS NOT DISTINCT FROM r.lang),
done AS (
  SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256,
         list_reduce(list_concat([cur], steps), lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root
  FROM ways)
SELECT *, folded_root = root AS verified FROM done
"""


def oracle_sql() -> dict[str, str]:
    limits = {"op2_sharding": SHARD_BYTES, "sharding_small_limit": SMALL_SHARD_BYTES}
    return {k: OP2_SQL.replace("LIMIT_BYTES", str(v)) for k, v in limits.items()} | {"op5_line_dedup": OP5_SQL, "op6_exact_dedup": OP6_SQL, "op10_url_filters": OP10_SQL, "op13_merkle": OP13_SQL}
