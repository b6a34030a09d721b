"""The catalogue's queries as SQL over the same tables."""

from __future__ import annotations

from claimloom.operators.extract import MIN_CHARS
from claimloom.plans.store import TABLES
from claimloom.schemas import (
    AFFINITY, DEFAULT_HOME, DENIED_FILES, DUPLICATE_STOPWORDS, ENTITY_STOPWORDS, HOMES, INACTIVE, MANIFEST_KEYS, PERSONAL_HOMES, PERSONAL_SOURCES, RELATIONS, RETRIEVAL_STOPWORDS, SECTIONS,
    SHARED_SOURCES, SOURCE_TYPES, STATUSES, TYPES, VERDICT_SCORES, VERDICTS,
)
from claimloom.sources.fixtures import CHECKED, HINTS, NAMED, NOW, REMOVED, RUN, STEMS


def _list(values: list) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values: list) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _tokens(x: str, pattern: str, stop: list[str]) -> str:
    return f"list_filter(list_distinct(regexp_extract_all(lower({x}), '{pattern}')), lambda t: NOT list_contains({_list(stop)}, t))"


def _retrieval(x: str) -> str:
    return _tokens(x, "[a-z0-9][a-z0-9._-]{1,}", RETRIEVAL_STOPWORDS)


def _duplicate(x: str) -> str:
    return _tokens(x, "[a-z0-9]+", DUPLICATE_STOPWORDS)


def _jaccard(a: str, b: str) -> str:
    return f"(len(list_intersect({a}, {b})) / greatest(len(list_distinct(list_concat({a}, {b}))), 1)::DOUBLE)"


def _subject(x: str) -> str:
    low = f"lower({_strip(f'coalesce({x}, chr(32))')})"
    bare = f"regexp_replace({low}, '^(the|a|an) ', '')"
    return f"CASE WHEN length({bare}) >= 4 AND regexp_matches({bare}, '[^aeious]s$') THEN substr({bare}, 1, length({bare}) - 1) ELSE {bare} END"


def _predicate(x: str) -> str:
    p = f"lower({_strip(f'coalesce({x}, chr(32))')})"
    out = "CASE"
    for end, least in (("ing", 3), ("ed", 3), ("s", 4)):
        n = len(end)
        out += f" WHEN {p} LIKE '%{end}' AND length({p}) - {n} >= {least} AND regexp_matches(substr({p}, 1, length({p}) - {n}), '[a-z]$') THEN substr({p}, 1, length({p}) - {n})"
    return out + f" ELSE {p} END"


def _score(name: str, k: int) -> str:
    return f"((doc_id * {k}) % 101) / 100.0::DOUBLE"


_WORD = "\\p{L}\\p{M}\\p{Nd}\\p{Pc}"  # characters of words
_SCORES = dict(zip(VERDICT_SCORES, (3, 7, 11, 13, 17, 19), strict=True))
_TOTAL = " + ".join(_score(n, k) for n, k in list(_SCORES.items())[:5]) + f" - {_score('noise_risk', 19)}"
_UPDATED = "CAST(DATE '2024-01-01' + CAST(doc_id // 24 AS INTEGER) AS VARCHAR) || 'T' || lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || ':00:00Z'"
_LATEST = "(updated_at = '') DESC, updated_at DESC"

_SAID = f"'operator ' || ({_list(STEMS)})[(doc_id // 4) % 6 + 1] || ' ' || lang || ' item ' || (doc_id % 10) || ' source ' || source AS text"

CTES = {
    "src_docs": "SELECT doc_id, 'doc/' || doc_id || '.md' AS path, replace(coalesce(text, ''), '.' || chr(10), '.' || chr(10) || chr(10)) AS text FROM documents",
    "sections_docs": "SELECT doc_id, replace(coalesce(text, ''), '.' || chr(10), '.' || chr(10) || '## ') AS text FROM documents",
    "src_lines": f"SELECT doc_id, path, unnest(range(1, len(ls) + 1)) AS n, unnest(ls) AS l FROM (SELECT doc_id, path, string_split(text, chr(10)) AS ls FROM src_docs)",
    "src_marked": f"SELECT *, {_strip('l')} IN ('', '---', '___', '***') AS gap, sum(CASE WHEN {_strip('l')} IN ('', '---', '___', '***') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS island FROM src_lines",
    "src_units": f"SELECT doc_id, path, min(n) AS line_start, max(n) AS line_end, {_strip('string_agg(l, chr(10) ORDER BY n)')} AS body, bool_and(starts_with({_strip('l')}, '#')) AS headings FROM src_marked WHERE NOT gap GROUP BY doc_id, path, island",
    "paragraphs": f"SELECT doc_id, path, CAST(line_start AS INTEGER) AS line_start, CAST(line_end AS INTEGER) AS line_end, body FROM src_units WHERE length(body) >= {MIN_CHARS} AND NOT headings",
    "sec_lines": "SELECT doc_id, unnest(range(1, len(ls) + 1)) AS n, unnest(ls) AS l FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM sections_docs)",
    "sec_marked": f"SELECT *, sum(CASE WHEN l LIKE '## %' THEN 1 ELSE 0 END) OVER w AS head, {_strip('l')} IN ('', '---', '___', '***') AS gap, sum(CASE WHEN {_strip('l')} IN ('', '---', '___', '***') THEN 1 ELSE 0 END) OVER w AS island FROM sec_lines WINDOW w AS (PARTITION BY doc_id ORDER BY n)",
    "sections": f"SELECT doc_id, CAST(min(n) AS INTEGER) AS line_start, CAST(max(n) AS INTEGER) AS line_end, {_strip('string_agg(l, chr(10) ORDER BY n)')} AS body FROM sec_marked WHERE head >= 1 GROUP BY doc_id, head HAVING length({_strip('string_agg(l, chr(10) ORDER BY n)')}) >= {MIN_CHARS} AND NOT bool_and(starts_with({_strip('l')}, '#') OR {_strip('l')} = '')",
    "section_paragraphs": f"SELECT doc_id, CAST(min(n) AS INTEGER) AS line_start, CAST(max(n) AS INTEGER) AS line_end, {_strip('string_agg(l, chr(10) ORDER BY n)')} AS body FROM sec_marked WHERE NOT gap GROUP BY doc_id, island HAVING length({_strip('string_agg(l, chr(10) ORDER BY n)')}) >= {MIN_CHARS} AND NOT bool_and(starts_with({_strip('l')}, '#'))",
    "claims": f"""
  SELECT doc_id AS ord, 'cl-' || substr(sha256(source || '|' || lang || '|' || doc_id), 1, 16) AS id,
    CASE doc_id % 4 WHEN 0 THEN 'topic-' || lang WHEN 1 THEN 'The topic-' || lang WHEN 2 THEN 'topic-' || lang || 's' ELSE upper('topic-' || lang) END AS subject,
    ({_list(STEMS)})[(doc_id // 4) % 6 + 1] || CASE WHEN (doc_id // 24) % 4 = 0 THEN '' ELSE ' via ' || ((doc_id // 24) % 4) END AS predicate,
    CASE WHEN doc_id % 7 <> 0 THEN lang END AS object,
    ({_list(HOMES)})[(doc_id // 2) % 5 + 1] AS primary_home, ({_list(STATUSES)})[(doc_id // 5) % 7 + 1] AS status, ({_list(TYPES)})[doc_id % 14 + 1] AS type,
    doc_id % 3 = 0 AS is_new,
    {_SAID},
    {_UPDATED} AS updated_at,
    list_sort(list_distinct(['src' || (doc_id % 20), 'src' || (doc_id * 7 % 20)])) AS sources,
    CASE WHEN doc_id % 11 = 0 THEN 'cl-' || substr(sha256('near|' || (doc_id + 2)), 1, 16) END AS competing, ({_list(RELATIONS)})[doc_id % 3 + 1] AS relation,
    CASE WHEN doc_id % 13 = 0 THEN (doc_id % 8)::DOUBLE END AS recurrence, CASE WHEN doc_id % 6 = 0 THEN 'tag' || (doc_id % 5) END AS tag,
    CASE WHEN doc_id % 5 = 0 THEN 'high' END AS confidence, lang
  FROM documents""",
    "keyed": f"SELECT *, {_subject('subject')} AS ns, {_predicate('predicate')} AS np, {_strip('primary_home')} AS nh, status NOT IN {_in(INACTIVE)} AS active, {_subject('object')} AS no_, list_sort({_duplicate('text')}) AS toks, epoch(CAST(replace(updated_at, 'Z', '') AS TIMESTAMP)) AS ep FROM claims",
    "reuse": "SELECT n.id, p.id AS target_id, row_number() OVER (PARTITION BY n.id ORDER BY p.ep DESC, p.id) AS rn FROM keyed n JOIN keyed p ON n.is_new AND NOT p.is_new AND p.active AND n.ns = p.ns AND n.np = p.np AND n.nh = p.nh",
    "dup_pairs": f"""
  SELECT n.id, p.id AS target_id, p.ord, 0.4::DOUBLE + (CASE WHEN n.np = p.np THEN 1.0 ELSE 0.0 END)::DOUBLE * 0.2::DOUBLE + 0.2::DOUBLE + {_jaccard('n.toks', 'p.toks')} * 0.2::DOUBLE + (CASE WHEN n.no_ <> '' AND n.no_ = p.no_ THEN 0.1 ELSE 0.0 END)::DOUBLE AS score
  FROM keyed n JOIN keyed p ON n.is_new AND NOT p.is_new AND p.active AND n.ns = p.ns AND n.nh = p.nh
  WHERE n.id NOT IN (SELECT id FROM reuse)""",
    "dups": "SELECT id, target_id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, ord) AS rn FROM dup_pairs WHERE score >= 0.8::DOUBLE",
    "disposed": "SELECT c.id, CASE WHEN r.id IS NOT NULL THEN 'reuse_existing' WHEN d.id IS NOT NULL THEN 'probable_duplicate' ELSE 'new_claim' END AS disposition FROM claims c LEFT JOIN reuse r ON c.id = r.id AND r.rn = 1 LEFT JOIN dups d ON c.id = d.id AND d.rn = 1 WHERE c.is_new",
    "supers": "SELECT n.id AS by_id, n.ord, p.id AS target, p.status FROM claims n JOIN claims p ON p.ord = n.ord + 1 AND NOT p.is_new WHERE n.is_new AND n.ord % 9 = 0",
    "inv": "SELECT doc_id, 'doc/' || doc_id || '.md' AS path, sha256(coalesce(text, '')) AS content_hash FROM documents",
    "inv_prior": "SELECT path, content_hash FROM inv WHERE doc_id % 19 <> 0",
    "inv_cur": "SELECT path, CASE WHEN doc_id % 13 = 0 THEN 'new-' || content_hash ELSE content_hash END AS content_hash FROM inv WHERE doc_id % 17 <> 0",
    "verdicts": f"""
  SELECT doc_id, 'cand-' || doc_id AS candidate_id, {', '.join(f"{_score(n, k)} AS {n}" for n, k in _SCORES.items())}, {_TOTAL} AS total,
    CASE WHEN doc_id % 29 = 0 THEN 1.2::DOUBLE ELSE {_score('durability', 3)} END AS shown,
    CASE WHEN doc_id % 23 = 0 THEN {_TOTAL} + 0.05::DOUBLE ELSE {_TOTAL} END AS strength,
    CASE WHEN doc_id % 31 = 0 THEN 'compress' WHEN ({_TOTAL}) <= 0.5::DOUBLE OR {_score('noise_risk', 19)} >= 0.8::DOUBLE THEN 'reject' WHEN ({_TOTAL}) < 2.0::DOUBLE THEN 'defer' ELSE 'promote' END AS verdict
  FROM documents""",
    "edges": "SELECT doc_id AS src, doc_id + 4 AS dst FROM documents WHERE doc_id % 12 < 8 AND doc_id + 4 IN (SELECT doc_id FROM documents)",
    # An edge goes from id to id + 4 where id % 12 < 8, so a component is {k, k + 4, k + 8} with k % 12 < 4.
    "labels_": "SELECT doc_id AS id, CASE WHEN doc_id % 12 >= 8 THEN doc_id - 8 WHEN doc_id % 12 >= 4 THEN doc_id - 4 ELSE doc_id END AS component FROM documents",
    "clusters": f"""
  SELECT 'clust-' || lang || '-' || lpad(CAST(ord // 30 AS VARCHAR), 8, '0') AS cluster_id, 'topic-' || lang AS qs, string_agg(text, ' ' ORDER BY ord) AS text, arg_min(type, ord) AS qt, arg_min(primary_home, ord) AS qh
  FROM claims WHERE is_new GROUP BY lang, ord // 30""",
    "q": f"SELECT cluster_id, qs, {_retrieval('qs')} AS qst, ['operator'] AS qe, {_retrieval('text')} AS qtok, qt, qh FROM clusters",
    "c": f"SELECT ord, id AS claim_id, updated_at, lower({_strip('subject')}) AS cs, {_retrieval("lower(" + _strip("subject") + ")")} AS cst, {_retrieval('predicate')} AS cp, {_retrieval('text')} AS ct, primary_home AS ch, type AS ctype FROM claims WHERE NOT is_new",
    "scored": f"""
  SELECT cluster_id, claim_id, ord, updated_at, qs <> '' AND qs = cs AS same_subject,
    (CASE WHEN qs <> '' AND qs = cs THEN 3.0 ELSE 0.0 END)::DOUBLE + 2.0::DOUBLE * {_jaccard('qst', 'cst')}
    + 1.5::DOUBLE * least(1.0::DOUBLE, len(list_intersect(qe, ct)) / 1.0::DOUBLE)
    + (CASE WHEN qh = ch THEN 1.0 ELSE 0.0 END)::DOUBLE + (CASE WHEN qt = ctype THEN 0.5 ELSE 0.0 END)::DOUBLE + 1.0::DOUBLE * {_jaccard('qtok', 'ct')}
    + (CASE WHEN len(cp) = 0 THEN 0.0::DOUBLE WHEN len(list_intersect(cp, qtok)) = len(cp) THEN 1.0::DOUBLE ELSE 0.5::DOUBLE * {_jaccard('cp', 'qtok')} END) AS score
  FROM q CROSS JOIN c""",
    "ranked": f"SELECT cluster_id, claim_id, ord, updated_at, score, row_number() OVER (PARTITION BY cluster_id ORDER BY round(score, 9) DESC, {_LATEST}, ord) AS rank FROM scored WHERE score >= 0.5::DOUBLE",
    "border": "SELECT cluster_id, row_number() OVER (ORDER BY cluster_id) AS k FROM (SELECT DISTINCT cluster_id FROM scored WHERE score >= 0.3::DOUBLE AND score < 0.5::DOUBLE)",
    "wide": "SELECT r.* FROM ranked r LEFT JOIN border b USING (cluster_id) WHERE rank <= 5 + CASE WHEN b.k IS NULL THEN 0 ELSE greatest(0, least(3, 30 - 3 * (b.k - 1))) END",
    "scored_recent": "SELECT * REPLACE (score + CASE WHEN same_subject AND epoch(TIMESTAMP '2024-02-05 00:00:00') - epoch(CAST(replace(updated_at, 'Z', '') AS TIMESTAMP)) <= 30 * 86400 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score) FROM scored",
    "ranked_recent": f"SELECT cluster_id, claim_id, ord, updated_at, score, row_number() OVER (PARTITION BY cluster_id ORDER BY round(score, 9) DESC, {_LATEST}, ord) AS rank FROM scored_recent WHERE score >= 0.5::DOUBLE",
    "border_recent": "SELECT cluster_id, row_number() OVER (ORDER BY cluster_id) AS k FROM (SELECT DISTINCT cluster_id FROM scored_recent WHERE score >= 0.3::DOUBLE AND score < 0.5::DOUBLE)",
    "wide_recent": "SELECT r.* FROM ranked_recent r LEFT JOIN border_recent b USING (cluster_id) WHERE rank <= 10 + CASE WHEN b.k IS NULL THEN 0 ELSE greatest(0, least(3, 30 - 3 * (b.k - 1))) END",
    "affinity": "SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{s}', {_list(a)}, {_list(i)})" for t, (s, a, i) in AFFINITY.items()) + ") AS v(type, strong, acceptable, impossible)",
    "routed": "SELECT c.*, CASE WHEN list_contains(a.impossible, primary_home) THEN 'impossible' WHEN a.strong = primary_home THEN 'strong' WHEN list_contains(a.acceptable, primary_home) THEN 'acceptable' ELSE 'suspicious' END AS state, a.strong FROM claims c JOIN affinity a USING (type)",
    "retired": f"SELECT id, sources FROM claims WHERE NOT is_new AND status NOT IN {_in(INACTIVE)} AND len(list_filter(sources, lambda s: NOT list_contains({_list(REMOVED)}, s))) = 0",
    "shown_": f"SELECT * FROM (SELECT * REPLACE (({_list(STATUSES)})[(ord // 11) % 7 + 1] AS status) FROM claims) WHERE status NOT IN {_in(INACTIVE)}",
    "jobs": "SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 'other-' ELSE 'claims-' END || CASE WHEN c_custkey % 2 = 0 THEN 'reconciliation-' ELSE 'incremental-' END || c_custkey AS name, c_custkey % 7 <> 0 AS ok, c_custkey % 60 AS mi, c_custkey % 24 AS ho, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 7 END AS dow, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 3 = 0 END AS deliver FROM customer",
    "job_fires": "SELECT c_custkey, min(t) AS t FROM (SELECT c_custkey, dow, unnest([TIMESTAMP '2025-03-01 00:00:00' + to_days(CAST(k AS INTEGER)) + to_hours(ho) + to_minutes(mi) FOR k IN range(0, 8)]) AS t FROM jobs WHERE ok) WHERE t > TIMESTAMP '2025-03-01 10:30:00' AND (dow IS NULL OR dayofweek(t) = dow) GROUP BY c_custkey",
    "files": f"SELECT CASE WHEN doc_id < {len(NAMED)} THEN ({_list(NAMED)})[doc_id + 1] ELSE ['episodes/', 'memory/', 'notes/'][doc_id % 3 + 1] || doc_id || '.md' END AS path FROM documents",
    "survivors_": f"SELECT doc_id, component, 'd' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS cid, ({_list(HINTS)})[doc_id % 5 + 1] AS hint, ['src' || (doc_id % 4), 'src' || (doc_id % 7)] AS srcs FROM documents JOIN labels_ ON id = doc_id",
    "kinds_": "SELECT component, hint, row_number() OVER (PARTITION BY component ORDER BY count(*) DESC, min(cid)) AS rn FROM survivors_ GROUP BY component, hint",
    "subjects_": "SELECT component, src, row_number() OVER (PARTITION BY component ORDER BY count(*) DESC, min(cid || pos)) AS rn FROM (SELECT component, cid, unnest(srcs) AS src, unnest([0, 1]) AS pos FROM survivors_) GROUP BY component, src",
    "canon": f"SELECT doc_id AS k, 'clust-' || CASE WHEN doc_id % 11 = 0 THEN doc_id + 1 ELSE doc_id END AS id FROM documents",
    "bad": """
  SELECT ord, CASE WHEN ord % 53 = 0 THEN NULL WHEN ord % 59 = 0 THEN 'other-' || (ord + 1) ELSE 'other-' || ord END AS id, CASE WHEN ord % 61 = 0 THEN 'odd' ELSE type END AS type,
    CASE WHEN ord % 67 = 0 THEN 'odd' ELSE status END AS status, CASE WHEN ord % 71 = 0 THEN 'odd' ELSE primary_home END AS home,
    ord % 3 = 0 AND ord % 71 <> 0 AS self_tag, ord % 73 = 0 AS no_text, ord % 73 <> 0 AND ord % 7 = 3 AS long_text, ord % 6 = 1 AS alien, ord % 47 = 0 AS no_source, ord % 5 = 0 AS from_episode,
    CASE WHEN ord % 10 = 0 THEN ['other-' || (ord + 1), 'other-' || ord] WHEN ord % 10 = 4 THEN ['nobody'] WHEN ord % 10 = 6 THEN ['other-' || (ord + 1)] ELSE [] END AS down,
    CASE WHEN ord % 10 = 7 THEN ['other-' || (ord - 1)] WHEN ord % 10 = 8 THEN ['other-' || ord] WHEN ord % 10 = 9 THEN ['nobody'] ELSE [] END AS up
  FROM claims""",
    "bad_down": "SELECT id, unnest(down) AS other FROM bad WHERE id IS NOT NULL",
    "bad_up": "SELECT id, unnest(up) AS other FROM bad WHERE id IS NOT NULL",
    "bad_marked": "SELECT id AS other, bool_or(status = 'superseded') AS marked FROM bad WHERE id IS NOT NULL GROUP BY id",
    "bad_links": """
  SELECT id, 'supersedes_self' AS rule FROM bad_down WHERE id = other UNION ALL SELECT id, 'superseded_by_self' FROM bad_up WHERE id = other
  UNION ALL SELECT id, 'warn:supersedes_dangling' FROM bad_down WHERE other NOT IN (SELECT other FROM bad_marked)
  UNION ALL SELECT id, 'supersedes_status' FROM bad_down JOIN bad_marked USING (other) WHERE NOT marked
  UNION ALL SELECT id, 'warn:superseded_by_dangling' FROM bad_up WHERE other NOT IN (SELECT other FROM bad_marked)
  UNION ALL SELECT d.id, 'supersedes_one_sided' FROM bad_down d JOIN bad_marked USING (other) WHERE d.id <> d.other AND NOT EXISTS (SELECT 1 FROM bad_up u WHERE u.id = d.other AND u.other = d.id)""",
    "bad_routed": f"SELECT b.id, CASE WHEN list_contains(a.impossible, b.home) THEN 'impossible' WHEN a.strong = b.home THEN 'strong' WHEN list_contains(a.acceptable, b.home) THEN 'acceptable' ELSE 'suspicious' END AS state FROM bad b JOIN affinity a USING (type) WHERE b.id IS NOT NULL AND b.home IN {_in([h for h in HOMES if h not in PERSONAL_HOMES])}",
    "bad_found": f"""
  SELECT id, rule FROM (SELECT id, unnest([
      CASE WHEN type = 'odd' THEN 'type' END, CASE WHEN status = 'odd' THEN 'status' END, CASE WHEN home = 'odd' THEN 'primary_home' END, CASE WHEN home IN {_in(PERSONAL_HOMES)} THEN 'personal_home' END,
      CASE WHEN no_text THEN 'text_empty' END, CASE WHEN no_source THEN 'provenance_empty' END, CASE WHEN self_tag THEN 'warn:self_tag' END, CASE WHEN alien THEN 'warn:profile_scope' END,
      CASE WHEN type = 'episode' AND long_text THEN 'warn:digest_long' END, CASE WHEN type = 'episode' AND NOT no_source AND NOT from_episode THEN 'warn:episode_source' END]) AS rule FROM bad WHERE id IS NOT NULL) WHERE rule IS NOT NULL
  UNION ALL SELECT NULL, 'id_missing' FROM bad WHERE id IS NULL
  UNION ALL SELECT id, CASE WHEN state = 'impossible' THEN 'route_impossible' ELSE 'warn:route' END FROM bad_routed WHERE state <> 'strong'
  UNION ALL SELECT id, 'id_duplicate' FROM bad WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
  UNION ALL SELECT id, rule FROM bad_links""",
    "lists": f"SELECT c_custkey AS k, 'claims-' || c_custkey AS name, CASE WHEN c_custkey % 4 <> 0 THEN (c_custkey % 60) || ' 3 * * *' END AS cron, ([true, false, false, true, false, true, NULL])[c_custkey % 7 + 1] AS deliver FROM customer WHERE c_custkey % 9 <> 0 AND c_custkey % 31 <> 0",
    "active_": f"SELECT * FROM claims WHERE status NOT IN {_in(INACTIVE)}",
    "homes_active": "SELECT primary_home AS home, count(*) AS n FROM active_ GROUP BY primary_home",
}


def _with(select: str, **other: str) -> str:
    """The select with the CTEs it needs, in order; ``other`` ones take the place of those of their names."""
    import re

    ctes = CTES | other
    need: set[str] = set()
    queue = [select]
    while queue:
        text = queue.pop()
        for name, body in ctes.items():
            if name not in need and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text, re.I):
                need.add(name)
                queue.append(body)
    if not need:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in ctes.items() if n in need) + "\n" + select


def _broken(rules: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT candidate_id, '{name}' AS rule FROM verdicts WHERE {test}" for name, test in rules)


_HEAD = "'### ' || subject || ' — ' || predicate || CASE WHEN object IS NULL THEN '' ELSE ' ' || object END"
_SOURCE = "CASE WHEN len(sources) = 1 THEN '_Source: ' || sources[1] || ' L' || (ord % 50 + 1) || '-' || (ord % 50 + 3) || '_' ELSE '_Sources: ' || array_to_string(sources, ', ') || '_' END"
_CONTESTED = "CASE WHEN competing IS NULL THEN '' ELSE chr(10) || chr(10) || '> Contested by:' || chr(10) || '> - [' || relation || '] ' || competing END"
_BLOCK = f"{_HEAD} || chr(10) || text || chr(10) || chr(10) || {_SOURCE} || CASE WHEN status <> 'resolved' THEN '  _Status: ' || status || '_' ELSE '' END || CASE WHEN confidence IS NULL THEN '' ELSE '  _Confidence: ' || confidence || '_' END || '  _Updated: ' || substr(updated_at, 1, 10) || '_' || {_CONTESTED}"
_TAGS = "CASE WHEN tag IS NULL THEN '' ELSE '  _Tags: ' || tag || '_' END"


def _view(section: str, section_ord: str, where: str, order: str, block: str) -> str:
    return f"SELECT {section_ord} AS section_ord, {section} AS section, CAST(row_number() OVER (PARTITION BY {section_ord} ORDER BY {order}, ord) AS INTEGER) AS row_ord, id, md5({block}) AS block_md5 FROM shown_ WHERE {where}"


_SECTION = "CASE type " + " ".join(f"WHEN '{k}' THEN {i}" for i, (_, k, _) in enumerate(SECTIONS)) + " END"
_SECTION_NAME = "CASE type " + " ".join(f"WHEN '{k}' THEN '{t}'" for t, k, _ in SECTIONS) + " END"
_ASC = [k for _, k, o in SECTIONS if o == "subject_asc"]

_GROUP = "coalesce(tag, 'Uncategorized')"
_PLAYBOOKS = _view(_GROUP, _GROUP, "primary_home = 'PLAYBOOKS.md' AND type IN ('method', 'procedure')", "lower(subject), updated_at", _BLOCK).replace("AS section_ord", "AS grp")

ORACLE = {
    "extract_paragraphs": "SELECT doc_id, line_start, line_end, length(body) AS n_chars, md5(body) AS body_md5 FROM paragraphs",
    "extract_h2_sections": "SELECT doc_id, line_start, line_end, md5(body) AS body_md5 FROM sections UNION ALL SELECT doc_id, line_start, line_end, md5(body) AS body_md5 FROM section_paragraphs WHERE doc_id NOT IN (SELECT doc_id FROM sections)",
    "candidate_ids": "SELECT doc_id, line_start, 'cand-' || substr(sha256(path || ':' || line_start || ':' || lower(regexp_replace(body, '\\s+', ' ', 'g'))), 1, 16) AS candidate_id FROM paragraphs",
    "fingerprint_inventory": "SELECT 'doc/' || doc_id || '.md' AS path, CAST(strlen(text) AS BIGINT) AS bytes, 'sha256:' || sha256(text) AS content_hash FROM documents",
    "delta_scope": "SELECT c.path, c.content_hash FROM inv_cur c LEFT JOIN inv_prior p USING (path) WHERE p.content_hash IS DISTINCT FROM c.content_hash",
    "removed_sources": "SELECT path FROM inv_prior WHERE path NOT IN (SELECT path FROM inv_cur)",
    "cursor_hash": "SELECT 'cursor-v1:' || substr(sha256(string_agg(path || ':' || content_hash, chr(10) ORDER BY path, content_hash)), 1, 16) AS cursor FROM inv_cur",
    "strength": "SELECT candidate_id, round(total, 6) AS strength FROM verdicts",
    "verdict_rules": f"SELECT candidate_id, CASE WHEN total <= 0.5::DOUBLE OR noise_risk >= 0.8::DOUBLE THEN 'reject' WHEN total < 2.0::DOUBLE THEN 'defer' ELSE 'promote' END AS verdict FROM verdicts",
    "verdict_counts_zero_filled": f"SELECT v.verdict, count(r.candidate_id) AS n FROM (VALUES {_values([(v,) for v in VERDICTS])}) AS v(verdict) LEFT JOIN verdicts r ON r.verdict = v.verdict GROUP BY v.verdict",
    "verdict_violations": _broken([
        ("score_range:durability", "shown NOT BETWEEN 0.0 AND 1.0"),
        ("strength_formula", "abs(strength - (total - durability + shown)) > 0.01::DOUBLE"),
        ("compress_target_missing", "verdict = 'compress'"),
    ]) + " UNION ALL SELECT 'cand-' || (doc_id + 1000000000) AS candidate_id, 'candidate_missing' AS rule FROM documents WHERE doc_id % 50 = 0",
    "batch_chunks": "SELECT candidate_id, CAST((row_number() OVER (ORDER BY candidate_id) - 1) // 40 AS BIGINT) AS batch, (row_number() OVER (ORDER BY candidate_id) - 1) // 40 >= 10 AS pending FROM verdicts",
    "json_recovery": "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'direct' WHEN 1 THEN 'fence_strip' WHEN 2 THEN 'brace_scan' END AS step, CASE WHEN event_id % 4 < 3 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, CASE WHEN event_id % 4 = 3 THEN 'parse_failed' END AS error FROM events",
    "merge_components": "SELECT id, component FROM labels_",
    "cluster_ids": "SELECT 'clust-' || substr(sha256(string_agg('d' || lpad(CAST(id AS VARCHAR), 12, '0'), '|' ORDER BY id)), 1, 16) AS cluster_id, count(*) AS members FROM labels_ GROUP BY component",
    "shared_entities": f"""
SELECT component, coalesce(string_agg(entity, ',' ORDER BY entity) FILTER (WHERE n = size), '') AS entities FROM (
  SELECT component, entity, count(DISTINCT id) AS n, any_value(size) AS size FROM (
    SELECT l.component, l.id, count(*) OVER (PARTITION BY l.component) AS size, list_filter(list_distinct(regexp_extract_all(regexp_replace(d.text, '[^\\x00-\\x7F]', 'x', 'g'), '\\b[A-Z][\\w./-]{{2,}}\\b')), lambda e: NOT list_contains({_list(ENTITY_STOPWORDS)}, e)) AS es
    FROM labels_ l JOIN documents d ON d.doc_id = l.id), unnest(CASE WHEN len(es) = 0 THEN [NULL] ELSE es END) AS u(entity) GROUP BY component, entity)
GROUP BY component""",
    "majority_type": "SELECT component, hint FROM (SELECT component, hint, row_number() OVER (PARTITION BY component ORDER BY n DESC, first) AS rn FROM (SELECT component, hint, count(*) AS n, min(id) AS first FROM (SELECT component, id, ({0})[(id * 5 // 3) % 14 + 1] AS hint FROM labels_) GROUP BY component, hint)) WHERE rn = 1".format(_list(TYPES)),
    "norm_subject": f"SELECT DISTINCT s, {_subject('s')} AS n FROM (SELECT p_name AS s FROM part UNION ALL SELECT c_name FROM customer UNION ALL SELECT subject FROM claims)",
    "norm_predicate": f"SELECT DISTINCT s, {_predicate('s')} AS n FROM (SELECT p_name AS s FROM part UNION ALL SELECT p_type FROM part UNION ALL SELECT predicate FROM claims)",
    "retrieval_tokens": f"SELECT doc_id, CAST(len({_retrieval('text')}) AS INTEGER) AS n, md5(array_to_string(list_sort({_retrieval('text')}), ' ')) AS tokens_md5 FROM documents",
    "dup_tokens": f"SELECT doc_id, CAST(len({_duplicate('text')}) AS INTEGER) AS n, md5(array_to_string(list_sort({_duplicate('text')}), ' ')) AS tokens_md5 FROM documents",
    "jaccard_pairs": f"SELECT a.id AS a, b.id AS b, round({_jaccard('a.toks', 'b.toks')}, 6) AS j FROM keyed a JOIN keyed b ON b.ord = a.ord + 1",
    "exact_reuse": "SELECT id, target_id FROM reuse WHERE rn = 1",
    "probable_duplicates": "SELECT id, target_id, round(score, 3) AS score FROM dups WHERE rn = 1",
    "disposition_counts": "SELECT disposition, count(*) AS n FROM disposed GROUP BY disposition",
    "prior_topk": "SELECT cluster_id, claim_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM ranked WHERE rank <= 5",
    "prior_topk_widened": "SELECT cluster_id, claim_id, CAST(rank AS INTEGER) AS rank FROM wide",
    "prior_global_cap": f"SELECT claim_id, round(score, 6) AS score FROM (SELECT claim_id, max(score) AS score, any_value(updated_at) AS updated_at, min(cluster_id || lpad(CAST(rank AS VARCHAR), 3, '0')) AS first FROM wide GROUP BY claim_id) ORDER BY round(score, 9) DESC, {_LATEST}, first LIMIT 50",
    "contradiction_candidates": "SELECT cluster_id, string_agg(claim_id, ',' ORDER BY rank) AS ids FROM wide WHERE rank <= 3 GROUP BY cluster_id",
    "newest_priors": "SELECT id FROM claims WHERE NOT is_new ORDER BY updated_at DESC, ord LIMIT 50",
    "upsert_claims": "SELECT coalesce(n.id, p.id) AS id, coalesce(n.status, p.status) AS status, p.id IS NOT NULL AS was_there FROM (SELECT id, status FROM claims WHERE ord % 2 = 0) p FULL JOIN (SELECT id, 'fresh-' || status AS status FROM claims WHERE ord % 3 = 0) n ON n.id = p.id",
    "apply_supersession": "SELECT c.id, CASE WHEN s.target IS NULL THEN c.status ELSE 'superseded' END AS status, coalesce(s.by_id, '') AS superseded_by FROM claims c LEFT JOIN supers s ON s.target = c.id",
    "chain_warnings": "SELECT by_id AS new_id, target, 'unknown' AS successor FROM supers WHERE status = 'superseded'",
    "stale_sweep": f"SELECT c.id, CASE WHEN r.id IS NULL THEN c.status ELSE 'retire_candidate' END AS status, coalesce(array_to_string(r.sources, ','), '') AS removed FROM claims c LEFT JOIN retired r ON r.id = c.id WHERE NOT c.is_new",
    "contradiction_flatten": f"SELECT 'contra-' || substr(sha256(id), 1, 12) AS contradiction_cluster_id, id AS claim_id, competing AS competing_claim_id, relation, '{RUN}' AS flagged_in_run_id FROM claims WHERE is_new AND competing IS NOT NULL",
    "contradiction_dedupe": "SELECT 'contra-' || substr(sha256(id), 1, 12) AS contradiction_cluster_id, id AS claim_id, competing AS competing_claim_id, CASE WHEN ord % 2 = 0 THEN 'run-2' ELSE 'run-1' END AS flagged_in_run_id FROM claims WHERE competing IS NOT NULL",
    "entities": "SELECT subject, count(DISTINCT id) AS n, md5(string_agg(DISTINCT id, ',' ORDER BY id)) AS ids_md5 FROM claims GROUP BY subject",
    "routes": f"SELECT h.home, count(a.id) AS n, md5(coalesce(string_agg(a.id, ',' ORDER BY a.id), '')) AS ids_md5 FROM (VALUES {_values([(h,) for h in HOMES])}) AS h(home) LEFT JOIN active_ a ON a.primary_home = h.home GROUP BY h.home",
    "cross_surface": "SELECT id, array_to_string(sources, ',') AS sources FROM claims",
    "status_totals": "SELECT count(*) FILTER (WHERE status = 'superseded') AS superseded, count(*) FILTER (WHERE status = 'stale') AS stale, count(*) FILTER (WHERE status = 'retire_candidate') AS retire_candidate FROM claims",
    "claim_totals": "SELECT (SELECT count(*) FROM claims WHERE is_new) AS claims, (SELECT count(*) FROM supers) AS with_supersedes, (SELECT count(*) FROM claims WHERE is_new AND competing IS NOT NULL) AS with_contradictions",
    "home_counts": f"SELECT h.home AS primary_home, count(a.id) AS n FROM (VALUES {_values([(h,) for h in HOMES])}) AS h(home) LEFT JOIN active_ a ON a.primary_home = h.home GROUP BY h.home",
    "route_affinity": "SELECT id, state AS route_state, CASE state WHEN 'strong' THEN 1.0 WHEN 'acceptable' THEN 0.5 WHEN 'suspicious' THEN 0.1 ELSE 0.0 END::DOUBLE AS route_score, CASE WHEN state <> 'strong' THEN strong END AS route_suggested FROM routed",
    "route_warnings": "SELECT id, type, primary_home, state AS route_state FROM routed WHERE state <> 'strong'",
    "default_homes": f"SELECT c.id, h.home AS proposed_home FROM claims c JOIN (VALUES {_values(list(DEFAULT_HOME.items()))}) AS h(type, home) USING (type)",
    "normalization_signature": "SELECT id, ns || '|' || np || '|' || nh AS sig, 'cl-' || substr(sha256(subject || '|' || predicate || '|' || text || '|' || primary_home), 1, 16) AS stable_id FROM keyed",
    "integrity_supersedes": "SELECT id, rule FROM bad_links",
    "integrity_routes": f"SELECT 'unknown-' || ord AS id, 'route_unknown' AS rule FROM claims WHERE ord % 15 = 0 UNION ALL SELECT id, 'route_inactive' AS rule FROM claims WHERE ord % 15 <> 0 AND status IN {_in(INACTIVE)} UNION ALL SELECT id, 'route_home' AS rule FROM claims WHERE ord % 15 <> 0 AND ord % 10 = 0",
    "integrity_claims": "SELECT id, rule FROM bad_found",
    "discovered_sources": f"""
SELECT 'found' AS kind, path, CAST(NULL AS VARCHAR) AS severity FROM files WHERE path IN {_in(SHARED_SOURCES + PERSONAL_SOURCES)} OR path LIKE 'episodes/%'
UNION ALL SELECT 'missing', path, severity FROM (VALUES {_values([(n, 'warn') for n in SHARED_SOURCES] + [(n, 'info') for n in PERSONAL_SOURCES])}) AS v(path, severity) WHERE path NOT IN (SELECT path FROM files)
UNION ALL SELECT 'denied', path, NULL FROM (VALUES {_values([(n,) for n in CHECKED])}) AS v(path) WHERE path IN {_in(DENIED_FILES)} OR path LIKE 'memory/%' OR path LIKE 'runtime/%'""",
    "denied_paths": f"SELECT path FROM files WHERE path IN {_in(DENIED_FILES)} OR path LIKE 'memory/%' OR path LIKE 'runtime/%'",
    "type_hints": "SELECT path, CASE WHEN path LIKE 'episodes/%' THEN 'episode' " + " ".join(f"WHEN path = '{k}' THEN '{v}'" for k, v in SOURCE_TYPES.items()) + " ELSE 'unknown' END AS hint FROM files",
    "jsonl_records": "SELECT c_custkey AS k, c_name AS name FROM customer WHERE c_custkey % 7 NOT IN (0, 3)",
    "jsonl_rejects": "SELECT line, '{broken ' || c_custkey AS value FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS line FROM customer) WHERE c_custkey % 7 = 3",
    "episode_units": f"SELECT doc_id, CAST(1 AS INTEGER) AS line_start, CAST(greatest(1, len(string_split(text, chr(10))) - CASE WHEN ends_with(text, chr(10)) THEN 1 ELSE 0 END) AS INTEGER) AS line_end, md5({_strip('text')}) AS body_md5 FROM documents WHERE length({_strip('text')}) >= {MIN_CHARS}",
    "cluster_hints": "SELECT 'clust-' || substr(sha256(string_agg(cid, '|' ORDER BY cid)), 1, 16) AS cluster_id, string_agg(cid, ',' ORDER BY cid) AS members, array_to_string(list_sort(list_distinct(flatten(list(srcs)))), ',') AS sources, any_value(j.src) AS subject, any_value(k.hint) AS kind, any_value(CASE k.hint " + " ".join(f"WHEN '{h}' THEN '{DEFAULT_HOME[h]}'" for h in HINTS if h in DEFAULT_HOME) + " END) AS home FROM survivors_ s JOIN kinds_ k ON k.component = s.component AND k.rn = 1 JOIN subjects_ j ON j.component = s.component AND j.rn = 1 GROUP BY s.component",
    "scored_candidates": f"SELECT v.candidate_id, v.verdict, '{RUN}' AS run_id, CASE WHEN doc_id % 3 <> 0 THEN 'fact' END AS type_hint, CASE WHEN doc_id % 3 <> 0 THEN md5(text) END AS text_md5 FROM verdicts v JOIN documents USING (doc_id)",
    "asked_verdicts": "SELECT candidate_id, verdict FROM verdicts WHERE doc_id % 4 = 0",
    "canonical_checks": """
SELECT id, rule FROM (SELECT id, unnest([
    CASE WHEN k % 13 = 0 THEN 'score_missing:semantic_cluster_confidence' END, CASE WHEN k % 17 = 0 THEN 'score_range:canonical_clarity' END, CASE WHEN k % 19 = 0 THEN 'type' END, CASE WHEN k % 23 = 0 THEN 'status' END,
    CASE WHEN k % 29 = 0 THEN 'primary_home' WHEN k % 5 >= 3 THEN 'personal_home' END, CASE WHEN k % 31 = 0 THEN 'text_empty' END, CASE WHEN k % 37 = 0 THEN 'provenance_empty' WHEN k % 43 = 0 THEN 'provenance_type' END,
    CASE WHEN k % 10 = 0 THEN 'contradiction_empty' END, CASE WHEN k % 15 = 0 THEN 'contradiction_relation' END, CASE WHEN k % 47 = 0 THEN 'freshness_posture' END, CASE WHEN k % 7 = 2 THEN 'confidence_posture' END,
    CASE WHEN k % 7 = 0 THEN 'claim_id_unknown' END]) AS rule FROM canon) WHERE rule IS NOT NULL
UNION ALL SELECT id, 'cluster_duplicate' FROM canon GROUP BY id HAVING count(*) > 1
UNION ALL SELECT DISTINCT id, 'cluster_unknown' FROM canon WHERE id NOT IN (SELECT 'clust-' || k FROM canon)
UNION ALL SELECT 'clust-' || k, 'cluster_missing' FROM canon WHERE 'clust-' || k NOT IN (SELECT id FROM canon)
UNION ALL SELECT DISTINCT id, 'provenance_untraceable' FROM canon WHERE k % 37 <> 0 AND (k % 41 = 0 OR id NOT IN (SELECT 'clust-' || k FROM canon))""",
    "stored_claims": f"SELECT c.id AS source_cluster_id, CASE WHEN d.disposition = 'reuse_existing' THEN r.target_id ELSE 'cl-' || substr(sha256(subject || '|' || predicate || '|' || text || '|' || primary_home), 1, 16) END AS id, CASE WHEN d.disposition = 'probable_duplicate' THEN 'probable_duplicate' ELSE status END AS status, 'business' AS profile_scope, '{RUN}' AS updated_in_run_id, '{NOW}' AS updated_at, CASE WHEN competing IS NOT NULL THEN '{RUN}' END AS flagged_in, array_to_string(sources, ',') AS sources FROM claims c JOIN disposed d ON d.id = c.id LEFT JOIN reuse r ON r.id = c.id AND r.rn = 1",
    "prior_topk_recent": "SELECT cluster_id, claim_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM ranked_recent WHERE rank <= 5",
    "reconciliation_priors": f"SELECT claim_id, round(score, 6) AS score FROM (SELECT claim_id, max(score) AS score, any_value(updated_at) AS updated_at, min(cluster_id || lpad(CAST(rank AS VARCHAR), 3, '0')) AS first FROM wide_recent GROUP BY claim_id) ORDER BY round(score, 9) DESC, {_LATEST}, first LIMIT 120",
    "view_checks": "SELECT home AS id, 'warn:view_empty' AS rule, 'business' AS profile FROM homes_active WHERE home IN ('LTMEMORY.md', 'EPISODES.md') UNION ALL SELECT unnest(['HISTORY.md', 'WISHES.md']), 'warn:view_personal', 'business' UNION ALL SELECT home, 'warn:view_empty', 'personal' FROM homes_active WHERE home IN ('LTMEMORY.md', 'EPISODES.md', 'HISTORY.md')",
    "check_status": "SELECT 'all' AS part, CASE WHEN count(*) FILTER (WHERE rule NOT LIKE 'warn:%') > 0 THEN 'errors' WHEN count(*) > 0 THEN 'warnings' ELSE 'ok' END AS status FROM bad_found UNION ALL SELECT 'warnings', CASE WHEN count(*) > 0 THEN 'warnings' ELSE 'ok' END FROM bad_found WHERE rule LIKE 'warn:%' UNION ALL SELECT 'none', 'ok'",
    "manifest_checks": "SELECT doc_id AS id, CASE WHEN doc_id % 29 = 0 THEN 'manifest_unreadable' ELSE 'manifest_key:' || (" + _list(MANIFEST_KEYS) + ")[doc_id % 17 + 1] END AS rule FROM documents WHERE doc_id % 29 = 0 OR doc_id % 17 < 16 UNION ALL SELECT doc_id, 'warn:manifest_status' FROM documents WHERE doc_id % 5 = 0 AND doc_id % 17 <> 3 AND doc_id % 29 <> 0 UNION ALL SELECT doc_id, 'warn:manifest_profile' FROM documents WHERE doc_id % 7 = 0 AND doc_id % 17 <> 4 AND doc_id % 29 <> 0",
    "store_checks": f"SELECT CAST(doc_id AS VARCHAR) AS id, 'table_missing:' || t.name AS rule FROM documents JOIN (VALUES {_values([(t, i) for i, t in enumerate(TABLES)])}) AS t(name, i) ON doc_id % 11 = t.i UNION ALL SELECT CAST(doc_id AS VARCHAR) AS id, 'warn:view_missing:' || h.name AS rule FROM documents JOIN (VALUES {_values([(h, i) for i, h in enumerate(HOMES)])}) AS h(name, i) ON doc_id % 13 = 0 OR doc_id % 8 = h.i",
    "upgrade_states": "SELECT doc_id AS id, CASE WHEN doc_id % 19 = 0 THEN 'new' WHEN doc_id % 12 < 10 OR doc_id % 7 = 0 THEN 'refuse' WHEN doc_id % 12 = 11 OR doc_id % 5 = 0 THEN 'warn' ELSE 'ok' END AS state FROM documents",
    "delivery_settings": (
        "SELECT c_custkey, CASE WHEN c_custkey % 17 <> 0 THEN CASE c_custkey % 5 WHEN 0 THEN true WHEN 1 THEN false END END AS enabled,"
        " CASE WHEN c_custkey % 17 <> 0 AND c_custkey % 3 = 0 THEN 'c1' WHEN c_custkey % 13 <> 0 THEN 'c2' END AS channel,"
        " CASE WHEN c_custkey % 17 <> 0 AND c_custkey % 2 = 0 THEN 't1' WHEN c_custkey % 13 <> 0 AND c_custkey % 11 <> 0 THEN 't2' END AS target,"
        " CASE WHEN c_custkey % 13 <> 0 THEN CASE c_custkey % 4 WHEN 0 THEN 'UTC' WHEN 3 THEN 'Etc/GMT+1' ELSE 'Asia/Manila' END ELSE 'Asia/Manila' END AS zone,"
        " CASE WHEN c_custkey % 13 <> 0 THEN CASE c_custkey % 7 WHEN 0 THEN 300 WHEN 5 THEN 45 ELSE 1200 END ELSE 1200 END AS timeout FROM customer"
    ),
    "log_shards": "SELECT strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d') AS log_date, count(*) AS n, min(event_id) AS first FROM events GROUP BY 1",
    "first_filled": "SELECT id, coalesce(CASE WHEN ord % 6 = 0 THEN tag END, confidence, object) AS found FROM claims",
    "lenient_texts": "SELECT doc_id, md5(coalesce(text, '') || chr(65533) || 'A' || chr(65533)) AS text_md5 FROM documents",
    "json_documents": "SELECT c_custkey, c_custkey AS k, c_name AS name FROM customer WHERE c_custkey % 5 IN (2, 3, 4) UNION ALL SELECT c_custkey, c_custkey + 1, c_name FROM customer WHERE c_custkey % 5 IN (3, 4)",
    "json_objects": "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 0 WHEN c_custkey % 5 >= 3 THEN 2 ELSE -1 END AS n FROM customer",
    "jsonl_round_trip": "SELECT ord, id, object, text, CASE WHEN tag IS NULL THEN 'NOTES.md' ELSE tag END AS tags, recurrence FROM claims",
    "step_warnings": (
        "SELECT 'scope' AS step, 'source is gone: ' || path AS warning FROM inv_prior WHERE path NOT IN (SELECT path FROM inv_cur)"
        " UNION ALL SELECT 'scope', 'waited for a batch: ' || doc_id FROM documents WHERE doc_id % 9 = 0"
        " UNION ALL SELECT 'verdicts', 'batch ' || (doc_id % 10) || ' was asked for again after attempt ' || (doc_id % 2 + 1) || ': ' || count(*) || ' broken rules, ' || min(rule) || ' among them'"
        " FROM (SELECT doc_id, 'score_range:durability' AS rule FROM verdicts WHERE shown NOT BETWEEN 0.0 AND 1.0"
        " UNION ALL SELECT doc_id, 'strength_formula' FROM verdicts WHERE abs(strength - (total - durability + shown)) > 0.01::DOUBLE"
        " UNION ALL SELECT doc_id, 'compress_target_missing' FROM verdicts WHERE verdict = 'compress'"
        " UNION ALL SELECT doc_id, 'candidate_id_unknown' FROM verdicts WHERE doc_id % 45 = 0) GROUP BY doc_id % 10, doc_id % 2"
        " UNION ALL SELECT 'verdicts', 'answer to nothing that was asked: cand-' || doc_id FROM documents WHERE doc_id % 45 = 0"
        " UNION ALL SELECT 'route', id FROM routed WHERE state <> 'strong'"
    ),
    "entity_segments": "SELECT subject, CAST(r // 64 AS BIGINT) AS segment, count(*) AS n, md5(string_agg(id, ',' ORDER BY id)) AS ids_md5 FROM (SELECT subject, id, row_number() OVER (PARTITION BY subject ORDER BY id) - 1 AS r FROM (SELECT DISTINCT subject, id FROM claims)) GROUP BY subject, r // 64",
    "route_segments": "SELECT home, CAST(r // 64 AS BIGINT) AS segment, count(*) AS n, md5(string_agg(id, ',' ORDER BY id)) AS ids_md5 FROM (SELECT primary_home AS home, id, row_number() OVER (PARTITION BY primary_home ORDER BY id) - 1 AS r FROM active_) GROUP BY home, r // 64",
    "entity_rows": "SELECT DISTINCT subject, id AS claim_id FROM claims",
    "route_rows": f"SELECT h.home, a.id AS claim_id FROM (VALUES {_values([(h,) for h in HOMES])}) AS h(home) LEFT JOIN active_ a ON a.primary_home = h.home",
    "claim_epochs": "SELECT id, CAST(CASE ord % 5 WHEN 0 THEN e WHEN 1 THEN e - 7200 WHEN 2 THEN e ELSE 0 END AS DOUBLE) AS epoch FROM (SELECT *, epoch(CAST(replace(updated_at, 'Z', '') AS TIMESTAMP)) AS e FROM claims)",
    "time_triples": "SELECT id, asked, strftime(moment + to_hours(h), '%Y-%m-%dT%H:%M:%S') || o AS timestamp, strftime(moment, '%Y-%m-%dT%H:%M:%SZ') AS timestamp_utc, timezone FROM (SELECT id, CAST(replace(updated_at, 'Z', '') AS TIMESTAMP) AS moment FROM claims), (VALUES ('Etc/GMT+5', -5, '-05:00', 'Etc/GMT+5'), ('Nowhere/None', 8, '+08:00', 'Asia/Manila')) AS z(asked, h, o, timezone)",
    "schedule_windows": "SELECT event_id, (dayofweek(ts) IN (1, 3) AND abs(hour(ts) - 3) <= 1) OR (dayofweek(ts) = 0 AND abs(hour(ts) - 22) <= 1) AS inside FROM events",
    "run_durations": "SELECT doc_id, CAST(doc_id % 50 * 3600 AS DOUBLE) AS seconds FROM documents",
    "version_parts": "SELECT p_partkey, (p_partkey % 10) || ',' || (p_partkey % 77) || ',' || CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_partkey % 5 END AS parts FROM part",
    "state_versions": "SELECT p_partkey, substr(sha1('1.' || (p_partkey % 9) || '.0|1.0.' || p_size || '|1.0.0'), 1, 12) AS state FROM part",
    "usage_blocks": "SELECT event_id, p AS prompt_tokens, c AS completion_tokens, p + c AS total_tokens, CASE WHEN p + c = 0 THEN 'unavailable' ELSE 'exact' END AS source FROM (SELECT event_id, event_id % 3 AS p, CASE WHEN event_id % 2 = 0 THEN 0 ELSE event_id % 7 END AS c FROM events)",
    "unwrapped_answers": "SELECT event_id, CASE WHEN event_id % 5 = 4 THEN props ELSE 'said ' || event_id END AS answer FROM events",
    "listed_jobs": "SELECT name, cron, deliver FROM lists",
    "sync_plan": "SELECT name, step, command, CASE WHEN step = 2 THEN cron END AS cron, CASE WHEN step = 2 THEN 'Asia/Manila' END AS tz, CASE WHEN step = 2 THEN 1200 END AS timeout_seconds, CASE WHEN step = 2 THEN 'c' END AS channel, CASE WHEN step = 2 THEN 't' END AS target FROM lists, (VALUES (1, 'delete'), (2, 'add')) AS v(step, command) WHERE deliver = false AND cron IS NOT NULL",
    "entity_mentions": f"SELECT doc_id, entity, count(*) AS n FROM (SELECT doc_id, unnest(list_filter(regexp_extract_all(text, '(?:^|[^{_WORD}])([A-Z][{_WORD}./-]*[{_WORD}])', 1), lambda e: length(e) >= 3 AND NOT list_contains({_list(ENTITY_STOPWORDS)}, e))) AS entity FROM documents) GROUP BY doc_id, entity",
    "recall_surface": f"""
SELECT id, status, age_days, round_even(score, 3) AS recall_score FROM (
  SELECT id, status, updated_at, age_days, least(age_days::DOUBLE, 14.0::DOUBLE) * 0.1::DOUBLE + (CASE status WHEN 'contested' THEN 3.0 WHEN 'unresolved' THEN 2.0 ELSE 1.0 END)::DOUBLE + least(len(sources)::DOUBLE, 5.0::DOUBLE) * 0.3::DOUBLE + least(coalesce(recurrence, 0.0::DOUBLE), 10.0::DOUBLE) * 0.2::DOUBLE AS score
  FROM (SELECT *, greatest(CAST(floor((epoch(TIMESTAMP '{NOW[:-1].replace('T', ' ')}') - epoch(CAST(replace(updated_at, 'Z', '') AS TIMESTAMP))) / 86400) AS BIGINT), 0) AS age_days FROM claims WHERE NOT is_new AND status IN ('contested', 'unresolved', 'retire_candidate')))
ORDER BY score DESC, updated_at, id LIMIT 1""",
    "age_days": f"SELECT id, greatest(CAST(floor((epoch(TIMESTAMP '{NOW[:-1].replace('T', ' ')}') - epoch(CAST(replace(updated_at, 'Z', '') AS TIMESTAMP))) / 86400) AS BIGINT), 0) AS age, round(greatest((epoch(TIMESTAMP '{NOW[:-1].replace('T', ' ')}') - epoch(CAST(replace(updated_at, 'Z', '') AS TIMESTAMP))) / 86400.0::DOUBLE, 0), 6) AS days FROM claims",
    "posture_bands": "SELECT id, CASE WHEN s >= 0.8::DOUBLE THEN 'fresh' WHEN s >= 0.5::DOUBLE THEN 'recent' WHEN s >= 0.3::DOUBLE THEN 'aging' ELSE 'stale' END AS freshness, CASE WHEN s >= 0.8::DOUBLE THEN 'high' WHEN s >= 0.5::DOUBLE THEN 'medium' WHEN s >= 0.3::DOUBLE THEN 'low' ELSE 'tentative' END AS confidence FROM (SELECT id, (ord * 7 % 101) / 100.0::DOUBLE AS s FROM claims)",
    "next_fires": "SELECT j.c_custkey, strftime(f.t, '%Y-%m-%d %H:%M') AS fires_at FROM jobs j LEFT JOIN job_fires f USING (c_custkey)",
    "next_schedule": "SELECT name, CASE WHEN contains(name, 'reconciliation') THEN 'reconciliation' ELSE 'incremental' END AS mode, strftime(t, '%Y-%m-%d %H:%M') AS fires_at FROM jobs JOIN job_fires USING (c_custkey) WHERE name LIKE 'claims-%' ORDER BY t, name LIMIT 1",
    "delivery_actions": "SELECT action, count(*) AS n FROM (SELECT CASE WHEN deliver IS NULL THEN 'skipped_indeterminate' WHEN deliver THEN 'in_sync' WHEN NOT ok THEN 'skipped_missing_fields' ELSE 'skipped_missing_announce_target' END AS action FROM jobs WHERE name LIKE 'claims-%') GROUP BY action",
    "config_paths": "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'k' ELSE 'cron.tz,props.k' END AS missing FROM events",
    "prior_context": "SELECT id AS claim_id, type, primary_home, array_to_string(sources, ',') AS sources, CAST(ord % 50 + 3 AS INTEGER) AS last_line FROM claims WHERE NOT is_new",
    "view_ltmemory": _view(_SECTION_NAME, _SECTION, f"primary_home = 'LTMEMORY.md' AND type IN {_in([k for _, k, _ in SECTIONS])}", f"CASE WHEN type IN {_in(_ASC)} THEN lower(subject) END, CASE WHEN type IN {_in(_ASC)} THEN updated_at END, updated_at DESC", _BLOCK),
    "view_playbooks": f"SELECT CAST(dense_rank() OVER (ORDER BY section = 'Uncategorized', lower(section)) - 1 AS INTEGER) AS section_ord, section, row_ord, id, block_md5 FROM ({_PLAYBOOKS})",
    "view_episodes": _view("''", "0", "primary_home = 'EPISODES.md' AND type = 'episode'", "updated_at DESC", f"'### ' || substr(updated_at, 1, 10) || ' — ' || subject || chr(10) || text || chr(10) || chr(10) || '_Source: ' || sources[1] || ' L' || (ord % 50 + 1) || '-' || (ord % 50 + 3) || '_' || {_TAGS} || {_CONTESTED}"),
    "view_history": _view("''", "0", "primary_home = 'HISTORY.md' AND type = 'milestone'", "updated_at", f"'### ' || substr(updated_at, 1, 10) || ' — ' || subject || chr(10) || text || chr(10) || chr(10) || '_Source: ' || array_to_string(sources, ', ') || '_' || {_TAGS} || {_CONTESTED}"),
    "view_wishes": _view("CASE status WHEN 'resolved' THEN 'Active Aspirations' ELSE 'Emerging Patterns' END", "CASE status WHEN 'resolved' THEN 0 ELSE 1 END", "primary_home = 'WISHES.md' AND type = 'aspiration' AND status IN ('resolved', 'unresolved')", "CASE WHEN status = 'resolved' THEN coalesce(recurrence, 0) ELSE 0 END DESC, updated_at DESC", f"'### ' || subject || chr(10) || text || chr(10) || chr(10) || CASE WHEN recurrence IS NULL THEN '' ELSE '_Recurrence: ' || CAST(recurrence AS BIGINT) || ' occurrences_  ' END || '_Last reinforced: ' || substr(updated_at, 1, 10) || '_' || {_CONTESTED}"),
    "usage_fold": "SELECT event_type, CAST(sum(user_id) AS BIGINT) AS prompt_tokens, CAST(sum(event_id % 7) AS BIGINT) AS completion_tokens, CAST(sum(user_id + event_id % 7) AS BIGINT) AS total_tokens, ['exact', 'approximate', 'unavailable'][max(event_id % 3) + 1] AS source FROM events GROUP BY event_type",
    "event_status_by_day": "SELECT strftime(ts, '%Y-%m-%d') AS log_date, event_type AS status, count(*) AS n FROM events GROUP BY 1, 2",
    "text_truncations": "SELECT doc_id, md5(CASE WHEN length(text) > 80 THEN substr(text, 1, 77) || '…' ELSE text END) AS heading_md5, md5(CASE WHEN length(text) > 240 THEN substr(text, 1, 237) || '...' ELSE text END) AS recall_md5, CAST(CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, length(text) // 4) END AS INTEGER) AS tokens FROM documents",
}

#: The same on the documents' own texts.
_TEXTS = CTES["claims"].replace(_SAID, "coalesce(text, '') AS text")
_ON_TEXTS = {f"{k}_texts": _with(ORACLE[k], claims=_TEXTS) for k in ("prior_topk", "probable_duplicates")}
ORACLE = {k: _with(v) for k, v in ORACLE.items()} | _ON_TEXTS
