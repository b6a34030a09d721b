"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.schemas import DUPLICATE_STOPWORDS, ENTITY_STOPWORDS, RETRIEVAL_STOPWORDS

#: White space in the Unicode sense, with the four separator controls that Java leaves out.
_SPACE = r"[\s\x1C-\x1F]"
_EDGES = rf"(?U)\A{_SPACE}+|{_SPACE}+\z"
_LINE_END = r"\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x85\u2028\u2029]"
_RETRIEVAL_TOKEN = r"[a-z0-9][a-z0-9._-]{1,}"
_DUPLICATE_TOKEN = r"[a-z0-9]+"
_ENTITY = r"(?U)\b[A-Z][\w./-]{2,}\b"


def blank(c: Column) -> Column:
    """Null as the empty text."""
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGES, "")


def lines_of(c: Column) -> Column:
    """The lines, by any Unicode line end; no empty line after a final line end."""
    parts = F.split(c, _LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def collapsed(c: Column) -> Column:
    """Lower case, white space collapsed: what hashes of candidates see."""
    return F.lower(F.regexp_replace(strip(c), rf"(?U){_SPACE}+", " "))


def subject_key(c: Column) -> Column:
    """Trimmed lower case without one leading article, a final plural s folded after a consonant."""
    low = F.lower(strip(blank(c)))
    bare = F.when(low.rlike(r"\A(the|a|an) "), strip(F.regexp_replace(low, r"\A(the|a|an) ", ""))).otherwise(low)
    return F.when((F.length(bare) >= 4) & bare.rlike(r"(?s)[^aeious]s\z"), F.substring(bare, F.lit(1), F.length(bare) - 1)).otherwise(bare)


def predicate_key(c: Column) -> Column:
    """Trimmed lower case; the first of the endings -ing, -ed, -s goes that leaves a long enough stem ending in a letter."""
    low = F.lower(strip(blank(c)))
    out = low
    for end, least in (("s", 4), ("ed", 3), ("ing", 3)):  # the last one tried comes first
        stem = F.substring(low, F.lit(1), F.length(low) - len(end))
        out = F.when(low.endswith(end) & (F.length(stem) >= least) & stem.rlike(r"(?s)\p{L}\z"), stem).otherwise(out)
    return out


def home_key(c: Column) -> Column:
    return strip(blank(c))


def _token_set(c: Column, pattern: str, without: list[str]) -> Column:
    found = F.array_distinct(F.regexp_extract_all(F.lower(blank(c)), F.lit(pattern), F.lit(0)))
    return F.array_except(found, F.array(*[F.lit(w) for w in without]))


def retrieval_tokens(c: Column) -> Column:
    return _token_set(c, _RETRIEVAL_TOKEN, RETRIEVAL_STOPWORDS)


def duplicate_tokens(c: Column) -> Column:
    return _token_set(c, _DUPLICATE_TOKEN, DUPLICATE_STOPWORDS)


def entity_mentions(c: Column) -> Column:
    """Capitalised mentions in order of appearance, repeats kept."""
    found = F.regexp_extract_all(blank(c), F.lit(_ENTITY), F.lit(0))
    return F.filter(found, lambda m: ~m.isin(*ENTITY_STOPWORDS))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets as arrays; 0 for two empty ones."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))


def heading_only(lines: Column) -> Column:
    """No line has anything but a heading; true of no lines."""
    filled = F.filter(F.transform(lines, strip), lambda x: x != "")
    return F.forall(filled, lambda x: x.startswith("#"))


def first_filled(*given: Column) -> Column:
    """The first that is neither null nor empty; null if there is none."""
    return F.coalesce(*[F.when(c != "", c) for c in given])


def lenient_text(content: Column) -> Column:
    """Bytes as text; what is no UTF-8 becomes replacement marks."""
    return F.make_valid_utf8(content.cast("string"))


def shortened(c: Column, most: int, keep: int, mark: str) -> Column:
    """Texts over ``most`` characters cut to ``keep`` and marked."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, keep), F.lit(mark))).otherwise(c)


def trimmed_end(c: Column) -> Column:
    """Without the white space behind."""
    return F.regexp_replace(c, rf"(?U){_SPACE}+\z", "")


def digest(c: Column, cap: int) -> Column:
    body = strip(blank(c))
    cut = F.concat(trimmed_end(F.substring(body, 1, cap - 1)), F.lit("…"))
    return F.when(F.length(body) > cap, cut).otherwise(body)


def approximate_tokens(c: Column) -> Column:
    n = F.length(blank(c))
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(n / 4).cast("int")))


def version_tuple(c: Column) -> Column:
    """Leading digits of each part between dots, for comparison as an array."""
    return F.transform(F.split(blank(c), r"\."), lambda p: F.coalesce(F.try_to_number(F.regexp_extract(p, r"^(\d*)", 1), F.lit("999999999")).cast("int"), F.lit(0)))


def short_hash(c: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(c, 256), 1, 16))
