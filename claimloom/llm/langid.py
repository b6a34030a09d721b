"""Language identification: known words first, then progressively shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import drop_tables, give_back, others, slices, small_batches, text_of, thrifty, write_table

UNKNOWN = "und"
#: Runs of letters and of the numerals that are no digits.
WORD = re.compile(r"[^\W\d_]+")
#: Words whose scores a task keeps, and the bytes these may take.
CACHED_WORDS, CACHED_BYTES = 200_000, 32 << 20
TOGETHER = 4096


def letters_of(text: str) -> list[str]:
    """The lower-cased words of a text: runs of letters, which are the characters of Unicode's categories L*."""
    found = WORD.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    parts = ("".join(c if c.isalpha() else " " for c in w).split() for w in found)
    return [w for part in parts for w in part]


def grams_of(word: str, n: int) -> list[str]:
    """The n-grams of a word with its ends marked; single letters without marks."""
    marked = word if n == 1 else f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Frequencies:
    """Log frequencies: a row for each known entry, a column for each language."""

    def __init__(self, entries: list[str], rows: np.ndarray):
        self.index, self.rows = {e: i for i, e in enumerate(entries)}, rows


@dataclass
class LanguageModel:
    """langs: sorted. words: frequencies of known words; grams: the same for n-grams, by length."""

    langs: list[str]
    words: Frequencies
    grams: dict[int, Frequencies]

    def word_scores(self, word: str) -> np.ndarray:
        """A known word's log frequency in each language; else the mean over its known n-grams of the longest
        length that has any; zeros if there is none."""
        found = self.words.index.get(word)
        if found is not None:
            return self.words.rows[found]
        for n in sorted(self.grams, reverse=True):
            known = self.grams[n]
            at = [known.index[g] for g in grams_of(word, n) if g in known.index]
            if at:
                return known.rows[at].sum(axis=0) / len(at)
        return np.zeros(len(self.langs))

    def predict(self, scores: np.ndarray, words: int) -> tuple[str, float]:
        """The best language (the first by name at a tie) and its share of the probability."""
        if not words or not self.langs:
            return UNKNOWN, 0.0
        p = np.exp(scores - scores.max())
        best = int(np.argmax(scores))
        return self.langs[best], float(p[best] / p.sum())


def _counted(sample: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """(size, lang, gram, n): words have size 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter = Counter()
            words: dict[str, Counter] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for part in slices(text):
                    words.setdefault(lang, Counter()).update(letters_of(part))
            for lang, counted in words.items():
                for word, n in counted.items():
                    seen[0, lang, word] += n
                    for k in sizes:
                        for g in grams_of(word, k):
                            seen[k, lang, g] += n
            keys = list(seen)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string()),
                    pa.array([k[2] for k in keys], pa.string()), pa.array(list(seen.values()), pa.int64())
                ],
                ["size", "lang", "gram", "n"]
            )

    made = sample.mapInArrow(thrifty(count), "size int, lang string, gram string, n long")
    return made.groupBy("size", "lang", "gram").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = 8000,
    sizes: tuple[int, ...] = (1, 2, 3, 4, 5), max_entries: int = 40_000, least_uses: int = 3, smooth: float = 0.5
) -> LanguageModel:
    """Word and n-gram frequencies of each language from the rows that satisfy ``learn`` and have a language.

    Bounds: about ``max_docs`` whole documents, shared evenly among the languages and drawn by a hash of the id (of
    each language one at least, so none is left out), and for words and each n-gram length the ``max_entries`` most
    frequent entries over all languages, of words only those used ``least_uses`` times or more. Words beyond these
    bounds are scored by their n-grams, and n-grams beyond them by shorter ones, as unseen ones are; with many languages
    raise ``max_entries``. The counts of all drawn rows are summed by Spark; the driver gets only the entries that stay.
    The model takes eight bytes for each of these in each language.
    """
    spark = docs.sparkSession
    ticket = F.pmod(F.xxhash64(F.lit("langid"), id_col), F.lit(1 << 30)) / (1 << 30)
    known = docs.where(learn & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), text_of(text_col).alias("text"), ticket.alias("ticket"))
    found_langs = known.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.min("ticket").alias("first")).collect()
    if not found_langs:
        return LanguageModel([], Frequencies([], np.zeros((0, 0))), {})
    share = max_docs / len(found_langs)
    draw = spark.createDataFrame([(r["lang"], min(1.0, share / r["count"]), r["first"]) for r in found_langs], "lang string, part double, first double")
    sample = known.join(F.broadcast(draw), "lang").where("ticket < part or ticket = first").select("lang", "text")
    small_batches(spark)
    grams = write_table(_counted(sample, sizes), "grams")
    totals: dict[int, dict[str, int]] = {}
    for r in grams.groupBy("size", "lang").agg(F.sum("n").alias("n")).collect():
        totals.setdefault(r["size"], {})[r["lang"]] = r["n"]
    langs = sorted({k for by in totals.values() for k in by})
    place = {k: i for i, k in enumerate(langs)}
    found = {0: Frequencies([], np.zeros((0, len(langs))))}
    every = grams.groupBy("size", "gram").agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
    every = every.where((F.col("size") > 0) | (F.col("all") >= least_uses))
    best = Window.partitionBy("size").orderBy(F.desc("all"), "gram")
    top = write_table(every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= max_entries), "entries")
    for size, by_lang in totals.items():
        got = top.where(F.col("size") == size).orderBy("rank").select("gram", "by").collect()
        n = np.zeros((len(got), len(langs)))
        for i, r in enumerate(got):
            for k, times in r["by"].items():
                n[i, place[k]] = times
        size_of = np.array([by_lang.get(k, 0) for k in langs], float)
        found[size] = Frequencies([r["gram"] for r in got], np.log((n + smooth) / (size_of + smooth * (len(got) + 1))))
    drop_tables(grams, top)
    return LanguageModel(langs, found.pop(0), found)


class _Scorer:
    """Scores of words, kept for the words seen lately in this task."""

    def __init__(self, model: LanguageModel):
        langs = max(1, len(model.langs))
        self.model, self.seen = model, {}
        self.rows = np.zeros((max(2 * TOGETHER, min(CACHED_WORDS, CACHED_BYTES // (8 * langs))), langs))

    def total(self, text: str) -> tuple[np.ndarray, int]:
        """The sum over the words of a text, and how many these are."""
        out, n = np.zeros(self.rows.shape[1]), 0
        for part in slices(text):
            words = letters_of(part)
            n += len(words)
            for i in range(0, len(words), TOGETHER):
                out += self._part(words[i : i + TOGETHER])
        return out, n

    def _part(self, words: list[str]) -> np.ndarray:
        seen = self.seen
        new = set(words).difference(seen)
        if len(seen) + len(new) > len(self.rows):
            seen.clear()
            new = set(words)
        for w in new:
            self.rows[len(seen)] = self.model.word_scores(w)
            seen[w] = len(seen)
        return self.rows[list(map(seen.__getitem__, words))].sum(axis=0)


def predict_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text", made: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All input columns, then the language and its probability under the names ``made`` (input columns of these
    names are replaced).

    Every word of the whole text counts. Null texts and texts without a letter are ``und`` with score 0, as is every
    text where no language was learned. Rows keep their number; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)

    @F.arrow_udf("struct<lang:string,score:double>")
    def predicted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        scorer = _Scorer(own)
        for texts in parts:
            langs, scores = [], []
            for text in texts:
                lang, score = own.predict(*scorer.total(text.as_py() or "")) if own.langs else (UNKNOWN, 0.0)
                langs.append(lang)
                scores.append(score)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])
        del scorer
        give_back()

    rows = docs.select(*[docs[c] for c in others(docs, list(made))], predicted(text_of(text_col)).alias("_found"))
    return rows.select(*[c for c in rows.columns if c != "_found"], F.col("_found.lang").alias(made[0]), F.col("_found.score").alias(made[1]))
