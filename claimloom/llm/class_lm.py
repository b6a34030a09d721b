"""A Brown class language model: words in classes by exchange, scores from class transitions and word emissions.

The probability of a word after another is that of its class after the other's class, times that of the word in its
class. How the model is made from the rows that may be learned from:

1. Words are counted. The most frequent ones, LOCAL at most, travel to the tasks with their place in that order; all others are
   rows of a table, and to their neighbours they look like their shape (``shape_of``).
2. Texts are encoded once: a number a token, and the words that have none, each where it stands.
3. The EXCHANGED most frequent words and the shapes are moved between classes in sweeps, each to the class that gives the
   class bigrams the greatest likelihood (Martin et al. 1998; words dealt over tasks as in Uszkoreit and Brants 2008).
4. The other words that travel get their class by the same criterion in one sweep. Every word of the rest gets its own
   too: the class most likely after its left neighbours.
5. Transitions are counted over all tokens, with each word in its class.

Scoring sums what a task can look up by itself, and joins the rest's words to their table. Nothing is left out: a word of
any frequency is counted, has a class, and is scored by its own count. A hot word never meets in one task, as hot words
travel; the driver holds LOCAL words of at most WORD_BYTES and CLASSES squared numbers.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import drop_tables, others, small_batches, text_of, thrifty, write_table

CLASSES = 128
#: Words that tasks look up, words moved in sweeps, and the most bytes of a word among them.
LOCAL, EXCHANGED, WORD_BYTES = 1 << 17, 1 << 13, 64
SWEEPS = 6
#: Added to the count of a word in its class; weight of a class's frequency in its transitions; tokens of its shape that
#: are added to what a word outside the sweeps was seen beside, since a few contexts say little.
EMIT, MOVE, PRIOR = 1.0, float(CLASSES), 4.0
#: Bytes of a text whose words are listed at once, and words or pairs a task counts before it hands them on.
SLICE, FLUSH = 1 << 20, 200_000
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_SIZES, _KINDS, _ENDS = 3, 4, 16
SHAPES = _SIZES * _KINDS * _ENDS
#: The end of a text is item 0; words follow in order of frequency, then the shapes.
END = 0


def shape_of(word: bytes) -> int:
    """What is known of a word that has no number: its length, what it is made of, and a hash of its last two bytes."""
    size = 0 if len(word) < 6 else 1 if len(word) < 10 else 2
    kind = 0 if word.isalpha() else 1 if word.isdigit() else 2 if not word.isascii() else 3
    return (size * _KINDS + kind) * _ENDS + zlib.crc32(word[-2:]) % _ENDS


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, A-Z in lower case, in lists of those of about SLICE bytes."""
    at = 0
    while len(text) - at > SLICE:
        found = _GAP.search(text, at + SLICE)
        if found is None:
            break
        yield text[at : found.start()].lower().split()
        at = found.start()
    yield (text[at:] if at else text).lower().split()


def _binary(text_col: str) -> Column:
    return text_of(text_col).cast("binary")


# --- counting ---------------------------------------------------------------------------------------------------------


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) of a table with one binary column."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for text in b.column(0).to_pylist():
                for words in words_of(text):
                    seen.update(words)
                    if len(seen) > FLUSH:
                        yield rows()
                        seen.clear()
        yield rows()

    return texts.mapInArrow(thrifty(count), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Words:
    """The words that travel: ``counts[i]`` is of item i (the end, then ``words``)."""

    words: list[bytes]
    counts: np.ndarray

    @property
    def first_shape(self) -> int:
        return len(self.words) + 1


def _encoder(own: Words):
    index = {w: i + 1 for i, w in enumerate(own.words)}
    find, base = index.get, own.first_shape

    def encode(text: bytes) -> tuple[np.ndarray, list[bytes]]:
        """The items of a text, the end behind; and its words that have no number, each time they occur."""
        parts, rest = [], []
        for words in words_of(text):
            items = list(map(find, words))
            if None in items:
                new = [w for w, i in zip(words, items, strict=True) if i is None]
                shapes = iter([base + shape_of(w) for w in new])
                items = [next(shapes) if i is None else i for i in items]
                rest += new
            parts.append(np.array(items, np.int32))
        parts.append(np.array([END], np.int32))
        return np.concatenate(parts), rest

    return encode


ENCODED = "train boolean, a long, b long, items binary, rest array<binary>"


def encode_texts(docs: DataFrame, learn: Column, id_col: str, text_col: str, shared) -> DataFrame:
    """ENCODED: whether the row may be learned from, a hash of (id, text) in two parts, its items and its other words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared.value)
        for b in batches:
            items, rest = [], []
            for text in b.column("text").to_pylist():
                ids, words = encode(text)
                items.append(ids.tobytes())
                rest.append(words)
            made = [b.column("train"), b.column("a"), b.column("b"), pa.array(items, pa.binary()), pa.array(rest, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(made, ["train", "a", "b", "items", "rest"])

    rows = docs.select(F.coalesce(learn, F.lit(False)).alias("train"), *_key(id_col, text_col), _binary(text_col).alias("text"))
    return rows.mapInArrow(thrifty(run), ENCODED)


def _key(id_col: str, text_col: str) -> list[Column]:
    """Equal for rows that are equal in id and text, which get equal scores."""
    return [F.xxhash64(F.col(id_col), F.col(text_col)).alias("a"), F.xxhash64(F.lit(1), F.col(text_col), F.col(id_col)).alias("b")]


def _items(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for raw in batch.column("items"):
        yield np.frombuffer(raw.as_buffer(), np.int32)


def _pairs(encoded: DataFrame, code) -> DataFrame:
    """(k, n): how often each number that ``code`` makes of a text's items occurs, in texts that may be learned from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, held, size = code(), [], 0

        def rows() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.int64), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["k", "n"])

        for b in batches:
            for items in _items(b):
                held.append(make(items))
                size += len(held[-1])
                if size > 10 * FLUSH:
                    yield rows()
                    held, size = [], 0
        yield rows()

    made = encoded.where("train").select("items").mapInArrow(thrifty(run), "k long, n long")
    return made.groupBy("k").agg(F.sum("n").alias("n"))


# --- exchange ---------------------------------------------------------------------------------------------------------


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


@dataclass
class Matrix:
    """Class bigrams: ``n[a, b]`` is how often class b follows class a."""

    n: np.ndarray
    after: np.ndarray = field(init=False)
    first: np.ndarray = field(init=False)

    def __post_init__(self):
        self.after, self.first = self.n.sum(axis=0), self.n.sum(axis=1)

    def gains(self, left: np.ndarray, right: np.ndarray, own: float) -> np.ndarray:
        """What the likelihood of the class bigrams gains when a word joins each of the classes. ``left[a]`` and
        ``right[a]`` are how often class a comes before and behind the word, ``own`` how often the word itself."""
        n, a, b = self.n, np.flatnonzero(left), np.flatnonzero(right)
        out = (_xlogx(n[a] + left[a, None]) - _xlogx(n[a])).sum(axis=0) + (_xlogx(n[:, b] + right[b]) - _xlogx(n[:, b])).sum(axis=1)
        diagonal = np.diag(n)
        both = left + right + own
        out += _xlogx(diagonal + both) - _xlogx(diagonal + left) - _xlogx(diagonal + right) + _xlogx(diagonal)
        for margin, more in ((self.after, left.sum() + own), (self.first, right.sum() + own)):
            out -= _xlogx(margin + more) - _xlogx(margin)
        return out

    def without(self, at: int, left: np.ndarray, right: np.ndarray, own: float) -> Matrix:
        n = self.n.copy()
        n[:, at] -= left
        n[at] -= right
        n[at, at] -= own
        return Matrix(np.maximum(n, 0.0))


def _contexts(pairs: DataFrame, width: int, side: str) -> DataFrame:
    """(item, other, n, side) rows of pairs ``k = first * width + second``."""
    first, second = F.floor(F.col("k") / width).cast("int"), F.pmod(F.col("k"), F.lit(width)).cast("int")
    item, other = (first, second) if side == "right" else (second, first)
    return pairs.select(item.alias("item"), other.alias("other"), "n", F.lit(side).alias("side"))


def exchange(pairs: DataFrame, items: int, classes: int, sweeps: int) -> np.ndarray:
    """Classes of ``items`` items, 0 .. classes - 1, from pairs of items ``k = first * items + second``.

    Item 0 keeps class 0 for itself. At first the others are dealt over the classes in their order. In each sweep half of
    the items, by turns, are moved to the class that gains most, given the classes of all others before the sweep.
    """
    spark = pairs.sparkSession
    both = _contexts(pairs, items, "left").unionByName(_contexts(pairs, items, "right"))
    # At most ``items`` neighbours a side, so a row is bounded.
    lists = [F.collect_list(F.when(F.col("side") == s, F.col(c))).alias(f"{s}_{c}") for s in ("left", "right") for c in ("other", "n")]
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = write_table(both.repartition(parts, "item").groupBy("item").agg(*lists), "contexts")
    now = np.arange(items) % max(1, classes - 1) + 1
    now[0] = 0

    def weigh(values, weights, group):
        return np.bincount(group[values.values.to_numpy()], weights.values.to_numpy().astype(float), minlength=classes) if len(values.values) else np.zeros(classes)

    def matrix_of(group: np.ndarray) -> Matrix:
        shared = spark.sparkContext.broadcast(group)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, of = np.zeros((classes, classes)), shared.value
            for b in batches:
                for item, others_, counts in zip(b["item"].to_pylist(), b["right_other"], b["right_n"], strict=True):
                    n[of[item]] += weigh(others_, counts, of)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n.ravel()[at])], ["k", "n"])

        found = rows.select("item", "right_other", "right_n").mapInArrow(run, "k long, n double").groupBy("k").agg(F.sum("n").alias("n")).collect()
        n = np.zeros(classes * classes)
        for k, v in found:
            n[k] = v
        return Matrix(n.reshape(classes, classes))

    for sweep in range(sweeps):
        shared = spark.sparkContext.broadcast((now, matrix_of(now)))

        def move(batches: Iterator[pa.RecordBatch], turn: int = sweep % 2) -> Iterator[pa.RecordBatch]:
            of, whole = shared.value
            moved, to = [], []
            for b in batches:
                for i, item in enumerate(b["item"].to_pylist()):
                    if item == END or (item * 2654435761 >> 7) % 2 != turn:
                        continue
                    counts = {}
                    own = 0.0
                    for s in ("left", "right"):
                        values, weights = b[f"{s}_other"][i], b[f"{s}_n"][i]
                        counts[s] = weigh(values, weights, of)
                        same = np.flatnonzero(values.values.to_numpy() == item) if len(values.values) else []
                        if len(same):
                            own = float(weights.values[same[0]].as_py())
                            counts[s][of[item]] -= own
                    gains = whole.without(of[item], counts["left"], counts["right"], own).gains(counts["left"], counts["right"], own)
                    gains[0] = -np.inf
                    best = int(np.argmax(gains))
                    if gains[best] > gains[of[item]] + 1e-9:
                        moved.append(item)
                        to.append(best)
            yield pa.RecordBatch.from_arrays([pa.array(moved, pa.int32()), pa.array(to, pa.int32())], ["item", "to"])

        changed = rows.mapInArrow(move, "item int, to int").collect()
        now = now.copy()
        for item, to in changed:
            now[item] = to
        if not changed and sweep:
            break
    drop_tables(rows)
    return now


# --- the model --------------------------------------------------------------------------------------------------------


@dataclass
class ClassModel:
    """``words`` travel with the classes of their items (shapes too); ``rest`` has (word, n, cls) of all others."""

    words: Words
    classes: np.ndarray
    rest: DataFrame
    #: log10 probabilities of a class after another; tokens and different words of each class, its shapes counted.
    moves: np.ndarray
    tokens: np.ndarray
    types: np.ndarray
    #: Of all training tokens: how many, and how many different ones.
    total: int
    distinct: int
    made: list[DataFrame] = field(default_factory=list)

    def emits(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 probability of a word with a count in its class; 0 is an unseen word's, one of each shape."""
        return np.log10((counts + EMIT) / (self.tokens[classes] + EMIT * self.types[classes]))

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.total + self.distinct + 1))


def _moves(n: np.ndarray) -> np.ndarray:
    """log10 P(class | class before): counts, and MOVE tokens spread as the classes' own frequencies are."""
    classes = len(n)
    own = (n.sum(axis=0) + 1) / (n.sum() + classes)
    return np.log10((n + MOVE * own) / (n.sum(axis=1, keepdims=True) + MOVE))


def train(encoded: DataFrame, words: Words, counted: DataFrame, classes: int = CLASSES, sweeps: int = SWEEPS) -> ClassModel:
    """The model of the ``encoded`` rows that may be learned from; ``counted`` has (word, n) of all their words."""
    spark = encoded.sparkSession
    known, base = len(words.words) + 1, words.first_shape
    moved = min(EXCHANGED + 1, known)
    shapes = np.concatenate([np.zeros(1, np.int64), [shape_of(w) for w in words.words]]).astype(np.int64)
    # In sweeps, words after the first ones are their shapes.
    small = np.concatenate([np.arange(moved), moved + shapes[moved:], moved + np.arange(SHAPES)])
    width = moved + SHAPES
    held = spark.sparkContext.broadcast(small)

    def of_items():
        of = held.value
        return lambda items: np.concatenate([[END], of[items[:-1]]]).astype(np.int64) * width + of[items]

    swept = exchange(_pairs(encoded, of_items), width, classes, sweeps)
    group = swept[small]
    group[moved:known] = _settled(encoded, group, words, moved, classes)
    matrix, rest, made = _rest(encoded, group, words, counted, classes)
    local = np.bincount(group[:known], weights=words.counts, minlength=classes)
    types = np.bincount(group, minlength=classes).astype(float)  # words that travel, and an unseen one of each shape
    total, distinct = float(words.counts.sum()), known
    for r in rest.groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        local[r["cls"]] += r["n"]
        types[r["cls"]] += r["words"]
        total, distinct = total + r["n"], distinct + r["words"]
    if not words.counts[END]:  # nothing was learned from: not even the end is known
        distinct = 0
    return ClassModel(words, group, rest, _moves(matrix), local, types, int(total), distinct, made)


def _matrix(encoded: DataFrame, group: np.ndarray, classes: int) -> np.ndarray:
    """Transitions between the classes of items."""
    shared = encoded.sparkSession.sparkContext.broadcast(group)

    def transitions():
        of = shared.value.astype(np.int64)
        return lambda items: np.concatenate([[of[END]], of[items[:-1]]]) * classes + of[items]

    out = np.zeros(classes * classes)
    for k, n in _pairs(encoded, transitions).collect():
        out[k] = n
    return out.reshape(classes, classes)


def _settled(encoded: DataFrame, group: np.ndarray, words: Words, moved: int, classes: int) -> np.ndarray:
    """Classes of the words that travel but were not in the sweeps: the one that gains most for each, to first order,
    which is near enough for words that are rare beside the classes."""
    known, spark = len(words.words) + 1, encoded.sparkSession
    if known == moved:
        return group[moved:known]
    matrix = _matrix(encoded, group, classes)
    shared = spark.sparkContext.broadcast(group)
    near, margins = np.log(matrix + 0.1), np.log(matrix.sum(axis=0) + 1.0) + np.log(matrix.sum(axis=1) + 1.0)
    usual = PRIOR * np.concatenate([(matrix / (matrix.sum(axis=0) + 1.0)).T, matrix / (matrix.sum(axis=1, keepdims=True) + 1.0)], axis=1)

    def contexts():
        of = shared.value.astype(np.int64)

        def make(items: np.ndarray) -> np.ndarray:
            after, before = of[items], np.concatenate([[of[END]], of[items[:-1]]])
            at = np.flatnonzero((items >= moved) & (items < known))  # never the last one, which is the end
            wide = items[at].astype(np.int64) * (2 * classes)
            return np.concatenate([wide + before[at], wide + classes + after[at + 1]])

        return make

    pairs = _pairs(encoded, contexts)
    each = pairs.groupBy(F.floor(F.col("k") / (2 * classes)).cast("int").alias("item")).agg(
        F.collect_list(F.pmod("k", F.lit(2 * classes)).cast("int")).alias("at"), F.collect_list("n").alias("n")
    )

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = np.zeros((b.num_rows, 2 * classes))
            sizes = np.diff(b["at"].offsets.to_numpy())
            both[np.repeat(np.arange(b.num_rows), sizes), b["at"].flatten().to_numpy()] = b["n"].flatten().to_numpy()
            both += usual[shared.value[b["item"].to_numpy()]]
            left, right = both[:, :classes], both[:, classes:]
            gains = left @ near + right @ near.T - left.sum(axis=1, keepdims=True) * margins
            gains[:, 0] = -np.inf
            yield pa.RecordBatch.from_arrays([b["item"], pa.array(gains.argmax(axis=1).astype(np.int32))], ["item", "to"])

    out = group[moved:known].copy()
    for item, to in each.mapInArrow(settle, "item int, to int").collect():
        out[item - moved] = to
    return out


def _rest(encoded: DataFrame, group: np.ndarray, words: Words, counted: DataFrame, classes: int) -> tuple[np.ndarray, DataFrame, list[DataFrame]]:
    """Transitions of all tokens, and (word, n, cls) of the words that don't travel, with the tables written."""
    spark, base = encoded.sparkSession, words.first_shape
    seen = _matrix(encoded, group, classes)
    gain = np.log(seen + 0.1) - np.log(seen.sum(axis=0) + 1.0)
    usual = PRIOR * (seen / (seen.sum(axis=0) + 1.0)).T @ gain
    shared = spark.sparkContext.broadcast((group, gain, usual))

    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(word, cls of the token before, cls of the word's shape, n) of the words that don't travel."""
        of = shared.value[0]
        found: Counter = Counter()

        def rows() -> pa.RecordBatch:
            keys = list(found)
            cols = [pa.array([k[j] for k in keys], t) for j, t in enumerate((pa.binary(), pa.int32(), pa.int32()))]
            return pa.RecordBatch.from_arrays([*cols, pa.array(list(found.values()), pa.int64())], ["word", "at", "like", "n"])

        for b in batches:
            for items, rest in zip(_items(b), b["rest"].to_pylist(), strict=True):
                found.update(_after(items, rest, of, base))
                if len(found) > FLUSH:
                    yield rows()
                    found.clear()
        yield rows()

    made = encoded.where("train").select("items", "rest").mapInArrow(thrifty(before), "word binary, at int, like int, n long")
    # By word, so that sums of (word, at) and lists of words need no further shuffle; none of these words is frequent.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    summed = made.repartition(parts, "word").groupBy("word", "at", "like").agg(F.sum("n").alias("n"))
    lists = summed.groupBy("word").agg(F.max("like").alias("like"), F.collect_list("at").alias("at"), F.collect_list("n").alias("n"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row a word with its class; and rows without a word: how often that class followed class ``at`` in its
        place of the words' shapes."""
        _, gain, usual = shared.value
        moves = np.zeros((classes, classes))
        shifts = np.zeros((classes, classes))
        for b in batches:
            for k in range(0, b.num_rows, 1000):  # a row of ``gain`` for each entry is held at once
                part = b.slice(k, 1000)
                at, n = part["at"].flatten().to_numpy(), part["n"].flatten().to_numpy().astype(float)
                starts = part["at"].offsets.to_numpy()[: part.num_rows] - part["at"].offsets[0].as_py()
                cls = np.zeros(0, np.int32)
                if part.num_rows:
                    scores = np.add.reduceat(gain[at] * n[:, None], starts, axis=0) + usual[part["like"].to_numpy()]
                    scores[:, 0] = -np.inf
                    cls = scores.argmax(axis=1).astype(np.int32)
                    sizes = np.diff(np.append(starts, len(at)))
                    np.add.at(moves, (at, np.repeat(cls, sizes)), n)
                    np.add.at(shifts, (at, np.repeat(part["like"].to_numpy(), sizes)), n)
                uses = np.add.reduceat(n, starts).astype(np.int64) if part.num_rows else np.zeros(0, np.int64)
                none = pa.nulls(part.num_rows, pa.int32())
                yield pa.RecordBatch.from_arrays([part["word"], pa.array(uses), pa.array(cls), none], ["word", "n", "cls", "at"])
        a, c = np.nonzero(moves - shifts)
        change = (moves - shifts)[a, c].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(a), pa.binary()), pa.array(change), pa.array(c.astype(np.int32)), pa.array(a.astype(np.int32))], ["word", "n", "cls", "at"]
        )

    table = write_table(lists.mapInArrow(thrifty(choose), "word binary, n long, cls int, at int"), "classes")
    for r in table.where("word is null").groupBy("at", "cls").agg(F.sum("n").alias("n")).collect():
        seen[r["at"], r["cls"]] += r["n"]
    return seen, table.where("word is not null").select("word", "n", "cls"), [table]


def _after(items: np.ndarray, rest: Iterable[bytes], group: np.ndarray, base: int) -> Iterator[tuple[bytes, int, int]]:
    """(word, class of the token before, class of the word's shape) of a text's words without a number."""
    at = np.flatnonzero(items >= base)
    before = group[np.where(at > 0, items[at - 1], END)]
    return zip(rest, before.tolist(), group[items[at]].tolist(), strict=True)


def _most_frequent(counted: DataFrame, most: int) -> list[tuple[int, bytes]]:
    """(-n, word) of the most frequent words, most frequent first: as many as there are above the least frequency that at
    most ``most`` words reach. Frequencies are cut at sixteenths of an octave, so the driver gets a short histogram and
    the words that it keeps."""
    level = F.floor(F.log2("n") * 16).cast("int")
    sizes = counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect()
    cut, held = None, 0
    for r in sorted(sizes, key=lambda r: -r["level"]):
        held += r["words"]
        if held > most:
            break
        cut = r["level"]
    return [] if cut is None else sorted((-r["n"], bytes(r["word"])) for r in counted.where(level >= cut).collect())


def learn_classes(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES, local: int = LOCAL) -> tuple[ClassModel, DataFrame]:
    """The model learned from the rows where ``learn`` holds, and all rows ENCODED.

    Counts, classes and transitions come from every such row and its whole text; null texts count as empty ones, which
    are an end alone. ``local`` bounds what travels to tasks, not what is learned.
    """
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    learned = docs.where(learn).select(_binary(text_col).alias("text"))
    counted = write_table(count_words(learned), "words")
    top = _most_frequent(counted.where(F.octet_length("word") <= WORD_BYTES), local)
    words = Words([w for _, w in top], np.array([docs.where(learn).count(), *[-n for n, _ in top]], float))
    encoded = write_table(encode_texts(docs, learn, id_col, text_col, spark.sparkContext.broadcast(words)), "encoded")
    model = train(encoded, words, counted, classes)
    drop_tables(counted)
    return model, encoded


def score_texts(
    docs: DataFrame, model: ClassModel, encoded: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    made: tuple[str, ...] = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
) -> DataFrame:
    """All input columns but the text, and: tokens of the text (its end included), those known from training, the
    number of training tokens, the add-one unigram score and the class model's score, log10 probabilities both.

    A null text is an empty one. Rows equal in id and text get equal scores. Input columns named as an output are
    replaced. An empty table gives no rows.
    """
    spark, base = docs.sparkSession, model.words.first_shape
    counts, known = model.words.counts, len(model.words.words) + 1
    emits = np.concatenate([model.emits(counts, model.classes[:known]), np.zeros(SHAPES)])
    unigram = np.concatenate([model.base(counts), np.zeros(SHAPES)])
    heard = np.concatenate([counts > 0, np.zeros(SHAPES, bool)])
    shared = spark.sparkContext.broadcast((model.classes, model.moves, emits, unigram, heard))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row a text for the words that travel (``word`` is null), and one for every other word, class before it
        and class of its shape, as often as they occur."""
        of, moves, emit, one, was = shared.value
        names = ["a", "b", "word", "at", "like", "tokens", "known", "base", "score"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

        def rows(*cols) -> pa.RecordBatch:
            n = len(cols[0])
            return pa.RecordBatch.from_arrays([pa.nulls(n, t) if c is None else pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

        for b in batches:
            keys = list(zip(b["a"].to_pylist(), b["b"].to_pylist(), strict=True))
            sums, key_a, key_b, words, times = [], [], [], [], []
            for key, items, rest in zip(keys, _items(b), b["rest"].to_pylist(), strict=True):
                cls = of[items]
                near = items < base
                score = (moves[np.concatenate([[of[END]], cls[:-1]])[near], cls[near]] + emit[items[near]]).sum()
                sums.append((len(items), int(was[items].sum()), float(one[items].sum()), float(score)))
                found = Counter(_after(items, rest, of, base))
                words += found
                times += found.values()
                key_a += [key[0]] * len(found)
                key_b += [key[1]] * len(found)
                if len(words) > FLUSH:
                    yield rows(key_a, key_b, *zip(*words, strict=True), times, None, None, None)
                    key_a, key_b, words, times = [], [], [], []
            if words:
                yield rows(key_a, key_b, *zip(*words, strict=True), times, None, None, None)
            if keys:
                yield rows(*zip(*keys, strict=True), None, None, None, *zip(*sums, strict=True))

    parts = write_table(
        encoded.mapInArrow(thrifty(run), "a long, b long, word binary, at int, like int, tokens long, known long, base double, score double"), "scores"
    )
    near = parts.where("word is null").select("a", "b", "tokens", "known", "base", "score", F.lit(1).alias("copies"))
    far = parts.where("word is not null").select("a", "b", "word", "at", "like", F.col("tokens").alias("times"))
    found = far.join(model.rest.withColumnRenamed("n", "uses"), "word", "left")
    cls, uses = F.coalesce("cls", "like"), F.coalesce("uses", F.lit(0))
    size = len(model.moves)
    grid = spark.createDataFrame([(a, c, float(model.moves[a, c]), float(model.tokens[c] + EMIT * model.types[c])) for a in range(size) for c in range(size)], "_at int, _cls int, move double, whole double")
    found = found.withColumns({"cls": cls, "uses": uses}).join(F.broadcast(grid), (F.col("at") == F.col("_at")) & (F.col("cls") == F.col("_cls")))
    times = F.col("times")
    far = found.select(
        "a", "b", F.lit(0).cast("long").alias("tokens"), F.when(F.col("uses") > 0, times).otherwise(0).alias("known"),
        (times * F.log10((F.col("uses") + 1) / (model.total + model.distinct + 1))).alias("base"),
        (times * (F.col("move") + F.log10((F.col("uses") + EMIT) / F.col("whole")))).alias("score"), F.lit(0).alias("copies")
    )
    sums = near.unionByName(far).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("tokens", "known", "base", "score", "copies")])
    each = lambda c: F.col(f"_{c}") / F.col("_copies")  # noqa: E731  of rows repeated whole
    sums = sums.select(F.col("a").alias("_a"), F.col("b").alias("_b"), *[F.col(c).alias(f"_{c}") for c in sums.columns[2:]])
    key_a, key_b = _key(id_col, text_col)
    keep = [c for c in others(docs, list(made)) if c != text_col]
    rows = docs.select(*keep, key_a.alias("_ka"), key_b.alias("_kb")).join(sums, (F.col("_ka") == F.col("_a")) & (F.col("_kb") == F.col("_b")))
    values = [each("tokens").cast("long"), each("known").cast("long"), F.lit(model.total).cast("long"), each("base"), each("score")]
    return rows.select(*keep, *[v.alias(n) for v, n in zip(values, made, strict=True)])
