"""Best-fit packing: length patterns fitted by non-negative least squares, residuals packed best-fit.

Everything the driver sees is the histogram of piece lengths (at most ``capacity`` numbers) and the packing
plan made from it; pieces themselves stay distributed.
"""

from __future__ import annotations

import bisect
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import slices, small_batches, text_of, thrifty, write_table

END_ID = 1
#: Words kept during a task (in each of two generations), and between tasks, when the process may do other work.
CACHED_WORDS, KEPT_WORDS = 400_000, 60_000
#: Neither Latin letters and ASCII signs, for which Python's lower case is the tokenizer's, nor free of the controls that
#: only Python's str.split() takes for white space.
ODD = re.compile("[\x1c-\x1f\u0250-\U0010ffff]")
NOT_SPACE = re.compile("[\x1c-\x1f]")
NOT_LATIN = re.compile("[^\x00-\u024f]")
#: ASCII signs between a letter and white space are a pre-token of their own either way. Where no two signs (or
#: controls) stand side by side, setting the most frequent ones apart takes no pattern.
RUN = re.compile(r"[\x00-\x08\x0e-\x1b!-/:-@\[-`{-\xa9\xab-\xb4\xb6-\xb9\xbb-\xbf\xd7\xf7]{2}")
MARK = re.compile(r"(?<=[a-z\u00df-\u00f6\u00f8-\u00ff])([!-/:-@\[-`{-~]+)(?=\s|$)")


def byte_alphabet() -> dict[int, int]:
    """The characters that byte-level vocabularies write for bytes: visible ones stand for themselves, the others are
    numbered from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


ALPHABET = byte_alphabet()


class WordIds:
    """The ids (little-endian, 32 bits) of words, kept for words seen lately: two generations of CACHED_WORDS each."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return _as_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def of(self, words: list[str]) -> bytes:
        """The ids of the words, one after the other."""
        found = list(map(self.young.get, words))
        if None in found:
            new = {w for w, ids in zip(words, found, strict=True) if ids is None}
            if len(self.young) + len(new) > CACHED_WORDS:
                self.old, self.young = self.young, {}
                new = set(words)
            unseen = []
            for w in new:
                ids = self.old.get(w)
                if ids is None:
                    unseen.append(w)
                else:
                    self.young[w] = ids
            self._learn(unseen)
            found = map(self.young.__getitem__, words)
        return b"".join(found)

    def shrink(self) -> None:
        """Keep the words learned first, which are mostly the frequent ones."""
        self.old = {}
        self.young = dict(islice(self.young.items(), KEPT_WORDS))

    def _learn(self, words: list[str]) -> None:
        other, young, model = [], self.young, self.tokenizer.model
        for w in words:
            # A lower-case word of Latin letters is one pre-token, so the model can take it without the stages before.
            if not w.isalpha():
                other.append(w)
            elif w.isascii() and w.islower():
                ids = [t.id for t in model.tokenize(w)]
                young[w] = struct.pack(f"<{len(ids)}I", *ids)
            elif w == w.lower() and not NOT_LATIN.search(w):
                ids = [t.id for t in model.tokenize(w.encode().decode("latin-1").translate(ALPHABET))]
                young[w] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                other.append(w)
        if other:
            for w, e in zip(other, self.tokenizer.encode_batch(other, add_special_tokens=False), strict=True):
                young[w] = _as_bytes(e.ids)


_word_ids: dict[str, WordIds] = {}


def _as_bytes(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def encode_texts(texts: Iterable[str | None], path: str) -> Iterator[bytes]:
    """For each text its ids as little-endian 32-bit integers.

    Word by word: the tokenizer's pre-tokens never cross white space, so a text's ids are those of its words, and
    words recur. Texts with special tokens or control characters that only Python calls white space go whole.
    """
    if path not in _word_ids:
        _word_ids[path] = WordIds(path)
    table = _word_ids[path]
    for text in texts:
        text = text or ""
        odd = not text.isascii() and ODD.search(text) or NOT_SPACE.search(text)
        if "<|" in text or odd and NOT_SPACE.search(text):
            yield table.whole(text)
            continue
        yield b"".join(table.of(_words(part, odd)) for part in slices(text))


def _words(text: str, odd: object) -> list[str]:
    """The words; without odd characters lower-cased, with signs at their ends set apart, so that fewer are different."""
    if not odd:
        text = text.lower()
        if RUN.search(text):
            text = MARK.sub(r" \1", text)
        else:
            text = text.replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n")
    return text.split()


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32. A document's ids end with END_ID; it is cut only every
    ``capacity`` ids, so only the last piece can be shorter."""
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = _as_bytes([END_ID])
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encode_texts(b.column(1).to_pylist(), tokenizer_path)):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                ["id", "piece", "start", "length", "ids_crc32"]
            )
        if tokenizer_path in _word_ids:
            _word_ids[tokenizer_path].shrink()

    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(
        thrifty(cut), f"id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """min |a x - b| over x >= 0, by active sets."""
    n = a.shape[1]
    x, inside = np.zeros(n), np.zeros(n, bool)
    slack = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0.0)))
    for _ in range(rounds):
        w = a.T @ (b - a @ x)
        w[inside] = -np.inf
        j = int(np.argmax(w))
        if w[j] <= slack:
            break
        inside[j] = True
        while True:
            at = np.flatnonzero(inside)
            s = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[at] = s
                break
            old = x[at]
            down = s <= 0
            step = np.min(old[down] / np.maximum(old[down] - s[down], 1e-300))
            x[at] = old + step * (s - old)
            inside[at[x[at] <= 1e-12 * max(1.0, x.max())]] = False
            x[~inside] = 0
            if not inside.any():
                break
    return x


def patterns(classes: int, most: int) -> list[tuple[int, ...]]:
    """Multisets of up to ``most`` length classes (1 to ``classes``), largest first, that fill a sequence."""
    out = []

    def add(head: tuple[int, ...], left: int) -> None:
        if left == 0:
            out.append(head)
        elif len(head) < most:
            for c in range(min(left, head[-1] if head else classes), 0, -1):
                if c * (most - len(head)) >= left:
                    add((*head, c), left - c)

    add((), classes)
    return out


def plan_packing(counts: dict[int, int], capacity: int = 4096, classes: int = 64, most: int = 4) -> list[tuple[tuple[int, ...], int]]:
    """Sequences for ``counts`` pieces of each length: (lengths in a sequence, how many such sequences).

    Lengths fall into ``classes`` equal classes. Patterns of up to ``most`` classes that fill a sequence get repeat
    counts by non-negative least squares on the histogram, rounded down. A pattern's sequences take the longest
    lengths of its classes, and as last piece the longest that still fits. What is left is packed best-fit, longest
    first, into the gaps and then into new sequences. Work depends on the number of different lengths and not on the
    number of pieces: equal sequences are handled as one.
    """
    left = {n: c for n, c in sorted(counts.items()) if c > 0}
    done: list[tuple[tuple[int, ...], int]] = []
    if left.get(capacity):
        done.append(((capacity,), left.pop(capacity)))
    lengths = sorted(left)  # those with pieces left, ascending
    width = capacity / classes

    def take(n: int, m: int) -> None:
        left[n] -= m
        if not left[n]:
            del left[n]
            lengths.pop(bisect.bisect_left(lengths, n))

    open_: dict[int, list[list]] = {}  # gap: [[lengths, how many]]
    gaps: list[int] = []

    def keep(seq: tuple[int, ...], m: int) -> None:
        gap = capacity - sum(seq)
        if gap == 0:
            done.append((seq, m))
            return
        if gap not in open_:
            open_[gap] = []
            bisect.insort(gaps, gap)
        open_[gap].append([seq, m])

    if lengths:
        forms = patterns(classes, most)
        a = np.zeros((classes, len(forms)))
        for j, form in enumerate(forms):
            for c in form:
                a[c - 1, j] += 1
        b = np.zeros(classes)
        for n, c in left.items():
            b[int(np.ceil(n / width)) - 1] += c
        times = np.floor(nnls(a, b) + 1e-6).astype(np.int64)
        for j in sorted(np.flatnonzero(times), key=lambda j: -forms[j][0]):
            parts = [((), int(times[j]))]
            for c in forms[j][:-1]:
                low, high, nxt = (c - 1) * width, c * width, []
                for seq, m in parts:
                    while m:
                        i = bisect.bisect_right(lengths, min(high, capacity - sum(seq))) - 1
                        if i < 0 or lengths[i] <= low:
                            if seq:
                                keep(seq, m)
                            break
                        n = lengths[i]
                        k = min(m, left[n])
                        take(n, k)
                        nxt.append(((*seq, n), k))
                        m -= k
                parts = nxt
            for seq, m in parts:
                while m:
                    i = bisect.bisect_right(lengths, capacity - sum(seq)) - 1
                    if i < 0:
                        if seq:
                            keep(seq, m)
                        break
                    n = lengths[i]
                    k = min(m, left[n])
                    take(n, k)
                    keep((*seq, n), k)
                    m -= k
    for n in sorted(left, reverse=True):
        m = left[n]
        while m:
            i = bisect.bisect_left(gaps, n)
            if i == len(gaps):
                q = min(m, capacity // n)
                keep((n,) * q, m // q)
                m %= q
                continue
            gap = gaps[i]
            seq, k = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
                gaps.pop(i)
            q = min(m, gap // n)
            use = min(k, m // q)
            keep(seq + (n,) * q, use)
            if k > use:
                keep(seq, k - use)
            m -= q * use
    return done + [(seq, m) for parts in open_.values() for seq, m in parts]


def slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length, runs of its pieces' ranks: where a run starts, and its first sequence and place in it.
    A run's ranks go to consecutive sequences, at the same place in each."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for seq, m in plan:
        place = 0
        for n in seq:
            at = rank.get(n, 0)
            rows.append((n, at, sequence, place))
            rank[n] = at + m
            place += n
        sequence += m
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4)
    return {"key": (cols[:, 0] << 48) + cols[:, 1], "rank": cols[:, 1], "sequence": cols[:, 2], "offset": cols[:, 3]}


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents packed into sequences of at most ``capacity`` ids, a row per piece: id, piece, start, length,
    ids_crc32, sequence_id, offset.

    A document's ids are those of the tokenizer file (no special tokens added) and END_ID; null and empty texts are
    END_ID alone. Only longer documents are cut, into pieces of ``capacity`` ids. Rows with equal ids are packed
    each for itself. Equal pieces may share any order. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    pieces = write_table(token_pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = spark.sparkContext.broadcast(slots(plan_packing(counts, capacity)))

    # Ranks among pieces of one length: inside lanes, then lanes after each other, as a length may hold most pieces.
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pieces.withColumn("lane", F.pmod(F.xxhash64("id", "piece", "start"), F.lit(lanes)))
    before = Window.partitionBy("length").orderBy("lane")
    starts = rows.groupBy("length", "lane").agg(F.count(F.lit(1)).alias("n")).select("length", "lane", (F.sum("n").over(before) - F.col("n")).alias("first"))
    ranked = rows.withColumn("rn", F.row_number().over(Window.partitionBy("length", "lane").orderBy("id", "piece", "ids_crc32"))).join(starts, ["length", "lane"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = runs.value
        for b in batches:
            length, rank = (b.column(k).to_numpy(zero_copy_only=False) for k in ("length", "rank"))
            at = np.searchsorted(t["key"], (length << 48) + rank, side="right") - 1
            sequence, offset = t["sequence"][at] + rank - t["rank"][at], t["offset"][at]
            keep = [b.column(k) for k in ("id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)], ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = docs.schema[id_col].dataType.simpleString()
    slim = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("rn") - 1).cast("long").alias("rank"))
    out = slim.mapInArrow(place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
