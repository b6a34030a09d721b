"""Which tokens of two tokenizers stand for the same bytes, by segments that are tokenised once.

1. ``cut``: texts are cut before runs of white space where neither vocabulary can merge across the cut (``Pair`` finds
   from the vocabularies which white space that is). Texts are gathered into chunks of bounded size; a chunk's different
   segments are its dictionary, and a text is a list of places in it.
2. ``align``: the dictionaries' entries are sorted by segment. Equal ones lie side by side, so each different segment is
   tokenised and aligned once, and each entry gets the result on the way. A segment is in a dictionary once, so even
   the most frequent one comes as often as there are chunks, not occurrences.
3. ``compose``: each chunk gets its dictionary, then its texts, in one stream; texts become digests and counted links,
   and the chunk counts how many of its documents hold each linked pair of ids.
4. Counts of pairs are summed over chunks, joined back to the chunks' pairs, and summed over each text's links.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import drop_tables, small_batches, text_of, thrifty, write_table
from claimloom.llm.packing import ALPHABET

#: Characters of text in a chunk, of segments that are tokenised together, and rows handed on at once.
CHUNK, TOGETHER, ROWS = 32 << 20, 1 << 16, 2000
WHITE = " \t\n\r\x0b\x0c"
SPACE_SIGN = "▁"
#: A pair of ids is one number: A's times this, and B's.
SHIFT = 1 << 31


#: Behind these no text is cut: what some tokenizer may hold for white space, and signs without a width.
DUBIOUS = r"\s\x00-\x20\x7f-\xa0\u180e\u200b-\u200f\u2028-\u202f\u205f-\u206f\u2581\u3000\ufeff"
_DUBIOUS = re.compile(f"[{DUBIOUS}]")
#: A text without any of them in ASCII, and without others before white space, is cut before all white space.
_CONTROLS = "".join(map(chr, [*range(9), *range(14, 32), 127]))
_BEFORE_WHITE = re.compile(f"(?![{WHITE}])[{DUBIOUS}][{WHITE}]")
_PARTS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


class Pair:
    """Both tokenizers, the bytes of their tokens, and the white space before which a text can be cut.

    A cut before a white space character ``w`` is safe if no token of either vocabulary has another character right
    before a ``w`` inside it (runs of white space are never cut), and if the second tokenizer, which puts a space in
    front, can't merge that space with a ``w`` that is none. The first tokenizer's own pre-tokens end before white
    space anyway.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        back = {chr(c): b for b, c in ALPHABET.items()}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece) if self.b.is_byte(i) else None
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE_SIGN, " ").encode())
        self.cuts = "".join(w for w in WHITE if self._safe(w.encode()))
        self.front = self.b.piece_to_id(SPACE_SIGN)
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in known], np.int64) for known in (self.bytes_a, self.bytes_b))
        self._odd = _CONTROLS + "".join(w for w in WHITE if w not in self.cuts)

    def _safe(self, w: bytes) -> bool:
        if self.a.normalizer is not None:
            return False
        white = WHITE.encode()
        for token in (*self.bytes_a, *self.bytes_b):
            at = token.find(w, 1)
            while at > 0:
                before = token[:at]
                last = before.decode(errors="ignore")[-1:]
                if before[-1] not in white and (not before.endswith(last.encode() or b"?") or not _DUBIOUS.match(last)):
                    return False
                if w != b" " and before.endswith(b" "):
                    return False
                at = token.find(w, at + 1)
        return True

    def segments(self, text: str) -> list[str]:
        """The text with a space in front, in segments: each but the first starts with a run of white space."""
        text = f" {text}"
        parts = _PARTS.findall(text)
        if not any(map(text.__contains__, self._odd)) and (text.isascii() or not _BEFORE_WHITE.search(text)):
            return parts
        out, now = [], parts[:1]
        for part in parts[1:]:
            if part[0] in self.cuts and not _DUBIOUS.match(now[-1][-1]):
                out.append("".join(now))
                now = [part]
            else:
                now.append(part)
        return [*out, "".join(now)]

    def said(self, segments: list[str]) -> list[str | None]:
        """The groups of each segment as text, None for one that a tokenizer doesn't give back byte for byte.

        Segments that can be cut before and behind are put together again, as many as TOGETHER holds: cutting them was
        safe, so the ids of the whole are theirs, one segment after the other.
        """
        out: list[str | None] = [None] * len(segments)
        block, size = [], 0
        for i, s in enumerate(segments):
            if s[0] not in self.cuts or _DUBIOUS.match(s[-1]):
                out[i] = self._alone(s)
                continue
            block.append(i)
            size += len(s)
            if size > TOGETHER:
                self._together(segments, block, out)
                block, size = [], 0
        if block:
            self._together(segments, block, out)
        return out

    def _together(self, segments: list[str], block: list[int], out: list[str | None]) -> None:
        own = [segments[i] for i in block]
        # A segment in front takes the space that the second tokenizer adds.
        text = "".join(["a", *own])
        found = self._groups(self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text, num_threads=1), f" {text}")
        if found is not None:
            ends, groups = found
            last = np.cumsum([2, *[len(s) if s.isascii() else len(s.encode()) for s in own]])
            at = np.searchsorted(ends, last)
            if (ends[np.minimum(at, len(ends) - 1)] == last).all():
                for i, lo, hi in zip(block, at[:-1] + 1, at[1:] + 1, strict=True):
                    out[i] = groups[lo] if hi - lo == 1 else ";".join(groups[lo:hi])
                return
        for i in block:
            out[i] = self._alone(segments[i])

    def _alone(self, segment: str) -> str | None:
        a = self.a.encode(segment, add_special_tokens=False).ids
        # The second tokenizer puts a space in front by itself; where the segment has none, its piece goes again.
        b = self.b.encode(segment[1:] if segment[0] == " " else segment, num_threads=1)
        if segment == " ":
            b = [self.front]  # of nothing it would make nothing
        elif segment[0] != " ":
            if b[:1] != [self.front]:
                return None
            b = b[1:]
        found = self._groups(a, b, segment)
        return None if found is None else ";".join(found[1])

    def _groups(self, a: list[int], b: list[int], text: str) -> tuple[np.ndarray, list[str]] | None:
        """Byte offsets where tokens of both end, and the ids up to each as text; None if these aren't the text."""
        raw = text.encode()
        if not a or not b or b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        first, second = list(map(str, a)), list(map(str, b))
        to_a, to_b = (np.searchsorted(x, ends, side="right").tolist() for x in (ends_a, ends_b))
        cuts = zip([0, *to_a], to_a, [0, *to_b], to_b, strict=False)
        return ends, [f"{first[i] if j - i == 1 else ','.join(first[i:j])}|{second[p] if q - p == 1 else ','.join(second[p:q])}" for i, j, p, q in cuts]


_pairs: dict[tuple[str, str], Pair] = {}


def pair_of(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


CUT = "chunk long, at int, segment string, id ID, places binary"


def cut(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, chunk: int = CHUNK) -> DataFrame:
    """CUT: a row for each text of a chunk (id, places in the chunk's dictionary) and for each entry of its dictionary
    (at, segment). A chunk is what one task reads until it has ``chunk`` bytes; the rows must be written before they
    are used. Places are ordered by how often they occur, so they are mostly small and pack well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, codec = pair_of(path_a, path_b), pa.Codec("zstd", 1)
        number = TaskContext.get().partitionId() << 32

        def rows(ids: pa.Array | None, places: list, at: list, segments: list) -> pa.RecordBatch:
            n, m = len(places), len(at)
            ids = ids if n else pa.nulls(0, kind)
            cols = [
                pa.array([number] * (n + m), pa.int64()), pa.array([None] * n + at, pa.int32()), pa.array([None] * n + segments, pa.string()),
                pa.concat_arrays([ids, pa.nulls(m, kind)]), pa.array(places + [None] * m, pa.binary())
            ]
            return pa.RecordBatch.from_arrays(cols, ["chunk", "at", "segment", "id", "places"])

        def flush() -> Iterator[pa.RecordBatch]:
            if not texts:
                return
            names = list(index)
            times = np.bincount(np.concatenate(texts), minlength=len(names)) if names else np.zeros(0, np.int64)
            order = np.argsort(-times, kind="stable")
            place = np.empty(len(names), np.int32)
            place[order] = np.arange(len(names), dtype=np.int32)
            packed = [_packed(place[t], codec) for t in texts]
            all_ids = pa.concat_arrays(ids)
            for k in range(0, len(packed), ROWS):
                yield rows(all_ids.slice(k, ROWS), packed[k : k + ROWS], [], [])
            for k in range(0, len(names), 20 * ROWS):
                part = order[k : k + 20 * ROWS]
                yield rows(None, [], list(range(k, k + len(part))), [names[j] for j in part])

        index: dict[str, int] = {}
        texts: list[np.ndarray] = []
        ids: list[pa.Array] = []
        size, kind = 0, None
        for b in batches:
            kind = b.schema.field(0).type
            for i, text in enumerate(b.column(1)):
                text = text.as_py()
                found = pair.segments(text) if text else []
                for s in set(found).difference(index):
                    index[s] = len(index)
                texts.append(np.array(list(map(index.__getitem__, found)), np.int32))
                ids.append(b.column(0).slice(i, 1))
                size += len(text) + 64
                if size > chunk:
                    yield from flush()
                    number, size = number + 1, 0
                    index.clear()
                    texts.clear()
                    ids.clear()
        yield from flush()

    kind_of = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(thrifty(run), CUT.replace("ID", kind_of))


ALIGNED = "chunk long, at int, said string"


def align(entries: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """ALIGNED for entries (chunk, at, segment) of dictionaries: their groups as text, null for segments that a tokenizer
    doesn't give back byte for byte. Equal segments come one after the other and are tokenised once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(path_a, path_b)
        before, last = None, None
        for b in batches:
            for k in range(0, b.num_rows, 10 * ROWS):
                part = b.slice(k, 10 * ROWS)
                segments = part["segment"]
                fresh = np.ones(len(segments), bool)
                fresh[1:] = pc.not_equal(segments[1:], segments[:-1]).to_numpy(zero_copy_only=False)
                fresh[0] = segments[0].as_py() != before
                said = [last, *pair.said(segments.filter(pa.array(fresh)).to_pylist())]
                before, last = segments[-1].as_py(), said[-1]
                yield pa.RecordBatch.from_arrays([part["chunk"], part["at"], pa.array(said, pa.string()).take(pa.array(np.cumsum(fresh)))], ["chunk", "at", "said"])

    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entries.repartition(parts, "segment").sortWithinPartitions("segment").mapInArrow(thrifty(run), ALIGNED)


def _packed(numbers: np.ndarray, codec: pa.Codec) -> bytes:
    raw = numbers.astype(np.int32).tobytes()
    return len(raw).to_bytes(8, "little") + codec.compress(raw, asbytes=True)


def _unpacked(raw: bytes, codec: pa.Codec) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    return np.frombuffer(codec.decompress(raw[8:], decompressed_size=size), np.int32) if size else np.zeros(0, np.int32)


def _streamed(entries: DataFrame, texts: DataFrame) -> DataFrame:
    """Both by chunk, each chunk's entries before its texts: a task holds one chunk's dictionary at a time."""
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = entries.unionByName(texts, allowMissingColumns=True)
    return both.repartition(parts, "chunk").sortWithinPartitions("chunk", F.col("at").isNull(), "at")


def _chunks(batches: Iterator[pa.RecordBatch], fields: list[str]) -> Iterator[tuple[pa.Table | None, pa.RecordBatch]]:
    """Goes through the rows of ``_streamed``: (a chunk's entries, its first texts), then (None, more of its texts)."""
    now, entries, told = None, [], True
    for b in batches:
        chunks = b["chunk"].to_numpy()
        texts = b["at"].is_null().to_numpy(zero_copy_only=False)
        turns = np.flatnonzero((np.diff(chunks) != 0) | (np.diff(texts.astype(np.int8)) != 0)) + 1
        for lo, hi in zip([0, *turns], [*turns, b.num_rows], strict=True):
            if lo == hi:
                continue
            if chunks[lo] != now:
                now, entries, told = chunks[lo], [], False
            part = b.slice(lo, hi - lo)
            if not texts[lo]:
                entries.append(part.select(fields))
                continue
            yield None if told else pa.Table.from_batches(entries, part.select(fields).schema), part
            entries, told = [], True


#: Entries of a dictionary that are taken apart at once; groups with more links are counted by different ids.
ENTRIES, MANY = 1 << 15, 64
_TO_SPACE = bytes.maketrans(b",|;", b"   ")


class _Dictionary:
    """The groups of a chunk's entries as arrays: what each entry has (n_a, n_b, groups, links), and its links as places
    among the chunk's ``pairs``."""

    def __init__(self, said: pa.ChunkedArray):
        """``said``: binary, null for entries that aren't ``ok``."""
        self.ok = said.is_valid().to_numpy(zero_copy_only=False) if len(said) else np.zeros(0, bool)
        self.said: list[bytes] = []
        tokens, sizes, pairs, index, weights = [np.zeros((0, 4), np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], []
        for at in range(0, len(said), ENTRIES):
            part = [x or b"" for x in said.slice(at, ENTRIES).to_pylist()]
            self.said += part
            own, links, times, of = self._taken_apart(part, self.ok[at : at + ENTRIES])
            tokens.append(own)
            sizes.append(np.bincount(of, minlength=len(part)))
            found, place = np.unique(links, return_inverse=True)
            pairs.append(found)
            index.append(place.astype(np.int32))
            weights.append(times)
        self.tokens, self.starts = np.concatenate(tokens), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        self.pairs = np.unique(np.concatenate(pairs))
        self.index = np.concatenate([np.zeros(0, np.int32), *[np.searchsorted(self.pairs, own).astype(np.int32)[i] for own, i in zip(pairs[1:], index, strict=True)]])
        self.weights = np.concatenate([np.zeros(0, np.int64), *weights])
        # Of the text at hand: how many links each pair has, and where it was seen last.
        self._sum, self._last = np.zeros(len(self.pairs), np.int64), np.zeros(len(self.pairs), np.int64)

    def _taken_apart(self, said: list[bytes], ok: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of some entries: what each has, and their links: pair, times, entry."""
        text = b"".join(x + b";" for x, fine in zip(said, ok, strict=True) if fine)
        if not text:
            none = np.zeros(0, np.int64)
            return np.zeros((len(said), 4), np.int64), none, none, none
        numbers = np.fromstring(text.translate(_TO_SPACE), np.int64, sep=" ")
        marks = np.frombuffer(text, np.uint8)
        marks = marks[(marks < 48) | (marks > 57)]  # what follows each id
        group = np.concatenate([[0], np.cumsum(marks == ord(";"))[:-1]])
        second = np.concatenate([[0], np.cumsum(marks == ord("|"))[:-1]]) > group
        groups = int(group[-1]) + 1
        n_a, n_b = (np.bincount(group[side], minlength=groups) for side in (~second, second))
        in_entry = np.zeros(len(said), np.int64)
        in_entry[ok] = [x.count(b";") + 1 for x, fine in zip(said, ok, strict=True) if fine]
        entry = np.repeat(np.arange(len(said)), in_entry)
        per = lambda values: np.bincount(entry, weights=values, minlength=len(said)).astype(np.int64)
        own = np.stack([per(n_a), per(n_b), in_entry, per(n_a * n_b)], axis=1)
        # A run of one character can be one group of very many equal tokens.
        many = (n_a * n_b > MANY)[group]
        few = _crossed(*[(group[m], numbers[m], np.ones(m.sum(), np.int64)) for m in (~second & ~many, second & ~many)], groups)
        parts = [few]
        if many.any():
            parts.append(_crossed(*[_different(group[m], numbers[m]) for m in (~second & many, second & many)], groups))
        of, links, times = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(of, kind="stable") if len(parts) > 1 else slice(None)
        return own, links[order], times[order], entry[of[order]]

    def links(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The different pairs that entries hold linked, and how many links each has."""
        sizes = self.starts[at + 1] - self.starts[at]
        flat = np.repeat(self.starts[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        index = self.index[flat]
        places = np.arange(len(index))
        self._last[index] = places
        held = np.sort(index[self._last[index] == places])
        np.add.at(self._sum, index, self.weights[flat])
        times = self._sum[held]
        self._sum[held] = 0
        return held, times


def _different(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, times) without repeats."""
    keys, times = np.unique(group * SHIFT + ids, return_counts=True)
    return keys // SHIFT, keys % SHIFT, times


def _crossed(first: tuple, second: tuple, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, times) of all of a group's first ids with all of its second ones; both are (group, id, times), in
    order of groups."""
    (of_a, ids_a, times_a), (of_b, ids_b, times_b) = first, second
    each = np.bincount(of_b, minlength=groups)
    sizes = each[of_a]
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    other = np.repeat(np.concatenate([[0], np.cumsum(each)])[of_a], sizes) + inside
    return np.repeat(of_a, sizes), np.repeat(ids_a, sizes) * SHIFT + ids_b[other], np.repeat(times_a, sizes) * times_b[other]


COMPOSED = "chunk long, id ID, links binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, at int, docs long"


def compose(entries: DataFrame, texts: DataFrame, kind_of: str) -> DataFrame:
    """COMPOSED: a row for each text with its numbers, digest and links (places among the chunk's pairs, then how many
    links each has), and one for each pair (pair, at) with how many of the chunk's documents hold it linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, own, chunk, kind, seen = pa.Codec("zstd", 1), None, None, None, np.zeros(0, np.int64)
        names = [c.split()[0] for c in COMPOSED.split(", ")]
        none = dict.fromkeys(names, pa.int64()) | {"links": pa.binary(), "groups_sha256": pa.string(), "at": pa.int32()}

        def batch(n: int, **cols) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([cols[k] if k in cols else pa.nulls(n, none[k]) for k in names], names)

        def counts() -> Iterator[pa.RecordBatch]:
            held = np.flatnonzero(seen)
            if len(held):
                yield batch(len(held), chunk=pa.array([chunk] * len(held)), id=pa.nulls(len(held), kind), pair=pa.array(own.pairs[held]), at=pa.array(held.astype(np.int32)), docs=pa.array(seen[held]))

        for table, part in _chunks(batches, ["said"]):
            if table is not None:
                yield from counts()
                own, chunk, kind = _Dictionary(table["said"].cast(pa.binary())), part["chunk"][0].as_py(), part["id"].type
                del table
                seen = np.zeros(len(own.pairs), np.int64)
            rows, digests, links = [], [], []
            for raw in part["places"].to_pylist():
                at = _unpacked(raw, codec)
                if not len(at) or not own.ok[at].all():
                    rows.append((0, 0, 0, 0))
                    digests.append("")
                    links.append(None)
                    continue
                rows.append(own.tokens[at].sum(axis=0))
                sha = hashlib.sha256()
                words = list(map(own.said.__getitem__, at.tolist()))
                for k in range(0, len(words), 100_000):
                    sha.update(b";" * (k > 0) + b";".join(words[k : k + 100_000]))
                digests.append(sha.hexdigest())
                held, times = own.links(at)
                seen[held] += 1
                links.append(_packed(np.concatenate([np.diff(held, prepend=0), times % SHIFT, times // SHIFT]), codec))
            sums = [pa.array(c) for c in np.array(rows, np.int64).reshape(-1, 4).T]
            tokens = dict(zip(["n_a", "n_b", "n_groups", "n_links"], sums, strict=True))
            yield batch(len(rows), chunk=part["chunk"], id=part["id"], links=pa.array(links, pa.binary()), groups_sha256=pa.array(digests, pa.string()), **tokens)
        yield from counts()

    return _streamed(entries, texts).mapInArrow(thrifty(run), COMPOSED.replace("ID", kind_of))


def value(worth: DataFrame, texts: DataFrame, kind_of: str) -> DataFrame:
    """Each text's numbers, and the sums over its links of what their pairs are ``worth`` (chunk, at, is_best, all_docs)."""
    keep = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, worths = pa.Codec("zstd", 1), np.zeros((0, 2), np.int64)
        for table, part in _chunks(batches, ["at", "is_best", "all_docs"]):
            if table is not None:
                places = table["at"].to_numpy()
                worths = np.zeros((int(places.max(initial=-1)) + 1, 2), np.int64)
                worths[places] = np.stack([table[c].to_numpy() for c in ("is_best", "all_docs")], axis=1)
            sums = np.zeros((part.num_rows, 2), np.int64)
            for i, raw in enumerate(part["links"].to_pylist()):
                if raw is not None:
                    steps, low, high = _unpacked(raw, codec).astype(np.int64).reshape(3, -1)
                    sums[i] = (worths[np.cumsum(steps)] * (low + high * SHIFT)[:, None]).sum(axis=0)
            cols = [part["id"], *[part[c] for c in keep], pa.array(sums[:, 0]), pa.array(sums[:, 1]), part["groups_sha256"]]
            yield pa.RecordBatch.from_arrays(cols, ["id", *keep, "n_best", "count_sum", "groups_sha256"])

    schema = f"id {kind_of}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return _streamed(worth, texts).mapInArrow(thrifty(run), schema)


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """A row per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Both tokenizers read a space and the text, without special tokens. Byte offsets where tokens of both end cut them
    into groups; all pairs of tokens of a group are linked. A pair of ids counts in as many documents (rows) as hold it
    linked. ``n_best`` are the links whose pair has the highest count among those of its first id, ties included,
    ``count_sum`` the counts of all links. Texts that are null, empty, or not given back byte for byte by both have no
    tokens: zeros and an empty digest. Rows that are equal each count. An empty table gives no rows. Other columns of
    ``docs`` have no effect, and none is carried along.
    """
    small_batches(docs.sparkSession)
    kind_of = docs.schema[id_col].dataType.simpleString()
    pieces = write_table(cut(docs, path_a, path_b, id_col, text_col, chunk), "segments", compression="zstd")
    entries = align(pieces.where("at is not null").select("chunk", "at", "segment"), path_a, path_b)
    composed = write_table(compose(entries, pieces.where("at is null").select("chunk", "id", "places"), kind_of), "composed", compression="zstd")
    drop_tables(pieces)
    held = composed.where("pair is not null").select("chunk", "at", "pair", "docs")
    sums = held.groupBy("pair").agg(F.sum("docs").alias("all_docs"))
    first = F.floor(F.col("pair") / SHIFT)
    best = sums.groupBy(first.alias("first")).agg(F.max("all_docs").alias("best"))
    worth = sums.join(best, first == F.col("first")).select("pair", "all_docs", (F.col("all_docs") == F.col("best")).cast("long").alias("is_best"))
    # A pair is in a chunk once, so it comes as often as there are chunks.
    worth = held.drop("docs").join(worth, "pair").drop("pair")
    texts = composed.where("pair is null").select("chunk", "id", "links", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return value(worth, texts, kind_of).withColumnRenamed("id", id_col)
