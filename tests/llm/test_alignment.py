"""Aligned tokenizers against whole texts tokenised in plain Python."""

import hashlib
from collections import Counter
from itertools import accumulate

import pytest
import sentencepiece
from tokenizers import Tokenizer

from claimloom.llm import alignment, queries
from edge import docs, nothing

A, B = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")
ODD = [
    "", "  ", " a", None, "\n", "a\n\n b\t c\r\nd  \n", "x  y   z", "à b à   ", "<|endoftext|> <s> <0x41> </s> <unk>", "a▁b c", "foo.\r bar\r", "ﬁ ａ　 b",
    "  x \u0085 y", "a\x1c b\x1d c", "日本語 テキスト 中文", "é é x", "😀 a 😀😀  b", "\x00 a", "a" * 5000, " \n \n ", "don't we'll  they're", "a​ b",
    "def f():\n\treturn 1\n\n\n    x = {'a': 1}\r\n", "tab\tsep\tx", "x ", "x  ", "    y", "same", "same", "same text twice same text twice",
]


def whole(text, a, b):
    """Ids of both and their groups, None where the bytes are not given back."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    found = a.encode(" " + text, add_special_tokens=False)
    first = [bytes(byte[c] for c in t) for t in found.tokens]
    own, ids = found.ids, b.encode(text)
    second = [bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in ids]
    if b"".join(first) != (" " + text).encode() or b"".join(second) != (" " + text).encode():
        return None
    ends_a, ends_b = list(accumulate(map(len, first))), list(accumulate(map(len, second)))
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        p, q = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        groups.append((own[i:p], ids[j:q]))
        i, j = p, q
    return own, ids, groups


def brute(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    held, counts, best = [whole(t, a, b) if t else None for _, t in rows], Counter(), Counter()
    for found in held:
        if found:
            counts.update({(x, y) for p, q in found[2] for x in set(p) for y in set(q)})
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for (doc, _), found in zip(rows, held, strict=True):
        if not found:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = Counter()
        for p, q in found[2]:
            for x, n in Counter(p).items():
                for y, m in Counter(q).items():
                    links[x, y] += n * m
        said = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in found[2])
        sums = len(found[0]), len(found[1]), len(found[2]), links.total(), sum(n for x, n in links.items() if counts[x] == best[x[0]]), sum(n * counts[x] for x, n in links.items())
        out.append((doc, *sums, hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=str)


def test_the_space_that_is_cut_before():
    """A carriage return is part of pieces of the second vocabulary."""
    assert set(alignment.Pair(A, B).cuts) == set(" \t\n\x0b\x0c")


@pytest.mark.parametrize("chunk", [1, 1000, 1 << 20])
def test_odd_texts(spark, chunk):
    given = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    assert sorted(map(tuple, alignment.align_tokenizers(given, A, B, chunk=chunk).collect()), key=str) == brute(list(enumerate(ODD)))


def test_documents_and_edge_rows(spark):
    found = queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").union(docs(spark).select("doc_id", "text"))
    got = alignment.align_tokenizers(found, A, B, chunk=100_000)
    assert sorted(map(tuple, got.collect()), key=str) == brute([tuple(r) for r in found.collect()])
    assert alignment.align_tokenizers(nothing(spark), A, B).collect() == []
