"""Rows that try every operator: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, score string, lang_pred string, n_lines string, component_id string, tokens string, id string, _row string, lane string"


def rows():
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(400)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    base = say(120)
    texts = {
        1: base, 2: base.replace(" ", "\n"), 3: base + " ", 4: base, 5: base.replace(words[0], "zz").replace(
            base.split()[60], "qq"
        ), 6: None, 7: "", 8: " \t\n\x0b\f\r ", 9: "one two", 10: "ONE two",
        11: say(20_000), 12: "\n".join(
            ["same line a", "same line b", "same line c"] * 3
        ), 13: "x\nsame line a\nsame line b\nsame line c\ny", 14: "déjà Été 中文 #1!", 15: "12345 --- $$$", 16: "a" * 70_000, 17: say(3),
    }
    out = [(i, t, [None, "en", "fr"][i % 3], [None, "s1", "s2", ""][i % 4], None if t is None else len(t), *["x"] * 9) for i, t in texts.items()]
    out.append(out[0])  # a repeated row
    out.append((None, base, "en", "s1", 1, *[None] * 9))
    out.append((None, None, None, None, None, *[None] * 9))
    return out


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
