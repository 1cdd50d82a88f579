"""Small documents with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, kept boolean, ids string, fp string"


def rows(n=120, seed=5):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 9))) for _ in range(400)] + ["Über", "niño", "漢字", "it's", "<|endoftext|>", "3,141"]
    out = []
    for i in range(n):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 200)))
        if i % 7 == 0:
            text = text.replace(" ", "\n", 3)
        out.append((i, text))
    base = out[3][1]
    out += [(n + k, base) for k in range(40)]  # a third of all rows are copies
    out += [(n + 40 + k, base.replace(" ", f" {w} ", 1)) for k, w in enumerate(words[:5])]
    out += [(n + 50, None), (n + 51, ""), (n + 52, " \t\n "), (n + 53, "one"), (n + 54, "one two"), (n + 55, "x" * 70_000), (n + 56, "ab12 " * 30_000), (n + 57, " " * 3000 + "end"), (n + 58, "tab nbsp ́mark İ ΑΣ ΑΣ​"), (None, "a null id"), (None, None), (n + 59, "twice"), (n + 59, "twice")]
    rnd.shuffle(out)
    return [(i, t, None if k % 3 else "en", "src0", None, 1, 2, None, "clash", "clash") for k, (i, t) in enumerate(out)]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
