"""Small tables with everything awkward in them."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng: random.Random, size: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(size))


def awkward_rows(seed: int = 1, size: int = 40) -> list[tuple]:
    """Near and exact copies, nulls everywhere, blanks, a long text, repeated rows and ids."""
    rng = random.Random(seed)
    base = sentence(rng, 120)
    rows = []
    for i in range(size):
        words = base.split()
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        text = " ".join(words) if i % 3 else sentence(rng, rng.randint(1, 200))
        lines = text.split(" ")
        rows.append((i, "\n".join([" ".join(lines[:30]), "Common line.", " ".join(lines[30:])]),
                     rng.choice(["en", "fr", None]), rng.choice(["a", "a", "a", "b", "é", None]), len(text)))
    rows += [
        (100, None, "en", "a", None), (101, "", "fr", "b", 0), (102, " \t\n ", None, None, 4), (103, "one", "en", "a", 3),
        (104, "Ünïcödé ЖЖЖ 中文 👍 " * 5, "de", "é", None), (105, "12 34 !!", "en", "a", 8),
        (106, base, "en", "a", None), (107, base.upper(), "en", "b", None), (108, sentence(rng, 30000), "en", "a", None),
        (None, base, "en", "a", None), (None, None, None, None, None), (109, base, "en", "c", 5), (109, base, "en", "c", 5),
        (109, sentence(rng, 40), "en", "c", 5),
    ]
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, DOCUMENTS)


def clashing(docs):
    """The table with columns that have the names operators might use inside."""
    names = ("size key bucket source_size target taken rounds cut share a b id component rep path pivot sig set line lines "
             "pages host d x h1 h2 f1 f2 text_ ids spans start end gram run first count n level score lang_pred kept "
             "quality toxicity label_key _key pos part rows of").split()
    return docs.select("*", *[F.lit("clash").alias(n) for n in names if n not in docs.columns])


def components(nodes, pairs) -> dict:
    """Smallest reachable node of each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
