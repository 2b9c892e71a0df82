"""Every label is learned, and scores follow the backoff by hand."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from caremart.llm import language, line_dedup
from tests.llm.helpers import documents, sentence


def test_five_hundred_labels(spark):
    rng = random.Random(3)
    rows = []
    for k in range(500):
        words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(12)]
        # The first label has a hundred times the text of the others.
        for i in range(200 if k == 0 else 3):
            rows.append((1000 * k + i, " ".join(rng.choices(words, k=20)), f"x{k}", "a", None))
    model = language.fit(documents(spark, rows))
    assert len(model.languages) == 500
    found, _ = model.predict([r[1] for r in rows])
    assert sum(a == r[2] for a, r in zip(found, rows, strict=True)) > 0.99 * len(rows)


def _by_hand(training, text):
    """Log scores of a short text by dictionaries, without limits on entries."""
    languages = sorted({lang for lang, _ in training})
    counts = [Counter() for _ in range(language.LONGEST + 1)]
    for lang, known in training:
        for word in language._WORD.findall(known.lower()):
            counts[0][lang, word] += 1
            edged = language._EDGE + word + language._EDGE
            for n in range(1, language.LONGEST + 1):
                for i in range(n == 1, len(edged) - n + 1 - (n == 1)):
                    counts[n][lang, edged[i : i + n]] += 1
    names, whole = [], []
    for level in counts:
        total = Counter()
        for (_, gram), c in level.items():
            total[gram] += c
        names.append({g for g, c in total.items() if c > 1})
        whole.append({x: sum(c for (lang, g), c in level.items() if lang == x and g in names[-1]) + 0.5 * (len(names[-1]) + 1)
                      for x in languages})
    out = dict.fromkeys(languages, 0.0)
    for word in language._WORD.findall(text.lower()):
        for x in languages:
            if word in names[0]:
                out[x] += math.log((counts[0][x, word] + 0.5) / whole[0][x])
                continue
            edged = language._EDGE + word + language._EDGE
            for n in range(language.LONGEST, 0, -1):
                grams = [edged[i : i + n] for i in range(n == 1, len(edged) - n + 1 - (n == 1))]
                grams = [g for g in grams if g in names[n]]
                if grams:
                    out[x] += sum(math.log((counts[n][x, g] + 0.5) / whole[n][x]) for g in grams) / len(grams)
                    break
    return out


def test_scores_equal_the_backoff_by_hand(spark):
    training = [("en", "the cat sat on the mat the end"), ("en", "a dog and the cat"), ("fr", "le chat est sur la table le chien"),
                ("fr", "la table et le chat"), ("de", "der hund und die katze der tisch der hund")]
    model = language.fit(documents(spark, [(k, t, lang, "a", None) for k, (lang, t) in enumerate(training)]))
    for text in ["the cat", "katz", "tabl dogs", "hundert", "chatte the", "zzz q"]:
        (found,), (score,) = model.predict([text])
        want = _by_hand(training, text)
        best = max(sorted(want), key=want.get)
        assert found == best
        share = sum(1 / math.exp(want[best] - x) for x in want.values())
        if text != "zzz q":
            assert score == pytest.approx(1 / share, rel=1e-4)


def test_no_column_name_clashes(spark):
    names = ["_drop", "_lines", "_kept", "_host", "drop", "lines", "kept", "host", "_gone", "HOST", "__lines"]
    rows = [(k, f"Same line.\n{sentence(random.Random(k), 9)}", "en", "a", None) for k in range(8)]
    plain = documents(spark, rows)
    own = plain.select("*", *[F.lit(k).alias(n) for k, n in enumerate(n for n in names if n != "HOST")])
    got = line_dedup.drop_boilerplate(own)
    assert got.columns == own.columns
    assert {r.text for r in got.collect()} == {r.text for r in line_dedup.drop_boilerplate(plain).collect()}
    assert {(r._drop, r._lines, r._kept, r._host) for r in got.collect()} == {(0, 1, 2, 3)}
