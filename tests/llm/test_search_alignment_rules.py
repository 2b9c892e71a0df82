"""Lexical search, token alignment and quality rules against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from caremart.llm import alignment, lexical_search, target_ratio
from tests.llm.helpers import awkward_rows, clashing, documents, sentence

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_search(rows, items, top=50):
    docs = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(w for _, c, _ in docs for w in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in docs:
            m = 50 + (50 * n * n_docs) // length
            score = 0
            for w in set(TERM.findall((text or "").translate(LOWER))):
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += weight * ((1_000_000_000 * c[w]) // (1000 * c[w] + 20 * m))
            if score > 0:
                scored.append((-score, d if d is not None else -1, d))
        scored.sort(key=lambda x: x[:2])
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(scored[:top])]
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


ITEMS = "item_id long, text string"


@pytest.mark.parametrize("terms", [200_000, 40])
def test_search_equals_brute_force(spark, monkeypatch, terms):
    monkeypatch.setattr(lexical_search, "BLOCK", 4)
    docs = [(r[0], r[1]) for r in awkward_rows(3, 120)]
    words = " ".join(t or "" for _, t in docs[:30]).split()
    rng = random.Random(5)
    items = [(k, " ".join(rng.sample(words, 12))) for k in range(12)]
    items += [(50, ""), (51, None), (52, "zzzz neverseen"), (53, "ÜNÏCÖDÉ ünïcödé жжж"), (54, docs[4][1])]
    table = clashing(documents(spark, awkward_rows(3, 120)))
    asked = spark.createDataFrame(items, ITEMS).select("*", F.lit("x").alias("row"), F.lit("x").alias("q"))
    got = lexical_search.search(table, asked, top=7, round_terms=terms)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert ordered(map(tuple, got.collect())) == ordered(brute_search(docs, items, 7))


def test_blocks_are_skipped(spark, monkeypatch):
    """Families of alike documents: most blocks lie below the floor, and nothing is lost."""
    monkeypatch.setattr(lexical_search, "BLOCK", 8)
    rng = random.Random(9)
    families = [sentence(rng, 40).split() for _ in range(25)]
    docs = [(100 * k + i, " ".join([*rng.sample(f, 30), "common", "words"])) for k, f in enumerate(families) for i in range(40)]
    items = [(k, " ".join([*families[k][:15], "common"])) for k in range(6)]
    seen = []
    real = lexical_search.open_blocks
    monkeypatch.setattr(lexical_search, "open_blocks", lambda *x: seen.append(real(*x)) or seen[-1])
    got = lexical_search.search(spark.createDataFrame(docs, ITEMS).toDF("doc_id", "text"), spark.createDataFrame(items, ITEMS), top=5)
    assert ordered(map(tuple, got.collect())) == ordered(brute_search(docs, items, 5))
    skipped = seen[0].groupBy("open").count().rdd.collectAsMap()
    assert skipped.get(False, 0) > 0


def test_search_in_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b"), (None, "b c")], ITEMS)
    assert lexical_search.search(none.toDF("doc_id", "text"), some).count() == 0
    assert lexical_search.search(some.toDF("doc_id", "text"), none).count() == 0
    found = lexical_search.search(some.toDF("doc_id", "text"), some).collect()
    assert {(r.item_id, r.doc_id) for r in found} >= {(None, None), (1, 1)}


def brute_alignment(rows):
    tool = alignment.Pair(public_tokenizers.path(alignment.BYTE_LEVEL), public_tokenizers.path(alignment.PIECES))
    out, count, each = [], Counter(), []
    for doc, text in rows:
        a = tool.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tool.b.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        spelled = [b"".join(t[i] for i in x) for t, x in ((tool.bytes_a, a), (tool.bytes_b, b))]
        if not text or spelled[0] != raw or spelled[1] != raw:
            each.append((doc, [], [], [], ""))
            continue
        owner_a = [k for k, i in enumerate(a) for _ in tool.bytes_a[i]]
        owner_b = [k for k, i in enumerate(b) for _ in tool.bytes_b[i]]
        links = [(a[x], b[y]) for x, y in dict.fromkeys(zip(owner_a, owner_b, strict=True))]
        ends = [{k + 1 for k in range(len(o)) if k + 1 == len(o) or o[k] != o[k + 1]} for o in (owner_a, owner_b)]
        spell, at = [], 0
        for end in sorted(ends[0] & ends[1]):
            left = [str(a[k]) for k in dict.fromkeys(owner_a[at:end])]
            right = [str(b[k]) for k in dict.fromkeys(owner_b[at:end])]
            spell.append(",".join(left) + "|" + ",".join(right))
            at = end
        count.update(set(links))
        each.append((doc, a, b, links, ";".join(spell)))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    for doc, a, b, links, spell in each:
        out.append((doc, len(a), len(b), spell.count("|") if a else 0, len(links), sum(count[x] == most[x[0]] for x in links),
                    sum(count[x] for x in links), hashlib.sha256(spell.encode()).hexdigest() if a else ""))
    return out


@pytest.mark.parametrize("sent", [alignment.SENT, 0])
def test_alignment_equals_brute_force(spark, sent):
    rows = awkward_rows(2, 25)
    special = ["<|endoftext|> <s> <unk>", "a▁b", "x  y\t\tz\r\n", "\x00\x01 nul", "日本語 한국어 🏳️‍🌈🏳️‍🌈", " lead", "trail ", "<0x41>"]
    rows += [(300 + k, t, "en", "a", None) for k, t in enumerate(special)]
    got = alignment.align_documents(clashing(documents(spark, rows)), sent=sent)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got.columns == columns
    assert ordered(map(tuple, got.collect())) == ordered(brute_alignment([(r[0], r[1]) for r in rows]))


def test_alignment_of_long_texts_in_parts(spark, monkeypatch):
    rng = random.Random(4)
    text = sentence(rng, 4000) + " 1 2  3 " + "ü" * 50 + sentence(rng, 500)
    tool = alignment.Pair(public_tokenizers.path(alignment.BYTE_LEVEL), public_tokenizers.path(alignment.PIECES))
    whole = next(tool.encode([text]))
    monkeypatch.setattr(alignment, "LONGEST", 300)
    assert len(tool.parts(text)) > 20 and "".join(tool.parts(text)) == text
    cut = next(tool.encode([text]))
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_alignment_of_an_empty_table(spark):
    assert alignment.align_documents(documents(spark, [])).count() == 0
    got = alignment.align_documents(documents(spark, [(1, None, None, None, None), (2, "", None, None, None)])).collect()
    assert {(r.doc_id, r.n_a, r.groups_sha256) for r in got} == {(1, 0, ""), (2, 0, "")}


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


def brute_runs(text):
    raw = (" " + text + " " * (target_ratio.RUN - 1)).encode() if text else b""
    out = []
    for i in range(len(raw) - target_ratio.RUN + 1):
        key = int.from_bytes(raw[i : i + target_ratio.RUN], "little")
        key = ((key ^ (key >> 15)) * 0x9E3779B1) & 0xFFFFFFFF
        out.append(key >> (32 - target_ratio.BUCKETS.bit_length() + 1))
    return out


def test_rules_equal_brute_force(spark):
    rows = awkward_rows(6, 30)
    rows += [(400, "a b c " * 30, "en", "a", None), (401, "x y\nx y\n\n \nx y\nz", "en", "a", None), (402, "#*$%&|<> " * 60, "en", "a", None)]
    labels = [(r[0], 1) for r in rows[:20]] + [(3, 0), (402, 0), (None, 1), (5, None)]
    docs = clashing(documents(spark, rows))
    said = spark.createDataFrame(labels, "doc_id long, quality int")
    ratio = target_ratio.fit(docs, said)
    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(brute_runs(r[1]))
        if r[0] is not None and r[0] in range(20) and r[0] != 3:
            target.update(brute_runs(r[1]))
    size, prior = target_ratio.BUCKETS, target_ratio.PRIOR
    for b in [*list(raw)[:500], 1, 2, 3]:
        want = math.log((target[b] + prior) / (target.total() + prior * size)) - math.log((raw[b] + prior) / (raw.total() + prior * size))
        assert abs(ratio[b] - want) < 1e-5
    got = target_ratio.judge(docs, ratio).collect()
    assert len(got) == len(rows)
    by_rules = ordered((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert by_rules == ordered((r[0], *brute_rules(r[1])) for r in rows)
    text_of = {r[0]: r[1] for r in rows if r[0] is not None and r[0] != 109}
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= target_ratio.LEAST)
        if r.doc_id in text_of:
            runs = brute_runs(text_of[r.doc_id])
            assert abs(r.score - (sum(float(ratio[b]) for b in runs) / len(runs) if runs else 0)) < 1e-4


def test_rules_tell_junk_from_prose(spark):
    rng = random.Random(8)
    good = [(k, sentence(rng, 120)) for k in range(60)]
    junk = [(100 + k, " ".join(w + rng.choice(["$$$", " |", "!!"]) for w in sentence(rng, 120).split())) for k in range(40)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string")
    said = spark.createDataFrame([(k, 1) for k in range(0, 60, 2)], "doc_id long, quality int")
    kept = {r.doc_id for r in target_ratio.judge(docs, target_ratio.fit(docs, said)).where("kept").collect()}
    assert kept == {k for k, _ in good}


def test_long_texts_in_pieces(monkeypatch):
    text = ("".join(random.Random(2).choice("abcé ") for _ in range(5000))).encode()
    whole = target_ratio.runs(text)
    monkeypatch.setattr(target_ratio, "CHUNK", 701)
    assert (np.concatenate(list(target_ratio.pieces(text))) == whole).all()
    assert target_ratio.runs(b"").size == 0 and not list(target_ratio.pieces(b""))


def test_without_labels_or_rows_nothing_is_told(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = documents(spark, [(1, "word " * 10 + sentence(random.Random(1), 80), "en", "a", None), (2, None, None, None, None)])
    judged = {r.doc_id: r for r in target_ratio.judge(docs, target_ratio.fit(docs, none)).collect()}
    assert judged[1].score == 0 and judged[1].kept and not judged[2].kept
    empty = documents(spark, [])
    assert target_ratio.judge(empty, target_ratio.fit(empty, none)).count() == 0
