"""Mixing, line dedup, BPE, language, SimHash and the pipeline."""

import hashlib
import os
from collections import Counter, defaultdict

import pytest
import public_tokenizers
import tiktoken
import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import corpus_pipeline
from caremart.llm import bpe, language, line_dedup, mixing, quality, simhash
from caremart.llm.queries import oracle_sql, queries
from check_queries import compare

from tests.llm.helpers import DOCUMENTS, SF, WORD, awkward_rows, clashing, documents

needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


# --- op 4 -----------------------------------------------------------------


def expected_targets(sizes: dict) -> dict:
    """Targets by repeated resharing, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        unit = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if unit * weight[s] > 2 * sizes[s]]
        if not over:
            return {s: 2 * sizes[s] if s in full else unit * weight[s] for s in order}
        full.update(over)


def test_mix_report(spark):
    rows = awkward_rows()
    got = mixing.mix_report(clashing(documents(spark))).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows)
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = expected_targets(sizes)
    source_of = defaultdict(list)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        source = next(s for s in sizes if sizes[s] == r["source_size"])
        assert r["target"] == pytest.approx(want[source])
        source_of[source].append(r["taken"])
    for source, taken in source_of.items():
        assert abs(sum(taken) - want[source]) <= 2
    again = mixing.mix_report(documents(spark).repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_takes_the_words_of_the_report(spark):
    docs = documents(spark)
    report, mixed = mixing.mix_report(docs).collect(), mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"])
    want = Counter()
    for r in report:
        want[r["doc_id"]] += r["taken"]
    assert +words == +want


def test_mix_of_nothing(spark):
    assert mixing.mix_report(empty(spark)).count() == 0
    assert mixing.mix_documents(empty(spark)).count() == 0
    blank = documents(spark, [(1, None, None, "a", None), (2, " ", None, "b", 1)])
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mix_report(blank).collect()] == [(0, 0.0, 0)] * 2


# --- op 10 ----------------------------------------------------------------


def test_line_dedup(spark):
    rows = awkward_rows()
    pages, having = Counter(r[3] for r in rows), Counter()
    for _, text, _, source, _ in rows:
        having.update({(source, line.strip(" \t\r")) for line in (text or "").split("\n")})
    gone = {k for k, n in having.items() if k[1] and n >= line_dedup.MIN_PAGES and n > line_dedup.MAX_RATIO * pages[k[0]]}
    assert ("a", "Common line.") in gone
    want = Counter(
        (i, None if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip(" \t\r")) not in gone))
        for i, t, _, s, _ in rows
    )
    out = line_dedup.drop_boilerplate(clashing(documents(spark)))
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == want
    assert line_dedup.drop_boilerplate(empty(spark)).count() == 0


# --- op 8 -----------------------------------------------------------------


def reference_encoding():
    path = public_tokenizers.path(bpe.RANKS)
    ranks = dict((__import__("base64").b64decode(a), int(b)) for a, b in map(bytes.split, open(path, "rb")))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


REFERENCE = reference_encoding()
TOOL = bpe.codec(public_tokenizers.path(bpe.RANKS))


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("ab '\n\t  s.é²"))))
def test_encoding_is_tiktokens_and_comes_back(text):
    ids = TOOL.encode(text)
    assert ids.tolist() == REFERENCE.encode_ordinary(text)
    assert TOOL.decode(ids) == text.encode()


def test_encode_decode_and_spans(spark):
    docs = clashing(documents(spark))
    rows = bpe.decode(bpe.encode(docs, offsets=True)).select("text", "ids", "spans", "decoded", "decoded_text").collect()
    assert len(rows) == len(awkward_rows())
    for r in rows:
        text = r["text"] or ""
        assert r["ids"] == REFERENCE.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode() and r["decoded_text"] == text
        covered = {k for s in r["spans"] for k in range(s["start"], s["end"])}
        assert len(r["spans"]) == len(r["ids"]) and covered == set(range(len(text)))
    digests = bpe.round_trip(docs).collect()
    assert Counter(r["decoded_sha256"] for r in digests) == Counter(
        hashlib.sha256((r[1] or "").encode()).hexdigest() for r in awkward_rows())
    assert bpe.round_trip(empty(spark)).count() == 0


def test_split_character_decodes_whole():
    ids = TOOL.encode("👍🏽")
    assert len(ids) > 2 and TOOL.decode(ids).decode() == "👍🏽"
    assert "�" in TOOL.decode(ids[:1]).decode("utf-8", "replace")


# --- op 7 -----------------------------------------------------------------


@needs_data
def test_language_on_held_out_documents(spark):
    told = language.op7_language_id(spark, SF).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in told if r["held_out"]]
    assert len(told) == len(lang) and len(held) > 150
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.99 * len(held)
    assert all(0 <= r["score"] <= 1 for r in told)


def test_language_of_awkward_texts(spark):
    docs = documents(spark)
    model = language.fit(docs)
    told = {(r["doc_id"], r["text"]): r for r in language.predict(clashing(docs), model).collect()}
    for text in (None, "", " \t\n ", "12 34 !!"):
        assert {r["lang_pred"] for k, r in told.items() if k[1] == text} == {"und"}
    assert {r["lang_pred"] for r in told.values()} <= {"und", "en", "fr", "de"}
    nothing = language.fit(empty(spark))
    assert {r["lang_pred"] for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(empty(spark), model).count() == 0
    assert language.keep_identified(empty(spark)).count() == 0


def test_longer_grams_go_first():
    import numpy as np
    keys = lambda *gs: np.array(sorted(
        int(language._gram_keys(np.frombuffer(g.encode("utf-32-le"), np.uint32).astype(np.uint64), len(g))[0]) for g in gs
    ), np.uint64)
    entries = lambda *rows: language.Entries(
        np.zeros(2), np.arange(0, 2 * len(rows) + 1, 2), np.tile([0, 1], len(rows)), np.log(np.array(rows).reshape(-1)))
    grams = [(keys("a"), entries([0.9, 0.1])), (keys(), entries()), (keys("abc"), entries([0.2, 0.8])), (keys(), entries())]
    model = language.Model(["x", "y"], {"word": 0}, entries([0.7, 0.3]), grams)
    best, score = model.predict(["word", "abc", "a", "zzz", "abc zzz"])
    assert best[:3] == ["x", "y", "x"] and score[3] == 0
    assert score[:3] == pytest.approx([0.7, 0.8, 0.9]) and score[4] == pytest.approx(0.4)


# --- op 3 -----------------------------------------------------------------


@needs_data
def test_quality_on_labels_not_learned(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs, labels.where("doc_id % 3 > 0"))
    both = judged.join(labels.select("doc_id", labels["quality"].alias("good"), "toxic"), "doc_id").where("doc_id % 3 = 0")
    rows = both.collect()
    clean = [r["kept"] for r in rows if r["good"] == 1 and r["toxic"] == 0]
    toxic = [r["kept"] for r in rows if r["toxic"] == 1]
    junk = [r["kept"] for r in rows if r["good"] == 0]
    assert sum(clean) >= 0.97 * len(clean)
    assert sum(toxic) <= 0.4 * len(toxic) and sum(junk) <= 0.3 * len(junk)
    assert judged.count() == docs.count()


def test_sparse_sites_are_shrunk(spark):
    rows = [("h1", "p", 0.9)] * 60 + [("h2", "p", 0.1)] * 60 + [("h3", "p", 1.0)] + [("h1", "q", 0.0)] + [(None, None, 0.5)] * 5
    rates = quality.site_rates(spark.createDataFrame(rows, "host string, path string, quality double"), "quality")
    rate = {(r["host"], r["path"]): r["rate"] for r in rates.collect()}
    assert rate["h1", "p"] > 0.85 and rate["h2", "p"] < 0.15
    assert 0.5 < rate["h3", "p"] < 0.95  # one document moves it, but not all the way
    assert 0 < rate["h1", "q"] < rate["h1", "p"]  # towards its host, which is high
    assert (None, None) in rate


def test_quality_of_awkward_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark)
    assert quality.judge(clashing(docs), labels).count() == docs.count()
    assert quality.judge(docs, labels.limit(0)).where("kept is null").count() == 0
    assert quality.judge(empty(spark), labels).count() == 0


# --- op 5 -----------------------------------------------------------------


def simhash_of(text: str) -> int:
    words = __import__("re").split(r"[\x20\x09-\x0D]+", text.strip(" \t\n\x0b\x0c\r").lower())
    votes = [0] * 128
    long = lambda x, seed: xxhash.xxh64_intdigest(x.to_bytes(8, "little"), seed)
    for k, word in enumerate(words):
        h1 = xxhash.xxh64_intdigest(word.encode(), 42)
        if k + 1 < len(words):
            h1 = xxhash.xxh64_intdigest(words[k + 1].encode(), h1)
        h2 = long(h1, xxhash.xxh64_intdigest((2).to_bytes(4, "little"), 42))
        for b in range(64):
            votes[b] += 1 if h1 >> b & 1 else -1
            votes[64 + b] += 1 if h2 >> b & 1 else -1
    bits = [int(v > 0) for v in votes]
    return sum(v << b for b, v in enumerate(bits[:64])) << 64 | sum(v << b for b, v in enumerate(bits[64:]))


def test_simhash_against_brute_force(spark):
    rows = [r for r in awkward_rows() if r[0] is not None and r[0] != 109] + [(109, "twice", None, None, 5)] * 2
    got = simhash.edited_likeness(clashing(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    texts = dict(sorted(((r[0], r[1] or "") for r in rows), reverse=True))
    ids = list(texts)
    for r in got:
        text, after = texts[r["doc_id"]], texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own, other, near = simhash_of(text), simhash_of(edited), simhash_of(after)
        assert (int(r["fingerprint"], 16), int(r["edited_fingerprint"], 16)) == (own, other)
        assert r["near_edited"] == 1 - (own ^ other).bit_count() / 128
        assert r["near_next"] == 1 - (own ^ near).bit_count() / 128
    assert simhash.edited_likeness(documents(spark)).count() == len(awkward_rows())
    assert simhash.edited_likeness(empty(spark)).count() == 0


def test_every_fingerprint_in_the_radius_is_found(spark):
    import random
    rng = random.Random(4)
    base = [rng.getrandbits(128) for _ in range(20)]
    prints = {x ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, 5))) for x in base for _ in range(20)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(p >> 64), signed(p & (1 << 64) - 1)) for p in prints]
    df = spark.createDataFrame(rows, "f1 long, f2 long")
    unsigned = lambda a, b: (a % (1 << 64)) << 64 | b % (1 << 64)
    got = {(unsigned(r["q1"], r["q2"]), unsigned(r["f1"], r["f2"])): r["distance"]
           for r in simhash.within_radius(df, df, 3).collect()}
    assert got == {(p, q): (p ^ q).bit_count() for p in prints for q in prints if (p ^ q).bit_count() <= 3}


# --- all ------------------------------------------------------------------


@needs_data
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_match_their_sql(spark, name):
    good, text = compare(spark, name, "/root/testdata/sf0.001")
    assert good, text


def test_thirteen_operators_and_the_pipeline():
    names = set(queries())
    assert "pipeline" in names and len(names) == 14
    assert {int(n[2:].split("_")[0]) for n in names if n != "pipeline"} == set(range(1, 14))


@needs_data
def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, sf), "test")
        after = out.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        if name == "language ID":
            lettered = {i for i, r in rows.items() if any(map(str.isalpha, r["text"] or ""))}
            assert {r["doc_id"] for r in after} == lettered
        if name == "byte-level BPE encoding and decoding":
            want = Counter((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in docs.collect())
            assert Counter((r["doc_id"], r["decoded_sha256"]) for r in after) == want
        docs = out
    assert corpus_pipeline.run(spark, sf).count() == len(after)


def test_pipeline_stages_on_awkward_and_empty_tables(spark):
    for docs in (documents(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            assert out.count() <= 3 * docs.count()
