"""Embeddings, documents, substrings, pages and components against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from caremart.llm import chosen_path, embedding_dedup, html_text, substring_dedup
from caremart.llm.bwt import repeated
from caremart.llm.components import connected_components
from caremart.llm.shingles import shingle_sets

from tests.llm.helpers import DOCUMENTS, WORD, awkward_rows, clashing, components, documents


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)]
    pairs += [(500, k) for k in range(501, 700)] + [(7, 7), (None, 3), (4, None)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    real = [(a, b) for a, b in pairs if a is not None and b is not None and a != b]
    assert got == components({n for p in real for n in p}, real)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- op 1 -----------------------------------------------------------------


def vectors():
    rng = np.random.default_rng(1)
    rows = []
    for k in range(12):
        center = rng.standard_normal(16)
        for _ in range(12):
            rows.append((len(rows), (center + rng.standard_normal(16) * 0.14).tolist(), k % 3 if k % 4 else None))
    copy = rows[5][1]
    rows += [(900, copy, rows[5][2]), (901, [2 * x for x in copy], rows[5][2]), (902, copy, 7), (903, None, 1), (904, [], 1),
             (905, [0.0] * 16, 1), (906, [math.nan] + [1.0] * 15, 1), (907, [math.inf] + [1.0] * 15, 1),
             (908, [None] + [1.0] * 15, 1), (909, [1.0, 2.0], 1), (910, [1.0, 2.0], 1), (None, copy, rows[5][2])]
    return rows


def test_vectors_against_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in embedding_dedup.near_vectors(clashing(df)).collect() if r["vec_id"] is not None}
    good = [(i, np.array(v, float), c) for i, v, c in rows if i is not None and c is not None and v
            and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    pairs = [(i, j) for i, v, c in good for j, w, d in good
             if i < j and c == d and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98]
    assert len(pairs) > 100
    links, root = Counter(x for p in pairs for x in p), components([r[0] for r in rows if r[0] is not None], pairs)
    assert got == {i: (links[i], root[i], root[i] == i) for i in root}
    none = spark.createDataFrame([], df.schema)
    assert embedding_dedup.near_vectors(none).count() == 0


def test_hot_codes_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(3)
    center = rng.standard_normal(16)
    rows = [(i, (center + rng.standard_normal(16) * 0.05).tolist(), 1) for i in range(150)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    want = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate(want.tolist()))
    assert {r["component_id"] for r in got} == {0}


# --- op 9 -----------------------------------------------------------------


def word_set(text) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def test_near_documents_against_brute_force(spark):
    rows = awkward_rows(size=150)
    got = chosen_path.near_documents(clashing(documents(spark, rows))).collect()
    sets = [(r[0], word_set(r[1])) for r in rows]
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got) == Counter((i, len(s)) for i, s in sets)
    known = [(i, s) for i, s in sets if i is not None and s]
    pairs = [(i, j) for i, x in known for j, y in known if i < j and 100 * len(x & y) >= 85 * len(x | y)]
    assert len(pairs) > 50
    root = components({i for i, _ in sets if i is not None}, pairs)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["component_id"], r["kept"]) == (root[r["doc_id"]], root[r["doc_id"]] == r["doc_id"])
    assert chosen_path.near_documents(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_large_nodes_branch_on(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "SMALL", 6)
    rows = awkward_rows(seed=8, size=200)
    got = {r["doc_id"]: r["component_id"] for r in chosen_path.near_documents(documents(spark, rows)).collect() if r["doc_id"] is not None}
    known = [(r[0], word_set(r[1])) for r in rows if r[0] is not None]
    pairs = [(i, j) for i, x in known for j, y in known if i < j and x and y and 100 * len(x & y) >= 85 * len(x | y)]
    root = components({i for i, _ in known}, pairs)
    assert sum(got[i] != root[i] for i in root) <= 0.02 * len(root)


def test_pairs_in_a_family_below_the_threshold(spark):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(420)]
    tails = [[f"x{rng.getrandbits(40)}" for _ in range(40)] for _ in range(3000)]
    planted = [(2 * k, 2 * k + 1) for k in range(200)]
    for a, b in planted:
        tails[b][:9] = tails[a][:9]
    rows = [(k, " ".join(base + t), "en", "a", 0) for k, t in enumerate(tails)]
    sets = {r[0]: word_set(r[1]) for r in rows}
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert {round(alike(a, b), 2) for a, b in planted} == {0.87} and round(alike(0, 2), 2) == 0.84
    got = {r["doc_id"]: r["component_id"] for r in chosen_path.near_documents(documents(spark, rows)).collect()}
    assert got == components(sets, planted)


def test_common_shingles(monkeypatch):
    monkeypatch.setattr(chosen_path, "COLUMNS", 7)
    monkeypatch.setattr(chosen_path, "INCREMENTS", 50)
    rng = np.random.default_rng(5)
    for most in (40, 3000):
        xs = [np.unique(rng.integers(0, most, rng.integers(0, 40))).astype(np.uint64) for _ in range(60)]
        ys = xs[:20] + [np.zeros(0, np.uint64)]
        want = [[len(np.intersect1d(x, y)) for y in ys] for x in xs]
        assert chosen_path.common_shingles(xs, ys).tolist() == want


def test_shingle_sets_do_not_depend_on_chunks(monkeypatch):
    texts = [(r[1] or "").encode() for r in awkward_rows()]
    whole = [s for chunk in shingle_sets(texts) for s in chunk]
    monkeypatch.setattr("caremart.llm.shingles.CHUNK", 200)
    small = [s for chunk in shingle_sets(texts) for s in chunk]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(whole, small, strict=True))
    assert [len(s) for s in whole] == [len(word_set(t.decode())) for t in texts]


# --- op 6 -----------------------------------------------------------------


def without(texts: list[bytes], length: int) -> list[tuple[int, int, bytes]]:
    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) > 0).sum())
        out.append((int(gone.sum()), runs, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("most", [4096, 3])
def test_substrings_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(substring_dedup, "MOST", most)
    rng = random.Random(5)
    rows = [r for r in awkward_rows(size=60) if r[0] != 108]
    rows += [(200, "ab" * 300, "en", "a", 1), (201, "x" * 150 + "y" + "x" * 90, "en", "a", 1), (202, "é" * 80, "fr", "b", 2)]
    passage = "".join(rng.choice("klmnop ") for _ in range(70))
    rows += [(300 + k, "".join(rng.choice("qrst ") for _ in range(60)) + passage + "".join(rng.choice("uvw ") for _ in range(60)),
              "en", "a", 1) for k in range(20)]
    got = substring_dedup.without_repeats(clashing(documents(spark, rows)), length=48).collect()
    texts = [(r[1] or "").encode() for r in rows]
    want = Counter((r[0], len(t), *w) for r, t, w in zip(rows, texts, without(texts, 48), strict=True))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == want
    assert substring_dedup.without_repeats(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_long_texts_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr("caremart.llm.anchors.CHUNK", 300)
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    rows = [(1, text, None, None, 0), (2, text[1000:2500] + "!" + text[100:400], None, None, 0)]
    # Workers import the module anew, so the pieces are checked here and the whole job as it is.
    from caremart.llm.anchors import chunks, runs
    data = [r[1].encode() for r in rows]
    strings = sum(int(runs(d, s, e, 48)[4].sum()) for _, _, d, s, e in chunks(data, 48))
    assert strings == sum(len(d) - 47 for d in data)
    got = substring_dedup.without_repeats(documents(spark, rows), length=48).orderBy("doc_id").collect()
    assert [(r["n_removed"], r["n_spans"]) for r in got] == [w[:2] for w in without(data, 48)]


def test_transform_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        length, parts = int(rng.integers(8, 40)), []
        base = rng.integers(1, 4, 150)
        for _ in range(5):
            x = base.copy()
            x[rng.integers(0, len(x), 2)] = rng.integers(1, 4, 2)
            parts += [x[rng.integers(0, len(x)) :], [0]]
        text = np.concatenate(parts).astype(np.uint16)
        strings = [text[k : k + length].tobytes() if len(text) - k >= length and text[k : k + length].all() else None
                   for k in range(len(text))]
        seen = Counter(s for s in strings if s)
        assert repeated(text, length).tolist() == [s is not None and seen[s] > 1 for s in strings]


# --- op 2 -----------------------------------------------------------------


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h2>Site</h2></header><nav><ul><li>Menu</ul></nav><div class="ad">Buy</div><!-- <p>no</p> -->
<article><h1>Head &amp; shoulders</h1><p>One<b>two</b>\n  three<br>four <p>fi&eacute;ve &lt;b&gt; <script>var t="</p>";</script>
<div class="share-buttons">Share</div><p hidden>gone</p><form>Name <input></form></article>
<div class="comments"><p>First!</p></div><aside>Side</aside><footer>&copy; x</footer></body></html>"""


@pytest.mark.parametrize(("html", "text"), [
    (PAGE, "Head & shoulders Onetwo three four fiéve <b>"),
    ("<p>a<p>b", "a b"), ("", ""), ("plain &amp; simple", "plain & simple"), ("a < b <i>c</i>", "a < b c"),
    ("<article><p>cut of", "cut of"), ("<div>x</div><div>y</div><nav>n</nav>", "x y"),
    ("<article>a<article class='comment'>c</article></article>", "a"), ("<p title='a>b'>t</p>", "t"),
    ("<p>one</p><script>never closed <p>x</p>", "one"),
])
def test_main_text(html, text):
    assert html_text.Page(html).text() == text


def test_branches_that_never_change_are_removed(spark):
    rng = random.Random(1)
    rows = [(k, f"http://H.example/{k}", f"<body><div class='z1'>Same old words</div><div class='z2'>news {rng.random()}</div></body>")
            for k in range(30)]
    rows += [(100, "http://other.example/", "<body><div class='z1'>Same old words</div></body>"), (101, None, "<p>x</p>"),
             (102, "http://h.example/n", None), (102, "http://h.example/n", ""), (None, "odd", "<p>y</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_text.main_text(clashing(pages)).select("page_id", "text").collect()
    assert Counter(r["text"].split(" ")[0] for r in got) == Counter({"news": 30, "Same": 1, "x": 1, "y": 1, "": 2})
    assert html_text.main_text(spark.createDataFrame([], pages.schema)).count() == 0


def test_digest_of_removed_texts(spark):
    text = "word " * 200
    out = substring_dedup.without_repeats(documents(spark, [(1, text, None, None, 0), (2, text, None, None, 0)]))
    assert {hashlib.sha256(bytes(r["kept"])).hexdigest() for r in out.collect()} == {hashlib.sha256(b"").hexdigest()}
