"""Language identification by words first, then ever shorter character n-grams.

A word of the model scores by its log frequency in each language. A word that
the model lacks falls back to its character n-grams, the longest length of
which any is known, down to single characters. A text's score is the sum over
its words. Training counts come from a sample of labelled documents of a
stated size per language; the model has a stated number of entries, so it can
be sent to every task. Prediction reads whole texts, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremart.llm.arrow_groups import small
from caremart.sources.tables import staged

#: Documents per language that the counts are made of, about (chosen by a hash of the id).
SAMPLE_PER_LANGUAGE = 2000
#: Words, and n-grams of each length, that the model keeps over all languages: each language has
#: its own most frequent ones, an equal share of these numbers, but at least ``LEAST_ENTRIES``.
MODEL_WORDS = 50_000
MODEL_GRAMS = 30_000
LEAST_ENTRIES = 200
LONGEST = 4
UNKNOWN = "und"
#: Characters that are scored together, about: bounds the memory of a task.
CHUNK = 1_000_000

_WORD = re.compile(r"[^\W\d_]+")
_EDGE = "\x02"


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words with an edge mark before, between and after; the edges' places."""
    text = _EDGE + _EDGE.join(words) + _EDGE
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    return codes, np.flatnonzero(codes == ord(_EDGE))


def _gram_keys(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit key for each run of n code points."""
    keys = np.zeros(max(len(codes) - n + 1, 0), dtype=np.uint64)
    for i in range(n):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + len(keys)]
    return keys ^ (keys >> np.uint64(29))


def _word_of(edges: np.ndarray, starts: int, n: int) -> np.ndarray:
    """For each start of a run, its word; -1 if the run is not inside one word and its edges."""
    place = np.arange(starts)
    word = np.searchsorted(edges, place, side="right") - 1
    inside = word < len(edges) - 1
    word = np.where(inside, word, 0)
    inside &= place + n - 1 <= edges[word + 1]
    if n == 1:
        inside &= place != edges[word]
    return np.where(inside, word, -1)


@dataclass
class Entries:
    """Words, or n-grams of one length: a base score by language, and what entries add to it.

    An entry has a row of ``(language, more)`` for each language that knows it
    and nothing for the others, so many languages cost no space.
    """

    base: np.ndarray
    start: np.ndarray
    language: np.ndarray
    more: np.ndarray

    def added(self, at: np.ndarray, owner: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
        """Sum over entries ``at`` of their additions times ``weight``, by owner and language."""
        count = self.start[at + 1] - self.start[at]
        total = np.cumsum(count)
        place = np.arange(total[-1] if len(total) else 0) - np.repeat(total - count - self.start[at], count)
        width = len(self.base)
        to = np.repeat(owner, count) * width + self.language[place]
        return np.bincount(to, weights=np.repeat(weight, count) * self.more[place], minlength=size * width).reshape(size, width)


@dataclass
class Model:
    """Log frequencies by language; a plain value that is sent to the tasks.

    An entry takes some 60 bytes, and 12 more for each language that knows it.
    """

    languages: list[str]
    words: dict[str, int]
    word_scores: Entries | None
    #: For n = 1 .. LONGEST: sorted keys and their scores.
    grams: list[tuple[np.ndarray, Entries]]

    def unseen(self, words: list[str], doc: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Add the scores of words without an entry to their documents'; which of them any n-gram is known of."""
        known = np.zeros(len(words), dtype=bool)
        codes, edges = _grams(words)
        for n in range(LONGEST, 0, -1):
            keys, table = self.grams[n - 1]
            if not len(keys) or known.all():
                continue
            mine = _gram_keys(codes, n)
            word = _word_of(edges, len(mine), n)
            at = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
            hit = (word >= 0) & (keys[at] == mine)
            hit[hit] = ~known[word[hit]]
            word, at = word[hit], at[hit]
            if not len(word):
                continue
            # A word scores the mean over its n-grams of this length.
            count = np.bincount(word, minlength=len(words))
            new = count > 0
            total += np.bincount(doc[new], minlength=len(total))[:, None] * table.base
            total += table.added(at, doc[word], 1.0 / count[word], len(total))
            known |= new
        return known

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` and 0 without letters or without a model."""
        found = [_WORD.findall(t.lower()) if t else [] for t in texts]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        lettered = [any(w[0].isalpha() or any(map(str.isalpha, w)) for w in ws) for ws in found]
        best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages or not sizes.sum():
            return best, score
        words = list(chain.from_iterable(found))
        ids = np.fromiter(map(self.words.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        doc = np.repeat(np.arange(len(texts)), sizes)
        known = ids >= 0
        total = np.zeros((len(texts), len(self.languages)))
        if known.any():
            total += np.bincount(doc[known], minlength=len(texts))[:, None] * self.word_scores.base
            total += self.word_scores.added(ids[known], doc[known], np.ones(int(known.sum())), len(texts))
        new = np.flatnonzero(~known)
        if len(new):
            known[new] = self.unseen([words[i] for i in new], doc[new], total)
        share = np.bincount(doc, weights=known, minlength=len(texts)) / np.maximum(sizes, 1)
        weight = np.exp(total - total.max(axis=1, keepdims=True))
        top = total.argmax(axis=1)
        score = np.where(lettered, share / weight.sum(axis=1), 0.0)
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(top, lettered, strict=True)], score


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts ``(lang, n, gram, count)`` of each batch; n is 0 for words."""
    for batch in small(batches):
        counts: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = Counter(_WORD.findall(text.lower()))
            for word, times in words.items():
                counts[lang, 0, word] += times
                edged = _EDGE + word + _EDGE
                for n in range(1, LONGEST + 1):
                    for i in range(n == 1, len(edged) - n + 1 - (n == 1)):
                        counts[lang, n, edged[i : i + n]] += times
            if len(counts) > 500_000:
                yield _count_batch(counts)
                counts = Counter()
        yield _count_batch(counts)


def _count_batch(counts: Counter) -> pa.RecordBatch:
    lang, n, gram = zip(*counts, strict=True) if counts else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(n, pa.int32()), pa.array(gram, pa.string()),
         pa.array(counts.values(), pa.int64())],
        names=["lang", "n", "gram", "count"],
    )


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        sample: int = SAMPLE_PER_LANGUAGE, words: int = MODEL_WORDS, grams: int = MODEL_GRAMS) -> Model:
    """A model of the labelled rows of ``docs``.

    About ``sample`` documents of each language are read, the same ones in
    each run; rows with null text or label are not. Every label is learned,
    however rare. Of each language the most frequent words and n-grams are
    entries, equally many of each, about ``words`` and ``grams`` in all.
    """
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), docs[lang].alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    per = staged(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    languages = sorted(r["lang"] for r in per.select("lang").collect())
    if not languages:
        return Model([], {}, None, [])
    chance = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.join(per, "lang").where(chance * F.col("rows") < sample).select("lang", "text")
    counts = chosen.mapInArrow(_counted, "lang string, n int, gram string, count long")
    table = staged(counts.groupBy("n", "gram", "lang").agg(F.sum("count").alias("count")), "language-counts")
    number = {name: k for k, name in enumerate(languages)}

    def entries(n: int, most: int) -> tuple[list[str], Entries]:
        mine = table.where(F.col("n") == n)
        total = mine.groupBy("gram").agg(F.sum("count").alias("total")).where("total > 1")
        mine = mine.join(total, "gram").select("gram", "lang", "count")
        order = Window.partitionBy("lang").orderBy(F.desc("count"), "gram")
        own = mine.withColumn("place", F.row_number().over(order)).where(F.col("place") <= max(LEAST_ENTRIES, most // len(languages)))
        found = mine.join(own.select("gram").distinct(), "gram").orderBy("gram", "lang").toArrow()
        names, place = np.unique(found.column("gram").to_numpy(), return_inverse=True)
        language = np.array([number[x] for x in found.column("lang").to_pylist()], np.int32)
        count = found.column("count").to_numpy().astype(float)
        order_ = np.lexsort((language, place))
        place, language, count = place[order_], language[order_], count[order_]
        smooth = 0.5
        whole = np.bincount(language, weights=count, minlength=len(languages)) + smooth * (len(names) + 1)
        more = (np.log(count + smooth) - np.log(smooth)).astype(np.float32)
        start = np.searchsorted(place, np.arange(len(names) + 1))
        return names.tolist(), Entries(np.log(smooth) - np.log(whole), start, language, more)

    known, word_scores = entries(0, words)
    lists = []
    for n in range(1, LONGEST + 1):
        names, scores = entries(n, grams)
        keys = np.fromiter(
            (_gram_keys(np.frombuffer(g.encode("utf-32-le"), np.uint32).astype(np.uint64), n)[0] for g in names),
            dtype=np.uint64, count=len(names),
        )
        order = np.argsort(keys)
        size = np.diff(scores.start)[order]
        start = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(start[-1]) - np.repeat(start[:-1] - scores.start[:-1][order], size)
        lists.append((keys[order], Entries(scores.base, start, scores.language[place], scores.more[place])))
    return Model(languages, {w: i for i, w in enumerate(known)}, word_scores, lists)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` added; columns of these names are replaced.

    The score is the chance of the language among those learned, times the
    share of words of which the model knows anything. A null text and one
    without letters have ``und`` and 0.
    """
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = rest.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts, start = batch.column(place).to_pylist(), 0
            names, scores = [], []
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and (end == start or size < CHUNK):
                    size += len(texts[end] or "")
                    end += 1
                best, score = shared.value.predict(texts[start:end])
                names += best
                scores.append(score)
                start = end
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(np.concatenate([*scores, np.zeros(0)]))],
                names=[*rest, "lang_pred", "score"],
            )

    schema = T.StructType([docs.schema[c] for c in rest]).add("lang_pred", "string").add("score", "double")
    return docs.select(*rest).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training; a null id is not."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents whose language is told with a score of at least ``least``.

    The model learns from the labels of ``docs`` itself. Without any label
    nothing can be told, and nothing is rejected.
    """
    model = fit(docs)
    if not model.languages:
        return docs
    return predict(docs, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(*docs.columns)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    told = predict(docs.select("doc_id", "text"), model)
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
