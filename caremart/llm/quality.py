"""Quality and toxicity of documents by hierarchical empirical Bayes.

A document classifier gives evidence: logistic models over the shape of the
text and, for toxicity, its distinct words and their beginnings, fitted to a
bounded sample of labelled rows. Hosts, and paths below them, have posterior
rates from what their documents show: a host's rate is shrunk towards the
global one, a path's towards its host's, by as many documents' worth of prior
as the spread between sites supports (method of moments), so a site with few
documents has about the rate of what it belongs to. Rates are grouped sums,
combined before they are shuffled. A document's posterior is its evidence
with the global prior odds replaced by its path's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremart.llm.arrow_groups import small
from caremart.sources.tables import staged

#: Labelled documents that the models are fitted to, about (chosen by a hash of the id).
SAMPLE = 8000
#: Hashed features; the last ones are for the shape of the text.
WIDTH, SHAPES = 1 << 20, 9 * 16
#: A word feature has a weight if it is in so many documents of the sample, and the
#: share of the target among them is so many standard deviations from the average.
LEAST_DOCUMENTS, DEVIATIONS = 3, 4.5
EPOCHS, RATE, DECAY = 40, 0.1, 1e-4
#: Distinct words whose weights a worker remembers.
REMEMBERED = 500_000
TARGETS = ("quality", "toxic")
#: Whether words tell about a target; quality is a matter of the text's shape alone, whatever it is about.
BY_WORDS = {"quality": False, "toxic": True}
#: A prior is worth at most so many documents, also where sites do not differ.
MOST_PRIOR = 1000.0

_WORD = re.compile(r"[^\W\d_]+")


def _word_features(word: str) -> tuple[int, ...]:
    whole = crc32(b"w" + word.encode("utf-8", "surrogatepass"))
    starts = [crc32(b"p" + word[:n].encode("utf-8", "surrogatepass")) for n in (3, 4, 5) if len(word) > n]
    return tuple(x % (WIDTH - SHAPES) for x in (whole, *starts))


def _shape(text: str, words: list[str], distinct: int) -> list[int]:
    """Nine measures of the text, each as one of sixteen steps."""
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    size, count = max(int(raw.sum()), 1), max(len(words), 1)
    letters = max(int(raw[65:91].sum() + raw[97:123].sum() + raw[128:].sum()), 1)
    symbols = raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum()
    measures = [
        distinct / count,
        min(1.0, raw[65:91].sum() / letters),
        min(1.0, 4 * symbols / size),
        min(1.0, 4 * raw[48:58].sum() / size),
        min(1.0, np.log2(count + 1) / 16),
        min(1.0, letters / count / 16),
        min(1.0, 8 * raw[10] / count),
        min(1.0, 8 * (raw[33] + raw[35] + raw[36] + raw[37] + raw[38] + raw[42]) / size),
        min(1.0, 4 * sum(map(str.__eq__, words, words[1:])) / count),
    ]
    return [WIDTH - SHAPES + 16 * k + min(15, int(16 * m)) for k, m in enumerate(measures)]


@dataclass
class Model:
    """Weights by feature, one column per target, and the biases."""

    weights: np.ndarray
    bias: np.ndarray

    def scores(self, texts: list[str | None], known: dict[str, tuple[float, ...]]) -> np.ndarray:
        """Log-odds of each target for each text."""
        out = np.tile(self.bias, (len(texts), 1))
        for k, text in enumerate(texts):
            words = _WORD.findall(text.lower()) if text else []
            distinct = set(words)
            for word in distinct:
                if word not in known:
                    known[word] = self.weights[list(_word_features(word))].sum(axis=0)
            if distinct:
                out[k] += np.sum([known[w] for w in distinct], axis=0)
            out[k] += self.weights[_shape(text or "", words, len(distinct))].sum(axis=0)
            if len(known) > REMEMBERED:
                known.clear()
        return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        rows = []
        for text in batch.column(0).to_pylist():
            words = _WORD.findall(text.lower()) if text else []
            distinct = set(words)
            found = [f for w in distinct for f in _word_features(w)]
            rows.append(np.array(sorted(found + _shape(text or "", words, len(distinct))), "<i4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.binary()), *batch.columns[1:]], names=["features", *TARGETS]
        )


def _telling(rows: list[np.ndarray], labels: np.ndarray, words: bool) -> list[np.ndarray]:
    """The rows' features without words that tell nothing about the labels."""
    if not words:
        return [x[x >= WIDTH - SHAPES] for x in rows]
    total = np.bincount(np.concatenate(rows), minlength=WIDTH).astype(float)
    good = np.bincount(np.concatenate(rows), weights=np.repeat(labels, [len(x) for x in rows]), minlength=WIDTH)
    rate = labels.mean()
    deviation = np.sqrt(np.maximum(total * rate * (1 - rate) * (1 - total / len(rows)), 1e-9))
    telling = (total >= LEAST_DOCUMENTS) & (np.abs(good - total * rate) >= DEVIATIONS * deviation)
    telling[WIDTH - SHAPES :] = True
    return [x[telling[x]] for x in rows]


def _fitted(rows: list[np.ndarray], labels: np.ndarray, words: bool) -> tuple[np.ndarray, float]:
    """Logistic weights by adaptive gradient steps over the rows, in a fixed order."""
    weights, squares = np.zeros(WIDTH), np.full(WIDTH, 1e-4)
    rate = labels.mean()
    rows = _telling(rows, labels, words)
    bias = float(np.log(max(rate, 1e-3) / max(1 - rate, 1e-3)))
    order = np.random.default_rng(3)
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.concatenate([*rows, np.zeros(0, np.int64)])
    for _ in range(EPOCHS):
        for part in np.array_split(order.permutation(len(rows)), max(1, len(rows) // 64)):
            if not len(part):
                continue
            size = ends[part + 1] - ends[part]
            at = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in part])
            row, feature = np.repeat(np.arange(len(part)), size), flat[at]
            odds = bias + np.bincount(row, weights=weights[feature], minlength=len(part))
            wrong = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - labels[part]
            step = np.bincount(feature, weights=wrong[row], minlength=WIDTH)
            some = np.flatnonzero(step)
            slope = step[some] / len(part) + DECAY * weights[some]
            squares[some] += slope * slope
            weights[some] -= RATE * slope / np.sqrt(squares[some])
            bias -= 0.01 * wrong.mean()
    return weights, bias


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """Models of quality and toxicity from about ``sample`` labelled documents.

    Labels that repeat a document are read once; of conflicting ones the
    cautious one holds: the lowest quality, the highest toxicity. Null labels
    are not read. Without a single label both models say even odds.
    """
    marks = labels.select(F.col("doc_id").alias("_id"), *TARGETS).where("_id is not null and quality is not null and toxic is not null")
    marks = marks.groupBy("_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    count = marks.count()
    share = F.lit(min(1.0, sample / max(count, 1)))
    marks = marks.where(F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30)) < share)
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    rows = rows.join(marks, rows["doc_id"] == marks["_id"])
    kind = "features binary, quality int, toxic int"
    found = rows.select("text", *[F.col(t).cast("int") for t in TARGETS]).mapInArrow(_features, kind).collect()
    if not found:
        return Model(np.zeros((WIDTH, 2)), np.zeros(2))
    found.sort(key=lambda r: r["features"])
    each = [np.unique(np.frombuffer(r["features"], "<i4")).astype(np.int64) for r in found]
    both = [_fitted(each, np.array([r[t] for r in found], float), BY_WORDS[t]) for t in TARGETS]
    return Model(np.stack([w for w, _ in both], axis=1).astype(np.float32), np.array([b for _, b in both]))


def evidence(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``_quality`` and ``_toxic``, the classifier's probabilities.

    Columns of these names, in any case of letters, are replaced.
    """
    docs = docs.select(*[docs[c] for c in docs.columns if c.lower() not in ("_quality", "_toxic")])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place, names = docs.columns.index(text), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in small(batches):
            odds = shared.value.scores(batch.column(place).to_pylist(), known)
            chance = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(chance[:, 0]), pa.array(chance[:, 1])], names=[*names, "_quality", "_toxic"]
            )

    schema = T.StructType([*docs.schema.fields]).add("_quality", "double").add("_toxic", "double")
    return docs.mapInArrow(run, schema)


def _shrunk(sites: DataFrame, total: Column, prior: Column, worth: Column) -> Column:
    return (total + prior * worth) / (sites["n"] + worth)


def site_rates(rows: DataFrame, target: str) -> DataFrame:
    """``(host, path, rate, base)`` of ``rows`` (host, path, target): posterior rates by path.

    How many documents a prior is worth comes from the spread of the sites'
    means: between-site variance v, and mean m, give m (1 - m) / v - 1.
    """
    paths = staged(
        rows.groupBy("host", "path").agg(
            F.count(F.lit(1)).alias("n"), F.sum(target).alias("s"), F.sum(F.col(target) ** 2).alias("q")
        ),
        f"paths-{target}",
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))

    def worth(sites: DataFrame, inside: DataFrame | None = None) -> tuple[float, float]:
        """Mean over all documents, and the prior's worth, from scalar sums."""
        r = sites.agg(
            F.sum("n").alias("n"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("k"),
            F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between"), F.sum("q").alias("q"),
            F.sum(F.col("n") * F.col("n")).alias("nn"),
        ).first()
        if not r["n"]:
            return 0.5, MOST_PRIOR
        n, k, mean = float(r["n"]), float(r["k"]), r["s"] / r["n"]
        if k < 2 or n <= k:
            return mean, MOST_PRIOR
        within = (r["q"] - r["between"]) / (n - k)
        size = (n - r["nn"] / n) / (k - 1)
        spread = ((r["between"] - n * mean * mean) / (k - 1) - within) / max(size, 1e-9)
        if spread <= 0:
            return mean, MOST_PRIOR
        return mean, float(min(MOST_PRIOR, max(1.0, mean * (1 - mean) / spread - 1)))

    mean, of_hosts = worth(hosts)
    _, of_paths = worth(paths)
    hosts = hosts.select(
        F.col("host").alias("_of"),
        _shrunk(hosts, F.col("s"), F.lit(mean), F.lit(of_hosts)).alias("host_rate"),
    )
    joined = paths.join(hosts, paths["host"].eqNullSafe(hosts["_of"]))
    return staged(
        joined.select(
            "host", "path", _shrunk(paths, F.col("s"), F.col("host_rate"), F.lit(of_paths)).alias("rate"),
            F.lit(mean).alias("base"),
        ),
        f"rates-{target}",
    )


def _odds(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
          path: str = "lang", model: Model | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, quality, toxicity and kept.

    Both are posterior probabilities; a row is kept if its quality is at
    least a half and its toxicity is below. Null texts are judged as empty
    ones; a null host or path is a site of its own; a null id is judged like
    any other. No rows give no rows.
    """
    model = model or fit(docs, labels, doc_id, text)
    rows = docs.select(
        docs[doc_id].alias("doc_id"), docs[text].alias("text"),
        docs[host].cast("string").alias("host"), docs[path].cast("string").alias("path"),
    )
    told = staged(evidence(rows, model).drop("text"), "evidence")
    for target in TARGETS:
        rates = site_rates(told.select("host", "path", F.col(f"_{target}").alias(target)), target)
        rates = rates.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "rate", "base")
        told = told.join(
            rates, told["host"].eqNullSafe(rates["_h"]) & told["path"].eqNullSafe(rates["_p"])
        ).withColumn(
            target, 1 / (1 + F.exp(-(_odds(F.col(f"_{target}")) + _odds(F.col("rate")) - _odds(F.col("base")))))
        ).drop("_h", "_p", "rate", "base")
    return told.select(
        "doc_id", "quality", F.col("toxic").alias("toxicity"),
        ((F.col("quality") >= 0.5) & (F.col("toxic") < 0.5)).alias("kept"),
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source and language, with the labels at hand."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
