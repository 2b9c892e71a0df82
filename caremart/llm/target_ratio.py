"""Quality rules and a hashed n-gram log-likelihood ratio against a trusted target.

Two multinomials over hashed runs of bytes are counted: one of the documents
that labels call good, the target, and one of the whole raw corpus. A document
scores the mean of log(target / raw) over its runs, so its length does not
matter: 0 is a document that is as likely in either, and one that falls below
``LEAST`` is made of runs that the target has several times more rarely than
the corpus. Every document gets the same fixed threshold, so reruns agree.

Counting sums a vector of fixed size in each task before anything is shuffled,
so the result, which every task gets, is bounded by ``BUCKETS`` whatever the
corpus is. Beside the ratio stand rules on words and lines of the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caremart.llm.arrow_groups import small
from caremart.sources.tables import staged

#: Bytes in a run, and buckets that runs are hashed to (at most 1 MB of ratios, and 6 MB of counts a task).
RUN, BUCKETS = 4, 1 << 18
#: Runs that a bucket has beforehand in both multinomials.
PRIOR = 0.1
#: Trusted documents that the target is counted over, about (chosen by a hash of the id); the corpus is counted whole.
TRUSTED = 50_000
#: Documents whose runs are, on average, e times rarer in the target than in the corpus are not kept.
LEAST = -1.0
#: Rules: a document fails with fewer words, or with a larger share (percent) of words in repeated windows.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Bytes of text that are hashed together, about.
CHUNK = 1 << 20

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_FACTOR = np.uint32(0x9E3779B1)


def runs(text: bytes) -> np.ndarray:
    """Bucket of each run of ``RUN`` bytes of a text with a space before and after; none of an empty one."""
    if not text:
        return np.zeros(0, np.uint32)
    data = np.frombuffer(b" " + text + b" " * (RUN - 1), np.uint8).astype(np.uint32)
    size = len(text) + 1
    key = data[:size] | (data[1 : size + 1] << np.uint32(8)) | (data[2 : size + 2] << np.uint32(16))
    key |= data[3 : size + 3] << np.uint32(24)
    return (key ^ (key >> np.uint32(15))) * _FACTOR >> np.uint32(32 - (BUCKETS.bit_length() - 1))


def pieces(text: bytes) -> Iterator[np.ndarray]:
    """The runs of a text, ``CHUNK`` of them at a time; a run that starts in a piece may end in the next."""
    for start in range(0, len(text), CHUNK):
        part = runs(text[start : start + CHUNK + RUN - 1])
        yield part if len(text) <= CHUNK else part[min(start, 1) : CHUNK + 1]


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(bucket, n)`` over all rows of a task."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in small(batches):
        found, size = [], 0
        for text in _texts(batch.column(0)):
            for part in pieces(text):
                found.append(part)
                size += len(part)
                if size > CHUNK:
                    total += np.bincount(np.concatenate(found), minlength=BUCKETS)
                    found, size = [], 0
        if found:
            total += np.bincount(np.concatenate(found), minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])


def counts(texts: DataFrame) -> np.ndarray:
    """Runs in each bucket over all rows of a table of one text column."""
    table = texts.mapInArrow(_counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS)
    out[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


def ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of target over raw in each bucket; all even without a target."""
    if not target.sum():
        return np.zeros(len(raw), np.float32)
    in_target = np.log((target + PRIOR) / (target.sum() + PRIOR * len(target)))
    return (in_target - np.log((raw + PRIOR) / (raw.sum() + PRIOR * len(raw)))).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
        trusted: int = TRUSTED) -> np.ndarray:
    """The ratio of each bucket: documents labelled good against all of ``docs``.

    A document is good if all labels of its id that are not null say 1. About
    ``trusted`` of them are the target, the same ones in each run: their ids
    are few enough to be sent to all tasks, so no text is shuffled to meet its
    label. Rows that repeat count as often as they are there, null texts have
    no runs. Without a good document every ratio is 0.
    """
    rows = docs.select(docs[doc_id].alias("id"), docs[text].alias("text")).where("text is not null")
    said = labels.select(labels[doc_id].alias("good"), labels[quality].alias("said")).where("good is not null")
    good = said.groupBy("good").agg(F.min("said").alias("said")).where("said = 1").select("good")
    good = staged(good, "good-documents")
    share = min(1.0, trusted / max(good.count(), 1))
    chance = F.pmod(F.xxhash64("good", F.lit(13)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    target = rows.join(F.broadcast(good.where(chance < share)), F.col("id") == F.col("good"), "left_semi")
    return ratios(counts(target.select("text")), counts(rows.select("text")))


def repeated_words(words: list[str]) -> int:
    """Words in windows of three that are found twice or more."""
    if len(words) < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    pair = ids[:-1] * len(number) + ids[1:]
    if len(number) >= 1 << 21:
        pair = np.unique(pair, return_inverse=True)[1]
        number = dict.fromkeys(range(len(words)))
    _, first, times = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = times[first] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k : k + len(again)] |= again
    return int(hit.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return len(lines) - len(set(lines))


RULES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"


def judge(docs: DataFrame, ratio: np.ndarray, doc_id: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """Per row of ``docs``: doc_id, the rules' counts, ``score``, ``base_failed`` and ``kept``.

    A null or empty text has no words and the score 0, and fails the rules.
    Rows that repeat give equal rows; no rows give none. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def score(text: bytes) -> float:
        return sum(float(shared.value[part].sum(dtype=np.float64)) for part in pieces(text)) / (len(text) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows = []
            for raw in _texts(batch.column(1)):
                whole = raw.decode("utf-8", "replace")
                words = _WORD.findall(whole)
                rows.append((len(words), sum(map(len, words)), len(_SYMBOL.findall(whole)), repeated_lines(whole),
                             repeated_words(words), score(raw)))
            columns = zip(*rows, strict=True) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64() if k < 5 else pa.float64()) for k, c in enumerate(columns)]],
                names=["doc_id", *[x.split()[0] for x in RULES.split(", ")]],
            )

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    judged = rows.mapInArrow(run, f"doc_id long, {RULES}")
    failed: Column = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= least))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, judged against those that ``labels`` calls good."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
