"""Removal of byte strings that stand anywhere else, however they are cut into documents.

Strings of ``length`` bytes choose anchors by their content (see ``anchors``);
runs of strings with one anchor are compared in two steps.

* Runs with equal hashes are equal: all of their strings repeat. This is
  decided by grouped counts, combined before the shuffle, so a passage on very
  many documents costs no task more than any other.
* Runs that share an anchor with others but have no equal one differ in part.
  They, and one of each kind of equal runs, are brought together by anchor
  with their bytes, and the Burrows-Wheeler transform of all that a task has
  at a time tells, by bounded interval expansion, which strings repeat.

An anchor of more than ``MOST`` different runs is not brought together: the
strings of its runs are counted by hash. All of this is judged on the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremart.llm.anchors import Prefixes, chunks, runs
from caremart.llm.arrow_groups import small, sorted_groups
from caremart.llm.bwt import repeated
from caremart.sources.tables import staged

LENGTH = 400
#: Different runs of an anchor that one task takes at most, and bytes of a transform, about.
MOST, TOGETHER = 4096, 1_000_000
NO_ID = -(1 << 63)


def _run_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            doc, hashed = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for source, offset, data, start, end in chunks(texts, length):
                text, gram, whole, first, count = runs(data, start, end, length)
                row = source[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(doc[row]),
                     pa.array(hashed[row]), pa.array((first + offset[text]).astype(np.int64)),
                     pa.array(count.astype(np.int32))],
                    names=["gram", "run", "d", "x", "first", "count"],
                )

    return run


def _bytes_of_runs(length: int):
    """The bytes of each document's listed runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            for d, x, listed, text in zip(*[c.to_pylist() for c in batch.columns[:3]],
                                          batch.column(3).cast(pa.binary()).to_pylist(), strict=True):
                parts = [text[r["first"] : r["first"] + r["count"] - 1 + length] for r in listed]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["gram"] for r in listed], pa.int64()), pa.array([d] * len(listed), pa.int64()),
                     pa.array([x] * len(listed), pa.int64()),
                     pa.array([r["first"] for r in listed], pa.int64()), pa.array(parts, pa.binary())],
                    names=["gram", "d", "x", "first", "bytes"],
                )

    return run


def _spans(marks: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that are covered by strings that start at the marks: starts and ends."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return edge[0::2], edge[1::2] - 1 + length


def _transformed(length: int):
    """Spans of the repeated strings in runs that share an anchor, many anchors at a time."""

    def solve(groups: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(groups).combine_chunks()
        texts = [t.as_py() for t in rows["bytes"].chunk(0)]
        symbols = np.concatenate([np.append(np.frombuffer(t, np.uint8).astype(np.uint16) + 1, 0) for t in texts])
        marks = repeated(symbols.astype(np.uint16), length)
        base = np.cumsum([0, *(len(t) + 1 for t in texts)])
        start, end = _spans(marks, length)
        if not len(start):
            return
        row = np.searchsorted(base, start, side="right") - 1
        first = rows["first"].to_numpy()[row] - base[row]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["d"].to_numpy()[row]), pa.array(rows["x"].to_numpy()[row]),
             pa.array(start + first), pa.array(end + first)],
            names=["d", "x", "start", "end"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in sorted_groups(batches, "gram"):
            if group.num_rows < 2:
                continue
            held.append(group)
            size += group.column("bytes").nbytes
            if size >= TOGETHER:
                yield from solve(held)
                held, size = [], 0
        if held:
            yield from solve(held)

    return run


def _hashed_strings(length: int):
    """A row per string of the runs, for anchors that no task can take."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            for d, x, first, text in zip(*[batch.column(c).to_pylist() for c in ("d", "x", "first", "bytes")], strict=True):
                data = np.frombuffer(text, np.uint8)
                place = np.arange(len(data) - length + 1)
                key = Prefixes(data).between(place, place + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.full(len(place), d)), pa.array(np.full(len(place), x)),
                     pa.array(place + first)],
                    names=["key", "d", "x", "start"],
                )

    return run


def repeated_spans(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(d, x, spans)`` of texts ``(d, x, text)``: bytes covered by repeated strings.

    ``d, x`` name a text; rows that repeat them are equal texts, which repeat
    each other. Spans are lists of starts and ends and may overlap.
    """
    found = staged(
        keyed.mapInArrow(_run_rows(length), "gram long, run long, d long, x long, first long, count int"), "runs"
    )
    this = F.xxhash64("d", "x", "first")
    kinds = found.groupBy("gram", "run").agg(F.count(F.lit(1)).alias("n"), F.min(this).alias("least"))
    kinds = staged(kinds, "run-kinds")
    shared = kinds.groupBy("gram").agg(
        F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"), F.sum((F.col("n") == 1).cast("long")).alias("single")
    ).where(F.col("all") > 1)
    kinds = staged(kinds.join(staged(shared, "anchors"), "gram").drop("all"), "shared-runs")
    rows = staged(found.join(kinds, ["gram", "run"]).select(
        "gram", "d", "x", "first", "count", "n", "kinds",
        ((F.col("n") == 1) | (F.col("single") > 0) & (this == F.col("least"))).alias("compare"),
    ), "shared")
    spans = [rows.where("n > 1").select(
        "d", "x", F.col("first").alias("start"), (F.col("first") + F.col("count") - 1 + length).alias("end")
    )]
    listed = rows.where("compare and kinds > 1").groupBy("d", "x").agg(
        F.collect_list(F.struct("gram", "first", "count")).alias("runs")
    )
    parts = listed.join(keyed, ["d", "x"]).select("d", "x", "runs", "text")
    parts = parts.mapInArrow(_bytes_of_runs(length), "gram long, d long, x long, first long, bytes binary")
    large = staged(shared.where(F.col("kinds") > MOST).select("gram"), "large-anchors")
    any_large = not large.isEmpty()
    if any_large:
        parts = staged(parts, "run-bytes")
        many = parts.join(large, "gram", "left_semi").mapInArrow(
            _hashed_strings(length), "key long, d long, x long, start long"
        )
        many = staged(many, "strings")
        again = many.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
        spans.append(many.join(staged(again, "repeated"), "key").select(
            "d", "x", "start", (F.col("start") + length).alias("end")))
        parts = parts.join(large, "gram", "left_anti")
    spans.append(
        parts.repartition("gram").sortWithinPartitions("gram")
        .mapInArrow(_transformed(length), "d long, x long, start long, end long")
    )
    every = spans[0]
    for more in spans[1:]:
        every = every.union(more)
    return every.groupBy("d", "x").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        lists, out = batch.column("spans"), []
        for k, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            spans = lists[k].values
            text = text or b""
            depth = np.zeros(len(text) + 1, np.int32)
            if spans is not None and len(spans):
                np.add.at(depth, spans.field("start").to_numpy(), 1)
                np.add.at(depth, spans.field("end").to_numpy(), -1)
            gone = np.cumsum(depth[:-1]) > 0
            edge = np.diff(np.concatenate([[0], gone.astype(np.int8)]))
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            out.append((len(text), int(gone.sum()), int((edge > 0).sum()), kept))
        size, removed, count, kept = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(count, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and ``kept``, the remaining bytes.

    A byte goes if it is in a string of ``length`` bytes that starts anywhere
    else, in the same text or another one; strings never cross texts. Null
    texts are empty, texts shorter than ``length`` stay whole, and rows that
    repeat a text of at least that size lose it, as each is the other's
    repetition. Remaining bytes may end inside a character. (A null id and
    the smallest long are told apart.) No rows give no rows.
    """
    body = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(
        docs[doc_id].cast("long").alias("doc_id"),
        F.coalesce(docs[doc_id].cast("long"), F.lit(NO_ID)).alias("d"),
        F.xxhash64(docs[doc_id].isNull(), body).alias("x"),
        body.alias("text"),
    )
    spans = staged(repeated_spans(rows.select("d", "x", "text"), length), "spans")
    joined = rows.join(spans, ["d", "x"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(
        _without, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
