"""Ranked lexical search with geometric blocks in every posting list.

A document is a vector with one coordinate per term, what the term adds to a
score. A code of sign bits tells in which cell of that space it lies: with
more leading bits the cells get smaller, and their documents more alike. Each
term's posting list is cut into blocks by the cell, as finely as its length
asks for, and a block keeps a summary, the largest value of each coordinate
among its documents. An item's product with a summary is a bound for all
documents of the block.

An item has a floor first, the score of its last place among documents that
are good for one of its terms. Of its lists only those have to be looked at
whose terms can lift a document over the floor (the other terms together
cannot); of these, a block is skipped if its bound is below the floor.
Documents of the other blocks are scored in full. Bounds and scores are
integers, so nothing is lost to rounding, and what is skipped cannot place.

Postings, summaries, bounds and scores are grouped and joined as tables. A
list of very many documents is cut into blocks by documents, and no step
gathers a list. Items come in rounds of a bounded number of terms, since the
terms of a round are sent to the tasks that read the texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caremart.llm.arrow_groups import small
from caremart.sources.tables import staged

#: Documents that each item gets, at most.
TOP = 50
#: Documents of a block, about, and sign bits of a code.
BLOCK, BITS = 128, 30
#: Terms of the items of a round, about; what the tasks get of them is some 100 bytes each.
TERMS = 200_000
#: Postings that a task works on at a time, about.
POSTINGS = 1_000_000

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
RANKED = "item_id long, rank int, doc_id long, score long"
_VECTOR = "array<struct<t: int, c: bigint>>"


def terms(text: str | None) -> list[str]:
    """The terms of a text in order, repeats included."""
    return _TERM.findall(text.translate(_LOWER)) if text else []


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        for q, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = list(dict.fromkeys(terms(text)))
            yield pa.RecordBatch.from_arrays([pa.array([q] * len(found), pa.int64()), pa.array(found, pa.string())], names=["q", "term"])


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Per row of ``(row, doc_id, text)``: row, doc_id, ``n`` terms in all, ``t`` and ``tf``, those of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast({w: k for k, w in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        name = list(number)
        for batch in small(batches):
            size, ends, ids, times = [], [0], [], []
            for text in batch.column(2).to_pylist():
                count = Counter(terms(text))
                size.append(count.total())
                known = sorted(number[w] for w in count.keys() & number.keys())
                ids += known
                times += [count[name[k]] for k in known]
                ends.append(len(ids))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(at, pa.array(times, pa.int64()))],
                names=["row", "doc_id", "n", "t", "tf"],
            )

    return docs.mapInArrow(run, "row long, doc_id long, n long, t array<int>, tf array<long>")


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """The weight of a term that so many of all documents hold."""
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


def _signs(count: int) -> np.ndarray:
    return np.random.default_rng(12).choice(np.array([-1.0, 1.0], np.float32), (count, BITS))


def vectors(found: DataFrame, weight: np.ndarray, documents: int, length: int) -> DataFrame:
    """Per row with a term of weight: row, doc_id, ``code`` and ``vec``, what each of its terms adds to a score."""
    shared = found.sparkSession.sparkContext.broadcast(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = _signs(len(shared.value))
        for batch in small(batches):
            size = np.diff(batch.column(3).offsets.to_numpy())
            if not size.sum():
                continue
            t, tf = batch.column(3).flatten().to_numpy(), batch.column(4).flatten().to_numpy()
            n = batch.column(2).to_numpy()
            m = np.repeat(50 + (50 * n * documents) // length, size)
            c = shared.value[t] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            owner = np.repeat(np.arange(batch.num_rows), size)
            keep = c > 0
            t, c, owner = t[keep], c[keep], owner[keep]
            rows, first = np.unique(owner, return_index=True)
            if not len(rows):
                continue
            side = np.add.reduceat(c[:, None].astype(np.float32) * signs[t], first) > 0
            code = side.astype(np.int64) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
            pairs = pa.StructArray.from_arrays([pa.array(t, pa.int32()), pa.array(c, pa.int64())], names=["t", "c"])
            ends = pa.array(np.append(first, len(t)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(code), pa.ListArray.from_arrays(ends, pairs)],
                names=["row", "doc_id", "code", "vec"],
            )

    return found.mapInArrow(run, f"row long, doc_id long, code long, vec {_VECTOR}")


def best(scored: DataFrame, group: str, order: list[Column], top: int) -> DataFrame:
    """The first ``top`` rows of each group; each task cuts its own rows down before they are shuffled."""
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= top)


def _postings(vec: DataFrame, *more: str) -> DataFrame:
    return vec.select("row", *more, F.explode("vec").alias("x")).select("row", *more, "x.t", "x.c")


@dataclass
class Items:
    """The items of a round, sent to the tasks: their ids, their terms and where each one's begin."""

    q: np.ndarray
    t: np.ndarray
    start: np.ndarray

    @classmethod
    def of(cls, q: np.ndarray, t: np.ndarray) -> Items:
        order = np.lexsort((t, q))
        ids, start = np.unique(q[order], return_index=True)
        return cls(ids, t[order], np.append(start, len(t)))


class Postings:
    """The posting lists of the documents of a batch, with the stretch of each term of each item."""

    def __init__(self, vec: pa.ListArray, items: Items):
        size = np.diff(vec.offsets.to_numpy())
        pairs = vec.flatten()
        t = pairs.field("t").to_numpy()
        order = np.argsort(t, kind="stable")
        self.owner = np.repeat(np.arange(len(size)), size)[order]
        self.c = pairs.field("c").to_numpy()[order]
        self.first = np.searchsorted(t[order], items.t)
        self.last = np.searchsorted(t[order], items.t, side="right")

    def of(self, k: int) -> slice:
        """The postings of the list of one item's term."""
        return slice(self.first[k], self.last[k])


def _pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``POSTINGS`` postings."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = batch.column(column).offsets.to_numpy()
        cut = np.unique((ends[1:] - ends[0]) // POSTINGS, return_index=True)[1].tolist()
        for a, b in zip(cut, [*cut[1:], batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def scores(vec: DataFrame, pairs: DataFrame, items: Items, floor: np.ndarray) -> DataFrame:
    """``(q, row, doc_id, score)`` of the pairs ``(q, row)`` that reach the item's floor, and 1."""
    asked = pairs.groupBy("row").agg(F.collect_set("q").alias("qs"))
    shared = vec.sparkSession.sparkContext.broadcast((items, np.maximum(floor, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, least = shared.value
        for batch in _pieces(batches, "vec"):
            lists = Postings(batch.column("vec"), items)
            wanted = batch.column("qs")
            row = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
            item = np.searchsorted(items.q, wanted.flatten().to_numpy())
            order = np.argsort(item, kind="stable")
            row, item = row[order], item[order]
            some, first = np.unique(item, return_index=True)
            found_row, found_score, found_item = [], [], []
            for k, a, b in zip(some.tolist(), first.tolist(), [*first[1:].tolist(), len(item)], strict=True):
                total = np.zeros(batch.num_rows, np.int64)
                for j in range(items.start[k], items.start[k + 1]):
                    part = lists.of(j)
                    total[lists.owner[part]] += lists.c[part]
                mine = row[a:b][total[row[a:b]] >= least[k]]
                found_row.append(mine)
                found_score.append(total[mine])
                found_item.append(np.full(len(mine), items.q[k]))
            none = np.zeros(0, np.int64)
            place = pa.array(np.concatenate([*found_row, none]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*found_item, none])), batch.column("row").take(place), batch.column("doc_id").take(place),
                 pa.array(np.concatenate([*found_score, none]))],
                names=["q", "row", "doc_id", "score"],
            )

    joined = vec.join(asked, "row").select("row", "doc_id", "vec", "qs")
    return joined.mapInArrow(run, "q long, row long, doc_id long, score long")


def floors(vec: DataFrame, wanted: DataFrame, items: Items, top: int = TOP) -> np.ndarray:
    """Per item a score that at least ``top`` documents reach; 0 where fewer good documents are found.

    Good are the first documents of each of its lists: a bounded number of rows.
    """
    champions = best(_postings(vec), "t", [F.desc("c"), F.col("row")], top).select("t", "row")
    pairs = staged(champions.join(wanted, "t").select("q", "row").distinct(), "champions")
    scored = scores(vec, pairs, items, np.zeros(len(items.q), np.int64))
    last = best(scored, "q", [F.desc("score"), F.col("row")], top).where(F.col("rank") == top).select("q", "score").toArrow()
    floor = np.zeros(len(items.q), np.int64)
    floor[np.searchsorted(items.q, last.column("q").to_numpy())] = last.column("score").to_numpy()
    return floor


def essential(items: Items, most: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """Which of the items' lists a document over the floor must be in one of.

    Terms that add least are left out as long as all of them together stay
    below the floor. ``most`` is the largest value of each term.
    """
    out = np.zeros(len(items.t), bool)
    for k in range(len(items.q)):
        mine = np.arange(items.start[k], items.start[k + 1])
        mine = mine[np.argsort(most[items.t[mine]], kind="stable")]
        out[mine] = np.cumsum(most[items.t[mine]]) >= max(floor[k], 1)
    return out


def summaries(vec: DataFrame, items: Items, own: np.ndarray, bits: np.ndarray) -> DataFrame:
    """``(t, cell, u, most)``: of each block of the list of ``t`` the largest value of coordinate ``u``.

    Blocks of the lists that ``own`` marks, and the coordinates that an item
    asks for beside their term. ``bits`` are the leading bits of the cells of
    each term. A task sums up blocks of its own documents, which lie in the
    order of their codes, before any is shuffled.
    """
    shared = vec.sparkSession.sparkContext.broadcast((items, own, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, own, bits = shared.value
        for batch in _pieces(batches, "vec"):
            lists = Postings(batch.column("vec"), items)
            code = batch.column("code").to_numpy()
            t, cell, u, most = [], [], [], []
            for k in range(len(items.q)):
                span = range(items.start[k], items.start[k + 1])
                mine = [j for j in span if own[j] and lists.last[j] > lists.first[j]]
                if not mine:
                    continue
                values = np.zeros((batch.num_rows, len(span)), np.int64)
                for place, j in enumerate(span):
                    values[lists.owner[lists.of(j)], place] = lists.c[lists.of(j)]
                for j in mine:
                    rows = lists.owner[lists.of(j)]
                    cells = code[rows] >> (BITS - bits[items.t[j]])
                    start = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
                    summary = np.maximum.reduceat(values[rows], start, axis=0)
                    block, place = np.nonzero(summary)
                    t.append(np.full(len(block), items.t[j], np.int32))
                    cell.append(cells[start][block])
                    u.append(items.t[span.start + place])
                    most.append(summary[block, place])
                if sum(map(len, t)) > POSTINGS:
                    yield out(t, cell, u, most)
                    t, cell, u, most = [], [], [], []
            yield out(t, cell, u, most)

    def out(*columns: list[np.ndarray]) -> pa.RecordBatch:
        kinds = (np.int32, np.int64, np.int32, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([*x, np.zeros(0, k)]).astype(k)) for x, k in zip(columns, kinds, strict=True)],
            names=["t", "cell", "u", "most"],
        )

    found = vec.mapInArrow(run, "t int, cell long, u int, most long")
    return found.groupBy("t", "cell", "u").agg(F.max("most").alias("most"))


def open_blocks(summary: DataFrame, asked: DataFrame) -> DataFrame:
    """``(q, t, cell, bound, open)``: the blocks of the lists that each item has to look at.

    ``asked`` is ``(q, t, u, floor)``. Blocks that are not open hold no document that reaches the floor.
    """
    bounds = summary.join(asked, ["t", "u"]).groupBy("q", "t", "cell").agg(F.sum("most").alias("bound"), F.max("floor").alias("floor"))
    return bounds.select("q", "t", "cell", "bound", (F.col("bound") >= F.col("floor")).alias("open"))


def _asked(spark: SparkSession, items: Items, own: np.ndarray, floor: np.ndarray) -> DataFrame:
    """``(q, t, u, floor)`` of each term ``u`` that an item has beside a list ``t`` of its own."""
    item = np.repeat(np.arange(len(items.q)), np.diff(items.start))
    lists = pa.table({"q": items.q[item[own]], "t": items.t[own], "floor": floor[item[own]]})
    terms = pa.table({"p": items.q[item], "u": items.t})
    lists, terms = spark.createDataFrame(lists), spark.createDataFrame(terms)
    return staged(lists.join(terms, F.col("q") == F.col("p")).select("q", "t", "u", "floor"), "asked")


def _round(docs: DataFrame, wanted_terms: list[tuple[int, str]], top: int) -> DataFrame | None:
    """``(q, rank, doc_id, score)`` of the items of a round, whose terms are given; none if nothing can match."""
    spark = docs.sparkSession
    vocabulary = sorted({w for _, w in wanted_terms})
    found = staged(postings(docs, vocabulary), "postings")
    documents, length = found.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    held = found.select(F.explode("t").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toArrow()
    if not documents or not held.num_rows:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    df[held.column("t").to_numpy()] = held.column("df").to_numpy()
    number = {w: k for k, w in enumerate(vocabulary)}
    items = Items.of(np.array([q for q, _ in wanted_terms], np.int64), np.array([number[w] for _, w in wanted_terms], np.int32))
    wanted = spark.createDataFrame(pa.table({"q": np.repeat(items.q, np.diff(items.start)), "t": items.t}))
    # Alike documents lie side by side, so a task sums its blocks up well before they are shuffled.
    vec = vectors(found, weights(df, documents), documents, length)
    vec = staged(vec.repartitionByRange("code", F.xxhash64("row")).sortWithinPartitions("code"), "vectors")
    lists = _postings(vec).groupBy("t").agg(F.max("c").alias("most")).toArrow()
    most = np.zeros(len(vocabulary), np.int64)
    most[lists.column("t").to_numpy()] = lists.column("most").to_numpy()
    bits = np.clip(np.ceil(np.log2(np.maximum(df, 1) / BLOCK)), 0, BITS).astype(np.int64)
    floor = floors(vec, wanted, items, top)
    own = essential(items, most, floor)
    asked = _asked(spark, items, own, floor)
    summary = staged(summaries(vec, items, own, bits), "summaries")
    left = staged(open_blocks(summary, asked).where("open").select("q", "t", "cell"), "open-blocks")
    cells = spark.createDataFrame(pa.table({"t": np.arange(len(bits), dtype=np.int32), "bits": bits.astype(np.int32)}))
    pairs = _postings(vec, "code").join(cells, "t").select("row", "t", F.expr(f"shiftright(code, {BITS} - bits)").alias("cell"))
    pairs = staged(pairs.join(left, ["t", "cell"]).select("q", "row").distinct(), "pairs")
    placed = scores(vec, pairs, items, floor)
    order = [F.desc("score"), F.col("doc_id"), F.col("row")]
    return staged(best(placed, "q", order, top).select("q", "rank", "doc_id", "score"), "ranked")


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", top: int = TOP, round_terms: int = TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` rows of ``docs`` for each item.

    Items that repeat an id are one item with the terms of all of their texts;
    a null id is an item like others. Rows of ``docs`` are documents by
    themselves, also where an id repeats or is null; null ids come first among
    equal scores. Items without terms, and without a document that scores
    above 0, have no rows; so have empty tables. The rounds follow from
    ``round_terms``; one item's terms are in one round, however many.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    asked = items.select(items[item_id].cast("long").alias("item_id"), items[item_text].alias("text"))
    ids = staged(asked.select("item_id").distinct().withColumn("q", F.monotonically_increasing_id()), "items")
    asked = asked.withColumnRenamed("item_id", "own").join(ids, F.col("own").eqNullSafe(F.col("item_id"))).select("q", "text")
    wanted = staged(asked.mapInArrow(_item_terms, "q long, term string").distinct(), "item-terms")
    rounds = -(-wanted.count() // round_terms)
    out = None
    for k in range(rounds):
        mine = wanted.where(F.pmod(F.xxhash64("q"), F.lit(rounds)) == k).toArrow()
        pairs = sorted(zip(mine.column("q").to_pylist(), mine.column("term").to_pylist(), strict=True))
        found = _round(rows, pairs, top) if pairs else None
        if found is not None:
            out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], RANKED)
    return out.join(ids, "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms, row_number() OVER () AS row FROM documents),
sizes AS (SELECT row, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
tf AS (SELECT row, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row, unnest(terms) AS term FROM sizes) GROUP BY row, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * max(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, total GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT a.item_id, s.row, s.doc_id,
         CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * s.n * total.docs) // total.length)))) AS BIGINT) AS score
  FROM asked a JOIN w USING (term) JOIN tf USING (term) JOIN sizes s ON tf.row = s.row, total
  GROUP BY a.item_id, s.row, s.doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST, row) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
