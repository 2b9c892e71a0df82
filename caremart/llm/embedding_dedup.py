"""Near-duplicate vectors by random-hyperplane signs in several tables.

Equal vectors of a label are one class first. Every class gets a code per
table, the signs of its products with that table's random planes; vectors of
one label whose codes meet in any table are compared exactly. The length of
the codes follows the size of the largest label, and the number of tables
follows from it, so that a pair at the threshold is missed with a chance of
at most ``MISS``. A pair counts in the first table in which its codes meet.
A code that very many classes share is dealt out in blocks, and each pair of
blocks is a group of its own. Groups give counts and a spanning forest of
their links, never the list of all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caremart.llm.arrow_groups import sorted_groups, spanning_roots
from caremart.llm.components import connected_components
from caremart.sources.tables import staged

THRESHOLD = 0.98
#: Chance that a pair at the threshold meets in no table.
MISS = 1e-7
#: Classes per code that are aimed at, and classes in a block of a hot code.
PER_CODE, BLOCK = 32, 256
SEED = 20


def tables_for(largest: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """``(bits, tables)`` for a label of ``largest`` vectors."""
    bits = min(30, max(6, math.ceil(math.log2(max(largest, 1) / PER_CODE + 1))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - meet))


def _valid(label: Column, vector: Column) -> Column:
    """Whether a row can link: a label, and a finite vector that is not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(label.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat doubles and the offsets of a list column."""
    ends = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), ends - ends[0]


def _codes(bits: int, tables: int):
    """Adds each row's codes, one per table."""
    planes: dict[int, np.ndarray] = {}
    weight = 1 << np.arange(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = _vectors(batch.column("vector"))
            length = np.diff(ends)
            codes = np.zeros((batch.num_rows, tables), dtype=np.int32)
            for d in np.unique(length).tolist():
                if d not in planes:
                    planes[d] = np.random.default_rng([SEED, d]).standard_normal((d, tables * bits))
                rows = np.flatnonzero(length == d)
                unit = _unit(flat[ends[rows][:, None] + np.arange(d)])
                signs = (unit @ planes[d] > 0).reshape(len(rows), tables, bits)
                codes[rows] = signs @ weight
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, codes.size + 1, tables, dtype=np.int32)), pa.array(codes.ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "codes"])

    return run


def _links(threshold: float):
    """Counts and forest of the links of each group of rows with one key."""

    def pairs(group: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        flat, ends = _vectors(group.column("vector"))
        length = np.diff(ends)
        kind = np.stack([length, group.column("label_key").to_numpy()], axis=1)
        if (kind != kind[0]).any():  # two keys with one hash: only rows of one kind are compared
            parts = [np.flatnonzero((kind == k).all(axis=1)) for k in np.unique(kind, axis=0)]
            found = [(r, pairs(group.take(pa.array(r)))) for r in parts]
            return np.concatenate([r[a] for r, (a, _) in found]), np.concatenate([r[b] for r, (_, b) in found])
        unit = _unit(flat.reshape(len(length), -1))
        table, side = group.column("table")[0].as_py(), group.column("side").to_numpy()
        two = side.max() > 0
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if two else left
        close = unit[left] @ unit[right].T >= threshold
        a, b = np.nonzero(close if two else np.triu(close, 1))
        a, b = left[a], right[b]
        codes = group.column("codes").flatten().to_numpy().reshape(len(length), -1)
        first = (codes[a, table] == codes[b, table]) & ~(codes[a, :table] == codes[b, :table]).any(axis=1)
        return a[first], b[first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "group"):
            if group.num_rows < 2:
                continue
            a, b = pairs(group)
            if not len(a):
                continue
            size = group.column("n").to_numpy()
            count = np.bincount(a, weights=size[b], minlength=len(size)) + np.bincount(b, weights=size[a], minlength=len(size))
            rep = group.column("rep").to_numpy()
            root = spanning_roots(len(size), a, b)
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [group.column("h1").take(pa.array(some)), group.column("h2").take(pa.array(some)),
                 pa.array(count[some].astype(np.int64)), pa.array(rep[some]), pa.array(rep[root[some]])],
                names=["h1", "h2", "links", "a", "b"],
            )

    return run


def near_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """Per row of ``rows``: vec_id, n_links, component_id, kept.

    Vectors of one label link if their cosine in double precision is at least
    ``threshold``. Null labels, null, empty and zero vectors, and those with
    null or non-finite elements link with nothing, nor do vectors of different
    lengths. A row with a null id links with nothing, its component is null
    and it is kept. Rows that repeat an id are rows of one member: they share
    a component, and each has its own links. No rows give no rows.
    """
    base = rows.select(
        rows[vec_id].cast("long").alias("vec_id"), rows[vector].alias("vector"), rows[label].alias("label")
    )
    base = base.withColumn("ok", _valid(F.col("label"), F.col("vector")) & F.col("vec_id").isNotNull())
    base = base.withColumns({
        "h1": F.when(F.col("ok"), F.xxhash64("label", "vector")),
        "h2": F.when(F.col("ok"), F.xxhash64(F.lit(1), "label", "vector")),
    })
    valid = base.where("ok")
    classes = staged(
        valid.groupBy("h1", "h2").agg(
            F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"),
            F.first(F.xxhash64("label")).alias("label_key"),
        ),
        "vector-classes",
    )
    largest = classes.groupBy("label_key").count().agg(F.max("count")).first()[0] or 0
    bits, tables = tables_for(largest, threshold, miss)
    kind = classes.schema["vector"].dataType.simpleString()
    coded = classes.mapInArrow(
        _codes(bits, tables),
        f"h1 long, h2 long, rep long, n long, vector {kind}, label_key long, codes array<int>",
    )
    met = coded.select("*", F.posexplode("codes").alias("table", "code"))
    met = met.withColumn("key", F.xxhash64("label_key", F.size("vector"), "table", "code"))
    hot = met.groupBy("key").agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > BLOCK)
    hot = staged(hot.select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "hot-codes")
    dealt = met.join(hot, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod("h2", "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    dealt = dealt.select(
        F.xxhash64("key", low, high).alias("group"), "h1", "h2", "rep", "n", "vector", "label_key", "codes",
        F.col("table").cast("int").alias("table"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).cast("int").alias("side"),
    )
    found = staged(
        dealt.repartition("group").sortWithinPartitions("group")
        .mapInArrow(_links(threshold), "h1 long, h2 long, links long, a long, b long"),
        "vector-links",
    )
    counts = staged(found.groupBy("h1", "h2").agg(F.sum("links").alias("links")), "vector-counts")
    slim = base.select("vec_id", "h1", "h2")
    named = slim.join(classes.select("h1", "h2", "rep", "n"), ["h1", "h2"], "left")
    members = named.where("rep is not null and vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    component = connected_components(members.union(found.select("a", "b")))
    out = named.join(counts, ["h1", "h2"], "left").join(component, named["vec_id"] == component["id"], "left")
    own = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        (F.coalesce(F.col("n") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"),
    )


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP1_SQL = """
WITH RECURSIVE valid AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached AS (
  SELECT vec_id AS id, vec_id AS root FROM embeddings
  UNION SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.id),
component AS (SELECT id, min(root) AS component_id FROM reached GROUP BY id),
counted AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN component c ON c.id = e.vec_id LEFT JOIN counted k ON k.id = e.vec_id
"""
