"""Mixing sources to target weights: hash-random order, prefix sums, exact cuts.

Every document gets a random key from a hash. Equal ranges of the key are
buckets, about as many as the square root of the number of documents, so
neither a bucket nor a source's list of buckets grows beyond that root, also
where one source holds most rows. Prefix sums over bucket totals find the
bucket in which a source's budget ends, prefix sums inside that bucket the
document. What is left is one row per source: how often all of its documents
are repeated, and the key at which the last, partial round is cut.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caremart.sources.tables import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: The mix takes 3 / 2 of all words, and at most 2 times those of a source.
SHARE = (3, 2)
MOST = 2
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Hexadecimal digest of seed, id and text; equal rows have equal keys."""
    return F.md5(
        F.concat(
            F.lit(seed + ":"),
            F.coalesce(doc_id.cast("string"), F.lit("")),
            F.lit(":"),
            F.md5(F.coalesce(text, F.lit(""))),
        )
    )


def _targets(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    One row per source here, so the two ordered passes in one task see as
    many rows as there are sources. Sources in the order of the ratio of
    limit to weight: those that stop at their limit come first, and the first
    one that does not fixes what a unit of weight gets. All in whole numbers.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = sizes.select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("decimal(20,0)").alias("w"),
        F.row_number().over(by_name).alias("place"),
        (F.lit(MOST) * F.col("source_size")).cast("decimal(20,0)").alias("most"),
    )
    order = Window.orderBy((F.col("most").cast("double") / F.col("w").cast("double")), "place")
    everyone = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everyone).cast("decimal(20,0)")
    ranked = ranked.select(
        "*",
        (total * SHARE[0] - SHARE[1] * F.coalesce(F.sum("most").over(before), F.lit(0))).alias("num"),
        (F.sum("w").over(onward) * SHARE[1]).alias("den"),
        F.row_number().over(order).alias("pos"),
    )
    ranked = ranked.withColumn("full", F.expr("most * den <= w * num"))
    unit = F.min(F.when(~F.col("full"), F.struct("pos", "num", "den"))).over(everyone)
    ranked = ranked.withColumn("unit", unit)
    free = F.col("unit").isNotNull() & (F.col("pos") >= F.col("unit.pos"))
    shared = (F.col("w") * F.col("unit.num")).cast("double") / F.col("unit.den").cast("double")
    return ranked.select(
        "source",
        "source_size",
        F.when(free, shared).otherwise(F.col("most").cast("double")).alias("target"),
    )


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          seed: str = SEED) -> DataFrame:
    """``(doc_id, source, size, key)`` of every row, written once."""
    return staged(
        docs.select(
            docs[doc_id].alias("doc_id"),
            docs[source].alias("source"),
            word_count(docs[text]).alias("size"),
            random_key(docs[doc_id], docs[text], seed).alias("key"),
        ),
        "sized",
    )


def mix_plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source of ``sized`` rows: source_size, target, rounds, cut, share.

    A document is taken ``rounds`` times, once more if its key is below
    ``cut``, and for ``share`` words more if its key is ``cut``. Rows of the
    very same key (repeated rows) divide the words that are left at the cut.
    A source without words has target 0. No rows give no plan.
    """
    count = rows.count()
    buckets = max(1, math.isqrt(count))
    low = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("bucket", F.floor(low * buckets / F.lit(2.0**32)).cast("int"))
    totals = staged(
        rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-buckets"
    )
    plan = _targets(totals.groupBy("source").agg(F.sum("words").alias("source_size")), weights)
    budget = F.floor("target").cast("long")
    rounds = F.when(F.col("source_size") > 0, F.expr("div(floor(target), source_size)")).otherwise(0)
    plan = plan.select("*", rounds.cast("int").alias("rounds")).withColumn(
        "rest", budget - F.col("rounds") * F.col("source_size")
    )
    plan = staged(plan, "mix-targets")

    def ends_in(df: DataFrame, order: str, words: str) -> DataFrame:
        """Of each source, the row in which its rest ends; and the rest there."""
        span = Window.partitionBy("source").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        df = df.withColumn("before", F.coalesce(F.sum(words).over(span), F.lit(0).cast("long")))
        at = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col(words))
        return df.where(at).withColumn("rest", F.col("rest") - F.col("before"))

    rest = plan.select(F.col("source").alias("of"), "rest")
    same = F.col("source").eqNullSafe(F.col("of"))
    bucket = ends_in(totals.join(rest, same).drop("of"), "bucket", "words")
    bucket = bucket.select(F.col("source").alias("of"), F.col("bucket").alias("at"), "rest")
    inside = (
        rows.join(bucket, same & (F.col("bucket") == F.col("at")))
        .groupBy("source", "key", "rest")
        .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("copies"))
    )
    cut = ends_in(inside, "key", "words").select(
        F.col("source").alias("of"),
        F.col("key").alias("cut"),
        F.expr("div(rest, copies)").cast("long").alias("share"),
    )
    return staged(
        plan.join(cut, same, "left").select(
            "source", "source_size", "target", "rounds",
            F.coalesce("cut", F.lit("")).alias("cut"), F.coalesce("share", F.lit(0).cast("long")).alias("share"),
        ),
        "mix-plan",
    )


def taken(size: Column, key: Column, plan: DataFrame) -> Column:
    """Words taken of a document, repeats counted."""
    last = F.when(key < plan["cut"], size).when(key == plan["cut"], plan["share"]).otherwise(0)
    return (plan["rounds"] * size + last).cast("long")


def mix_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
               weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target and taken words.

    Null and blank texts have size 0 and nothing of them is taken; null is a
    source of its own and comes last; a null id is an id like any other.
    Further columns of ``docs`` are not read, whatever their names.
    """
    rows = sized(docs, doc_id, text, source, seed)
    plan = mix_plan(rows, weights)
    return rows.join(plan, rows["source"].eqNullSafe(plan["source"])).select(
        rows["doc_id"], rows["size"], plan["source_size"], plan["target"],
        taken(rows["size"], rows["key"], plan).alias("taken"),
    )


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                  weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The mix itself: ``docs`` with a row for each time a document is taken.

    The document at a source's cut is taken up to the words that fit. The
    plan has one row per source and is joined to the documents, whose text is
    not shuffled where that plan is small enough for Spark to broadcast.
    """
    plan = mix_plan(sized(docs, doc_id, text, source, seed), weights)
    plan = plan.select(*[F.col(c).alias(f"_mix_{c}") for c in plan.columns])
    joined = docs.join(plan, docs[source].eqNullSafe(plan["_mix_source"]))
    key = random_key(docs[doc_id], docs[text], seed)
    size = word_count(docs[text])
    whole = plan["_mix_rounds"] + (key < plan["_mix_cut"]).cast("int")
    part = F.when((key == plan["_mix_cut"]) & (size > 0), plan["_mix_share"]).otherwise(0)
    # Words with the white space before them; the first of them, put together again.
    pieces = F.regexp_extract_all(docs[text], F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    head = F.array_join(F.slice(pieces, F.lit(1), F.col("_mix_part").cast("int")), "")
    texts = F.concat(
        F.array_repeat(docs[text], F.when(F.col("_mix_size") > 0, F.col("_mix_whole")).otherwise(0)),
        F.when(F.col("_mix_part") > 0, F.array(head)).otherwise(F.array().cast("array<string>")),
    )
    counted = joined.withColumns({"_mix_whole": whole, "_mix_part": part, "_mix_size": size})
    out = counted.withColumn("_mix_text", F.explode(texts))
    columns = []
    for c in docs.columns:
        if c == text:
            columns.append(F.col("_mix_text").alias(c))
        elif c == "n_chars":
            columns.append(F.length("_mix_text").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(docs[c])
    return out.select(*columns)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place,
         2 * source_size AS most,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
         sum(source_size) OVER () AS total
  FROM per_source),
steps AS (
  SELECT *, row_number() OVER o AS pos,
         3 * total - 2 * coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
         2 * sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS den
  FROM ranked WINDOW o AS (ORDER BY CAST(most AS DOUBLE) / CAST(w AS DOUBLE), place)),
unit AS (SELECT pos AS upos, num AS unum, den AS uden FROM steps WHERE most * den > w * num ORDER BY pos LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN upos IS NOT NULL AND pos >= upos
              THEN CAST(w * unum AS DOUBLE) / CAST(uden AS DOUBLE) ELSE CAST(most AS DOUBLE) END AS target
  FROM steps LEFT JOIN unit ON true),
budgets AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS rounds
  FROM targets),
summed AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.rounds,
         CAST(floor(b.target) AS BIGINT) - b.rounds * b.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id ROWS UNBOUNDED PRECEDING) - s.size AS before
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(rounds * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM summed
"""
