"""SimHash fingerprints in DataFrame functions, and all fingerprints in a Hamming radius.

A text's terms are its pairs of neighbouring words, weighted by how often they
occur. Every occurrence votes on 128 bits. Votes are counted sixteen bits to a
number's lane: a shift and a mask bring four bits of a hash into four lanes of
one long, so 32 sums hold all votes. A lane cannot overflow, since long texts
are counted in chunks, which are then added in wider lanes. One task never
holds more of a text than its row; what is shuffled is one row of sums per
text and chunk.

Fingerprints within radius r: bits are cut into blocks, r of which can differ.
For each choice of the other blocks there is a table keyed by their bits, as
if bits were permuted so that these blocks lead; fingerprints that meet in a
table are compared. Equal fingerprints are one row with a count.
"""

from __future__ import annotations

import functools
import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caremart.sources.tables import staged

SPACE = " \t\n\x0b\x0c\r"
#: Terms that are counted in narrow lanes together: below 2 ** 15.
CHUNK_BITS = 14
_NARROW, _WIDE, _HALF = 0x0001000100010001, 0x0000000100000001, 0x0000FFFF0000FFFF
RADIUS = 3
NO_ID = -(1 << 63)


def terms(text: Column) -> Column:
    """Words of a text; one empty word if there are none."""
    return F.split(F.lower(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))), r"[\x20\x09-\x0D]+")


def fingerprints(rows: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """``(*key, f1, f2)``: the 128 bits of each key's text as two longs.

    Only primitive columns belong into ``key``, which has to name one row:
    rows of one key would vote together, into lanes made for one text. Null
    and blank texts have the fingerprint of an empty word.
    """
    words = rows.select(*key, terms(rows[text]).alias("_words"))
    # The last word's partner is null, which leaves the word alone.
    pairs = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1)))
    votes = words.select(*key, F.posexplode(pairs).alias("_place", "_h1"))
    votes = votes.select(*key, F.shiftright("_place", CHUNK_BITS).alias("_chunk"), "_h1",
                         F.xxhash64(F.lit(2), "_h1").alias("_h2"))
    lanes = [
        F.sum(F.shiftrightunsigned(f"_h{h}", j).bitwiseAND(F.lit(_NARROW))).alias(f"_n{h}_{j}")
        for h in (1, 2) for j in range(16)
    ]
    narrow = votes.groupBy(*key, "_chunk").agg(F.count(F.lit(1)).alias("_count"), *lanes)
    # Lanes 0 and 2 of a narrow sum are the even half, 1 and 3 the odd one.
    wide = [
        F.sum((F.col(f"_n{h}_{j}") if even else F.shiftrightunsigned(f"_n{h}_{j}", 16)).bitwiseAND(F.lit(_HALF)))
        .alias(f"_w{h}_{j}_{0 if even else 1}")
        for h in (1, 2) for j in range(16) for even in (True, False)
    ]
    summed = narrow.groupBy(*key).agg(F.sum("_count").alias("_count"), *wide)

    def word(h: int) -> Column:
        bits = []
        for j, odd, high in itertools.product(range(16), (0, 1), (0, 1)):
            ones = F.shiftrightunsigned(f"_w{h}_{j}_{odd}", 32 * high).bitwiseAND(F.lit(0xFFFFFFFF))
            place = j + 16 * odd + 32 * high
            bits.append(F.when(ones * 2 > F.col("_count"), F.shiftleft(F.lit(1).cast("long"), place)).otherwise(0))
        return functools.reduce(Column.bitwiseOR, bits)

    return summed.select(*key, word(1).alias("f1"), word(2).alias("f2"))


def hexadecimal(*longs: Column) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(x), 16, "0") for x in longs]))


def distance(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    return F.bit_count(a1.bitwiseXOR(b1)) + F.bit_count(a2.bitwiseXOR(b2))


def block_tables(radius: int, bits: int = 128) -> list[tuple[int, int]]:
    """Masks of the bits that lead in each table: all but ``radius`` of the blocks."""
    blocks = radius + 3
    edges = [bits * k // blocks for k in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    low = (1 << 64) - 1
    return [
        (signed(sum(m) & low), signed(sum(m) >> 64)) for m in itertools.combinations(masks, blocks - radius)
    ]


def within_radius(asked: DataFrame, known: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``(q1, q2, f1, f2, distance)`` of asked and known fingerprints ``(f1, f2)``.

    Every pair at a distance of at most ``radius`` is found, once, equal ones
    included. Both sides are made distinct first.
    """
    masks = block_tables(radius)

    def keyed(df: DataFrame, a: str, b: str) -> DataFrame:
        df = df.select(F.col("f1").alias(a), F.col("f2").alias(b)).distinct()
        keys = [
            F.xxhash64(F.lit(t), F.col(a).bitwiseAND(F.lit(x)), F.col(b).bitwiseAND(F.lit(y)))
            for t, (x, y) in enumerate(masks)
        ]
        return df.select(a, b, F.explode(F.array(*keys)).alias("key"))

    met = keyed(known, "f1", "f2").join(keyed(asked, "q1", "q2"), "key")
    apart = distance(F.col("q1"), F.col("q2"), F.col("f1"), F.col("f2"))
    return met.withColumn("distance", apart).where(F.col("distance") <= radius).drop("key").distinct()


def _successors(rows: DataFrame) -> DataFrame:
    """``rows`` (d, x, ...) with ``nd, nx``: the next key, descending by d, then ascending by x.

    Ranges of keys, about as many as the root of their number, are written
    with their number; inside a range the next row is a neighbour, and the
    last row's next is the first of the next range. The very last one's is
    the very first.
    """
    order = [F.desc("d"), F.asc("x")]
    parts = max(1, math.isqrt(rows.count()))
    ranged = rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    ranged = staged(ranged, "ranges")
    firsts = ranged.groupBy("part").agg(
        F.min(F.struct((-1 - F.col("d")).alias("m"), "x")).alias("least")
    ).select("part", (-1 - F.col("least.m")).alias("d"), F.col("least.x").alias("x"))
    line = Window.orderBy("part")  # one row per range
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.struct("d", "x")
    after = firsts.select(
        "part", F.coalesce(F.lead(first).over(line), F.first(first).over(whole)).alias("after")
    )
    inside = Window.partitionBy("part").orderBy(*order)
    linked = ranged.withColumn("next", F.lead(F.struct("d", "x")).over(inside)).join(after, "part")
    follow = F.coalesce("next", "after")
    return staged(linked.select(*rows.columns, follow["d"].alias("nd"), follow["x"].alias("nx")), "successors")


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of texts and of their edited forms, as the query returns them.

    Null texts are empty. Documents go by descending id, null ids last; rows
    of one id follow each other by a hash of the text, and rows that repeat
    entirely count as one document in that order and give a row each. (The
    smallest long stands for a null id.) No rows give no rows.
    """
    body = F.coalesce(docs[text], F.lit(""))
    base = docs.select(
        F.coalesce(docs[doc_id].cast("long"), F.lit(NO_ID)).alias("d"),
        F.xxhash64(docs[doc_id].isNull(), body).alias("x"),
        body.alias("text"),
    )
    slim = base.groupBy("d", "x").agg(F.count(F.lit(1)).alias("copies"), F.max(F.length("text")).alias("n_chars"))
    slim = staged(slim, "documents")
    chain = _successors(slim)
    # Of rows that repeat, one votes. The texts of all others are not shuffled for that.
    repeat = staged(slim.where("copies > 1").select("d", "x"), "repeated")
    one = base.join(repeat, ["d", "x"], "left_semi").groupBy("d", "x").agg(F.first("text").alias("text"))
    base = base.join(repeat, ["d", "x"], "left_anti").union(one)
    needs = chain.select(
        F.col("nd").alias("d"), F.col("nx").alias("x"), F.col("d").alias("for_d"), F.col("x").alias("for_x"),
        F.expr("cast(n_chars div 3 as int)").alias("part"),
    )
    heads = base.join(needs, ["d", "x"]).select(
        F.col("for_d").alias("d"), F.col("for_x").alias("x"), F.expr("left(text, part)").alias("head")
    )
    both = base.join(heads, ["d", "x"])
    edited = F.expr("concat(left(text, cast(length(text) - length(text) div 3 as int)), head)")
    both = both.select("d", "x", F.array("text", edited).alias("texts"))
    # The digest goes along as four numbers, which a hash aggregate can hold.
    digest = F.sha2(F.element_at("texts", 2), 256)
    quarters = [
        F.conv(F.substring(digest, 16 * k + 1, 16), 16, -10).cast("long").alias(f"s{k}") for k in range(4)
    ]
    texts = both.select("d", "x", "texts", *quarters).select(
        "d", "x", *[f"s{k}" for k in range(4)], F.posexplode("texts").alias("form", "text")
    )
    found = fingerprints(texts, ["d", "x", "form", "s0", "s1", "s2", "s3"])
    own = lambda c, form: F.max(F.when(F.col("form") == form, F.col(c)))
    prints = staged(
        found.groupBy("d", "x").agg(
            own("f1", 0).alias("f1"), own("f2", 0).alias("f2"), own("f1", 1).alias("e1"), own("f2", 1).alias("e2"),
            *[F.max(f"s{k}").alias(f"s{k}") for k in range(4)],
        ),
        "fingerprints",
    )
    nexts = prints.select(
        F.col("d").alias("nd"), F.col("x").alias("nx"), F.col("f1").alias("n1"), F.col("f2").alias("n2")
    )
    rows = chain.join(prints, ["d", "x"]).join(nexts, ["nd", "nx"])
    sizes = chain.join(prints, ["d", "x"]).groupBy("f1", "f2").agg(F.sum("copies").alias("rows"))
    asked = prints.where(F.col("d") % 100 == 0)
    near = within_radius(asked, prints).join(sizes, ["f1", "f2"])
    near = near.groupBy(F.col("q1").alias("f1"), F.col("q2").alias("f2")).agg(F.sum("rows").alias("near_rows"))
    rows = rows.join(staged(near, "near"), ["f1", "f2"], "left")
    like = lambda a, b: 1 - distance(F.col("f1"), F.col("f2"), F.col(a), F.col(b)) / F.lit(128.0)
    return rows.select(
        F.when(F.col("d") != NO_ID, F.col("d")).alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        hexadecimal(*[F.col(f"s{k}") for k in range(4)]).alias("edited_sha256"),
        hexadecimal(F.col("f1"), F.col("f2")).alias("fingerprint"),
        hexadecimal(F.col("e1"), F.col("e2")).alias("edited_fingerprint"),
        like("e1", "e2").alias("near_edited"),
        like("n1", "n2").alias("near_next"),
        F.when(F.col("d") % 100 == 0, F.col("near_rows") - 1).alias("n_within_radius"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For ids divisible by 100, also how many other rows lie within the radius."""
    return edited_likeness(spark.read.parquet(f"{sf_dir}/documents.parquet"))
