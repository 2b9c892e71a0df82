"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles; equal sets are one class first.
Each class has minwise tokens. A tree starts with one token as the branch,
and goes on with a token that the path so far selects: what agrees in it
stays together. A small node is compared exhaustively, on signatures; a large
one is compared with a pivot of its own, and branches again in ``FORKS`` ways,
as long as that at least halves the pairs to compare. Trees are repeated until
all of them miss a pair at the threshold with a chance of ``MISS``, branches
included. All levels are grouped and joined by path, so a large node is a
skewed key and never one task's group.

Candidates are confirmed on the full sets, in two rounds: first one for each
document, then those whose ends the first round has not connected. Links that
would join what is joined already are not confirmed: they cannot change a
component.

Large nodes that branching does not thin out are families of texts that are
all alike. Nodes with common members are one family; all of its pairs that are
not connected by then are compared on the full sets, in pairs of blocks. Only
sizes that could be similar enough meet, and members of the component that
most of the family is in do not meet each other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caremart.llm.arrow_groups import small, sorted_groups, spanning_roots
from caremart.llm.components import connected_components
from caremart.llm.shingles import mix, shingle_sets
from caremart.sources.tables import staged

WORDS = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Chance that no tree brings a pair at the threshold together, about.
MISS = 1e-12
#: One byte of so many further tokens is a signature.
SIGNATURE = 96
#: Signatures that agree by less than the threshold minus this are no candidates (4 standard deviations).
SLACK = 0.15
#: Classes in a node that is compared on signatures at once; ways in which a larger one branches.
SMALL, FORKS = 40, 3
#: Branches on a path; what is large after the last one is compared in blocks.
LEVELS = 6
#: Sets, and shingles in them, that make a block of a family.
BLOCK, BLOCK_SHINGLES = 1000, 1_000_000
#: Columns of a block's matrix, and common shingles of single pairs, that are counted at a time.
COLUMNS, INCREMENTS = 4096, 4_000_000
SEED = 9


def tree_count(percent: int, miss: float = MISS) -> int:
    p = percent / 100
    found = p * (1 - (1 - p) ** FORKS) ** LEVELS
    return math.ceil(math.log(miss) / math.log(1 - found)) if found < 1 else 1


def _factors(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, count])
    a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def _sketch(trees: int, size: int):
    """Number of shingles, two sums that name the set, first tokens and signature of each text."""
    a, b = _factors(trees + SIGNATURE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            start = 0
            for sets in shingle_sets([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()], size):
                count = np.array([len(s) for s in sets])
                names = np.zeros((2, len(sets)), np.uint64)
                tokens = np.zeros((trees + SIGNATURE, len(sets)), np.uint64)
                some = np.flatnonzero(count)
                if len(some):
                    flat = np.concatenate([sets[k] for k in some])
                    at = np.concatenate([[0], np.cumsum(count[some])[:-1]])
                    names[0, some] = np.add.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), at)
                    names[1, some] = np.add.reduceat(mix(flat ^ np.uint64(0x14057B7EF767814F)), at)
                    for k in range(trees + SIGNATURE):
                        tokens[k, some] = np.minimum.reduceat(flat * a[k] + b[k], at)
                first = np.ascontiguousarray(tokens[:trees].T).view(np.int64)
                sig = np.ascontiguousarray((mix(tokens[trees:]) & np.uint64(255)).astype(np.uint8).T)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(sets)), pa.array(count),
                     pa.array(names[0].view(np.int64)), pa.array(names[1].view(np.int64)),
                     pa.ListArray.from_arrays(
                         pa.array(np.arange(0, first.size + 1, trees, dtype=np.int32)), pa.array(first.ravel())),
                     pa.array([row.tobytes() for row in sig], pa.binary())],
                    names=["doc_id", "n", "s1", "s2", "first", "sig"],
                )
                start += len(sets)

    return run


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SIGNATURE)


def _alike(least: float):
    """Of pairs with signatures, those that agree in enough tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            same = (_bytes(batch.column("sa")) == _bytes(batch.column("sb"))).mean(axis=1)
            found = batch.filter(pa.array(same >= least))
            yield found.select(["a", "b"])

    return run


def _within(least: float):
    """Pairs inside small nodes, each a row of lists, that agree in enough tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            left, right = [], []
            for reps, sigs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = np.frombuffer(b"".join(sigs), np.uint8).reshape(-1, SIGNATURE)
                same = (rows[:, None, :] == rows[None, :, :]).mean(axis=2)
                a, b = np.nonzero(np.triu(same >= least, 1))
                ids = np.array(reps)
                left.append(np.minimum(ids[a], ids[b]))
                right.append(np.maximum(ids[a], ids[b]))
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*left, none])), pa.array(np.concatenate([*right, none]))], names=["a", "b"]
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            start = 0
            for sets in shingle_sets([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()], size):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["id", "set"],
                )
                start += len(sets)

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            good = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(batch.column("xa"), batch.column("xb"), strict=True)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                good[k] = 100 * common >= percent * (len(both) - common)
            yield batch.filter(pa.array(good)).select(["a", "b"])

    return run


def common_shingles(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each of ``xs`` with each of ``ys``, sets of numbers."""
    out = np.zeros((len(xs), len(ys)), np.int64)
    flat = np.concatenate([*xs, *ys])
    row = np.repeat(np.arange(len(xs) + len(ys)), [*map(len, xs), *map(len, ys)])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    column = np.cumsum(np.concatenate([[0], flat[1:] != flat[:-1]]))[: len(flat)]
    width = int(column[-1]) + 1 if len(column) else 0
    left = row < len(xs)
    of_x = np.bincount(column[left], minlength=width)
    of_y = np.bincount(column[~left], minlength=width)
    x_row, x_column = row[left], column[left]
    y_row, y_column = row[~left] - len(xs), column[~left]
    # A shingle of many sets is a column of two matrices; the pairs of a rarer one are counted one by one.
    dense = of_x * of_y * 250 > out.size
    place = np.cumsum(dense) - 1
    x_dense, y_dense = dense[x_column], dense[y_column]
    xr, xc, yr, yc = x_row[x_dense], place[x_column[x_dense]], y_row[y_dense], place[y_column[y_dense]]
    for start in range(0, int(dense.sum()), COLUMNS):
        a, b = np.zeros((len(xs), COLUMNS), np.float32), np.zeros((len(ys), COLUMNS), np.float32)
        i, j = np.searchsorted(xc, [start, start + COLUMNS])
        a[xr[i:j], xc[i:j] - start] = 1
        i, j = np.searchsorted(yc, [start, start + COLUMNS])
        b[yr[i:j], yc[i:j] - start] = 1
        out += (a @ b.T).astype(np.int64)
    x_row, x_column = x_row[~x_dense], x_column[~x_dense]
    begin = np.cumsum(of_y) - of_y
    times = of_y[x_column]
    some = np.flatnonzero(times)
    ends = np.cumsum(times[some])
    flat_out = out.reshape(-1)
    at = 0
    while at < len(some):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + INCREMENTS, side="right")))
        part = some[at:to]
        count = times[part]
        step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        other = y_row[np.repeat(begin[x_column[part]], count) + step]
        flat_out += np.bincount(np.repeat(x_row[part], count) * len(ys) + other, minlength=out.size)
        at = to
    return out


def _blocks(percent: int):
    """Links that span what is similar enough in each group: one block, or two sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "group"):
            ids, side = group.column("id").to_numpy(), group.column("side").to_numpy()
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("set")]
            size = np.array([len(x) for x in sets])
            left = np.flatnonzero(side == 0)
            right = np.flatnonzero(side == 1) if side.max() > 0 else left
            if len(left) and len(ids) > 1:
                common = common_shingles([sets[k] for k in left], [sets[k] for k in right])
                good = 100 * common >= percent * (size[left][:, None] + size[right][None, :] - common)
                a, b = np.nonzero(good)
                root = spanning_roots(len(ids), left[a], right[b])
                some = np.flatnonzero(ids != ids[root])
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ids[root[some]])], names=["a", "b"])

    return run


def family_links(hot: DataFrame, sets: DataFrame, known: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``(a, b)`` between members of families that ``known`` (id, component) does not connect.

    ``hot`` are pairs ``(rep, pivot)`` of members of one node, ``sets`` are the
    members' ``(id, set)``. No pair of a family that is similar enough stays
    apart.
    """
    family = connected_components(hot, "rep", "pivot").select("id", F.col("component").alias("family"))
    known = known.select(F.col("id").alias("k"), F.col("component").alias("part"))
    parts = staged(
        family.join(known, family["id"] == known["k"], "left").select("id", "family", F.coalesce("part", "id").alias("part")),
        "families",
    )
    most = parts.groupBy("family", "part").agg(F.count(F.lit(1)).alias("n"))
    most = most.groupBy("family").agg(F.max(F.struct("n", "part"))["part"].alias("main"))
    # Similar sets have sizes in one band or in two that are neighbours.
    width = max(-math.log(percent / 100), 1e-3) * 1.000001
    sizes = sets.select("id", F.expr("length(set) div 8").alias("n"))
    members = parts.join(most, "family").join(sizes, "id").select(
        "id", "family", "n", F.floor(F.log("n") / width).alias("band"), (F.col("part") == F.col("main")).cast("long").alias("main")
    )
    members = staged(members.distinct(), "members")
    units = members.groupBy("family", "band", "main").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks")
    )
    units = staged(units, "units")
    others = units.select(
        "family", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"),
        F.col("band").alias("band2"), F.col("main").alias("main2"), F.col("blocks").alias("blocks2"),
    )
    met = staged(
        units.join(others, ["family", "band"]).where("main + main2 < 2"), "met-units"
    )
    code = lambda band, main, block: (F.col(band) * 2 + F.col(main)) * F.lit(1 << 32) + F.col(block)
    dealt = members.join(met, ["family", "band", "main"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id", F.lit(SEED)), F.col("blocks")))
    dealt = dealt.withColumn("block2", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks2") - 1)))
    dealt = dealt.select("id", "family", "n", code("band", "main", "block").alias("own"), code("band2", "main2", "block2").alias("other"))
    dealt = dealt.select(
        "id", "n", F.xxhash64("family", F.least("own", "other"), F.greatest("own", "other")).alias("group"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )
    rows = dealt.join(sets.withColumn("n", F.expr("length(set) div 8")), ["id", "n"]).select("group", "id", "side", "set")
    rows = rows.repartition("group").sortWithinPartitions("group")
    return staged(rows.mapInArrow(_blocks(percent), "a long, b long"), "family-links")


def _sizes(node: DataFrame) -> DataFrame:
    """``(path, size, pivot)`` of nodes with two members or more."""
    count = node.groupBy("path").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct(F.xxhash64("path", "rep"), "rep"))["rep"].alias("pivot")
    )
    return staged(count.where("size > 1"), "paths")


def _not_thinned(large: DataFrame, byte: Callable[[int], Column]) -> DataFrame:
    """The paths of nodes whose branches have more than half of the node's pairs to compare.

    Told from grouped counts, a way at a time: no row is copied for it.
    """
    left = None
    for fork in range(FORKS):
        count = large.groupBy("path", byte(fork).alias("byte")).agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("of"))
        pairs = count.groupBy("path").agg(F.sum(F.when(F.col("n") > 1, F.col("n") * F.col("n")).otherwise(0)).alias("left"),
                                          F.first("of").alias("of"))
        left = pairs if left is None else left.union(pairs)
    left = left.groupBy("path").agg(F.sum("left").alias("left"), F.first("of").alias("of"))
    return left.where(2 * F.col("left") > F.col("of") * F.col("of")).select("path")


def candidates(classes: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """What trees bring together of classes ``(rep, first, sig)``.

    Pairs ``(a, b)``, a < b, and the members of large nodes that no branch
    thins out, as ``(rep, pivot)`` with a member that is the node's pivot.
    """
    least = percent / 100 - SLACK
    known = classes.select("rep", "sig")
    node = classes.select("rep", F.posexplode("first").alias("tree", "token")).select(
        F.xxhash64("tree", "token").alias("path"), "rep"
    )
    small: list[DataFrame] = []
    pairs: list[DataFrame] = []
    hot: list[DataFrame] = []
    count = _sizes(node)
    alive = staged(node.join(count, "path").join(known, "rep").select("path", "rep", "sig", "size", "pivot"), "nodes")
    for level in range(LEVELS + 1):
        small.append(alive.where(F.col("size") <= SMALL).select("path", "rep", "sig"))
        large = alive.where(F.col("size") > SMALL)
        if large.isEmpty():
            break
        pivots = count.where(F.col("size") > SMALL).select("path", "pivot")
        pivots = staged(
            pivots.join(known, pivots["pivot"] == known["rep"]).select("path", F.col("sig").alias("sb")), "pivots"
        )
        star = large.join(pivots, "path").where("rep <> pivot").select(
            F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"), F.col("sig").alias("sa"), "sb"
        )
        pairs.append(star.mapInArrow(_alike(least), "a long, b long"))
        if level == LEVELS:
            hot.append(large.select("rep", "pivot"))
            break
        # Different bytes of the signature in each way, from a place that the path selects.
        byte = lambda fork: F.expr(
            f"substring(sig, cast(pmod(pmod(xxhash64(path, {level}), {SIGNATURE}) + ({fork}) * {SIGNATURE // FORKS}, "
            f"{SIGNATURE}) as int) + 1, 1)")
        families = staged(_not_thinned(large, byte), "families")
        hot.append(large.join(families, "path", "left_semi").select("rep", "pivot"))
        # Only members of nodes that branching thins out are there several times.
        thin = large.join(families, "path", "left_anti")
        forked = thin.select("*", F.explode(F.sequence(F.lit(0), F.lit(FORKS - 1))).alias("fork"))
        forked = forked.select(F.xxhash64("path", "fork", byte("fork")).alias("path"), "rep", "sig")
        count = _sizes(forked)
        alive = staged(forked.join(count, "path").select("path", "rep", "sig", "size", "pivot"), "nodes")
    nodes = small[0]
    for more in small[1:]:
        nodes = nodes.union(more)
    lists = nodes.groupBy("path").agg(F.collect_list(F.struct("rep", "sig")).alias("in")).select("in.rep", "in.sig")
    found = lists.mapInArrow(_within(least), "a long, b long")
    for more in pairs:
        found = found.union(more)
    members = classes.select("rep", F.col("rep").alias("pivot")).limit(0)
    for more in hot:
        members = members.union(more)
    return staged(found.distinct(), "candidates"), staged(members.distinct(), "hot-nodes")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets ``(id, set)`` are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("xa"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("xb"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return staged(joined.select("a", "b", "xa", "xb").mapInArrow(_confirmed(percent), "a long, b long"), "links")


def near_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                   percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    A text of fewer than ``words`` words is one shingle of its own; null and
    blank texts have the empty set and link with nothing. A row with a null
    id links with nothing, its component is null and it is kept. Rows that
    repeat an id are one member with several sets. No rows give no rows.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    trees = tree_count(percent, miss)
    sketch = staged(
        rows.mapInArrow(_sketch(trees, words), "doc_id long, n long, s1 long, s2 long, first array<long>, sig binary"),
        "sketch",
    )
    classes = sketch.where("n > 0 and doc_id is not null").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("rep"), F.first("first").alias("first"), F.first("sig").alias("sig")
    )
    classes = staged(classes, "classes")
    pairs, hot = candidates(classes, percent)
    # A class is confirmed on the text of its smallest row; ids that repeat have a text per set.
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).union(hot.select("rep"))
    needed = staged(needed.distinct(), "needed")
    texts = rows.join(needed, rows["doc_id"] == needed["id"], "left_semi")
    sets = staged(texts.mapInArrow(_sets(words), "id long, set binary"), "sets")
    first = pairs.groupBy("b").agg(F.min("a").alias("a"))
    links = confirm(first, sets, percent)
    known = staged(connected_components(links), "linked")
    left = known.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    right = known.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    apart = pairs.join(left, "a", "left").join(right, "b", "left")
    apart = apart.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    apart = staged(apart.join(first, ["a", "b"], "left_anti"), "apart")
    links = links.union(confirm(apart, sets, percent))
    if not hot.isEmpty():
        links = links.union(family_links(hot, sets, connected_components(links), percent))
    copies = sketch.join(classes.select("s1", "s2", "rep"), ["s1", "s2"]).where("n > 0 and doc_id <> rep")
    copies = copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    component = connected_components(links.union(copies))
    out = sketch.select("doc_id", F.col("n").alias("n_shingles"))
    out = out.join(component, out["doc_id"] == component["id"], "left")
    own = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept")
    )


def keep_one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the rows whose document another one of its component stands for."""
    found = staged(near_documents(docs, percent=percent).where("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    return docs.join(found, docs["doc_id"] == found["_gone"], "left_anti")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
