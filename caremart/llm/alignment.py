"""Which tokens of two tokenizers stand for the same bytes.

Rows are brought together by their full text first, so that each distinct
text is tokenised and aligned once, however many rows have it. Both token
sequences of a text spell the same bytes; a link is a token of either side
whose byte ranges overlap, a group is what lies between two places where
tokens of both sides end. Ends are marked in one array of bytes, so all of it
is arithmetic over the marks: each stretch between two marks is one link.
Both sides end a token before a single space that stands between printable
ASCII and an ASCII letter, so a text is cut there, a piece that comes again is
not tokenised again, and what is known of the pieces is put together.

A text's distinct linked pairs of ids go to a table, and count as often as
rows have the text. The counts meet the texts again by a broadcast if they are
few (their number is checked; it is bounded by the vocabularies, not by the
corpus), else by a join on the pair. At last the measures of a text join the
rows that have it, by the text's digest.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremart.llm.arrow_groups import small
from caremart.sources.tables import staged

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Counted pairs that are sent to every task, at most: 17 bytes each.
SENT = 6_000_000
#: Distinct pairs that a task sums up before it passes them on.
HELD = 1_000_000
#: Characters of a text that go to the tokenizers at once, about.
LONGEST = 1_000_000
#: Pieces of a text that a worker keeps, at most, and characters of one.
KEPT, KEPT_LENGTH = 100_000, 32
_SPACE = "▁"
#: Where a long text may be cut: no token of either side crosses a single space between ASCII letters.
_CUT = regex.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")
#: The space between two pieces, which begins the second one.
_BETWEEN = re.compile(r" (?=[A-Za-z])(?<=[!-~] )")
#: A piece that others may stand before and after, and how many go to the tokenizers in one text.
_INNER = re.compile(r"[A-Za-z](?s:.*[!-~])?\Z")
TOGETHER = 500

MEASURES = "n_a long, n_b long, n_groups long, n_links long"


def byte_of_character() -> dict[str, int]:
    """The byte that each printable character of a byte-level vocabulary stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return {chr(b) if b in plain else chr(next(others)): b for b in range(256)}


class Pair:
    """Both tokenizers, with the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = byte_of_character()
        entries = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(entries.values(), default=-1) + 1)
        for entry, number in entries.items():
            self.bytes_a[number] = bytes(map(byte.__getitem__, entry))
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(k)[1:-1], 16)]) if self.b.is_byte(k)
            else self.b.id_to_piece(k).replace(_SPACE, " ").encode()
            for k in range(self.b.vocab_size())
        ]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # A piece with a space inside could be cut in two.
        self.may_cut = not any(b" " in x[1:] and x.strip(b" ") for x in self.bytes_b)
        names_a, names_b = map(str, range(len(self.bytes_a))), map(str, range(len(self.bytes_b)))
        #: Decimal ids with what follows them: a comma inside a group, the group's bar or semicolon at its end.
        self.spelled = [x.encode() for n in names_a for x in (n + ",", n + "|")]
        self.spelled += [x.encode() for n in names_b for x in (n + ",", n + ";")]
        self.kept: dict[str, tuple[bytes, bytes, bytes] | None] = {}

    def parts(self, text: str) -> list[str]:
        """The text in parts of about ``LONGEST`` characters, each but the first beginning with a space."""
        out, start = [], 0
        while self.may_cut and len(text) - start > LONGEST:
            cut = _CUT.search(text, start + LONGEST)
            if not cut:
                break
            out.append(text[start : cut.start()])
            start = cut.start()
        return [*out, text[start:]]

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of either side for each text; none where they do not spell the text."""
        cut = [self.parts(t) for t in texts]
        # A part after the first has the space that A gets and B adds.
        spaced = [p if k else " " + p for parts in cut for k, p in enumerate(parts)]
        found_a = [x.ids for x in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        found_b = self.b.encode([p[1:] for p in spaced], num_threads=1)
        none, at = np.zeros(0, np.int64), 0
        for parts in cut:
            ids_a = [i for x in found_a[at : at + len(parts)] for i in x]
            ids_b = [i for x in found_b[at : at + len(parts)] for i in x]
            whole = "".join(spaced[at : at + len(parts)]).encode()
            at += len(parts)
            same = b"".join(map(self.bytes_a.__getitem__, ids_a)) == whole
            same = same and b"".join(map(self.bytes_b.__getitem__, ids_b)) == whole
            yield (np.array(ids_a, np.int64), np.array(ids_b, np.int64)) if same else (none, none)

    def align(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the linked tokens on either side, and whether a group ends with a link."""
        end_a, end_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        mark = np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, np.uint8)
        mark[end_a] = 1
        mark[end_b] |= 2
        kind = mark[mark > 0]
        ends_a, ends_b = (kind & 1).astype(np.int64), (kind >> 1).astype(np.int64)
        return np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b, kind == 3

    def groups(self, ids_a: np.ndarray, ids_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, ends: np.ndarray) -> bytes:
        """The groups in decimal, as ``a1,a2|b1;a3|b2,b3``."""
        return b"".join(self.tokens(ids_a, ids_b, at_a, at_b, ends))[:-1]

    def tokens(self, ids_a: np.ndarray, ids_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """What ``groups`` puts together: each token in decimal with what follows it."""
        last_a, last_b = at_a[ends], at_b[ends]
        in_a = np.zeros(len(ids_a), np.int64)
        in_a[last_a] = 1
        in_b = np.zeros(len(ids_b), np.int64)
        in_b[last_b] = 1
        group_a, group_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        order = np.zeros(len(ids_a) + len(ids_b), np.int64)
        before_b = np.concatenate([[0], last_b + 1])
        order[np.arange(len(ids_a)) + before_b[group_a]] = 2 * ids_a + in_a
        order[np.arange(len(ids_b)) + last_a[group_b] + 1] = 2 * (ids_b + len(self.bytes_a)) + in_b
        return list(map(self.spelled.__getitem__, order.tolist()))

    def aligned(self, pieces: list[str]) -> list[tuple[bytes, bytes, bytes] | None]:
        """Of each piece its groups in decimal, the pairs of its links and its numbers of tokens and groups.

        None for a piece that either side does not spell. Tokens of both sides
        end where a piece does, so all pieces are aligned as one sequence.
        """
        inner = [k for k, p in enumerate(pieces) if _INNER.match(p)]
        rest = sorted(set(range(len(pieces))) - set(inner))
        sets = [inner[i : i + TOGETHER] for i in range(0, len(inner), TOGETHER)] + [[k] for k in rest]
        out: list[tuple[bytes, bytes, bytes] | None] = [None] * len(pieces)
        some, found = [], []
        for which, ids in zip(sets, self.encode([" ".join([pieces[k] for k in s]) for s in sets]), strict=True):
            if len(ids[0]):
                some += which
                found.append(ids)
            elif len(which) > 1:  # one of them is not spelled
                for k in which:
                    ids = next(self.encode([pieces[k]]))
                    if len(ids[0]):
                        some.append(k)
                        found.append(ids)
        if not some:
            return out
        a, b = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
        # A piece has as many bytes as it is spelled with, and the space before it.
        end = np.cumsum([len(pieces[k].encode()) + 1 for k in some])
        n_a = np.diff(np.searchsorted(np.cumsum(self.size_a[a]), end, side="right"), prepend=0)
        n_b = np.diff(np.searchsorted(np.cumsum(self.size_b[b]), end, side="right"), prepend=0)
        at_a, at_b, ends = self.align(a, b)
        links = (a[at_a] * len(self.bytes_b) + b[at_b]).tobytes()
        link = 8 * np.searchsorted(at_a, np.concatenate([[0], np.cumsum(n_a)]))
        groups = np.diff(np.concatenate([[0], np.cumsum(ends)])[link // 8])
        numbers = np.stack([n_a, n_b, groups], axis=1).astype(np.int64).tobytes()
        tokens = self.tokens(a, b, at_a, at_b, ends)
        token = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        link = link.tolist()
        for i, k in enumerate(some):
            spelled = b"".join(tokens[token[i] : token[i + 1]])[:-1]
            out[k] = spelled, links[link[i] : link[i + 1]], numbers[24 * i : 24 * i + 24]
        return out

    def measured(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray] | None]:
        """Of each text its groups in decimal, the pairs of its links, and its numbers of tokens and groups.

        None where a side does not spell the text.
        """
        cut = [_BETWEEN.split(t) if self.may_cut else [t] for t in texts]
        kept = self.kept
        new = list(dict.fromkeys(p for pieces in cut for p in pieces if p not in kept))
        fresh = dict(zip(new, self.aligned(new), strict=True))
        for pieces in cut:
            found = [kept[p] if p in kept else fresh[p] for p in pieces]
            if None in found:
                yield None
                continue
            spelled, links, numbers = zip(*found, strict=True)
            yield (
                b";".join(spelled), np.frombuffer(b"".join(links), np.int64),
                np.frombuffer(b"".join(numbers), np.int64).reshape(-1, 3).sum(axis=0),
            )
        if len(kept) + len(fresh) > KEPT:
            kept.clear()
        if len(fresh) <= KEPT:
            kept.update((p, x) for p, x in fresh.items() if len(p) <= KEPT_LENGTH)


@cache
def pair_of(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _packed(keys: np.ndarray, times: np.ndarray) -> bytes:
    """Rising keys and how often each is there, by their steps, byte by byte."""
    rows = np.stack([np.diff(keys, prepend=0), times]).astype("<u8")
    return zstandard.compress(np.ascontiguousarray(rows.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T
    rows = np.ascontiguousarray(flat).view("<u8").reshape(2, -1).astype(np.int64)
    return np.cumsum(rows[0]), rows[1]


def aligned_texts(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row ``(key, copies, text)``: key, copies, the numbers of tokens, groups and links,
    ``groups_sha256``, and ``pairs``, the linked pairs of ids with their number of links, packed.

    A pair is one number: id of A times the size of B's vocabulary, plus id of B.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = pair_of(path_a, path_b)
        for batch in small(batches):
            rows = []
            for found in tool.measured(batch.column(2).to_pylist()):
                if found is None:
                    none = np.zeros(0, np.int64)
                    rows.append((0, 0, 0, 0, "", _packed(none, none)))
                    continue
                spelled, links, numbers = found
                keys, times = np.unique(links, return_counts=True)
                rows.append((*numbers.tolist(), len(links), hashlib.sha256(spelled).hexdigest(), _packed(keys, times)))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            columns = zip(*rows, strict=True) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=["key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"],
            )

    schema = f"key binary, copies long, {MEASURES}, groups_sha256 string, pairs binary"
    return texts.select("key", "copies", "text").mapInArrow(run, schema)


def _summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.concatenate([*keys, np.zeros(0, np.int64)])
    found, place = np.unique(flat, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, np.concatenate([*times, np.zeros(0, np.int64)]))
    return found, total


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(pair, n)``: rows that hold a pair, summed over a task as far as it has room."""
    keys, times, size = [], [], 0

    def out(found: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(total)], names=["pair", "n"])

    for batch in small(batches):
        for copies, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            mine = _unpacked(data)[0]
            keys.append(mine)
            times.append(np.full(len(mine), copies, np.int64))
            size += len(mine)
            if size > 2 * HELD:
                found, total = _summed(keys, times)
                if len(found) > HELD:
                    yield out(found, total)
                    found, total = found[:0], total[:0]
                keys, times, size = [found], [total], len(found)
    yield out(*_summed(keys, times))


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``(pair, n, best)``: rows in which a pair is linked, and whether that is the most of its A id."""
    found = aligned.select("copies", "pairs").mapInArrow(_counted, "pair long, n long")
    found = staged(found.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts").withColumn("a", F.expr(f"pair div {size_b}"))
    most = found.groupBy("a").agg(F.max("n").alias("most"))
    return staged(found.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def _looked_up(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``(key, n_best, count_sum)`` with all counts in every task."""
    table = counts.orderBy("pair").toArrow()
    columns = [np.ascontiguousarray(table.column(c).to_numpy()) for c in ("pair", "n", "best")]
    shared = aligned.sparkSession.sparkContext.broadcast(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, count, best = shared.value
        for batch in small(batches):
            some = [_unpacked(x) for x in batch.column(1).to_pylist()]
            n_best, total = [], []
            for keys, times in some:
                at = np.searchsorted(pairs, keys)
                n_best.append(int(times[best[at]].sum()))
                total.append(int((times * count[at]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], names=["key", "n_best", "count_sum"]
            )

    return aligned.select("key", "pairs").mapInArrow(run, "key binary, n_best long, count_sum long")


def _joined(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a join on the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, times = _unpacked(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(keys), pa.binary()), pa.array(keys), pa.array(times)], names=["key", "pair", "times"]
                )

    rows = aligned.select("key", "pairs").mapInArrow(run, "key binary, pair long, times long").join(counts, "pair")
    return rows.groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )


def align_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path_a: str | None = None,
                    path_b: str | None = None, sent: int = SENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` are links whose pair is in as many rows as any pair of its A
    id, ``count_sum`` adds up those numbers over all links. A null or empty
    text, and one that either side does not spell byte by byte, has zeros and
    an empty digest. Rows that repeat count as rows. ``path_a`` is a
    byte-level vocabulary of the tokenizers library, ``path_b`` a
    sentencepiece model; more than ``sent`` counted pairs are joined.
    """
    path_a = path_a or public_tokenizers.path(BYTE_LEVEL)
    path_b = path_b or public_tokenizers.path(PIECES)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    key = F.unhex(F.sha2("text", 256))
    texts = rows.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    aligned = staged(aligned_texts(texts.select(key.alias("key"), "copies", "text"), path_a, path_b), "aligned")
    some = aligned.where("n_a > 0")
    counts = pair_counts(some, len(pair_of(path_a, path_b).bytes_b))
    looked_up = _looked_up if counts.count() <= sent else _joined
    found = staged(looked_up(some, counts), "links")
    measures = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    whole = some.select("key", *measures).join(found, "key")
    ids = rows.select("doc_id", F.when(F.col("text") != "", key).alias("own"))
    out = ids.join(whole, ids["own"] == whole["key"], "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*measures[:4], "n_best", "count_sum")]
    return out.select("doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
