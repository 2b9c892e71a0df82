"""Byte-level BPE with the tokenizers library, and its way back.

The ranks file gives tokens as bytes. Each byte has a printable character, so
that the library can work on text; its merges are put together from the ranks:
the two parts that a token is made of are what merging by lower ranks leaves
of its bytes. A text is split by the public pattern, and the library is given
each different piece once: pieces repeat far more often than texts. Decoding
joins the tokens' bytes, so characters that are split over tokens come back
whole.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from caremart.llm.arrow_groups import small
from pyspark.sql import functions as F

RANKS = "byte_bpe_50k.tiktoken"
#: Pieces of text whose ids a worker remembers, and the longest of them.
REMEMBERED, LONGEST = 100_000, 40
#: Characters of which the standard library's classes and the pattern's are the same, and the pattern in its terms.
_UNLIKE = re.compile(r"[^\t\n\r\x20-\x7e\xa0\xc0-\xd6\xd8-\xf6\xf8-\u024f]")
_LIKE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Tokens of the rows that go back to Spark together, about.
TOGETHER = 500_000


def byte_characters() -> list[str]:
    """The printable character of each byte: itself, or one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def _parts(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens that the last merge of ``token`` joins."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        joined = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
        i = min(range(len(joined)), key=joined.__getitem__)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


class Codec:
    """Encoder and decoder of one ranks file, built once per worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        character = byte_characters()

        def text(token: bytes) -> str:
            return "".join(map(character.__getitem__, token))

        merges = [tuple(map(text, _parts(t, ranks))) for t in sorted(ranks, key=ranks.get) if len(t) > 1]
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.encoder = Tokenizer(models.BPE({text(t): r for t, r in ranks.items()}, merges))
        # Bytes to characters and nothing else: the text is already split.
        self.encoder.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        pieces = (self.split if _UNLIKE.search(text) else _LIKE).findall(text)
        known = self.known
        new = [p for p in dict.fromkeys(pieces) if p not in known]
        if new:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = list(dict.fromkeys(pieces))
            for start in range(0, len(new), 1000):
                some = new[start : start + 1000]
                for piece, done in zip(some, self.encoder.encode_batch_fast(some, add_special_tokens=False), strict=True):
                    known[piece] = np.array(done.ids, dtype="<u4").tobytes()
        ids = np.frombuffer(b"".join(map(known.__getitem__, pieces)), dtype="<u4")
        for piece in new:
            if len(piece) > LONGEST:
                del known[piece]
        return ids

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Of each token its first character and the one after its last."""
        found = list(self.split.finditer(text))
        return [
            (at + a, at + b)
            for start in range(0, len(found), 1000)
            for at, done in zip(
                [m.start() for m in found[start : start + 1000]],
                self.encoder.encode_batch([m[0] for m in found[start : start + 1000]], add_special_tokens=False),
                strict=True,
            )
            for a, b in done.offsets
        ]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, text: str = "text", offsets: bool = False, path: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, an array of token ids, added (a column of this name is replaced).

    With ``offsets`` there is ``spans`` too: of each token the first character
    and the one after its last; tokens that share a character share its place.
    A null or empty text has no tokens. ``path`` is that of the ranks file.
    """
    path = path or public_tokenizers.path(RANKS)
    rest = [c for c in docs.columns if c not in ("ids", "spans")]
    place = rest.index(text)
    pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)

        def out(rows: pa.RecordBatch, done: list[np.ndarray], texts: list[str]) -> pa.RecordBatch:
            ends = np.cumsum([0, *map(len, done)]).astype(np.int32)
            flat = np.concatenate([*done, np.zeros(0, "<u4")]).astype(np.int32)
            new = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
            if offsets:
                new.append(pa.array([[{"start": a, "end": b} for a, b in tool.spans(t)] for t in texts], pair))
            return pa.RecordBatch.from_arrays([*rows.columns, *new], names=[*rest, "ids", *["spans"] * offsets])

        for batch in small(batches):
            start, done, size = 0, [], 0
            texts = [t or "" for t in batch.column(place).to_pylist()]
            for k, text in enumerate(texts):
                done.append(tool.encode(text))
                size += len(done[-1])
                if size >= TOGETHER or k == len(texts) - 1:
                    yield out(batch.slice(start, len(done)), done, texts[start : k + 1])
                    start, done, size = k + 1, [], 0

    schema = T.StructType([docs.schema[c] for c in rest]).add("ids", T.ArrayType(T.IntegerType()))
    if offsets:
        one = T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType())
        schema = schema.add("spans", T.ArrayType(one))
    return docs.select(*rest).mapInArrow(run, schema)


def decode(coded: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``coded`` with ``decoded`` (bytes) and ``decoded_text`` added.

    Bytes that are no whole character become the replacement character in
    the text. Null ids decode to nothing; an id that is no token is an error.
    """
    path = path or public_tokenizers.path(RANKS)
    rest = [c for c in coded.columns if c not in ("decoded", "decoded_text")]
    place = rest.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            raw = [codec(path).decode(np.array(x or [], dtype=np.int64)) for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(raw, pa.binary()),
                 pa.array([x.decode("utf-8", "replace") for x in raw], pa.string())],
                names=[*rest, "decoded", "decoded_text"],
            )

    schema = T.StructType([coded.schema[c] for c in rest]).add("decoded", "binary").add("decoded_text", "string")
    return coded.select(*rest).mapInArrow(run, schema)


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Digests of each row's ids and of what they decode to.

    Encodes and decodes as ``encode`` and ``decode`` do, in one pass, so the
    ids do not travel between Spark and Python.
    """
    path = path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in small(batches):
            count, coded, back = [], [], []
            for text in batch.column(1).to_pylist():
                ids = tool.encode(text or "")
                count.append(len(ids))
                coded.append(hashlib.sha256(ids.tobytes()).hexdigest())
                back.append(hashlib.sha256(tool.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(coded, pa.string()),
                 pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, DIGEST)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
