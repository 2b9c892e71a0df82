"""Token alignment: pieces that come again are tokenised once, with the result of whole texts."""

import random

import numpy as np
import public_tokenizers

from caremart.llm import alignment

PARTS = ["a", "Be", "é", " ", "  ", " ", "​", "▁", "'s", "\n", "\t", "12", "日本", "<|endoftext|>", ". ", ", ", "the ", "the ", "\x00"]


def _tool():
    return alignment.Pair(public_tokenizers.path(alignment.BYTE_LEVEL), public_tokenizers.path(alignment.PIECES))


def _whole(tool, text):
    a, b = next(tool.encode([text]))
    if not len(a):
        return None
    at_a, at_b, ends = tool.align(a, b)
    return tool.groups(a, b, at_a, at_b, ends), (a[at_a] * len(tool.bytes_b) + b[at_b]).tolist(), [len(a), len(b), int(ends.sum())]


def test_pieces_give_what_whole_texts_give(monkeypatch):
    monkeypatch.setattr(alignment, "KEPT", 300)
    rng, tool = random.Random(3), _tool()
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    for start in range(0, len(texts), 100):
        some = texts[start : start + 100]
        got = [x and (x[0], x[1].tolist(), x[2].tolist()) for x in tool.measured(some)]
        assert got == [_whole(tool, t) for t in some]
    assert None in got and len(tool.kept) <= 300


def test_a_piece_is_tokenised_once(monkeypatch):
    tool, seen = _tool(), []
    encode = tool.encode
    monkeypatch.setattr(tool, "encode", lambda texts: seen.extend(texts) or encode(texts))
    first = list(tool.measured(["one two one two, three", "two one"]))
    again = list(tool.measured(["three two one", "one two one two, three"]))
    assert " ".join(seen).split() == ["one", "two", "two,", "three"]
    assert first[0][0] == again[1][0] and np.array_equal(first[0][1], again[1][1])
