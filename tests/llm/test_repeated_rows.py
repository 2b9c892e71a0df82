"""SimHash of rows that repeat very often."""

import random

from caremart.llm import simhash

from tests.llm.helpers import documents, sentence
from tests.llm.test_text_operators import simhash_of


def test_rows_that_repeat_do_not_vote_again(spark):
    rng = random.Random(7)
    texts = [sentence(rng, 100) for _ in range(4)]
    rows = [(1, texts[0], "en", "a", 0)] * 1000 + [(None, texts[1], "en", "a", 0)] * 1000
    rows += [(2, texts[2], "en", "a", 0), (None, texts[3], "en", "a", 0)]
    got = simhash.edited_likeness(documents(spark, rows)).select("doc_id", "fingerprint", "edited_fingerprint").collect()
    prints = [f"{simhash_of(t):032x}" for t in texts]
    for doc_id, text, count in ((1, 0, 1000), (None, 1, 1000), (2, 2, 1), (None, 3, 1)):
        mine = [r for r in got if r["doc_id"] == doc_id and r["fingerprint"] == prints[text]]
        assert len(mine) == count and len(set(mine)) == 1
    assert len(got) == len(rows)
