"""Documents that are there several times keep their text in the pipeline."""

import random

import corpus_pipeline

from tests.llm.helpers import documents, sentence


def test_one_of_each_group_of_copies_leaves_with_its_text(spark):
    rng = random.Random(9)
    texts = ["\n".join(sentence(rng, 12) for _ in range(8)) for _ in range(20)]
    rows = [(k, "\n".join(["Common line.", t]), "en", "a", 0) for k, t in enumerate(texts)]
    rows += [(100 + 10 * k + i, rows[k][1], "en", "a", 0) for k in range(3) for i in range(6)]
    rows += [(200 + i, rows[4][1] + " \n", "en", "a", 0) for i in range(6)]
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES[1:3]:
        docs = corpus_pipeline.staged(stage(spark, docs, ""), "test")
    got = {r["doc_id"]: r["text"].rstrip() for r in docs.collect()}
    assert got == dict(enumerate(texts))
