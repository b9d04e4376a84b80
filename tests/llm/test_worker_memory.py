"""What Python workers hold between stages, and how texts come to them."""

import numpy as np
from jobnest.llm import common, jaccard_join, minhash, sp_dropout, token_store
from jobnest.llm.queries import BYTE_BPE, PIECE_BPE, vocabulary


def test_what_other_operators_remember_is_dropped():
    common.at_work("jobnest.llm.minhash")
    minhash.shingle_hashes(b"a few words of a text", 2)
    common.at_work("jobnest.llm.minhash")
    assert minhash._words
    common.at_work("jobnest.llm.jaccard_join")
    jaccard_join.hashes(b"a few words of a text", 2)
    assert jaccard_join._known and not minhash._words
    common.at_work("jobnest.llm.sp_dropout")
    sp_dropout.Segmenter.of(vocabulary(PIECE_BPE), 0.1, 29)
    token_store.Encoder.of(vocabulary(BYTE_BPE), False)
    assert sp_dropout._models and not jaccard_join._known
    common.at_work("jobnest.llm.token_store")
    assert token_store._loaded and not sp_dropout._models
    common.at_work("jobnest.llm.langid")
    assert not token_store._loaded


def test_batches_for_python_are_bounded_in_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    rows = spark.range(0, 200, 1, 1).selectExpr("id", "repeat('x', 100000) as text")
    try:
        n = common.map_batches(rows, lambda b: {"n": [b.nbytes]}, "n long").collect()
        assert len(n) > 3
        assert max(r.n for r in n) <= 2 * common.BATCH_BYTES
        spark.conf.set(name, 1 << 20)
        common.short_batches(rows)
        assert spark.conf.get(name).rstrip("b") == str(1 << 20)
    finally:
        spark.conf.unset(name)


def test_a_ways_end_needs_no_place_of_its_own():
    s = sp_dropout.Segmenter(vocabulary(PIECE_BPE), 0.1, 29)
    texts = ["some words, some more words and the same words", "", "x" * 100 + " end"]
    alone = [sp_dropout.Segmenter(vocabulary(PIECE_BPE), 0.1, 29).encode(t, i).tolist() for i, t in enumerate(texts)]
    assert [x.tolist() for x in s.encode_all(texts, [0, 1, 2])] == alone
    assert [s.decode(np.array(x)) for x in alone] == texts
    assert not hasattr(s, "first")
