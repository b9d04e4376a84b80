"""Units of texts are cut in arrays; files are decoded without copies of their ids."""

import random

import numpy as np
from jobnest.llm import token_store
from jobnest.llm.queries import BYTE_BPE, vocabulary


def test_units_are_cut_in_arrays():
    names, places, begins = token_store._units(["a few, few\nwords", "", "é\n\nx ", " few"])
    assert [names[i] for i in places] == ["a", " few", ",", " few", "\n", "words", "é", "\n\nx", " ", " few"]
    assert begins.tolist() == [0, 6, 6, 9, 10]
    assert len(names) == len(set(names))
    assert [len(x) for x in token_store._units([])] == [0, 0, 1]


def test_units_of_any_characters_encode_like_whole_texts():
    rng = random.Random(3)
    signs = [*"abZ09 \t\n\r.,!?'\"<>|~`_-éß中😀\x00\x7f", "  ", "\n\n", "'s", "'re", " the"]
    odd = [*signs, "<|endoftext|>", "\x0b", "\x85", " ", "　"]
    one = token_store.Encoder(vocabulary(BYTE_BPE), False)
    for _ in range(40):
        texts = ["".join(rng.choices(odd if rng.random() < 0.1 else signs, k=rng.randrange(60))) for _ in range(40)]
        plain = [e.ids for e in one.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        assert [x.tolist() for x in one.encode(texts)] == plain


def test_files_keep_ids_starts_and_rows_without_id(spark, tmp_path):
    rows = [(None, "no id"), (3, "some words, more words\nend"), (1, None), (2, ""), (3, "some words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    token_store.write(docs, vocabulary(BYTE_BPE), f"file:{tmp_path}/files")
    got = sorted(token_store.read(spark, f"file:{tmp_path}/files").collect(), key=lambda r: r.start)
    one = token_store.Encoder(vocabulary(BYTE_BPE), False)
    ids = {t: [*one.tokenizer.encode(t or "", add_special_tokens=False).ids, token_store.END_ID] for _, t in rows}
    assert sorted((r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == sorted((i or 0, ids[t]) for i, t in rows)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert [r.doc_id for r in got][:3] == [None, 1, 2]
