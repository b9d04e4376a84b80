"""Whole texts are not shuffled to pick some of them, nor for a mix; units of a text are looked up once."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from jobnest.llm import common, jaccard_join, minhash, mixture, token_store
from jobnest.llm.queries import BYTE_BPE, vocabulary


def test_likely_keeps_all_wanted_and_drops_most_others(spark):
    rows = spark.range(20000).select(F.xxhash64("id").alias("key"), "id")
    wanted = rows.filter("id % 10 = 0").select("key")
    got = {r.id for r in common.likely(rows, "key", wanted).select("id").collect()}
    assert got >= set(range(0, 20000, 10))
    assert len(got) < 5000
    assert common.likely(rows, "key", wanted.limit(0)).count() == 0


def test_numbered_is_exact(spark, monkeypatch):
    rows = spark.range(5000).repartition(7).select(F.monotonically_increasing_id().alias("n"), "id")
    rows = common.written(rows, "rows")
    kept = rows.filter("id % 3 = 0 or id between 64 and 200")
    want = {r.id for r in kept.collect()}
    assert {r.id for r in common.numbered(rows, "n", kept.select("n")).collect()} == want
    monkeypatch.setattr(common, "MAP_WORDS", 0)  # too long to be broadcast
    assert {r.id for r in common.numbered(rows, "n", kept.select("n")).collect()} == want


def _shuffled(df) -> list[str]:
    """Columns of every shuffle of the plan."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]", plan)


def test_kept_documents_are_not_shuffled(spark):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(words[i:] + [f"x{i}"])) for i in (0, 1, 30)] + [(3, None)], "doc_id long, text string")
    kept = minhash.keep_one(docs)
    assert not any(re.match(r"c\d+#", c.strip()) for x in _shuffled(kept) for c in x.split(","))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 30]


def test_mixed_documents_shuffle_texts_once(spark):
    docs = spark.createDataFrame([(i, f"s{i % 2}", f"word{i} " * 50) for i in range(40)], "doc_id long, source string, text string")
    mixed = mixture.mixed_documents(docs)
    assert sum("c2#" in x for x in _shuffled(mixed)) <= 1
    taken = sum(r.taken for r in mixture.mix(docs)[0].collect())
    assert sum(len(r.text.split()) for r in mixed.collect()) == taken


def test_texts_of_nodes_are_filtered_before_they_are_shuffled(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(2000)], "doc_id long, text string")
    names = docs.select(F.xxhash64("doc_id", "text").alias("key"), F.col("doc_id").alias("node"))
    kept = []
    monkeypatch.setattr(jaccard_join, "likely", lambda *a: kept.append(common.likely(*a)) or kept[-1])
    got = jaccard_join._texts(docs, names, names.filter("node < 20").select("node"))
    assert {(r.node, r.text) for r in got.collect()} == {(i, f"some text {i}") for i in range(20)}
    assert kept[0].count() < 500


def test_a_unit_is_looked_up_once_for_all_its_places():
    class Counted(dict):
        seen = 0

        def get(self, *a):
            self.seen += 1
            return super().get(*a)

        def __getitem__(self, k):
            self.seen += 1
            return super().__getitem__(k)

    one = token_store.Encoder(vocabulary(BYTE_BPE), False)
    one.known = Counted()
    text = "the same few words again, " * 500
    got = one.encode([text, "", text + "x" * 100, "<|endoftext|>" + text])
    plain = lambda t: one.tokenizer.encode(t, add_special_tokens=False).ids
    assert [g.tolist() for g in got] == [plain(text), [], plain(text + "x" * 100), plain("<|endoftext|>" + text)]
    assert one.known.seen < 100


def test_blocks_of_every_width():
    rng = np.random.default_rng(1)
    for width in range(33):
        for n in (1, 7, 8, 9, 1000, 1024):
            ids = rng.integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
            ids[rng.integers(0, n, n // 50)] = 4_000_000_000
            data = b"xyz" + token_store.pack_block(ids) + b"tail"
            got, end = token_store.unpack_block(data, 3)
            assert got.tolist() == ids.tolist() and end == len(data) - 4
    # the layout is that of the bits, lowest first
    ids = rng.integers(0, 1 << 13, 1001, dtype=np.uint64).astype(np.uint32)
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little", count=13)
    assert token_store._packed(ids, 13) == np.packbits(bits.ravel(), bitorder="little").tobytes()
