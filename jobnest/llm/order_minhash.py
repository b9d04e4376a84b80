"""Order MinHash fingerprints in DataFrame functions alone.

A text's k-mers are its runs of ``K`` words (split at ASCII white space); the n-th occurrence of a k-mer is an element
of its own.  For each of ``SKETCHES`` hash functions the ``2`` elements with the smallest hashes are selected, put in the
order of the text and hashed together.  Two texts' likeness is the share of equal sketches; it falls when words change
and when they change places, as the edit distance rises.

The hash functions are one 64-bit hash XOR a constant that differs in the top bits.  So the smallest elements of function
j lie among the two smallest of each class of equal top bits: one sorted pass keeps those, whatever the length, and the
functions look at them only.

A null text counts as empty; texts without words all have the same fingerprint.  A text with fewer words than ``K`` is
one k-mer.  Repeated rows (same id and text) give equal rows and take one place in the order of documents, in which
rows without an id come last (descending), and rows that share an id stand by their texts' hashes.  A single document is
its own next one.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, written
from .ordering import running

K = 2
BITS = 5
SKETCHES = 1 << BITS


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def elements(text: Column) -> Column:
    """array<struct<v, pos>> by v: the hash of every occurrence-numbered k-mer, and its place."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")

    def kmers(w: Column) -> Column:
        pairs = F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: F.xxhash64(a, b))
        return F.slice(pairs, 1, F.greatest(F.size(w) - 1, F.least(F.size(w), F.lit(1))))

    def numbered(s: Column) -> Column:
        starts = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (F.get(s, i - 1)["h"] != x["h"]), i)), lambda i: i.isNotNull())

        def runs(st: Column) -> Column:
            each = F.transform(st, lambda a, j: F.slice(s, a + 1, F.coalesce(F.get(st, j + 1), F.size(s)) - a))
            return F.flatten(F.transform(each, lambda r: F.transform(r, lambda x, n: F.struct(F.xxhash64(x["h"], n).alias("v"), x["pos"].alias("pos")))))

        return let(starts, runs)

    placed = let(words, lambda w: F.sort_array(F.transform(kmers(w), lambda h, i: F.struct(h.alias("h"), i.alias("pos")))))
    return F.sort_array(let(placed, numbered))


def fingerprint(text: Column) -> Column:
    """array<int> of SKETCHES values; zeros for a text without words."""
    top = lambda x: F.shiftrightunsigned(x["v"], 64 - BITS)
    few = let(elements(text), lambda s: F.filter(s, lambda x, i: (i < 2) | (top(x) != top(F.get(s, i - 2)))))
    ordered = lambda x, y: F.when(y.isNull(), F.hash(x["v"])).when(x["pos"] < y["pos"], F.hash(x["v"], y["v"])).otherwise(F.hash(y["v"], x["v"]))
    # in the order of the signed hashes: the classes 16, ..., 31, 0, ..., 15; XOR with the sign bit compares unsigned
    keys = [((j + SKETCHES // 2) % SKETCHES << 64 - BITS) ^ 1 << 63 for j in range(SKETCHES)]
    keys = F.array(*[F.lit(k - 2**64 if k >= 2**63 else k) for k in keys])

    def sketch(s: Column) -> Column:
        # each class has two: function j's smallest are the two of class j, side by side
        full = F.transform(F.sequence(F.lit(0), F.lit(SKETCHES - 1)), lambda j: ordered(F.get(s, 2 * j), F.get(s, 2 * j + 1)))

        def nearest(key: Column) -> Column:
            near = F.sort_array(F.transform(s, lambda x: F.struct(x["v"].bitwiseXOR(key).alias("d"), x["pos"].alias("pos"), x["v"].alias("v"))))
            return let(near, lambda n: ordered(F.get(n, F.lit(0)), F.get(n, F.lit(1))))

        some = F.transform(keys, nearest)
        none = F.array_repeat(F.lit(0), SKETCHES)
        return F.when(F.size(s) == 2 * SKETCHES, full).when(F.size(s) > 0, some).otherwise(none)

    return let(few, sketch)


def written_out(sketches: Column) -> Column:
    return F.array_join(F.transform(sketches, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(SKETCHES))


def compare(docs: DataFrame) -> DataFrame:
    """The contract's rows of ``docs`` (doc_id, text): fingerprints of each text and of its edited text, likenesses."""
    own = pick(docs, doc_id="long", text="string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("tie", F.xxhash64("text"))
    keys = own.select("doc_id", "tie", F.char_length("text").cast("long").alias("n_chars")).distinct().withColumn("one", F.lit(1))
    order = written(running(keys, [], ["doc_id", "tie"], "one", "at", "order").select("doc_id", "tie", "n_chars", "at", "at_total"), "order")
    # the next in descending order, after the last the first
    nexts = order.select(F.col("doc_id").alias("next_id"), F.col("tie").alias("next_tie"), F.col("at").alias("next_at"))
    pairs = written(order.join(nexts, F.pmod(F.col("at") - 1 + F.col("at_total"), "at_total") == F.col("next_at")).select("doc_id", "tie", "n_chars", "next_id", "next_tie"), "neighbours")

    # keys without nulls: what is grouped by them lies where joins on them want it, and is shuffled once
    keyed = lambda df, id_, tie, to: df.select("*", F.coalesce(id_, F.lit(0)).alias(f"{to}_id"), F.col(id_).isNull().alias(f"{to}_none"), F.col(tie).alias(f"{to}_tie"))
    this = lambda a, b: [F.col(f"{a}_{c}") == F.col(f"{b}_{c}") for c in ("id", "none", "tie")]
    pairs = pairs.withColumnsRenamed({"next_id": "after_id", "next_tie": "after_tie"})
    steps = keyed(keyed(pairs, "doc_id", "tie", "to"), "after_id", "after_tie", "next")
    steps = steps.select(F.floor(F.col("n_chars") / 3).cast("int").alias("need"), *[f"{x}_{c}" for x in ("to", "next") for c in ("id", "none", "tie")])
    # both joins read the same columns of the texts, so that these are shuffled once for the two
    own = keyed(own, "doc_id", "tie", "own").drop("doc_id", "tie")
    pieces = (own.join(steps, this("own", "next"))
              .select("to_id", "to_none", "to_tie", "need", F.expr("left(text, need)").alias("piece")).groupBy("to_id", "to_none", "to_tie").agg(F.first("need").alias("need"), F.first("piece").alias("piece")))
    both = own.join(pieces, this("own", "to"))
    n = F.char_length("text")
    both = both.select(F.when(~F.col("own_none"), F.col("own_id")).alias("doc_id"), F.col("own_tie").alias("tie"), "text", n.cast("long").alias("n_chars"), F.concat(F.expr("left(text, char_length(text) - need)"), "piece").alias("edited"))
    prints = written(both.select("doc_id", "tie", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("own"), fingerprint(F.col("edited")).alias("changed")), "fingerprints")
    prints = keyed(prints, "doc_id", "tie", "own").drop("tie")

    by_key = prints.select(F.col("own_id").alias("p_id"), F.col("own_none").alias("p_none"), F.col("own_tie").alias("p_tie"), F.col("own").alias("next")).dropDuplicates(["p_id", "p_none", "p_tie"])
    following = steps.join(by_key, this("next", "p")).select("to_id", "to_none", "to_tie", "next")
    out = prints.join(following, this("own", "to"))
    return out.select("doc_id", "n_chars", "edited_sha256", written_out(F.col("own")).alias("fingerprint"), written_out(F.col("changed")).alias("edited_fingerprint"),
                      likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"))
