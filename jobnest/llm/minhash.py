"""Near-duplicate documents: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidates.

A document's words (lower-cased A-Z, split at ASCII white space) give the set of its ``shingle``-word shingles.  Each
shingle is hashed once; the hash's top bits choose one of ``BINS`` bins, whose smallest hash is kept.  An empty bin
borrows from the first non-empty bin of its own keyed sequence of bins (optimal densification).  ``ROWS`` bins make a
band; documents that agree in a band share a bucket.

Documents with equal sets are one *class*, found by a 128-bit digest of the set, and only class representatives go on.
In every bucket all members are compared to one centre (a star), never all with all; a comparison is made on the full
sets of the two texts.  Rounds follow: linked classes are merged into components, buckets that lie in one component are
settled, and the others get another centre, until ``STAR_ROUNDS`` are done; a centre has met all its bucket and leaves
it.  What is still unsettled then is compared exactly, in blocks of bounded size: members of the smaller components of
a bucket with all others.  So no link inside a bucket is lost to the stars.

Two sets with similarity 0.8 miss each other in all 32 bands with a probability of about 5e-8.

A null text or one without words has an empty set and links with nothing; a text with fewer words than a shingle has
the whole sequence as its one shingle.  Repeated rows and copies fall in one class.  An empty table gives no rows.  Rows
without an id take part and pass links on; a component is named by its smallest id (null only if none of its rows has
one), and such rows are kept.  Texts are read whole, whatever their length; other columns take no part, whatever their
names.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import at_work, flat, likely, map_batches, memory, mixed, numbered, pick, place, written
from .components import components

BINS, ROWS = 128, 4
BANDS = BINS // ROWS
PERCENT = 80
STAR_ROUNDS = 2
#: Members of a bucket that are compared at a time, with as many others.
BLOCK = 1024

_words: dict[bytes, int] = {}


@memory
def _forget() -> None:
    _words.clear()


def words(text: bytes) -> list[bytes]:
    """bytes.lower() changes A-Z only, bytes.split() splits at ASCII white space only."""
    return text.lower().split()


def shingle_hashes(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    tokens = words(text or b"")
    if not tokens:
        return np.empty(0, np.uint64)
    if len(_words) > 300_000:
        _words.clear()
    known = _words
    for t in set(tokens).difference(known):
        known[t] = xxhash.xxh3_64_intdigest(t)
    h = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    size = min(k, len(h))
    out = h[: len(h) - size + 1]
    for i in range(1, size):
        out = mixed(out) + h[i: len(h) - size + 1 + i]
    # the length tells a short whole text from a shingle
    return np.unique(mixed(out, size))


def _borrow_order() -> np.ndarray:
    """[bin, attempt]: the keyed bins that an empty bin asks in turn, every bin at last."""
    rng = np.random.Generator(np.random.PCG64(5))
    draws = rng.integers(0, BINS, (BINS, 4 * BINS))
    return np.concatenate((draws, np.tile(np.arange(BINS), (BINS, 1))), axis=1)


_BORROW = _borrow_order()
_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_EDGES = np.arange(BINS, dtype=np.uint64) << _SHIFT


def signature(hashes: np.ndarray) -> np.ndarray:
    """BINS minima of a non-empty sorted hash set, densified."""
    first = np.minimum(np.searchsorted(hashes, _EDGES), len(hashes) - 1)
    minima = hashes[first]
    own = (minima >> _SHIFT) == np.arange(BINS, dtype=np.uint64)
    empty = np.flatnonzero(~own)
    if len(empty):
        lends = own[_BORROW[empty]]
        minima = minima.copy()
        minima[empty] = minima[_BORROW[empty, lends.argmax(axis=1)]]
    return minima


def bands(hashes: np.ndarray) -> np.ndarray:
    """One 64-bit key for every band."""
    rows = signature(hashes).reshape(BANDS, ROWS)
    key = rows[:, 0]
    for i in range(1, ROWS):
        key = mixed(key) + rows[:, i]
    return mixed(key + np.arange(BANDS, dtype=np.uint64)).astype(np.int64)


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(key, doc_id, n_shingles, digest, keys) of every row; ``key`` is a hash of id and text, digest and keys null for an
    empty set."""

    def sketch(batch):
        import pyarrow as pa

        out = {"key": batch.column(0), "doc_id": batch.column(1), "n_shingles": [], "digest": [], "keys": []}
        for text in batch.column(2).cast(pa.binary()).to_pylist():
            h = shingle_hashes(text, k)
            out["n_shingles"].append(len(h))
            out["digest"].append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
            out["keys"].append(bands(h) if len(h) else None)
        return out

    return map_batches(_keyed(docs), sketch, "key long, doc_id long, n_shingles long, digest binary, keys array<long>")


def _keyed(docs: DataFrame) -> DataFrame:
    return pick(docs, doc_id="long", text="string").select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")


def linked(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ids whose full sets agree: 100 * intersection >= percent * union.  ``texts``: id, text.

    Rows come sorted by a, so a centre's set is built once for a run of its pairs."""
    rows = (pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b"))

    def test(batch):
        import pyarrow as pa

        keep = []
        recent: OrderedDict[int, set] = OrderedDict()
        left, right = batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())
        for i, a in enumerate(batch.column(0).to_pylist()):
            if a not in recent:
                recent[a] = _set(left[i].as_py(), k)
                if len(recent) > 4:
                    recent.popitem(last=False)
            x, y = recent[a], _set(right[i].as_py(), k)
            both = len(x & y)
            keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
        mask = pa.array(keep, pa.bool_())
        return {"a": batch.column(0).filter(mask), "b": batch.column(1).filter(mask)}

    return map_batches(rows, test, "a long, b long")


def _set(text: bytes, k: int) -> set:
    w = words(text)
    size = min(k, len(w))
    return set(zip(*[w[i: len(w) - size + 1 + i] for i in range(size)])) if w else set()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    sk = written(sketches(docs, shingle), "sketches")
    # the row that stands for a class: the one with the smallest id, one without an id only if there is no other
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    classes = sk.filter("digest is not null").groupBy("digest").agg(first).select("first.key", F.col("first.doc_id").alias("id"))
    classes = written(classes, "classes")
    reps = (sk.filter("digest is not null").join(classes, "key").select("id", "n_shingles", "digest", "keys", F.col("key").alias("node"))
            .dropDuplicates(["node"]))
    reps = written(reps, "representatives")
    rows = reps.select("node", F.col("n_shingles").alias("n"), F.posexplode("keys").alias("band", "key")).withColumn("bucket", F.xxhash64("band", "key")).drop("band", "key")
    shared = rows.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1").select("bucket")
    open_ = written(rows.join(shared, "bucket").select("bucket", "node", "n", F.col("node").alias("comp")), "buckets")
    nodes = open_.select("node").distinct()
    if open_.isEmpty():
        label = None
    else:
        picked = written(nodes.select(F.col("node").alias("key")), "candidates")
        texts = written(likely(_keyed(docs), "key", picked).join(picked, "key").select(F.col("key").alias("id"), "text").dropDuplicates(["id"]), "texts")
        label = _resolve(open_, texts, shingle, percent)
    named = reps.select("node", "id", "digest")
    if label is not None:
        named = named.join(label, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    else:
        named = named.withColumn("comp", F.col("node"))
    smallest = named.groupBy("comp").agg(F.min("id").alias("component_id"))
    by_class = named.join(smallest, "comp").select("digest", "component_id")
    out = sk.select("doc_id", "n_shingles", "digest").join(by_class, "digest", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _resolve(open_: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, comp) of all nodes in ``open_`` (bucket, node, n, comp)."""
    label = written(texts.select(F.col("id").alias("node"), F.col("id").alias("comp")), "labels")
    for turn in range(STAR_ROUNDS + 1):
        if open_.isEmpty():
            break
        if turn < STAR_ROUNDS:
            # the centre: of the component that comes last the member that comes first
            centre = open_.groupBy("bucket").agg(F.max(F.struct("comp", F.xxhash64("node", F.lit(turn)).alias("h"), "node", "n")).alias("c"))
            met = open_.join(centre, "bucket")
            fits = F.least("n", "c.n") * 100 >= F.greatest("n", "c.n") * percent
            pairs = met.filter((F.col("comp") != F.col("c.comp")) & fits).select(F.least("c.node", "node").alias("a"), F.greatest("c.node", "node").alias("b"))
            links = linked(pairs.distinct(), texts, k, percent)
            open_ = met.filter(F.col("node") != F.col("c.node")).drop("c")
        else:
            links = linked_in_blocks(open_, texts, k, percent)
        links = written(links, "links")
        if not links.isEmpty():
            at = lambda c: label.select(F.col("node").alias(c), F.col("comp").alias(f"_{c}"))  # noqa: B023,E731
            merged = components(links.join(at("a"), "a").join(at("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
            label = written(label.join(merged.select(F.col("id").alias("comp"), "root"), "comp", "left").select("node", F.coalesce("root", "comp").alias("comp")), "labels")
        if turn < STAR_ROUNDS:
            rest = open_.drop("comp").join(label, "node")
            spread = rest.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("bucket")
            open_ = written(rest.join(spread, "bucket").select("bucket", "node", "n", "comp"), "buckets")
    return label


def linked_in_blocks(open_: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) that join all components of a bucket that any of its pairs joins.

    A bucket's members fall in blocks of about ``BLOCK``; a task holds two blocks at a time, whatever the bucket's size.
    Shared shingles are counted through the blocks' inverted lists, only for members outside the largest component, and
    what comes out is a spanning forest, never all pairs."""
    sizes = open_.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = open_.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("meeting"), "node", "comp")
    rows = rows.join(texts.withColumnRenamed("id", "node"), "node").select("meeting", "node", "comp", "text").repartition("meeting").sortWithinPartitions("meeting")

    def run(batches):
        import pyarrow as pa

        at_work(__name__)
        last, members = None, []

        def flush():
            pairs = _forest(members, percent)
            return pa.RecordBatch.from_pydict({"a": [p[0] for p in pairs], "b": [p[1] for p in pairs]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

        for batch in batches:
            meeting, node, comp, text = batch.columns
            for m, i, c, t in zip(meeting.to_pylist(), node.to_pylist(), comp.to_pylist(), text.cast(pa.binary())):
                if m != last and members:
                    yield flush()
                    members = []
                last = m
                members.append((i, c, shingle_hashes(t.as_py(), k)))
        if members:
            yield flush()

    return rows.mapInArrow(run, "a long, b long").distinct()


def _forest(members: list[tuple[int, int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links between members (node, component, shingles) of different components that connect all they can."""
    comps, comp = np.unique(np.array([c for _, c, _ in members]), return_inverse=True)
    if len(comps) < 2:
        return []
    size = np.array([len(h) for _, _, h in members])
    owner = np.repeat(np.arange(len(members)), size)
    _, token = np.unique(np.concatenate([h for _, _, h in members]), return_inverse=True)
    by_token = np.argsort(token, kind="stable")
    lists = owner[by_token]
    ends = np.cumsum(np.bincount(token))
    begins = np.concatenate(([0], ends[:-1]))
    offsets = np.concatenate(([0], np.cumsum(size)))
    root = np.arange(len(comps))
    out = []
    largest = np.argmax(np.bincount(comp))
    for i in np.flatnonzero(comp != largest).tolist():
        mine = token[offsets[i]: offsets[i + 1]]
        lengths = ends[mine] - begins[mine]
        places = np.repeat(begins[mine] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        both = np.bincount(lists[places], minlength=len(members))
        for j in np.flatnonzero((100 * both >= percent * (size[i] + size - both)) & (comp != comp[i])).tolist():
            if root[comp[i]] != root[comp[j]]:
                root[root == root[comp[j]]] = root[comp[i]]
                out.append((members[i][0], members[j][0]))
    return out


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the rows that are near-duplicates of one with a smaller id; rows without an id come after those
    with one.  Every row is judged by its own text, so rows that repeat an id stay if their texts differ enough, and of
    copies one stays whatever their ids.  Rows without words stay."""
    names = docs.columns
    # a row's number must be the same in every job
    own = written(flat(docs).withColumn("_row", F.monotonically_increasing_id()), "rows")
    rows = own.select(F.col("_row").alias("doc_id"), F.col(f"c{place(docs, 'text')}").alias("text"))
    root = near_duplicates(rows, shingle, percent).select(F.col("doc_id").alias("_row"), "component_id")
    doc_id = F.col(f"c{place(docs, 'doc_id')}").cast("long")
    order = F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"), F.col("_row").alias("row"))
    first = own.select("_row", order.alias("order")).join(root, "_row").groupBy("component_id").agg(F.min("order")["row"].alias("_row"))
    # whole rows are not shuffled for that
    return numbered(own, "_row", first.select("_row")).drop("_row").toDF(*names)
