"""Vectors compressed to one byte a part, with exact integer codebooks and memoised grid cells.

A vector's components become integers and are cut into ``PARTS`` consecutive parts.  Each part position has a codebook of
``ENTRIES`` entries, which starts as the parts of the first vectors and is improved by ``ROUNDS`` rounds of assigning
every part to its nearest entry and moving every entry to its parts' floored mean.

The nearest entry is found through a grid: a part's coarse cell (its components divided by ``WIDTH``) is hashed.  For a
cell the entries that may be nearest to some point of its box are remembered: an entry is dominated across the box if its
smallest possible distance there exceeds the largest possible distance of another one.  Both are bounded through the
box's centre and half diagonal.  Only the entries left are evaluated, exactly, in 64-bit integers, so the result is that
of trying all.  The memo holds a codebook's cells for the life of a task and is emptied when ``MEMO`` cells are reached;
copies and near copies of parts find their cell there.

Rows whose vector is null or holds a null or non-finite component are dropped.  Vectors must agree in their length: the
commonest length that is a multiple of ``PARTS``, the longer of equals, counts.  Vectors of another length, and those with
a component whose integer is 2 ** 27 or more in size (their squared error would not fit a long), stay in the result with
null code and errors and take no part in training.  A null id comes after all others; rows that repeat an id are vectors of
their own, in the order of their components.  With fewer vectors than entries the codebooks are smaller.  Other columns
take no part, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, pick, place, written

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
#: Width of a grid cell, in integer units.
WIDTH = 32
#: Cells remembered by a task for each codebook.
MEMO = 100_000
#: Parts looked up at a time.
CHUNK = 2048
LARGEST = 2**27


def packed(rows: DataFrame) -> DataFrame:
    """(vec_id, label, n, v) of the kept rows: n components, v their integers, big-endian with the sign bit flipped so
    that bytes sort as numbers, null where one is too large."""

    def pack(batch):
        import pyarrow as pa

        lists, n_rows = batch.column(1), batch.num_rows
        lengths = np.asarray(lists.value_lengths().fill_null(0))
        flat = lists.flatten()
        values = np.asarray(flat.fill_null(np.nan), float)
        owner = np.repeat(np.arange(n_rows), lengths)
        bad = np.zeros(n_rows, bool)
        bad[owner[~np.isfinite(values)]] = True
        bad |= np.asarray(lists.is_null())
        with np.errstate(all="ignore"):
            scaled = np.floor(SCALE * values)
        wide = np.zeros(n_rows, bool)
        wide[owner[~(np.abs(scaled) < LARGEST)]] = True
        ints = np.where(np.abs(scaled) < LARGEST, scaled, 0).astype(np.int64)
        raw = (ints + 2**31).astype(">u4").tobytes()
        ends = 4 * np.cumsum(lengths)
        v = [None if w else raw[e - 4 * n: e] for w, e, n in zip(wide.tolist(), ends.tolist(), lengths.tolist())]
        keep = pa.array(~bad)
        return {"vec_id": batch.column(0).filter(keep), "n": pa.array(lengths, pa.int32()).filter(keep), "v": pa.array(v, pa.binary()).filter(keep), "label": batch.column(2).filter(keep)}

    label = rows.schema.fields[place(rows, "label")].dataType.simpleString()
    return map_batches(pick(rows, vec_id="long", embedding="array<double>", label=label), pack, f"vec_id long, n int, v binary, label {label}")


def matrix(column) -> np.ndarray:
    """Integers of the packed vectors of a column without nulls, all of one length."""
    raw = b"".join(column.to_pylist() if not isinstance(column, list) else column)
    n = len(column)
    return (np.frombuffer(raw, ">u4").astype(np.int64) - 2**31).reshape(n, -1)


class Grid:
    """Nearest entries of one codebook."""

    def __init__(self, entries: np.ndarray, width: int = WIDTH, most: int = MEMO):
        self.entries, self.width, self.most = entries, width, most
        self.points = entries.astype(float)
        self.squares = (self.points**2).sum(axis=1)
        #: cell -> entries that are not dominated across its box
        self.memo: dict[bytes, np.ndarray] = {}
        self.evaluated = 0

    def _remember(self, cells: np.ndarray, keys: list[bytes]) -> None:
        """Entries that some point of a cell's box may be nearest to."""
        centre = cells * float(self.width) + (self.width - 1) / 2
        half = (self.width - 1) / 2 * cells.shape[1] ** 0.5
        square = (centre**2).sum(axis=1)
        distance = np.sqrt(np.maximum(square[:, None] + self.squares - 2 * (centre @ self.points.T), 0))
        # distances are rounded; the slack covers what the subtraction may lose
        slack = 1 + 1e-6 * (np.sqrt(square) + np.sqrt(self.squares.max(initial=0)))
        nearest = distance.min(axis=1) + half
        rows, found = np.nonzero(distance - half <= (nearest + slack)[:, None])
        for key, entries in zip(keys, np.split(found, np.searchsorted(rows, np.arange(1, len(cells))))):
            self.memo[key] = entries

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the lower) and the squared distance, of every row."""
        if not parts.shape[1]:
            return np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        cells = parts // self.width
        raw = np.ascontiguousarray(cells.astype(np.int32))
        step = raw.shape[1] * 4
        joined = raw.tobytes()
        keys = [joined[i: i + step] for i in range(0, len(joined), step)]
        if len(self.memo) + len(keys) > self.most:
            self.memo.clear()
        new = {k: i for i, k in enumerate(keys) if k not in self.memo}
        if new:
            self._remember(cells[list(new.values())], list(new))
        candidates = [self.memo[k] for k in keys]
        sizes = np.fromiter(map(len, candidates), np.int64, len(candidates))
        entry = np.concatenate(candidates)
        row = np.repeat(np.arange(len(parts)), sizes)
        self.evaluated += len(entry)
        d = parts[row] - self.entries[entry]
        distance = np.einsum("ij,ij->i", d, d)
        begins = np.cumsum(sizes) - sizes
        best = np.minimum.reduceat(distance, begins)
        hits = np.flatnonzero(distance == best[row])
        # candidates stand in the order of their indexes: the first hit of a row is the lowest
        _, first = np.unique(row[hits], return_index=True)
        return entry[hits[first]], best


def assigned(grids: list[Grid], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, part) -> entry and squared distance."""
    d = vectors.shape[1] // PARTS
    code, error = np.empty((len(vectors), PARTS), np.int64), np.empty((len(vectors), PARTS), np.int64)
    for i in range(0, len(vectors), CHUNK):
        for p, grid in enumerate(grids):
            code[i: i + CHUNK, p], error[i: i + CHUNK, p] = grid.nearest(vectors[i: i + CHUNK, p * d: (p + 1) * d])
    return code, error


def improved(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: a task adds up its parts by entry, Spark adds up the tasks' sums."""
    d = books[0].shape[1]
    n = len(books[0])

    def add(batches):
        import pyarrow as pa

        grids = [Grid(b) for b in books]
        count, total = np.zeros(PARTS * n, np.int64), np.zeros((PARTS * n, d), np.int64)
        for batch in batches:
            v = matrix(batch.column(0))
            code, _ = assigned(grids, v)
            for p in range(PARTS):
                np.add.at(count, p * n + code[:, p], 1)
                np.add.at(total, p * n + code[:, p], v[:, p * d: (p + 1) * d])
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), *[pa.array(np.ascontiguousarray(total[used, i])) for i in range(d)]], names=["entry", "n", *[f"s{i}" for i in range(d)]])

    sums = rows.select("v").mapInArrow(add, ", ".join(["entry long", "n long", *[f"s{i} long" for i in range(d)]]))
    new = [b.copy() for b in books]
    for r in sums.groupBy("entry").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(d)]).collect():
        new[r["entry"] // n][r["entry"] % n] = [r[f"s{i}"] // r["n"] for i in range(d)]
    return new


def train(rows: DataFrame, n: int) -> list[np.ndarray]:
    """Codebooks of the packed vectors of ``n`` components; the driver holds these and the first vectors alone."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    start = matrix([bytes(r.v) for r in first])
    d = n // PARTS
    books = [start[:, p * d: (p + 1) * d] for p in range(PARTS)]
    for _ in range(ROUNDS):
        books = improved(rows, books)
    return books


def compress(rows: DataFrame) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code, error) of every kept row, the codebooks): code has one byte a part."""
    all_rows = written(packed(rows), "vectors")
    fits = F.col("v").isNotNull() & (F.col("n") % PARTS == 0) & (F.col("n") > 0)
    commonest = all_rows.filter(fits).groupBy("n").count().orderBy(F.desc("count"), F.desc("n")).first()
    n = commonest["n"] if commonest else 0
    books = train(all_rows.filter(fits & (F.col("n") == n)), n) if n else []
    label = all_rows.schema["label"].dataType.simpleString()

    def encode(batches):
        import pyarrow as pa

        grids = [Grid(b) for b in books]
        for batch in batches:
            good = [i for i, (x, y) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2))) if x == n and y.is_valid] if n else []
            codes, errors = [None] * batch.num_rows, [None] * batch.num_rows
            if good:
                code, error = assigned(grids, matrix(batch.column(2).take(pa.array(good))))
                for i, c, e in zip(good, code.astype(np.uint8), error.sum(axis=1).tolist()):
                    codes[i], errors[i] = c.tobytes(), e
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(codes, pa.binary()), pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])

    return all_rows.mapInArrow(encode, f"vec_id long, label {label}, code binary, error long"), books


def decoded(code: bytes, books: list[np.ndarray]) -> list[int]:
    """The integers that a code stands for."""
    return [x for book, c in zip(books, code) for x in book[c].tolist()]


def digests(coded: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): labels are summed before they are joined."""
    coded = written(coded, "codes")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    text = ",".join(str(x) for b in books for x in b.ravel().tolist())
    out = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))
