"""Token ids in files of patched frame-of-reference blocks.

Documents are ordered by id, encoded, ended by ``END_ID`` and written shard by shard.  A shard's stream is cut into
blocks of ``BLOCK`` ids.  A block stores its minimum, and the differences packed at the width that ``PERCENTILE`` of
them need; larger ones go, with their places, to the block's exception list.  A row of the files is a *segment*: whole
documents of about ``SEGMENT`` ids, its blocks one after the other in ``payload``, an index of where each block starts
(id and byte) and the lengths of its documents.  Spark writes the rows as Parquet: its commit protocol keeps exactly
one copy of each segment when executors are lost.

Block layout, little-endian: uint32 n, uint32 minimum, uint16 width, uint16 0, uint32 exceptions; packed differences
(ceil(n * width / 8) bytes, lowest bits first); places uint16[exceptions]; values uint32[exceptions].

A null or empty text gives the end id alone.  Rows without an id come first; rows that repeat an id come in the order of
their texts' hashes.  An empty table writes files without rows.
"""

from __future__ import annotations

import re
import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_schema, at_work, memory, pick, short_batches, slices

END_ID = 2
BLOCK, SEGMENT = 1024, 1 << 18
PERCENTILE = 0.95
_HEAD = struct.Struct("<IIHHI")

# ---- blocks ----------------------------------------------------------------------------------------------------


def _packed(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bits, lowest bits first; up to 16 bits, eight values at a time make ``width`` bytes."""
    if width > 16:
        bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little", count=width)
        return np.packbits(bits.ravel(), bitorder="little").tobytes()
    if width == 16:
        return values.astype("<u2").tobytes()
    x = np.zeros(-(-len(values) // 8) * 8, np.uint64)
    x[: len(values)] = values
    for shift in (width, 2 * width):
        x = x[::2] | x[1::2] << np.uint64(shift)
    out = np.empty((len(x) // 2, 2), "<u8")
    out[:, 0] = x[::2] | x[1::2] << np.uint64(4 * width)
    out[:, 1] = x[1::2] >> np.uint64(64 - 4 * width)
    return out.view(np.uint8)[:, :width].tobytes()[: -(-len(values) * width // 8)]


def _unpacked(data: np.ndarray, n: int, width: int) -> np.ndarray:
    if width > 16:
        bits = np.unpackbits(data, bitorder="little", count=n * width).reshape(n, width)
        ids = np.zeros((n, 4), np.uint8)
        ids[:, : -(-width // 8)] = np.packbits(bits, axis=1, bitorder="little")
        return ids.view("<u4").ravel()
    if width == 16:
        return data.view("<u2").astype(np.uint32)
    eights = np.zeros(-(-n // 8) * width, np.uint8)
    eights[: len(data)] = data
    x = np.zeros((len(eights) // width, 16), np.uint8)
    x[:, :width] = eights.reshape(-1, width)
    x = x.view("<u8")
    x = np.stack((x[:, 0], x[:, 0] >> np.uint64(4 * width) | x[:, 1] << np.uint64(64 - 4 * width)), axis=1).ravel()
    for bits in (2 * width, width):
        x = np.stack((x, x >> np.uint64(bits)), axis=1).ravel()
    return (x[:n] & np.uint64((1 << width) - 1)).astype(np.uint32)


def pack_block(ids: np.ndarray) -> bytes:
    low = int(ids.min())
    rest = (ids - np.uint32(low)).astype(np.uint32)
    at = min(len(rest) - 1, int(PERCENTILE * len(rest)))
    need = np.partition(rest, at)[at]
    width = int(need).bit_length()
    over = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    values = rest[over]
    rest[over] = 0
    packed = _packed(rest, width) if width else b""
    return _HEAD.pack(len(ids), low, width, 0, len(over)) + packed + over.astype("<u2").tobytes() + values.astype("<u4").tobytes()


def unpack_block(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The block's ids and the byte behind it."""
    n, low, width, _, extra = _HEAD.unpack_from(data, at)
    at += _HEAD.size
    size = -(-n * width // 8)
    ids = _unpacked(np.frombuffer(data, np.uint8, size, at), n, width) if width else np.zeros(n, np.uint32)
    at += size
    places = np.frombuffer(data, "<u2", extra, at)
    ids[places] = np.frombuffer(data, "<u4", extra, at + 2 * extra)
    return ids + np.uint32(low), at + 6 * extra


def pack(ids: np.ndarray) -> tuple[bytes, list[int], list[int]]:
    """The payload of a segment, and by block its first id's place and its first byte."""
    parts, starts, offsets, at = [], [], [], 0
    for i in range(0, len(ids), BLOCK):
        parts.append(pack_block(ids[i: i + BLOCK]))
        starts.append(i)
        offsets.append(at)
        at += len(parts[-1])
    return b"".join(parts), starts, offsets


def unpack(payload: bytes, offsets: list[int], first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the blocks [first, last)."""
    some = [unpack_block(payload, o)[0] for o in offsets[first:last]]
    return np.concatenate(some) if some else np.zeros(0, np.uint32)


# ---- encoding --------------------------------------------------------------------------------------------------

#: White space beyond ASCII that the tokenizer's pattern treats as such, and control characters that only Python does.
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85   -     　]")
#: Its pattern never joins a character with white space behind it, nor a letter or digit with an ASCII mark behind it, nor
#: a single line end with a word behind it, so texts may be cut there.  Kinds of bytes: other, word, mark, blank, line end.
_WORD, _MARK, _BLANK, _LINE = 1, 2, 3, 4
_KIND = bytes(_WORD if chr(i).isalnum() else _LINE if i in b"\t\n\r" else _BLANK if i == 32 else _MARK if 33 <= i <= 126 else 0 for i in range(128)) + bytes(128)
_loaded: dict[tuple, Encoder] = {}
_CACHE = 400_000


@memory
def _forget() -> None:
    _loaded.clear()


class Encoder:
    """The tokenizer with a bounded memory of short units: text between white spaces is encoded once while known.

    Texts that hold the string of an added token are encoded uncut; ``encode_special_tokens`` is the library's switch,
    which makes the strings of special tokens ordinary text."""

    def __init__(self, path: str, encode_special_tokens: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = encode_special_tokens
        self.added = [a.content for a in self.tokenizer.get_added_tokens_decoder().values() if not (a.special and encode_special_tokens)]
        # a byte-level piece has one character for each byte
        self.widths = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        for piece, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            if i < len(self.widths):
                self.widths[i] = len(piece)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, *key) -> Encoder:
        if key not in _loaded:
            _loaded[key] = cls(*key)
        return _loaded[key]

    def _learn(self, units: list[str]) -> None:
        again = [u for u in units if u in self.older]
        self.known.update((u, self.older[u]) for u in again)
        units = [u for u in units if u not in self.older] if again else units
        # units that end without white space are encoded side by side; those that begin without, behind a line end each
        spaced, bare, alone = [], [], []
        for u in units:
            (alone if u[-1] in " \t\n\r" else spaced if u[0] in " \t\n\r" else bare).append(u)
        for side, before in ((spaced, ""), (bare, "\n")):
            for i in range(0, len(side), 4096):
                some = side[i: i + 4096]
                text = before + before.join(some)
                ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
                ends = np.cumsum(self.widths[ids])
                stops = np.cumsum([len(u) for u in some] if text.isascii() else [len(u.encode()) for u in some])
                stops += len(before) * np.arange(1, len(some) + 1)
                at = np.searchsorted(ends, stops)
                # every unit must end where a token does, and every line end before one must be a token
                if ends[-1] != stops[-1] or (ends[at] != stops).any() or before and (self.widths[ids[np.append(0, at[:-1] + 1)]] != 1).any():
                    alone += some
                    continue
                data = ids.tobytes()
                stop = 4 * (at + 1)
                start = np.append(0, stop[:-1]) + 4 * len(before)
                self.known.update(zip(some, [data[x:y] for x, y in zip(start.tolist(), stop.tolist())]))
        for unit, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            self.known[unit] = struct.pack(f"<{len(e.ids)}I", *e.ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        uncut = [bool(_ODD_SPACE.search(t)) or any(a in t for a in self.added) for t in texts]
        if len(self.known) > _CACHE:
            self.known, self.older = {}, self.known
        names, places, begins = _units(["" if u else t for t, u in zip(texts, uncut)])
        # every unit is looked up once for all its places in these texts
        found = [*map(self.known.get, names)]
        missing = [i for i, ids in enumerate(found) if ids is None]
        self._learn([names[i] for i in missing if len(names[i]) <= 64])
        for i in missing:
            found[i] = self.known[names[i]] if len(names[i]) <= 64 else self._whole(names[i])
        ids, ends = _laid_out(found, places)
        begins = ends[begins].tolist()
        return [np.frombuffer(self._whole(t), "<u4") if u else ids[x:y] for t, u, x, y in zip(texts, uncut, begins, begins[1:])]

    def _whole(self, unit: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([unit], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()


def _units(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct units of the texts by first occurrence, each unit's number in turn, and the place of each text's first
    unit, with the end."""
    import pyarrow as pa

    whole = [t.encode() for t in texts]
    data = b"".join(whole)
    begins = np.cumsum([0, *map(len, whole)])
    kind = np.frombuffer(data.translate(_KIND), np.uint8)
    start = np.zeros(len(data), bool)
    start[begins[begins < len(data)]] = True
    space = kind >= _BLANK
    # line ends that are alone: nothing or no white space of their text before them
    line = kind[:-1] == _LINE
    line[1:] &= ~space[:-2] | start[1:-1]
    start[1:] |= space[1:] & ~space[:-1] | (kind[1:] == _MARK) & (kind[:-1] == _WORD) | (kind[1:] == _WORD) & line
    first = np.flatnonzero(start)
    offsets = pa.py_buffer(np.append(first, len(data)))
    units = pa.LargeStringArray.from_buffers(len(first), offsets, pa.py_buffer(data)).dictionary_encode()
    return units.dictionary.to_pylist(), units.indices.to_numpy(), np.searchsorted(first, begins)


def _laid_out(found: list[bytes], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the units at ``places`` of ``found`` one after the other, and where each one begins, with the end."""
    n = np.fromiter(map(len, found), np.int64, len(found)) // 4
    first = (np.cumsum(n) - n)[places]
    ends = np.concatenate(([0], np.cumsum(n[places])))
    where = np.repeat(first - ends[:-1], n[places]) + np.arange(ends[-1])
    return np.frombuffer(b"".join(found), "<u4")[where], ends


SEGMENTS = ("shard int, segment int, first long, n_ids long, payload binary, block_starts array<int>, block_offsets array<int>, "
            "doc_ids array<long>, doc_lengths array<int>")


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) and write ``{path}/segments`` and ``{path}/shards`` (where each shard starts).

    The ids are those of the library's plain ``encode(text, add_special_tokens=False)``: the string of a special token
    in a text is that token."""
    rows = pick(docs, doc_id="long", text="string")
    tie = F.xxhash64("text")
    schema = arrow_schema(SEGMENTS)
    dealt = rows.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)

    def encode(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        at_work(__name__)
        shard = TaskContext.get().partitionId()
        encoder = Encoder.of(tokenizer, False)
        end = np.array([end_id], np.uint32)
        segment = first = size = 0
        ids, lengths, parts = [], [], []

        def flush():
            stream = np.concatenate(parts)
            payload, starts, offsets = pack(stream)
            return pa.RecordBatch.from_pydict({"shard": [shard], "segment": [segment], "first": [first], "n_ids": [len(stream)], "payload": [payload],
                                               "block_starts": [starts], "block_offsets": [offsets], "doc_ids": [ids], "doc_lengths": [lengths]}, schema=schema)

        for whole in batches:
            for batch in slices(whole, 4 << 20):
                got = encoder.encode([t or "" for t in batch.column(1).to_pylist()])
                for doc_id, x in zip(batch.column(0).to_pylist(), got):
                    ids.append(doc_id)
                    lengths.append(len(x) + 1)
                    parts += [x, end]
                    size += len(x) + 1
                    if size >= SEGMENT:
                        yield flush()
                        segment, first, size = segment + 1, first + size, 0
                        ids, lengths, parts = [], [], []
        if lengths:
            yield flush()

    short_batches(dealt).mapInArrow(encode, SEGMENTS).write.mode("overwrite").parquet(f"{path}/segments")
    spark = docs.sparkSession
    shards = spark.read.parquet(f"{path}/segments").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    # one row per shard
    before = F.sum("n_ids").over(W.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    shards.withColumn("start", F.coalesce(before, F.lit(0))).write.mode("overwrite").parquet(f"{path}/shards")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: doc_id, start (ids before it), n_tokens, ids (little-endian uint32 bytes)."""
    starts = spark.read.parquet(f"{path}/shards").select("shard", F.col("start").alias("shard_start"))
    segments = spark.read.parquet(f"{path}/segments").join(starts, "shard")
    segments = segments.select((F.col("shard_start") + F.col("first")).alias("start"), "payload", "block_offsets", "doc_ids", "doc_lengths")

    def decode(batches):
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for i in range(batch.num_rows):
                start, payload, offsets, ids, lengths = (batch.column(c)[i] for c in range(5))
                stream = unpack(payload.as_buffer(), offsets.as_py()).astype("<u4", copy=False)
                lengths = lengths.values.to_numpy()
                ends = np.cumsum(lengths, dtype=np.int64)
                each = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.append(0, 4 * ends).astype(np.int32)), pa.py_buffer(stream)])
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(start.as_py() + ends - lengths), pa.array(lengths, pa.int64()), each], schema=schema)

    return segments.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """The ids [start, stop) of the whole stream; only segments and blocks that hold some of them are read."""
    rows = (spark.read.parquet(f"{path}/segments").join(spark.read.parquet(f"{path}/shards").select("shard", F.col("start").alias("s")), "shard")
            .withColumn("at", F.col("s") + F.col("first")).filter((F.col("at") < stop) & (F.col("at") + F.col("n_ids") > start))
            .select("at", "n_ids", "payload", "block_starts", "block_offsets").orderBy("at").toLocalIterator())
    out = []
    for at, n, payload, starts, offsets in rows:
        lo, hi = max(0, start - at), min(n, stop - at)
        a, b = int(np.searchsorted(starts, lo, "right")) - 1, int(np.searchsorted(starts, hi, "left"))
        out.append(unpack(bytes(payload), offsets, a, b)[lo - starts[a]: hi - starts[a]])
    return np.concatenate(out) if out else np.zeros(0, np.uint32)
