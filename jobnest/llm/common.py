"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobnest.session import work_root

#: ASCII white space, the word separators of the contracts.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Exactly these columns (name='type'), cast.  Other columns may clash with them (other letter case, the same name
    again): columns are taken by position, the first exact match, else the first match in any case."""
    return flat(df).select(*[F.col(f"c{place(df, n)}").cast(t).alias(n) for n, t in columns.items()])


def flat(df: DataFrame) -> DataFrame:
    """The same columns, named c0, c1, ..."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place(df: DataFrame, name: str) -> int:
    exact = [i for i, c in enumerate(df.columns) if c == name]
    near = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if not exact + near:
        raise ValueError(f"no column {name} in {df.columns}")
    return (exact + near)[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, what: str) -> DataFrame:
    """The rows written once to the shared folder and reread: later jobs see the same rows in the same partitions'
    order, and a lost executor does not repeat the work before."""
    spark = df.sparkSession
    path = work_root(spark, "llm", what, unique=True)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Most 64-bit words of a map of keys that is broadcast.
MAP_WORDS = 1 << 19


def _bits(keys: DataFrame, key: str, words: int | None, what: str) -> tuple[DataFrame, Column]:
    """(_word, _bits) with a bit set for every key, and whether a row's key has its bit; keys are folded to ``words``."""
    at = F.shiftright(key, 6)
    at = at if words is None else F.pmod(at, F.lit(words))
    spot = F.col(key).bitwiseAND(F.lit(63)).cast("int")
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), spot))
    table = written(keys.groupBy(at.alias("_word")).agg(bits.alias("_bits")), what)
    own = F.call_function("shiftright", F.col("_bits"), spot).bitwiseAND(F.lit(1).cast("long")) == 1
    return table, (at == F.col("_word")) & own


def likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key``, a 64-bit hash, is none of ``wanted``; all others stay.  A bit map of
    bounded size is broadcast, so that a join behind this shuffles few rows in vain."""
    words = min(MAP_WORDS, 1 << max(6, (wanted.count() // 4).bit_length()))
    table, has = _bits(wanted, key, words, "map")
    return rows.join(F.broadcast(table), has, "left_semi")


def numbered(rows: DataFrame, number: str, kept: DataFrame) -> DataFrame:
    """``rows`` whose ``number`` is in ``kept``.  Numbers of monotonically_increasing_id() are dense in a partition, so
    a bit for each is small beside the rows; it is broadcast unless it is long."""
    table, has = _bits(kept, number, None, "kept")
    return rows.join(F.broadcast(table) if table.count() <= 2 * MAP_WORDS else table, has, "left_semi")


#: Lowest bits of a 64-bit number that are counted: the first tell its bucket, the last 32 its place there.
COUNTED = (1 << 42) - 1
#: Numbers that a task holds before it deals them to the buckets.
HELD = 1 << 18


def frequent(rows: DataFrame, numbers: Callable[[pa.RecordBatch], list], most: int) -> DataFrame:
    """(key): the counted bits of the numbers that come more than ``most`` times, and of few others.

    ``numbers`` gives a batch's numbers as uint64 arrays.  They go to their bucket as sorted blocks of 32-bit numbers, each
    ``most`` + 1 times at most, so a very common one is no burden, and a task counts a bucket at a time."""
    import numpy as np

    blocks, keys = "bucket int, numbers binary", "key long"
    as_blocks, as_keys = arrow_schema(blocks), arrow_schema(keys)
    module = numbers.__module__

    def deal(batches):
        def block():
            d = np.sort(np.concatenate(held) & np.uint64(COUNTED))
            # what is there so often already tells nothing
            d = np.concatenate((d[:most + 1], d[most + 1:][d[most + 1:] != d[:-most - 1]]))
            bucket, begins = np.unique(d >> np.uint64(32), return_index=True)
            parts = np.split(d.astype(np.uint32), begins[1:])
            return pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array([x.tobytes() for x in parts], pa.binary())], schema=as_blocks)

        at_work(module)
        held, n = [], 0
        for batch in batches:
            for part in slices(batch):
                for found in numbers(part):
                    held.append(found)
                    n += len(found)
                    if n >= HELD:
                        yield block()
                        held, n = [], 0
        if n:
            yield block()

    def count(batches):
        def often():
            d = np.sort(np.concatenate(held))
            again = np.unique(d[most:][d[most:] == d[:max(0, len(d) - most)]])
            return pa.RecordBatch.from_arrays([pa.array(again.astype(np.int64) + (last << 32))], schema=as_keys)

        at_work(module)
        last, held = None, []
        for batch in batches:
            for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != last and held:
                    yield often()
                    held = []
                last = bucket
                held.append(np.frombuffer(block, np.uint32))
        if held:
            yield often()

    dealt = short_batches(rows).mapInArrow(deal, blocks).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(count, keys)


def counted(number: str) -> Column:
    """The key that :func:`frequent` gives a number."""
    return F.col(number).bitwiseAND(F.lit(COUNTED))


_memories: dict[str, Callable[[], None]] = {}
_at_work: str | None = None


def memory(forget: Callable[[], None]) -> Callable[[], None]:
    """Registers what drops all that the function's module remembers in a Python worker."""
    _memories[forget.__module__] = forget
    return forget


def at_work(module: str) -> None:
    """A Python worker outlives a stage, so the memories of the operators before would add up: what is remembered
    belongs to the operator at work, and all else is dropped when another one begins."""
    global _at_work
    if module != _at_work:
        for name, forget in _memories.items():
            if name != module:
                forget()
        pa.default_memory_pool().release_unused()
        # glibc keeps what is freed below its heap's top; other libraries have no such call
        getattr(ctypes.CDLL(None), "malloc_trim", int)(0)
        _at_work = module


#: Bytes of the rows that go to Python at a time, twice of which an executor holds for every task.
BATCH_BYTES = 4 << 20


def short_batches(df: DataFrame) -> DataFrame:
    """``df``, whose batches for Python hold ``BATCH_BYTES`` (or one row) unless the session has a limit of its own."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name, str(64 << 20)).rstrip("b") == str(64 << 20):
        conf.set(name, BATCH_BYTES)
    return df


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str | StructType) -> DataFrame:
    """``fn`` turns one Arrow batch into a dict of columns in the schema's order; batches stay in their partition."""
    target = arrow_schema(schema)
    module = fn.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work(module)
        for batch in batches:
            # long texts: a slice of a batch holds a bounded number of bytes, or one row
            for part in slices(batch):
                cols = fn(part)
                if cols is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) if not isinstance(v, pa.Array) else v.cast(f.type) for v, f in zip(cols.values(), target, strict=True)], schema=target)

    return short_batches(df).mapInArrow(run, schema)


def arrow_schema(schema: str | StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def slices(batch: pa.RecordBatch, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of about ``most_bytes`` each."""
    n = max(1, -(-batch.nbytes // most_bytes))
    step = max(1, -(-batch.num_rows // n))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def mixed(x, seed: int = 0):
    """A 64-bit finaliser on numpy uint64 arrays: a keyed bijection."""
    import numpy as np

    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
