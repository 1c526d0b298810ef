"""What the training-data operators share: batches, saved tables, joins, word hashes."""

from __future__ import annotations

import contextlib
import gc
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes of one Arrow batch; a single longer text still travels whole.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20
#: Words whose hashes a task remembers before it starts afresh.
WORD_MEMORY = 400_000


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session, so that long texts fit in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which all executors share.

    Only a local master without that setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="stagewise-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/stagewise-{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def _tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let Spark drop the shuffle files of each write as soon as it has ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage for good."""
    spark = df.sparkSession
    folder = shared_folder(spark, label)
    with _tidy_shuffles(spark):
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join both of whose sides are shuffled for it, so that adaptive execution can
    split a hot key of ``left``. ``right`` should be unique per key. Null keys don't match."""
    mix = "_split"
    return left.withColumn(mix, F.xxhash64(*keys)).join(
        right.withColumn(mix, F.xxhash64(*keys)), [*keys, mix], how).drop(mix)


def identified(docs: DataFrame) -> DataFrame:
    """``did, th, text`` (binary) of each document: the id (null as the least long) and a
    hash of the text. Two rows equal in both have equal texts, so results may be keyed by them."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("did"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def doc_id_of(did) -> F.Column:
    """The document's id from ``identified``'s ``did``."""
    return F.when(F.col(did) != F.lit(-(2**63)), F.col(did))


def with_fields(df: DataFrame, ddl: str) -> StructType:
    """The columns of ``df`` and then those of ``ddl``."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]],
                schema: str | StructType, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` with one state per task: ``make()`` gives the function for its batches.
    A worker lets go of what earlier tasks left in it, unless ``make`` uses that (``keeps``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            let_go()
        work = make()
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)
    return df.mapInArrow(run, schema)


def kept_in_process(key: object, make: Callable[[], object]) -> object:
    """The value of ``make()``, made once per Python worker and reused by its later tasks, until
    another key is asked for or a task of another kind begins there."""
    state = sys.modules.setdefault("_stagewise_llm_state", types.ModuleType("_stagewise_llm_state")).__dict__.setdefault("kept", {})
    if key not in state:
        state.clear()
        state[key] = make()
    return state[key]


def let_go() -> None:
    """Free what ``kept_in_process`` holds, so that a worker of one stage leaves its memory to the next."""
    module = sys.modules.get("_stagewise_llm_state")
    if module is not None and module.__dict__.pop("kept", None):
        gc.collect()
        pa.default_memory_pool().release_unused()


def sorted_tiles(df: DataFrame, keys: list[str], one: Callable[[pa.Table], tuple], schema: str) -> DataFrame:
    """Apply ``one`` to the rows of each key (two or more), of bounded number, and gather its
    columns. Tasks hold one tile at a time, without a call to Spark for each."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        let_go()
        held = None
        for batch in _then_none(batches):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            if held is None or not held.num_rows:
                continue
            columns = [held.column(c).to_numpy() for c in keys]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            bounds = [0, *change.tolist(), held.num_rows]
            done = bounds[:-1] if batch is not None else bounds
            found = [one(held.slice(a, b - a)) for a, b in zip(done, done[1:]) if b - a > 1]
            found = [f for f in found if len(f[0])]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=names)
            held = held.slice(done[-1])
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _then_none(items: Iterable) -> Iterator:
    yield from items
    yield None


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of word windows from prefix sums, modulo 2**64 with an odd base."""

    def __init__(self, base: int = 0x9E3779B97F4A7C15) -> None:
        self.base, self.back = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n + 1:
            size = 1 << int(n + 1).bit_length()
            self.up = np.concatenate([np.ones(1, np.uint64), np.full(size, self.base, np.uint64)]).cumprod(dtype=np.uint64)
            self.down = np.concatenate([np.ones(1, np.uint64), np.full(size, self.back, np.uint64)]).cumprod(dtype=np.uint64)

    def prefix(self, hashes: np.ndarray) -> np.ndarray:
        """P with P[i] = sum of hashes[j] * base**j over j < i."""
        self._grow(len(hashes))
        out = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * self.up[:len(hashes)], dtype=np.uint64, out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Scrambled hash of the words start..end (exclusive), wherever they stand."""
        return mixed((prefix[end] - prefix[start]) * self.down[start] + (end - start).astype(np.uint64))


def signed(x: np.ndarray) -> pa.Array:
    """64-bit hashes as a long column."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


#: Bytes that part words, and a random 64-bit value for each byte.
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Bytes hashed at a time (a longer text is hashed by itself), and of a word hashed alone.
BLOCK_BYTES, LONG_WORD = 1 << 20, 256


class Words:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of many texts at once."""

    def __init__(self, lower: bool = False) -> None:
        self.lower, self.rolling = lower, Rolling(0xD1342543DE82EF95)

    def blocks(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(first, bounds, hashes)`` of runs of texts: text first + i has the word hashes
        ``hashes[bounds[i]:bounds[i + 1]]``. ``texts`` is binary without nulls."""
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + BLOCK_BYTES, "right")) - 1)
            yield (first, *self._hashed(data[ends[first]:ends[last]], ends[first:last + 1] - ends[first]))
            first = last

    def _hashed(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.lower:
            data = _LOWER[data]
        word = np.zeros(len(data) + 2, bool)
        np.logical_not(_BLANK[data], out=word[1:-1])
        # Words begin after blanks and at the beginnings of texts, and end likewise.
        begin = word[1:-1] & ~word[:-2]
        end = word[1:-1] & ~word[2:]
        inner = edges[(edges > 0) & (edges < len(data))]
        begin[inner] = word[inner + 1]
        end[inner - 1] = word[inner]
        begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        hashes = self.rolling.spans(self.rolling.prefix(_BYTE[data]), begin, end)
        for i in np.flatnonzero(end - begin > LONG_WORD):
            hashes[i] = xxhash.xxh3_64_intdigest(data[begin[i]:end[i]].tobytes())
        return np.searchsorted(begin, edges), hashes
