"""Helpers of the training-data operators: tables, stored intermediate results, text as bytes."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters that are neither a space nor \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
#: Text handled at once by the numpy kernels; one longer document is handled alone.
SLICE_BYTES = 1 << 18

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_local_folder: list[str] = []
#: Called in a Python worker when texts of another operator come: each drops what its operator's tasks remember there.
FORGET: list[Callable[[], None]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from `spark.checkpoint.dir`; a temporary one for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local_folder:
        _local_folder.append("file://" + tempfile.mkdtemp(prefix="footfall-"))
    return _local_folder[0]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` as Parquet to the shared folder and reads it back: cuts the lineage and outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/footfall-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once; lambdas would else compute it again for every element."""
    return F.transform(F.array(value), body)[0]


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """For runs of rows of about SLICE_BYTES: the rows, their UTF-8 bytes, and where each text starts in these (with the end).

    Null is empty. What the slices took is given back to the system when the batch is done: Python workers are reused,
    and what they keep is missing to the tasks and stages that follow. So is what an operator remembers from task to task.
    """
    for forget in FORGET:
        forget()
    texts = batch.column(column).fill_null("").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1)
        yield slice(first, last), data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last
    del texts, ends, data
    give_back()


def give_back() -> None:
    """Returns freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit changes about half of the output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BYTE_CODE = mixed(np.arange(1, 257, dtype=np.uint64))
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
IS_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
BASE, UNBASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, UNBASE)):
            steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the index of its text; words never cross texts."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~IS_BLANK[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = starts[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[edges - 1] = inside[edges - 1]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[LOWERED[data] if lower else data] * power[:-1], out=sums[1:])
    hashes = mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
    return hashes, np.searchsorted(starts, first, "right") - 1


#: Tables of counts are split into this many blocks; a merging task holds at most MERGED_PARTS parts of one block.
COUNT_BLOCKS, MERGED_PARTS = 64, 64
COUNTS = "kind string, block int, part long, data binary"


def sparse_counts(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted cells with their counts, as bytes."""
    return np.concatenate([cells.astype(np.uint32), counts.astype(np.uint32)]).tobytes()


def read_sparse(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(data, np.uint32)
    return both[: len(both) // 2], both[len(both) // 2 :]


def counted(cells: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal cells added up, sorted."""
    order = np.argsort(cells, kind="stable")
    cells, counts = cells[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])[: len(cells)])
    return cells[first], np.add.reduceat(counts, first) if len(first) else counts


def count_rows(kind: str, part: int, cells: np.ndarray, counts: np.ndarray, block_cells: int) -> Iterator[tuple]:
    """COUNTS rows of sorted cells; kind few."""
    edges = np.searchsorted(cells, np.arange(COUNT_BLOCKS + 1, dtype=np.int64) * block_cells)
    for b in range(COUNT_BLOCKS):
        if edges[b] < edges[b + 1]:
            at = slice(edges[b], edges[b + 1])
            yield kind, b, part, sparse_counts(cells[at] - b * block_cells, counts[at])


def byte_counts(kind: str, part: int, counts: np.ndarray) -> Iterator[tuple]:
    """COUNTS rows of a table of counts up to 255; kind low."""
    for b, block in enumerate(counts.astype(np.uint8).reshape(COUNT_BLOCKS, -1)):
        if block.any():
            yield kind, b, part, block.tobytes()


def read_bytes(data: bytes) -> np.ndarray:
    """The counts of a part of kind low: a byte each, or two behind an odd first byte in sums of parts."""
    return np.frombuffer(data, np.uint16, offset=1) if len(data) % 2 else np.frombuffer(data, np.uint8)


def count_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["kind", "block", "part", "data"])


def _merged(kind: str, parts: list[bytes]) -> bytes:
    if kind.startswith("any"):  # bits
        return np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in parts]).tobytes()
    if kind.startswith("low"):  # small counts, added up one part at a time
        total = np.zeros(len(read_bytes(parts[0])), np.uint32)
        for x in parts:
            total += read_bytes(x)
        return b"\0" + total.clip(max=2**16 - 1).astype(np.uint16).tobytes()
    pairs = [read_sparse(x) for x in parts]
    cells, counts = counted(np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]))
    return sparse_counts(cells, counts.clip(max=2**32 - 1))


def merged_counts(parts: DataFrame, partitions: int) -> DataFrame:
    """COUNTS rows of `partitions` tasks -> one row per kind and block; merged in levels of MERGED_PARTS parts.

    The kind's prefix says how: any (bits), low (dense counts), few (sparse counts).
    """
    import pandas as pd

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        kind = group.kind.iloc[0]
        return pd.DataFrame({"kind": [kind], "block": [group.block.iloc[0]], "part": [group.part.iloc[0]], "data": [_merged(kind, list(group.data))]})

    while True:
        partitions = -(-partitions // MERGED_PARTS)
        parts = parts.withColumn("part", F.floor(F.col("part") / MERGED_PARTS)).groupBy("kind", "block", "part").applyInPandas(merge, COUNTS)
        if partitions <= 1:
            return parts


def learns_from(key: Column, folds: int, held_out: int) -> Column:
    """Whether crc32 of the key as text leaves another remainder than the held-out one."""
    return ~F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == held_out, F.lit(False))
