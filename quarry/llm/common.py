"""Helpers shared by the corpus operators: scratch tables, byte-level word hashing, components.

Texts are handled as UTF-8 bytes inside Arrow batches.  A batch is cut into slices of bounded
bytes (one row at least), so a task's memory follows the longest text and not the batch.
"""

from __future__ import annotations

import ctypes
import gc
import pickle
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

SLICE_BYTES = 1 << 19
BATCH_BYTES = 8 << 20

# ---------------------------------------------------------------- scratch tables


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage; the files outlive any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the scratch table behind a DataFrame made by :func:`materialize`."""
    path = getattr(df, "scratch_path", None)
    if path:
        spark = df.sparkSession
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


BROADCAST_IDS = 1_000_000  # 8 MB of ids


def by_id(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """``rows`` whose doc_id is in ``ids(doc_id)`` (``left_semi``) or not (``left_anti``).

    Up to ``BROADCAST_IDS`` ids are broadcast, so that texts stay where they are; more are joined by
    a shuffle.  A null doc_id is in no list.
    """
    ids = materialize(ids.select("doc_id").filter("doc_id IS NOT NULL").distinct(), "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return rows.join(ids, "doc_id", how).select(*rows.columns)


# ---------------------------------------------------------------- models


def share(spark: SparkSession, model):
    """Broadcast an object of this package by value; read it in a task with :func:`shared`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def shared(variable):
    return pickle.loads(variable.value)


# ---------------------------------------------------------------- batches


def bound_batches(spark: SparkSession) -> None:
    """Let Spark hand at most about 8 MB to Python at once (one row at least), for this session.

    Both sides of the exchange hold whole batches, so this bounds an executor's memory outside its heap.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES):
    """Cut a batch into row slices whose ``column`` holds about ``max_bytes``; one row at least."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start, done = 0, 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, done + max_bytes, side="right"))
        stop = max(stop, start + 1)
        yield batch.slice(start, stop - start)
        start, done = stop, int(ends[stop - 1])


def tidy() -> None:
    """Give back the memory of a finished task to the system; Python workers live on after their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


#: Signs that are no letter, digit or mark; ASCII ones are left to the separators of :class:`WordHasher`.
_NO_WORD = r"[^\p{L}\p{N}\p{M}\x00-\x7F]"
#: Scripts written without blanks; every sign is a word.
_UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"


def spaced(text: Column) -> Column:
    """The text with a blank for each non-ASCII sign that belongs to no word, and around unspaced signs."""
    clean = F.regexp_replace(F.regexp_replace(text, _NO_WORD, " "), _UNSPACED, " $1 ")
    return F.when(text.rlike(r"[^\x00-\x7F]"), clean).otherwise(text)


def byte_list(column: pa.Array) -> list[bytes]:
    """The strings of a column as UTF-8 bytes; null gives empty bytes."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


# ---------------------------------------------------------------- hashing


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection on 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHasher:
    """Polynomial 64-bit hashes of all words of a list of byte strings, without a Python loop.

    ``separators`` is a 256-entry mask of bytes that end a word.  A prefix sum of
    ``table[byte] * base**i`` gives every word's hash as one difference times ``base**-start``.
    """

    def __init__(self, separators: np.ndarray, seed: int = 7):
        self.separators = separators
        self.table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        self.base = 0x5851F42D4C957F2D
        self.powers = self.inverse = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 1 << 16)
            for name, base in (("powers", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def words(self, texts: list[bytes]):
        """(buffer, start, end, hash, text index) of every word; texts are joined by a line feed."""
        joined = b"\n".join(texts) + b"\n"
        buf = np.frombuffer(joined, np.uint8)
        n = len(buf)
        self._grow(n)
        inside = ~self.separators[buf]
        inside[-1] = False
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate((np.zeros(1, edge.dtype), edge))
        start, end = edge[0::2], edge[1::2]
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[buf] * self.powers[:n], out=total[1:])
        h = (total[end] - total[start]) * self.inverse[start]
        h = mix(h + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        bounds = np.cumsum([len(t) + 1 for t in texts])
        return buf, start, end, h, np.searchsorted(bounds, start, side="right")


def windows(h: np.ndarray, text: np.ndarray, n_texts: int, size: int):
    """Hashes of all runs of ``size`` words inside one text: (hash, text index).

    A text of 1 to ``size - 1`` words gives one hash of its whole word sequence.
    """
    a = np.uint64(0x9E3779B97F4A7C15)
    count = np.bincount(text, minlength=n_texts)
    parts, owner = [], []
    if len(h) >= size:
        m = len(h) - size + 1
        x = np.zeros(m, np.uint64)
        for j in range(size):
            x = x * a + h[j:j + m]
        same = text[:m] == text[size - 1:]
        parts.append(mix(x[same]))
        owner.append(text[:m][same])
    first = np.cumsum(count) - count
    for i in np.flatnonzero((count > 0) & (count < size)):
        x = np.uint64(count[i])
        with np.errstate(over="ignore"):
            for v in h[first[i]:first[i] + count[i]]:
                x = x * a + v
        parts.append(mix(np.array([x ^ np.uint64(0xA5A5A5A5A5A5A5A5)])))
        owner.append(np.array([i]))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    x, t = np.concatenate(parts), np.concatenate(owner)
    if len(parts) > 1:
        order = np.argsort(t, kind="stable")
        x, t = x[order], t[order]
    return x, t


def separator_mask(chars: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(chars)] = True
    return mask


#: The blanks of the class [^\x20\x09-\x0D] of a word.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


# ---------------------------------------------------------------- components


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) of every vertex of ``edges(u, v)``: component is the smallest id reachable.

    Alternates large-star and small-star rewiring until the edge set is a forest of stars.  A hot
    vertex costs a partial aggregate and a join whose skewed side Spark can split; no neighbour
    list is ever collected.  Raises if ``max_rounds`` (logarithmic in practice) does not suffice.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        out = both.join(low, "u")
        if large:
            return out.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = out.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return kept.unionAll(low.select("u", F.col("m").alias("v"))).filter("u <> v")

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    cur = materialize(edges, "edges")
    seen = mark(cur)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        nxt = materialize(star(star(cur, True).distinct(), False).distinct(), "edges")
        now = mark(nxt)
        discard(cur)
        cur = nxt
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
