"""Pieces that several training-data operators share: scratch tables, word tables, span arithmetic."""

from __future__ import annotations

import atexit
import ctypes
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.sources.scratch import shared_folder

_written: list[tuple[SparkSession, str]] = []

#: Lower-cases A-Z, keeps 0-9, a-z and every byte from 0x80, and makes the rest a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir."""
    return shared_folder(spark)


def release() -> None:
    """Give back memory that this worker no longer uses, as workers live on through later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet to the shared scratch folder and read it again: lineage ends here, executors may go."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/foliograph/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    kept = spark.read.schema(df.schema).parquet(path)
    kept._foliograph_path = path
    return kept


def discard(df: DataFrame | None) -> None:
    """Delete a table that keep() wrote and nothing reads any more."""
    path = getattr(df, "_foliograph_path", None)
    if path:
        _delete(df.sparkSession, path)
        _written[:] = [x for x in _written if x[1] != path]


def mark() -> int:
    """A place in the list of tables that keep() has written, for discard_since()."""
    return len(_written)


def discard_since(place: int, but: DataFrame) -> None:
    """Delete the tables written after the mark, except `but`, once nothing reads them any more."""
    own = getattr(but, "_foliograph_path", None)
    for spark, path in [x for x in _written[place:] if x[1] != own]:
        _delete(spark, path)
        _written.remove((spark, path))


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001 - the JVM may have ended already
            return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id and the text as bytes (null: empty); other columns go, whatever their names."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, out=out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class RollingHash:
    """Rabin-Karp over values modulo 2**64: the hash of every window of a width is one difference of prefix sums."""

    def __init__(self, base: int):
        self.base = base | 1
        self.back = pow(self.base, -1, 1 << 64)
        self.size = 0
        self.grow(1 << 16)

    def grow(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, 2 * self.size)
            self.up, self.down = powers(self.base, self.size), powers(self.back, self.size)

    def windows(self, values: np.ndarray, width: int) -> np.ndarray:
        n = len(values)
        if n < width:
            return np.empty(0, dtype=np.uint64)
        self.grow(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * self.up[:n], out=sums[1:])
        return mix((sums[width:] - sums[:-width]) * self.down[: n - width + 1])


def minima(h: np.ndarray, width: int) -> np.ndarray:
    """For every run of `width` values, the index of its smallest (the leftmost of equals)."""
    n = len(h)
    if n < width:
        return np.empty(0, dtype=np.int64)
    best, at, span = h, np.arange(n, dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        left, right = best[: len(best) - step], best[step:]
        take = right < left
        best, at = np.where(take, right, left), np.where(take, at[step:], at[: len(at) - step])
        span += step
    return at


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as maximal ones; touching intervals join."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.ones(len(s), dtype=bool)
    fresh[1:] = s[1:] > e[:-1]
    at = np.flatnonzero(fresh)
    return s[at], e[np.append(at[1:], len(s)) - 1]


class Sums:
    """Prefix sums of one document for hashes of any range of its values, modulo 2**64."""

    def __init__(self, roll: RollingHash, values: np.ndarray):
        n = len(values)
        roll.grow(n + 1)
        self.roll, self.n = roll, n
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * roll.up[:n], out=self.sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.roll.down[starts])

    def windows(self, width: int) -> np.ndarray:
        if self.n < width:
            return np.empty(0, dtype=np.uint64)
        return mix((self.sums[width:] - self.sums[:-width]) * self.roll.down[: self.n - width + 1])


#: Bases of two independent rolling hashes.
ROLLS = (RollingHash(0x9E3779B97F4A7C15), RollingHash(0xD6E8FEB86659FD93))
#: Sums modulo 2**64 have known collisions from about a thousand values on; longer strings are hashed otherwise.
LONG_WORD = 64


def segments(values: np.ndarray, width: int, anchor: int, raw):
    """Cut the windows of a document into runs that share an anchor.

    A window's anchor is that of its runs of `anchor` values with the smallest hash, so equal windows, wherever they
    stand, have equal anchors at the same distance. Returns for each run: the anchor's hash, the number of the first
    window, the number of windows, the anchor's distance from there, and the XXH3 of all values that its windows hold;
    raw is the buffer of those values.
    """
    runs = Sums(ROLLS[0], values).windows(anchor)
    at = minima(runs, width - anchor + 1)
    if not len(at):
        none = np.empty(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    s = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    n = np.diff(np.append(s, len(at)))
    raw = memoryview(raw).cast("B")
    size, digest = len(raw) // len(values), xxhash.xxh3_64_intdigest
    content = [digest(raw[a:b]) for a, b in zip((s * size).tolist(), ((s + n - 1 + width) * size).tolist())]
    return runs[at[s]], s, n, at[s] - s, np.array(content, dtype=np.uint64)


def hash_words(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (runs of bytes other than 0x09-0x0D and 0x20), and the words' first and past-last bytes."""
    raw = np.frombuffer(body, dtype=np.uint8)
    blank = np.concatenate([[True], (raw == 32) | ((raw >= 9) & (raw <= 13)), [True]])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edge[::2], edge[1::2]
    # lengths join the hash, as a zero byte adds nothing to a sum
    h = Sums(ROLLS[0], raw.astype(np.uint64)).ranges(starts, ends) + (ends - starts).astype(np.uint64)
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        h[k] = xxhash.xxh3_64_intdigest(body[starts[k] : ends[k]])
    return h, starts, ends


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, body, and body_key, which with doc_id stands for the row (rows equal in both fare alike)."""
    return id_and_text(docs).withColumn("body_key", F.xxhash64("body"))


def same_row(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["body_key"] == b["body_key"])


def record_batch(batch, ids: list[np.ndarray], columns: dict[str, list[np.ndarray]]):
    """Rows made from a batch: ids has the batch's row number for each, columns their values."""
    at = pa.array(np.concatenate(ids) if ids else np.empty(0, dtype=np.int64))
    made = {c: batch[c].take(at) for c in ("doc_id", "body_key")}
    for name, parts in columns.items():
        x = np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
        made[name] = pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))
    return pa.RecordBatch.from_pydict(made)
