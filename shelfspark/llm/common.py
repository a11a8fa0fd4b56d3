"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from shelfspark.session import materialize

# Characters that separate words everywhere in this package: space and U+0009-U+000D. They are
# exactly what ``bytes.split()`` splits on, and ``bytes.lower()`` lower-cases A-Z only.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_ROWS = 2_000
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers = {"n": 0, "up": None, "down": None}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (once per application), as ``--py-files`` would, and
    bound the Arrow batches: at kilobytes a text, the default of 10,000 rows is tens of megabytes
    in several copies per task."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "shelfspark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a stage to the shared checkpoint folder and read it back (see session.materialize)."""
    return materialize(df, f"llm-{name}")


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer of 64-bit values (splitmix64), vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int):
    """Powers of the hash base and of its inverse modulo 2^64, for positions below n."""
    if n > _powers["n"]:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            t = np.full(size, base, dtype=np.uint64)
            t[0] = 1
            _powers[key] = np.multiply.accumulate(t)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte offsets of the words of a UTF-8 byte array."""
    space = np.empty(len(data) + 2, dtype=bool)
    space[0] = space[-1] = True
    space[1:-1] = _IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[0::2], edge[1::2]


def word_hashes(text: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of every word of a UTF-8 text, with the words' byte starts and ends.

    A word's hash is a polynomial in its bytes modulo 2^64, taken as a difference of prefix
    sums and shifted back to the word's start, so a whole text costs a few vector passes.
    """
    data = np.frombuffer(text, dtype=np.uint8)
    start, end = word_bounds(data)
    if not len(start):
        return np.empty(0, dtype=np.uint64), start, end
    if lower:
        data = _LOWER[data]
    up, down = _power_tables(len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=prefix[1:])
    h = (prefix[end] - prefix[start]) * down[start]
    return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), start, end


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; fewer words make one shingle, none make none."""
    n = len(words)
    if n == 0:
        return words
    if n < width:
        width = n
    h = np.zeros(n - width + 1, dtype=np.uint64)
    for i in range(width):
        h = mix64(h * np.uint64(0x9FB21C651E98DF25) + words[i:n - width + 1 + i] + np.uint64(i + 1))
    return h + np.uint64(width)


def to_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
