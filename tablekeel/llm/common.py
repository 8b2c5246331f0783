"""What the operators share: picking columns, cutting lineage, checked broadcasts, hashing of words."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A run of anything but the six ASCII white space characters, in Java's and Python's syntax.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of at most a few dozen bytes each that a broadcast may hold.
MOST_BROADCAST_ROWS = 500_000


def position(df: DataFrame, name: str) -> int:
    """Where the column stands: an exact match, otherwise a single match that ignores case."""
    places = [i for i, c in enumerate(df.columns) if c == name]
    places = places or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if len(places) != 1:
        raise ValueError(f"column {name!r} is found {len(places)} times in {df.columns}")
    return places[0]


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """The wanted columns under new names, whatever other columns there are."""
    found = {new: position(df, name) for new, name in wanted.items()}
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"_{i}").alias(new) for new, i in found.items()])


def unused(df: DataFrame, stem: str) -> str:
    """A column name that the DataFrame does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; only a session without one gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tablekeel-llm-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The DataFrame as files in the shared folder, so that later steps survive the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, for sessions whose executors do not have it installed."""
    context = spark.sparkContext
    package = Path(__file__).resolve().parents[1]
    name = f"{package.name}-{hash(context.applicationId) & 0xFFFFFF:06x}.zip"
    if any(f.endswith(name) for f in context.listFiles):
        return
    folder = tempfile.mkdtemp(prefix="tablekeel-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/{name}", "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(f"{folder}/{name}")


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Marked for broadcast if it is counted to be small; as it is otherwise. Its rows must be narrow."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= MOST_BROADCAST_ROWS else df


def training_row(doc_id: Column) -> Column:
    """Whether labels may be learned from a row: crc32 of the id as text, mod 5, is not 0. A null id: yes."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(True))


# ---------------------------------------------------------------- hashing over whole batches of texts

#: Bytes of texts whose words are hashed at once. The hashes do not depend on it, the memory of a task does.
_STEP = 1 << 17


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (shifts and odd multiplications)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = 0x5851F42D4C957F2D


def _powers(base: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * _STEP, base, dtype=np.uint64))])


class WordHasher:
    """64-bit hashes of the words of texts, over bytes, with ASCII letters lower-cased.

    A word's hash is a polynomial over its bytes, taken from running sums, so that a
    batch of texts takes a few passes over its bytes whatever the lengths of words.
    """

    def __init__(self) -> None:
        self.up = _powers(_ODD)
        self.down = _powers(pow(_ODD, -1, 1 << 64))
        self.table = _BYTES.copy()
        self.table[65:91] = self.table[97:123]
        self.space = np.zeros(256, dtype=bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and for each text the number of words before it, for texts that lie one after another."""
        starts, ends = self.words(data, offsets)
        return self.hashes(data, starts, ends), np.searchsorted(starts, offsets)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words start and end; the end of a text ends a word."""
        gap = self.space[data]
        start = ~gap
        end = ~gap
        start[1:] &= gap[:-1]
        end[:-1] &= gap[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        start[edges] |= ~gap[edges]
        end[edges - 1] |= ~gap[edges - 1]
        return np.flatnonzero(start), np.flatnonzero(end) + 1

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), dtype=np.uint64)
        at = 0
        while at < len(starts):  # windows of words within a bounded number of bytes
            first = starts[at]
            to = max(at + 1, int(np.searchsorted(ends, first + _STEP, side="right")))
            if ends[to - 1] - first <= 2 * _STEP:
                out[at:to] = self._hash(data[first : ends[to - 1]], starts[at:to] - first, ends[at:to] - first)
            else:  # one word longer than two windows
                out[at] = self._long(data[first : ends[at]])
                to = at + 1
            at = to
        return mixed(out)

    def _hash(self, part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(self.table[part] * self.up[: len(part)], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64)

    def _long(self, word: np.ndarray) -> np.uint64:
        value, length = 0, len(word)
        for i in range(0, length, _STEP):
            part = word[i : i + _STEP]
            piece = int(np.sum(self.table[part] * self.up[: len(part)]))
            value = (value + piece * pow(_ODD, i, 1 << 64)) % (1 << 64)
        return np.uint64((value + length) % (1 << 64))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string array, and the offset of each text and of the end; a null text is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64, count=texts.offset + len(texts) + 1)[texts.offset :]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose texts hold about so many bytes; a longer text is a slice of its own."""
    if not len(batch):
        return
    offsets = text_bytes(batch.column(column))[1]
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
