"""Pieces that several operators share: reading tables, column names, word and name hashing."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from spendmart.staging import new_path

#: ASCII white space: what separates words throughout this package.
SPACES = b" \t\n\v\f\r"

_SPACE = re.compile(rb"[ \t-\r]")
#: Bytes whose words are named at once.
SLICE = 4 << 20
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
#: One random 64-bit value per byte, and an odd multiplier: the polynomial name of a word.
_BYTE = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores in front until no column has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 256), _STEP, np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS


class Words:
    """The words of several texts: their 64-bit names and where each text's words begin.

    Equal words have equal names on every machine. ``bounds[i]:bounds[i + 1]`` are the words of
    text ``i``; ``starts`` and ``ends`` are byte positions in ``data``.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.data = b"\n".join(texts) + b"\n"
        if lower:
            self.data = self.data.lower()  # bytes.lower() changes A-Z only
        parts = [self._slice(a, b) for a, b in self._slices()]
        self.starts, self.ends, self.names = (np.concatenate(x) if len(parts) > 1 else x[0] for x in zip(*parts))
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.bounds = np.searchsorted(self.starts, begins)

    def _slices(self) -> Iterator[tuple[int, int]]:
        """Bounds of some megabytes each, behind a space: the arrays below are many times as large."""
        at = 0
        while len(self.data) - at > SLICE:
            cut = _SPACE.search(self.data, at + SLICE).end()  # type: ignore[union-attr]  # the data end in a space
            yield at, cut
            at = cut
        if at < len(self.data):
            yield at, len(self.data)

    def _slice(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the words of a slice start and end, and their names."""
        raw = np.frombuffer(self.data, np.uint8)[a:b]
        space = _IS_SPACE[raw]
        edge = np.empty(len(raw), bool)
        edge[0] = not space[0]
        np.greater(space[:-1], space[1:], out=edge[1:])
        starts = np.flatnonzero(edge)
        ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        if not len(starts):
            return starts, ends, np.zeros(0, np.uint64)
        first = starts[0]
        gap = np.diff(np.append(starts, len(raw)))
        place = np.arange(first, len(raw)) - np.repeat(starts, gap)
        value = _BYTE[raw[first:]]
        value[space[first:]] = 0
        value *= _powers(int(gap.max()))[place]
        names = mixed(np.add.reduceat(value, starts - first) ^ (ends - starts).astype(np.uint64))
        return starts + a, ends + a, names


def joined_names(names: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """The name of each run of ``k`` neighbours in ``names``; their order counts."""
    n = len(names) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, seed, np.uint64)
    for j in range(k):
        total *= _STEP
        total += names[j : j + n]
    return mixed(total)


def chunks(texts: list[bytes | None], most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about ``most`` bytes together (a longer one alone), with their place."""
    held: list[bytes] = []
    size = first = 0
    for i, text in enumerate(texts):
        text = text or b""
        if held and size + len(text) > most:
            yield first, held
            held, size, first = [], 0, i
        held.append(text)
        size += len(text)
    if held:
        yield first, held


Batches = Iterator[pa.RecordBatch]


def hand_back() -> None:
    """Return memory that this worker has freed to the machine.

    Both allocators keep it for later use, and with it an executor's workers would count for the
    most that any of their tasks ever held.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, handing memory back when its task ends."""

    def task(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            hand_back()

    return task


def binaries(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def compactly_staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as zstandard Parquet in the shared folder and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
