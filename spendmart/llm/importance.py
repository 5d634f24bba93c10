"""Importance resampling towards a target: hashed n-gram features, log-ratio weights, Gumbel draws.

1. Each text is lower-cased (A-Z), its separators become single spaces, and it is scanned once for
   the CRC-32 of every prefix that ends with a word. A prefix's CRC, shifted by as many bytes as
   follow, cancels out of the CRC of a longer prefix (both are polynomials over GF(2)), so any
   n-gram's CRC comes from the prefixes at its two ends. Its remainder is the n-gram's bucket. The
   buckets are stored; later steps read them and not the texts.
2. Buckets are counted over all documents and over the target, each task's counts first. A bucket's
   gain is the logarithm of its smoothed shares' ratio, in thousandths, rounded down.
3. A document's score is the sum of its features' gains and a Gumbel variate made of its id; the
   documents with the highest scores are a draw without replacement. They are sorted by ranges, and
   ranks are positions plus the rows of the ranges before.

Defined results: null, empty and wordless texts have no features and weight 0; a null id hashes as
empty text and comes last among ties; rows that are equal in all results are ranked one after the
other in any order, so repeated rows are drawn like different ones; an empty table gives an empty
result, an empty target makes every gain that of unseen features; very long texts are cut nowhere;
columns other than id and text are not read, so their names clash with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmart.llm.common import binaries, chunks, compactly_staged, lean
from spendmart.operators.numbering import number_in_order
from spendmart.staging import staged

#: What each byte becomes: A-Z small, a-z, digits and bytes of other scripts themselves, else a space.
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: Bytes of text whose words are held at a time.
PIECE = 1 << 20
_PROFILE = "id {}, n_words bigint, n_features bigint, buckets binary"


@lru_cache
def _zero_bytes() -> np.ndarray:
    """At [p, j, v]: what byte ``j`` of a CRC, if it is ``v``, adds to the CRC 2^p zero bytes later."""
    step = np.array([crc32(bytes([v])) ^ crc32(b"\0") for v in range(256)], np.uint32)
    one = np.array([[(v << 8 * j) >> 8 for v in range(256)] for j in range(4)], np.uint32)
    one[0] ^= step
    tables = [one]
    for _ in range(31):
        tables.append(_moved(tables[-1], tables[-1]))
    return np.stack(tables)


def _moved(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (
        table[0][crc & np.uint32(255)]
        ^ table[1][crc >> np.uint32(8) & np.uint32(255)]
        ^ table[2][crc >> np.uint32(16) & np.uint32(255)]
        ^ table[3][crc >> np.uint32(24)]
    )


def shifted(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """Each CRC moved on by as many zero bytes: what a prefix adds to the CRC of a longer text."""
    out = crc.copy()
    for p, table in enumerate(_zero_bytes()):
        rows = np.flatnonzero(n_bytes >> p & 1)
        if len(rows):
            out[rows] = _moved(table, out[rows])
        if not (n_bytes >> p + 1).any():
            break
    return out


class Prefixes:
    """The running CRCs of several texts' words, taken as one stream of words.

    ``bounds[i]:bounds[i + 1]`` are the words of text ``i``.
    """

    def __init__(self, split: list[list[bytes]]):
        words = [w for part in split for w in part]
        self.bounds = np.cumsum([0, *map(len, split)])
        running = accumulate(words, lambda crc, w: crc32(w, crc32(b" ", crc)), initial=0)
        ends = np.fromiter(running, np.uint32, len(words) + 1)
        self.after = ends[1:]  # of the stream up to the end of each word
        blank = ~ends[:-1]  # and up to its start, past the space
        self.before = ~(_zero_bytes()[0, 0][(blank ^ np.uint32(0x20)) & np.uint32(255)] ^ blank >> np.uint32(8))
        self.stop = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)

    def crcs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The CRC of each run of ``n`` words of one text, and the bounds of each text's runs."""
        sizes = np.maximum(np.diff(self.bounds) - n + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        first = np.arange(bounds[-1]) + np.repeat(self.bounds[:-1] - bounds[:-1], sizes)
        last = first + n - 1
        begin = np.concatenate([[0], self.stop[:-1]])[first] + 1
        return self.after[last] ^ shifted(self.before[first], self.stop[last] - begin), bounds


def _pieces(normal: bytes) -> Iterator[bytes]:
    """``normal`` cut at spaces into pieces of about ``PIECE`` bytes."""
    at = 0
    while len(normal) - at > PIECE:
        cut = normal.find(b" ", at + PIECE)
        if cut < 0:
            break
        yield normal[at:cut]
        at = cut
    yield normal[at:]


class Features:
    """Turns texts into their features' buckets."""

    def __init__(self, lengths: range, buckets: int):
        self.lengths, self.buckets = lengths, np.uint32(buckets)
        self.kind = bucket_type(buckets)

    def _runs(self, split: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray]]:
        prefixes = Prefixes(split)
        runs = (prefixes.crcs(n) for n in self.lengths)
        return [((crcs % self.buckets).astype(self.kind), bounds) for crcs, bounds in runs]

    def of(self, texts: list[bytes]) -> list[tuple[int, bytes]]:
        """The number of words and the buckets (any order) of each text."""
        split = [t.translate(_NORMAL).split() for t in texts]
        runs = self._runs(split)
        joined = (b"".join(f[b[i] : b[i + 1]].tobytes() for f, b in runs) for i in range(len(texts)))
        return list(zip(map(len, split), joined))

    def of_long(self, text: bytes) -> tuple[int, bytes]:
        """The same for one text, some words at a time; runs reach back into the words before."""
        n_words, found, held = 0, [], []
        for piece in _pieces(text.translate(_NORMAL)):
            words = piece.split()
            n_words += len(words)
            seen = [max(len(held) - n + 1, 0) for n in self.lengths]
            found += [f[skip:].tobytes() for skip, (f, _) in zip(seen, self._runs([held + words]))]
            back = max(self.lengths) - 1
            held = (held + words)[-back:] if back else []
        return n_words, b"".join(found)


def bucket_type(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def _profile(features: Features):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks(batch.column(1).to_pylist(), PIECE):
                found = [features.of_long(part[0])] if len(part[0]) > PIECE else features.of(part)
                n_words, buckets = zip(*found)
                width = np.dtype(features.kind).itemsize
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(part)),
                        pa.array(n_words, pa.int64()),
                        pa.array([len(b) // width for b in buckets], pa.int64()),
                        binaries(list(buckets)),
                    ],
                    names=["id", "n_words", "n_features", "buckets"],
                )

    return profile


def profiles(texts: DataFrame, lengths: range, buckets: int) -> DataFrame:
    """id, n_words, n_features and the feature buckets of each row of ``texts`` (id, text), written."""
    read = texts.select("id", F.col("text").cast("string").cast("binary").alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    return compactly_staged(read.mapInArrow(lean(_profile(Features(lengths, buckets))), _PROFILE.format(id_type)), "features")


def bucket_counts(profile: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs; every task counts before anything moves."""
    kind = bucket_type(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for row in batch.column(0):
                total += np.bincount(np.frombuffer(row.as_buffer(), kind), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], names=["bucket", "n"])

    counted = profile.select("buckets").mapInArrow(lean(count), "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():  # a row a bucket at most
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each bucket, in doubles."""
    buckets, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def weighted(profile: DataFrame, gain: np.ndarray) -> DataFrame:
    """id, n_words, n_features and weight: the sum of the gains of a row's features."""
    kind = bucket_type(len(gain))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = [int(gain[np.frombuffer(row.as_buffer(), kind)].sum()) for row in batch.column(3)]
            columns = [*batch.columns[:3], pa.array(weight, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_features", "weight"])

    id_type = profile.schema["id"].dataType.simpleString()
    return profile.mapInArrow(lean(weigh), f"id {id_type}, n_words bigint, n_features bigint, weight bigint")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    lengths: range = range(1, 2),
    buckets: int = 10_000,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """One row per row of ``docs``: id, n_features, weight, score, and rank for those drawn.

    ``percent`` of the documents of ``min_words`` words or more are drawn. Features are all runs
    of as many words as ``lengths`` holds.
    """
    profile = profiles(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), lengths, buckets)
    wanted = profiles(target.select(F.lit(0).alias("id"), F.col(target_text_col).alias("text")), lengths, buckets)
    gain = gains(bucket_counts(profile, buckets), bucket_counts(wanted, buckets))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")
    scored = weighted(profile, gain).select("id", "n_words", "n_features", "weight", (F.col("weight") + gumbel).alias("score"))
    scored = staged(scored, "scores")
    able = F.col("n_words") >= min_words
    drawn = percent * scored.where(able).count() // 100
    by_score = F.struct((-F.col("score")).alias("s"), F.col("id").isNull().alias("n"), F.col("id").alias("i"))
    ranked = number_in_order(scored.where(able).withColumn("_order", by_score), "_order", "rank")
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    first = ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).cast("bigint").alias("rank"))
    return first.unionAll(scored.where(~able).select(*columns, F.lit(None).cast("bigint").alias("rank")))
