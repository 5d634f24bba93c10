"""Token ids in files, by canonical length-limited Huffman coding.

Global counts of ids give code lengths of at most ``LONGEST`` bits (package-merge); codes follow from
lengths alone, so a file keeps lengths only. Documents in ascending id order are cut into blocks of
about ``BLOCK_IDS`` ids. A block is decoded without any other: its header has the bit offset of every
``CHECKPOINT``-th id, and table look-ups decode all stretches between checkpoints side by side.

A file set is a folder: ``codes`` (id, length) and ``blocks`` (part, block, doc_ids, doc_sizes,
offsets, bits), both Parquet, written and read by Spark, so any store will do.

Defined results: a null or empty text is its end id alone; a null document id comes first; rows that
repeat a document id follow one another; a very long document is a block of its own, however large;
columns other than id and text are not read; an empty table gives a file set without blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendmart.llm.tokens import MEMORY, tokenized
from spendmart.staging import new_path, staged

LONGEST = 18
BLOCK_IDS, CHECKPOINT = 1 << 16, 256
#: Blocks decoded side by side.
TOGETHER = 16


def code_lengths(counts: dict[int, int], longest: int = LONGEST) -> dict[int, int]:
    """Length-limited optimal prefix code lengths, by package-merge."""
    if not counts:
        return {}
    if len(counts) == 1:
        return dict.fromkeys(counts, 1)
    if len(counts) > 1 << longest:
        raise ValueError(f"{len(counts)} ids cannot have codes of {longest} bits")
    leaves = sorted((n, i) for i, n in counts.items())
    weights = [n for n, _ in leaves]
    # a package is its weight and how many of the lightest leaves of each level it holds
    level: list[tuple[int, int]] = [(w, 1) for w in weights]  # (weight, 1 for a leaf, 0 for a package)
    levels = [level]
    for _ in range(longest - 1):
        packages = [(level[i][0] + level[i + 1][0], 0) for i in range(0, len(level) - 1, 2)]
        level = list(heapq.merge([(w, 1) for w in weights], packages, key=lambda x: x[0]))
        levels.append(level)
    lengths = np.zeros(len(leaves), np.int64)
    take = 2 * len(leaves) - 2
    for level in reversed(levels):
        of = level[:take]
        n_leaves = sum(kind for _, kind in of)
        lengths[:n_leaves] += 1
        take = 2 * (len(of) - n_leaves)
    return {i: int(n) for (_, i), n in zip(leaves, lengths)}


class Code:
    """Canonical codes from lengths, and the table that decodes them."""

    def __init__(self, lengths: dict[int, int]):
        self.longest = max(lengths.values(), default=1)
        order = sorted(lengths, key=lambda i: (lengths[i], i))
        size = max(lengths, default=0) + 1
        self.codes, self.lengths = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        code = last = 0
        symbols, counts = [], []
        for i in order:
            code <<= lengths[i] - last
            last = lengths[i]
            self.codes[i], self.lengths[i] = code, last
            symbols.append(i)
            counts.append(1 << (self.longest - last))
            code += 1
        #: For the next ``longest`` bits, the id they begin with and, in the last five bits, its length.
        self.table = np.zeros(1 << self.longest, np.uint32)
        entries = np.array(symbols, np.uint32) << np.uint32(5) | self.lengths[symbols].astype(np.uint32) if symbols else self.table[:0]
        table = np.repeat(entries, counts)
        self.table[: len(table)] = table

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits, and the bit offset of every ``CHECKPOINT``-th id."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        begins = ends - sizes
        total = int(ends[-1]) if len(ends) else 0
        out = np.zeros(total // 64 + 2, np.uint64)
        word, bit = begins >> 6, (begins & 63).astype(np.uint64)
        shift = 64 - bit.astype(np.int64) - sizes
        codes = self.codes[ids]
        fits = shift >= 0
        here = np.where(fits, codes << np.maximum(shift, 0).astype(np.uint64), codes >> np.maximum(-shift, 0).astype(np.uint64))
        first = np.flatnonzero(np.diff(word, prepend=-1))
        if len(first):
            out[word[first]] += np.add.reduceat(here, first)
        over = np.flatnonzero(~fits)
        out[word[over] + 1] += codes[over] << (64 + shift[over]).astype(np.uint64)
        return out.astype(">u8").tobytes()[: (total + 7) // 8], begins[::CHECKPOINT]

    def decode(self, blocks: list[tuple[bytes, np.ndarray, int]]) -> list[np.ndarray]:
        """The ids of blocks (bits, offsets, number of ids); all stretches between checkpoints of
        all blocks advance together.
        """
        raw = np.frombuffer(b"".join(bits for bits, _, _ in blocks) + b"\0" * 8, np.uint8).astype(np.uint32)
        words = raw[:-3] << np.uint32(24)  # the 32 bits from each byte on
        for i in (1, 2, 3):
            words |= raw[i : len(raw) - 3 + i] << np.uint32(24 - 8 * i)
        bases = np.cumsum([0, *(8 * len(bits) for bits, _, _ in blocks)])
        at = np.concatenate([base + offsets.astype(np.int64) for base, (_, offsets, _) in zip(bases, blocks)])
        out = np.empty((CHECKPOINT, len(at)), np.uint32)
        top, mask, last = 32 - self.longest, np.uint32((1 << self.longest) - 1), len(words) - 1
        for step in range(CHECKPOINT):
            # a stretch that ended reads on into what follows; its surplus is cut off below
            value = words[np.minimum(at >> 3, last)] >> (top - (at & 7)).astype(np.uint32) & mask
            entry = self.table[value]
            np.right_shift(entry, np.uint32(5), out=out[step])
            at += entry & np.uint32(31)
        stretches = out.T
        found, first = [], 0
        for _, offsets, n in blocks:
            found.append(stretches[first : first + len(offsets)].ravel()[:n])
            first += len(offsets)
        return found


def _encoded(code: Code, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in ascending order: blocks of whole documents."""
        part, block = TaskContext.get().partitionId(), 0
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def close() -> pa.RecordBatch:
            bits, offsets = code.encode(np.concatenate([ids for _, ids in held]))
            row = {
                "part": [part], "block": [block], "n_ids": [size], "doc_ids": [[i for i, _ in held]],
                "doc_sizes": [[len(ids) for _, ids in held]], "offsets": [offsets.tobytes()], "bits": [bits],
            }
            return pa.RecordBatch.from_pydict(row, schema=_BLOCKS)

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.append((doc, np.frombuffer(ids.as_buffer(), kind)))
                size += len(held[-1][1])
                if size >= BLOCK_IDS:
                    yield close()
                    held, size, block = [], 0, block + 1
        if held:
            yield close()

    return run


_BLOCKS = pa.schema(
    [
        ("part", pa.int32()), ("block", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("doc_sizes", pa.list_(pa.int64())), ("offsets", pa.binary()), ("bits", pa.binary()),
    ]
)
_BLOCKS_SQL = "part int, block bigint, n_ids bigint, doc_ids array<bigint>, doc_sizes array<bigint>, offsets binary, bits binary"


def write_ids(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "word_bpe_49k.json", end_id: int = 2,
    ids_per_part: int = 1 << 25, word_memory: int = MEMORY,
) -> None:
    """Encode all texts into the file set at ``path``, in ascending ``id_col`` order.

    ``ids_per_part`` sets how many ids a file has, about.
    """
    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    tokens, kind = tokenized(chosen, ["doc_id"], "text", vocabulary, end_id, word_memory)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in batch.column(0)] or [np.zeros(0, kind)])
            found = np.bincount(ids, minlength=len(total))
            found[: len(total)] += total
            total = found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(total[seen])], names=["id", "n"])

    counts = tokens.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    # at most a row for each id of the vocabulary
    lengths = code_lengths({r["id"]: r["n"] for r in counts.collect()})
    spark = docs.sparkSession
    spark.createDataFrame(sorted(lengths.items()), "id bigint, length int").coalesce(1).write.parquet(f"{path}/codes")
    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(1, -(-total // ids_per_part), min(spark.sparkContext.defaultParallelism, -(-total // BLOCK_IDS)))
    tie = F.xxhash64("ids")
    ordered = tokens.select("doc_id", "ids", tie.alias("tie")).repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    blocks = ordered.select("doc_id", "ids").mapInArrow(_encoded(Code(lengths), kind), _BLOCKS_SQL)
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids (unsigned 32-bit, little-endian)."""
    lengths = {r["id"]: r["length"] for r in spark.read.parquet(f"{path}/codes").collect()}
    blocks = spark.read.schema(_BLOCKS_SQL).parquet(f"{path}/blocks")
    sizes = blocks.select("part", "block", "n_ids")
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_block = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(by_part), F.lit(0)).alias("before"))
    begins = (
        sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(by_block), F.lit(0)))
        .join(parts, "part")
        .select(F.col("part").alias("p"), F.col("block").alias("b"), (F.col("before") + F.col("inside")).alias("begin"))
    )
    begins = staged(begins, "block-starts")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths)
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(first, TOGETHER)
                begins, counts, docs, sizes, offsets, bits = (part.column(i) for i in range(6))
                blocks = [
                    (b, np.frombuffer(o, np.int64), n)
                    for b, o, n in zip(bits.to_pylist(), offsets.to_pylist(), counts.to_pylist())
                ]
                for row, ids in enumerate(code.decode(blocks)):
                    size = np.array(sizes[row].as_py(), np.int64)
                    ends = np.cumsum(size)
                    raw = ids.astype("<u4").tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [
                            docs[row].values,
                            pa.array(begins[row].as_py() + ends - size),
                            pa.array(size),
                            pa.array([raw[4 * (e - s) : 4 * e] for s, e in zip(size, ends)], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    placed = blocks.join(begins, (F.col("part") == F.col("p")) & (F.col("block") == F.col("b")))
    return placed.select("begin", "n_ids", "doc_ids", "doc_sizes", "offsets", "bits").mapInArrow(
        decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )


def new_file_set(spark: SparkSession) -> str:
    return new_path(spark, "id-files")
