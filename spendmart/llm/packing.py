"""Mixture-controlled packing: deficit round-robin over source queues.

Every window of ``window`` tokens serves each source's queue its share of tokens, in turns of whole
multiples of ``turn`` tokens: after k rounds a queue has been served floor(k * window * share / turn)
turns. What a round leaves over is carried on, across windows and across the partitions that hold a
queue. Documents are cut where a queue's turn ends and at sequence ends. Since a queue's turns follow
from its share and length, each task works out the places of its own documents from prefix sums, and
the round of a token by division; nothing is sorted or gathered, and no round is visited in vain.

A queue that runs out leaves its turns to nobody: its rounds get shorter, and sequences, which
follow one another without gaps, stay full. Only the very last sequence needs padding.

What a task must know is one row a queue. Sources beyond ``queues`` - the smallest ones - share one,
in which each source's documents are spread evenly: they are put in order of the share of their
source that lies before them, by a distributed sort, so that every one of them keeps its proportion
to the others all along.

Defined results: a null or empty text is its end id alone; a null source is a queue of its own; rows
equal in all columns are documents of their own; very long texts are cut like others; an empty table
gives an empty result; columns other than id, source and text are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendmart.llm.common import lean
from spendmart.llm.tokens import MEMORY, tokenized
from spendmart.operators.numbering import PARTITION_BIT
from spendmart.staging import staged

QUEUES = 4096
#: Rounds times queues whose turns a task remembers.
HELD = 1 << 20
#: Rounds are counted in doubles: no queue is given so small a share that they'd lose count.
MOST_ROUNDS = 2.0**50
_PIECES = (
    "doc_id bigint, source string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, window bigint"
)


class Rounds:
    """Where the turns of each queue begin in the packed stream."""

    def __init__(self, lengths: list[int], shares: list[float], window: int, turn: int = 1):
        self.lengths = np.array(lengths, float)
        # turns due in a round
        self.due = np.maximum(np.array(shares, float) * window, self.lengths / MOST_ROUNDS) / turn
        self.turn = turn
        self.held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def served(self, rounds: int) -> np.ndarray:
        """Tokens of each queue served in the first ``rounds`` rounds."""
        return np.minimum(np.floor(rounds * self.due) * self.turn, self.lengths).astype(np.int64)

    def turns(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of round ``k``: first token of each queue's turn, its end, its place in the stream."""
        if k not in self.held:
            if len(self.held) * len(self.due) > HELD:
                self.held.clear()
            first, end = self.served(k), self.served(k + 1)
            place = int(first.sum()) + np.concatenate([[0], np.cumsum(end - first)[:-1]])
            self.held[k] = first, end, place
        return self.held[k]

    def round_of(self, queue: int, token: int) -> int:
        """The round that serves a token: the first after which its turn is no longer due."""
        due, turns = float(self.due[queue]), token // self.turn
        k = max(math.ceil((turns + 1) / due) - 1, 0)
        while k and math.floor(k * due) > turns:  # a step at most: division may round up
            k -= 1
        while math.floor((k + 1) * due) <= turns:
            k += 1
        return k


def _cut(rounds: Rounds, queue: int, begin: int, length: int, size: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces (start, length, sequence, offset, window) of a document at ``begin`` of its queue."""
    done = 0
    while done < length:
        k = rounds.round_of(queue, begin + done)
        first, end, place = rounds.turns(k)
        in_turn = min(length - done, int(end[queue]) - begin - done)
        at = int(place[queue]) + begin + done - int(first[queue])
        while in_turn:
            take = min(in_turn, size - at % size)
            yield done, take, at // size, at % size, k
            done, at, in_turn = done + take, at + take, in_turn - take


def _spread(rows: DataFrame) -> DataFrame:
    """``begin`` of documents (s, p, inside, n, before, total) that share a queue: each source's in
    order, and all sources' spread evenly over the queue.
    """
    part = (F.col("before") + F.col("inside") + F.col("n") / 2) / F.col("total")
    ordered = rows.withColumn("at", part).orderBy("at", "s", "p", "inside")
    ordered = staged(ordered.select("s", "p", "inside", "n", F.monotonically_increasing_id().alias("row")), "shared-queue")
    block = F.shiftright("row", PARTITION_BIT)
    ahead = Window.partitionBy("block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    blocks = ordered.groupBy(block.alias("of")).agg(F.sum("n").alias("n"))  # a row for each task of the sort
    earlier = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("of", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    inner = ordered.withColumn("block", block).withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    joined = inner.join(F.broadcast(blocks), F.col("block") == F.col("of"))
    return joined.select("s", "p", F.col("inside").alias("i"), (F.col("earlier") + F.col("ahead")).alias("begin"))


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    vocabulary: str = "byte_bpe_50k.json",
    end_id: int = 0,
    size: int = 1024,
    window: int = 65536,
    turn: int = 64,
    targets: dict[str | None, float] | None = None,
    temper: float = 1.0,
    queues: int = QUEUES,
    word_memory: int = MEMORY,
    words_last: bool = True,
) -> DataFrame:
    """Pieces of all documents: doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, window.

    ``targets`` gives sources their weights in each window. The others' are their shares of all tokens
    to the power ``temper``: with 1 all queues end together, with less small sources get more of the
    windows they last for.
    """
    tokens, kind = tokenized(
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text")),
        ["doc_id", "source"],
        "text",
        vocabulary,
        end_id,
        word_memory,
        words_last,
    )
    spark = docs.sparkSession
    targets = targets or {}
    per_part = tokens.groupBy("source", "part").agg(F.sum("n_tokens").alias("n"))
    sizes = staged(per_part, "queue-sizes")
    by_source = sizes.groupBy("source").agg(F.sum("n").alias("n"))
    everything, n_sources = by_source.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    asked = F.coalesce(F.col("source").isin([s for s in targets if s is not None]), F.lit(None in targets))
    most = max(queues - 1, len(targets))
    largest = by_source.orderBy(asked.desc(), F.desc("n"), "source").limit(most).collect()
    named = [(r["source"], int(r["n"])) for r in largest]
    lengths = [n for _, n in named] + [int(everything) - sum(n for _, n in named)]
    weights = [targets.get(s, (n / max(everything, 1)) ** temper) for s, n in named]
    if n_sources > len(named):  # the weights of the sources that share a queue, added up
        others = by_source.join(spark.createDataFrame([(s,) for s, _ in named], "s string"), F.col("source").eqNullSafe(F.col("s")), "left_anti")
        weights.append(others.agg(F.sum(F.pow(F.col("n") / float(everything), F.lit(temper)))).first()[0])
    else:
        weights.append(0.0)
    total = sum(w for w, n in zip(weights, lengths) if n) or 1.0
    rounds = Rounds(lengths, [w / total if n else 0.0 for w, n in zip(weights, lengths)], window, turn)

    known = spark.createDataFrame([(s, i) for i, (s, _) in enumerate(named)], "s string, queue int")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("source", F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    offsets = offsets.join(known, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "s")
    offsets = staged(offsets, "queue-offsets")
    # a row per task and source, small enough to broadcast unless tasks or sources are very many
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))
    placed = tokens.join(offsets.where("queue is not null"), same).select(
        "doc_id", "source", "queue", (F.col("before") + F.col("inside")).alias("begin"), "ids"
    )
    if n_sources > len(named):
        shared = tokens.select("source", "part", "inside", F.col("n_tokens").alias("n")).join(offsets.where("queue is null"), same)
        totals = by_source.select(F.col("source").alias("of"), F.col("n").alias("total"))
        shared = shared.join(totals, F.col("source").eqNullSafe(F.col("of"))).select("s", "p", "inside", "n", "before", "total")
        begins = _spread(shared)
        rest = tokens.join(begins, same & (F.col("inside") == F.col("i")))
        placed = placed.unionAll(rest.select("doc_id", "source", F.lit(len(named)).alias("queue"), "begin", "ids"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, source = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            queue, begin = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            rows: list[tuple] = []
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column(4)[i].as_buffer(), kind).astype("<u4")
                n = len(ids)
                for start, length, sequence, offset, k in _cut(rounds, queue[i], begin[i], n, size):
                    rows.append(
                        (doc[i], source[i], start, length, zlib.crc32(ids[start : start + length].tobytes()), n, sequence, offset, k)
                    )
            columns = list(zip(*rows)) or [()] * 9
            types = [pa.int64(), pa.string(), *[pa.int64()] * 7]
            names = [f.split()[0] for f in _PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return placed.mapInArrow(lean(cut), _PIECES)
