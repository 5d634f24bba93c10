"""Quality rules judged by isolation forests.

Rule statistics of each text are turned into rates, in groups that belong to one rule. Each group
has a forest of random trees, grown on a bounded sample of labelled rows; an unusual document is
isolated after few splits, and the mean path length gives its score in that group. Labelled rows
set, for each group, the score from which a document is rejected; a group in which good and bad
rows mix rejects nothing.

Defined results: a null or empty text has no words and fails the base rules; without usable
labels only the base rules decide; repeated rows are judged one by one; a score that ties with its
group's cut is rejected like those beyond it; very long texts are read whole, one at a time; an empty
table gives an empty result; other columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendmart.llm.common import free_name
from spendmart.staging import staged

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_distinct", "n_upper", "n_digits", "n_marks")
SYMBOLS = b"#*$%&|<>"
MARKS = b"!?;:,.\"'()[]{}-_=/\\@~^+"
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
MIN_WORDS = 50


def rule_counts(text: bytes | None) -> tuple[int, ...]:
    """``COUNTS + EXTRA`` of one whole UTF-8 text."""
    if not text:
        return (0,) * len(COUNTS + EXTRA)
    words = text.split()
    solid = b"".join(words)
    chars = len(solid.decode("utf-8", "replace"))
    kept = lambda alphabet: len(solid) - len(solid.translate(None, alphabet))
    lines, repeated = [line for line in text.split(b"\n") if line.split()], 0
    triples = list(zip(words, words[1:], words[2:]))
    if len(set(triples)) < len(triples):
        often = {t for t, n in Counter(triples).items() if n > 1}
        covered = bytearray(len(words))
        for i, t in enumerate(triples):
            if t in often:
                covered[i : i + 3] = b"\1\1\1"
        repeated = sum(covered)
    return (
        len(words), chars, kept(SYMBOLS), len(lines) - len(set(lines)), repeated,
        len(lines), len(set(words)), kept(UPPER), kept(DIGITS), kept(MARKS),
    )


def _counts(texts: pa.Array) -> np.ndarray:
    rows = [rule_counts(t.as_py()) for t in texts]
    return np.array(rows, np.int64).reshape(len(rows), len(COUNTS + EXTRA))


def statistics(text: Column) -> Column:
    """The array of ``COUNTS + EXTRA`` of each text."""

    def count(texts: pa.Array) -> pa.Array:
        rows = _counts(texts)
        return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.ravel()))

    return F.arrow_udf(count, "array<bigint>")(text.cast("binary"))


def base_failed(counts: np.ndarray) -> np.ndarray:
    words, repeated = counts[:, 0], counts[:, 4]
    return (words < MIN_WORDS) | (100 * repeated > 50 * words)


def rates(counts: np.ndarray) -> dict[str, np.ndarray]:
    """What each group's forest splits on; rows are texts."""
    c = dict(zip(COUNTS + EXTRA, counts.T.astype(float)))
    words, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1)
    length, symbols, upper = c["word_chars"] / words, c["n_symbols"] / words, c["n_upper"] / words
    repeats = [c["n_dup_lines"] / lines, c["n_repeat_words"] / words]
    marks = [c["n_marks"] / words, c["n_digits"] / words]
    distinct = c["n_distinct"] / words
    groups = {
        "symbols": [symbols],
        "shape": [length, upper],
        "marks": marks,
        "repeats": [*repeats, distinct],
        "joint": [np.log1p(c["n_words"]), length, symbols, upper, distinct, *repeats, *marks],
    }
    return {g: np.stack(columns, 1) for g, columns in groups.items()}


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: feature (-1 at a leaf), cut, child at or below the cut, path length."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    path: np.ndarray
    scale: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1 for each row; near 1 where random splits isolate it soon."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, left, path in zip(self.feature, self.cut, self.left, self.path):
            node = np.zeros(len(x), np.int32)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > cut[node]
                node = np.where(inner, left[node] + right, node)
            total += path[node]
        return 2.0 ** (-total / (max(len(self.feature), 1) * self.scale))


def mean_path(n: np.ndarray | int) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` rows: what a leaf holding them adds."""
    n = np.asarray(n, float)
    deep = 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, deep, np.where(n == 2, 1.0, 0.0))


def grow(x: np.ndarray, trees: int, leaf_rows: int, seed: int) -> Forest:
    """Each tree takes ``leaf_rows`` rows, splits a random feature between its extremes, and goes
    on until rows are alone or the depth reaches log2 of the sample.
    """
    rng = np.random.default_rng(seed)
    take = min(leaf_rows, len(x))
    deepest = int(np.ceil(np.log2(max(take, 2))))
    grown = []
    for _ in range(trees):
        nodes: list[list[float]] = [[-1, 0.0, 0, 0.0]]
        todo = [(0, rng.choice(len(x), take, replace=False), 0)]
        while todo:
            at, rows, depth = todo.pop()
            low, high = x[rows].min(0), x[rows].max(0)
            open_to = np.flatnonzero(high > low)
            if depth >= deepest or len(rows) < 2 or not len(open_to):
                nodes[at][3] = depth + float(mean_path(len(rows)))
                continue
            f = rng.choice(open_to)
            cut = rng.uniform(low[f], high[f])
            above = x[rows, f] > cut
            nodes[at] = [f, cut, len(nodes), 0.0]
            nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
            todo += [(len(nodes) - 2, rows[~above], depth + 1), (len(nodes) - 1, rows[above], depth + 1)]
        grown.append(np.array(nodes))
    most = max(map(len, grown), default=1)
    full = np.stack([np.pad(t, ((0, most - len(t)), (0, 0))) for t in grown])
    return Forest(full[:, :, 0].astype(int), full[:, :, 1], full[:, :, 2].astype(np.int32), full[:, :, 3], float(mean_path(take)) or 1.0)


def fit(labelled: DataFrame, counts: str, *, trees: int = 64, leaf_rows: int = 256, max_rows: int = 8192, seed: int = 7) -> dict[str, Forest]:
    """A forest for each group of rates, on at most ``max_rows`` rows, the first in a hashed order."""
    key = F.xxhash64(F.lit(seed), counts)
    n = labelled.count()
    # the first rows in that order lie below twice their share of all hashes; few others travel
    bound = F.lit(min(1.0, 2 * max_rows / max(n, 1)) * 2.0**64 - 2.0**63)
    near = labelled if n <= max_rows else labelled.where(key.cast("double") <= bound)
    sample = near.select(counts).orderBy(key, counts).limit(max_rows).collect()
    if len(sample) < 2:
        return {}
    found = rates(np.array([row[0] for row in sample], np.int64))
    return {g: grow(x, trees, leaf_rows, seed) for g, x in found.items()}


def scores_of(forests: dict[str, Forest], counts: Column) -> Column:
    """The array of each group's score for an array of counts."""

    def score(rows: pa.Array) -> pa.Array:
        flat = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), len(COUNTS + EXTRA))
        x = rates(flat)
        made = np.stack([forest.scores(x[g]) for g, forest in forests.items()], 1)
        return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * made.shape[1], pa.array(made.ravel()))

    return F.arrow_udf(score, "array<double>")(counts)


def calibrate(scored: DataFrame, scores: list[str], quality: str, *, good_worth: float = 50.0, bins: int = 4000) -> dict[str, float]:
    """For each score the cut that removes most bad rows, a good row weighing ``good_worth`` bad ones.

    All labelled rows count; a row per score and bin reaches the driver. Of equal cuts the middle
    one is taken. Without a cut worth making the result is 2, which no score reaches.
    """
    one = F.lit(1.0)
    bin_of = lambda c: F.floor(F.least(F.greatest(F.col(c), F.lit(0.0)), one) * bins)
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("score"), bin_of(c).alias("bin")) for c in scores)))
    found = (
        scored.select(quality, pairs.alias("at"))
        .groupBy("at.score", "at.bin")
        .agg(F.count_if(F.col(quality) == 1).alias("good"), F.count_if(F.col(quality) == 0).alias("bad"))
    )
    held = {c: np.zeros((2, bins + 1)) for c in scores}
    for row in found.collect():
        held[row["score"]][:, row["bin"]] = row["good"], row["bad"]
    cuts = {}
    for c, (good, bad) in held.items():
        worth = np.cumsum((bad - good_worth * good)[::-1])[::-1]  # of rejecting this bin and all above
        best = np.flatnonzero(worth == worth.max()) if worth.max() > 0 and good.sum() else []
        cuts[c] = best[len(best) // 2] / bins if len(best) else 2.0
    return cuts


def judged(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", name: str = "judged", **forest
) -> DataFrame:
    """``docs`` with one more struct column: ``COUNTS``, base_failed, a score per group, kept.

    ``docs`` is read twice: once for the labelled rows, once for all. The column is called
    ``name``, with underscores in front if ``docs`` has one of that name.
    """
    marks = (
        labels.where(F.col(quality_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(quality_col).alias("_quality"))
    )
    counted = docs.select(F.col(id_col).alias("_id"), statistics(F.col(text_col)).alias("_counts"))
    fair = ~((F.col("_counts")[0] < MIN_WORDS) | (100 * F.col("_counts")[4] > 50 * F.col("_counts")[0]))
    # the same plan at every size: counts travel, texts don't
    labelled = staged(counted.join(marks.hint("merge"), "_id").where(fair).select("_quality", "_counts"), "quality-labelled")
    forests = fit(labelled, "_counts", **forest)
    cuts: dict[str, float] = {}
    if forests:
        groups = list(forests)
        scored = labelled.select("_quality", scores_of(forests, F.col("_counts")).alias("_s"))
        cuts = calibrate(scored.select("_quality", *(F.col("_s")[i].alias(g) for i, g in enumerate(groups))), groups, "_quality")
    used = {g: forest for g, forest in forests.items() if cuts[g] <= 1.0}

    def judge(texts: pa.Array) -> pa.Array:
        counts = _counts(texts)
        failed, x = base_failed(counts), rates(counts)
        scores = {g: forest.scores(x[g]) for g, forest in used.items()}
        kept = ~failed
        for g, values in scores.items():
            kept &= values < cuts[g]
        columns = [*counts.T[: len(COUNTS)], failed, *scores.values(), kept]
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    names = [*COUNTS, "base_failed", *(f"score_{g}" for g in used), "kept"]
    types = ["bigint"] * len(COUNTS) + ["boolean"] + ["double"] * len(used) + ["boolean"]
    schema = "struct<" + ",".join(f"{n}:{t}" for n, t in zip(names, types)) + ">"
    return docs.withColumn(free_name(docs, name), F.arrow_udf(judge, schema)(F.col(text_col).cast("binary")))
