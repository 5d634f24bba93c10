"""MinHash near-duplicates with sequential Bayesian verification.

1. Each text's set of word shingles gives its size, a 128-bit name of the set, a MinHash signature
   and band names. Texts with equal sets form a class; its smallest id stands for it.
2. Members of a band bucket are paired with the bucket's smallest member, so a bucket gives as many
   pairs as it has members.
3. A pair's signatures are compared batch by batch; it is dropped once the posterior probability
   (uniform prior) that the similarity reaches the threshold falls below ``miss``. Survivors are
   confirmed on their full sets; confirmed links give components.
4. Buckets that still hold several components are compared across components, in blocks, in the
   same sequential way, and survivors are confirmed: first one member of each component, the rest
   only where those haven't merged the bucket's components. Pairs inside one component are never
   looked at again, and no other pair of a bucket is left out.

Defined results: null, empty and wordless texts have size 0 and are linked with nothing; fewer
words than a shingle give one shingle; repeated rows of an id are texts of their own that share a
node; a null id gets size and itself as (null) component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmart.llm.common import Words, chunks, compactly_staged, free_name, joined_names, lean, mixed
from spendmart.llm.components import components
from spendmart.operators.numbering import number_in_order
from spendmart.staging import staged

HASHES, BAND = 128, 4
BATCH = 16
BLOCK = 512
_A = np.random.default_rng(5).integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = np.random.default_rng(6).integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle names of each text (A-Z lower-cased)."""
    words = Words(texts, lower=True)
    runs = joined_names(words.names, k)
    out = []
    for a, b in zip(words.bounds[:-1], words.bounds[1:]):
        if b - a >= k:
            out.append(np.unique(runs[a : b - k + 1]))
        else:
            out.append(joined_names(words.names[a:b], b - a, seed=2) if b > a else runs[:0])
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash rows of sets that aren't empty."""
    flat = np.concatenate(sets)
    begins = np.cumsum([0, *map(len, sets[:-1])])
    low, high = flat.astype(np.uint32), (flat >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), HASHES), np.uint32)
    value = np.empty(len(flat), np.uint32)
    for j in range(HASHES):
        np.multiply(low if j % 2 else high, _A[j], out=value)
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        value ^= _B[j]
        out[:, j] = np.minimum.reduceat(value, begins)
    return out


def _profile(k: int):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for first, part in chunks(texts):
                sets = shingle_sets(part, k)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                names: list[bytes | None] = [None] * len(part)
                sigs: list[bytes | None] = [None] * len(part)
                bands: list[np.ndarray | None] = [None] * len(part)
                if len(full):
                    rows = signatures([sets[i] for i in full])
                    quads = mixed(rows.astype(np.uint64)).reshape(len(rows), -1, BAND)
                    total = np.zeros(quads.shape[:2], np.uint64) + np.arange(quads.shape[1], dtype=np.uint64)
                    for j in range(BAND):
                        total = mixed(total * np.uint64(31) + quads[:, :, j])
                    for row, i in enumerate(full):
                        s = sets[i]
                        ends = mixed(s + np.uint64(1))
                        names[i] = np.array([s.sum(), ends.sum()], np.uint64).tobytes()
                        sigs[i] = rows[row].tobytes()
                        bands[i] = total[row].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(part)),
                        pa.array(sizes),
                        pa.array(names, pa.binary()),
                        pa.array(sigs, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["id", "n_shingles", "set_name", "sig", "bands"],
                )

    return profile


@lru_cache
def least_matches(threshold: float, miss: float) -> np.ndarray:
    """For each multiple of ``BATCH`` compared values, the matches below which a pair is dropped.

    With a uniform prior, P(similarity >= t | m of n match) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        chance = np.zeros(n + 2)
        chance[0] = 1.0
        for _ in range(n + 1):
            chance[1:] = chance[1:] * (1 - threshold) + chance[:-1] * threshold
            chance[0] *= 1 - threshold
        out.append(int(np.argmax(np.cumsum(chance) >= miss)))
    return np.array(out)


def survivors(a: np.ndarray, b: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Which rows of two equally long signature tables pass every batch."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for step, least in enumerate(least_matches(threshold, miss)):
        cut = slice(step * BATCH, (step + 1) * BATCH)
        matches[alive] += (a[alive, cut] == b[alive, cut]).sum(1)
        alive = alive[matches[alive] >= least]
    return alive


def _sig_table(column: pa.Array | pd.Series) -> np.ndarray:
    values = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    return np.frombuffer(b"".join(values), np.uint32).reshape(len(values), HASHES)


def _bayes(pairs: DataFrame, sigs: DataFrame, threshold: float, miss: float) -> DataFrame:
    """``pairs`` (a, b) that survive the sequential comparison of signatures."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = survivors(_sig_table(batch.column(2)), _sig_table(batch.column(3)), threshold, miss)
            yield batch.select([0, 1]).take(pa.array(keep))

    first = sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")).hint("merge")
    second = sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")).hint("merge")
    joined = pairs.join(first, "a").join(second, "b")
    return joined.select("a", "b", "sig_a", "sig_b").mapInArrow(lean(compare), "a bigint, b bigint")


def _shingles(texts: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """id and full shingle set (sorted 64-bit names) of the texts with one of ``ids``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks(batch.column(1).to_pylist()):
                found = [s.tobytes() for s in shingle_sets(part, k)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), pa.array(found, pa.binary())], names=["id", "shingles"]
                )

    needed = texts.join(ids.hint("merge"), "id", "left_semi").select("id", "text")
    return needed.mapInArrow(lean(sets), "id bigint, shingles binary")


def _confirmed(pairs: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` whose full shingle sets have at least the threshold in common."""
    percent = round(threshold * 100)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                least, most = sorted((len(s), len(t)))
                if 100 * least < percent * most:
                    continue
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= percent * (len(s) + len(t) - both):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    first = shingles.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")).hint("merge")
    second = shingles.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")).hint("merge")
    both = pairs.join(first, "a").join(second, "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(lean(check), "a bigint, b bigint")


def _short(shingles: DataFrame) -> DataFrame:
    """Shingle sets cut to 32 bits a name: what blocks compare before full sets confirm."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(np.frombuffer(x.as_buffer(), np.uint64).astype(np.uint32)).tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "short"])

    return shingles.mapInArrow(lean(cut), "id bigint, short binary")


def _pairs_of(
    sig: np.ndarray, left: np.ndarray, right: np.ndarray, comp: np.ndarray, met: np.ndarray, threshold: float, miss: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of different components that survive; the first batches as whole tables.

    Two rows that have both ``met`` were compared before.
    """
    least = least_matches(threshold, miss)
    matches = np.zeros((len(left), len(right)), np.uint8)
    for step in range(2):
        for j in range(step * BATCH, (step + 1) * BATCH):
            matches += sig[left, j][:, None] == sig[right, j][None, :]
        alive = matches >= least[step]
        if not alive.any():
            return left[:0], right[:0]
    alive &= comp[left][:, None] != comp[right][None, :]
    alive &= ~(met[left][:, None] & met[right][None, :])
    if left is right:
        alive &= np.tri(len(left), k=-1, dtype=bool).T
    x, y = np.nonzero(alive)
    x, y = left[x], right[y]
    keep = []
    for at in range(0, len(x), 1 << 14):
        part = slice(at, at + (1 << 14))
        keep.append(at + survivors(sig[x[part]], sig[y[part]], threshold, miss))
    keep = np.concatenate(keep) if keep else np.zeros(0, int)
    return x[keep], y[keep]


def _across(members: DataFrame, sigs: DataFrame, shingles: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Likely pairs of different components in the same bucket, block against block.

    ``members``: bucket, band, id, comp, met. A bucket of many members is dealt over blocks of about
    ``BLOCK``, and each pair of blocks is a group of its own; smaller buckets are grouped some
    thousands of rows together. A pair is looked at in the first band that it shares, and its
    sets, cut to 32 bits a name, must come within a hundredth of the threshold.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    n_chunks = members.count() // 4096 + 1
    small = F.pmod(F.xxhash64("bucket", F.lit(3)), F.lit(n_chunks))
    dealt = (
        members.join(sizes.hint("merge"), "bucket")
        .withColumn("of", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("id", F.lit(11)), F.col("of").cast("bigint")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
        .select(
            F.when(F.col("of") > 1, F.col("bucket")).otherwise(small).alias("chunk"), (F.col("of") > 1).alias("large"),
            "bucket", "band", "id", "comp", "met", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
        )
        .join(sigs.select("id", "sig").hint("merge"), "id")
        .join(_short(shingles).hint("merge"), "id")
    )
    percent = round(threshold * 100) - 1

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bucket", kind="stable")
        i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
        own, buckets, band = group["block"].to_numpy(), group["bucket"].to_numpy(), group["band"].to_numpy()
        sig, comp, ids = _sig_table(group["sig"]), group["comp"].to_numpy(), group["id"].to_numpy()
        met = group["met"].to_numpy()
        sets = [np.frombuffer(x, np.uint32) for x in group["short"]]
        edges = np.flatnonzero(np.diff(buckets, prepend=buckets[0] - 1 if len(buckets) else 0))
        found: set[tuple[int, int]] = set()
        for a, b in zip(edges, [*edges[1:], len(buckets)]):
            rows = np.arange(a, b)
            left = rows[own[rows] == i]
            right = left if i == j else rows[own[rows] == j]
            xs, ys = _pairs_of(sig, left, right, comp, met, threshold, miss)
            if len(xs):
                same = (sig[xs] == sig[ys]).reshape(len(xs), -1, BAND).all(2)
                first = same.argmax(1) >= band[a]
                xs, ys = xs[first], ys[first]
            for x, y in zip(xs, ys):
                s, t = sets[x], sets[y]
                least, most = sorted((len(s), len(t)))
                if 100 * least < percent * most:
                    continue
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= percent * (len(s) + len(t) - both):
                    found.add((min(ids[x], ids[y]), max(ids[x], ids[y])))
        return pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")

    return dealt.groupBy("large", "chunk", "i", "j").applyInPandas(compare, "a bigint, b bigint").distinct()


def _open_members(buckets: DataFrame, comp: DataFrame) -> DataFrame:
    """bucket, band, id, comp, met of the buckets that hold several components."""
    at = buckets.join(comp.withColumnRenamed("node", "id").hint("merge"), "id", "left").select(
        "bucket", "band", "id", F.coalesce("component", "id").alias("comp"), "met"
    )
    several = at.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return at.join(several.select("bucket").hint("merge"), "bucket", "left_semi")


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, threshold: float = 0.75, miss: float = 1e-6
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable), kept.

    At the threshold a pair shares no band of four values with probability (1 - 0.75^4)^32 = 6e-6.
    """
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    profile = staged(
        source.select("id", F.col("text").cast("binary")).mapInArrow(
            lean(_profile(shingle)), "id bigint, n_shingles bigint, set_name binary, sig binary, bands array<bigint>"
        ),
        "shingle-profile",
    )
    full = profile.where(F.col("set_name").isNotNull() & F.col("id").isNotNull())
    reps = staged(full.groupBy("set_name").agg(F.min("id").alias("id")), "shingle-classes")
    # an id that repeats may stand for several sets: each keeps its own signature
    rep_rows = full.join(reps, ["set_name", "id"], "left_semi")
    sigs = staged(rep_rows.select("id", "sig").distinct(), "signatures")
    banded = rep_rows.select("id", F.posexplode("bands").alias("band", "bucket")).distinct()
    hubs = banded.groupBy("bucket").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    buckets = staged(banded.join(hubs.hint("merge"), "bucket"), "buckets")

    texts = source.where(F.col("id").isNotNull()).select("id", F.col("text").cast("binary").alias("text"))
    shingles = staged(_shingles(texts, buckets.select("id").distinct(), shingle), "shingles")
    stars = buckets.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    pairs = staged(_bayes(stars, sigs, threshold, miss).distinct(), "star-pairs")
    links = staged(_confirmed(pairs, shingles, threshold).distinct(), "star-links")
    comp = staged(components(links, "a", "b"), "components")

    members = staged(_open_members(buckets.withColumn("met", F.lit(False)), comp), "open-buckets")
    first = members.groupBy("bucket", "comp").agg(F.min("id").alias("id"))
    several = members.join(first.select("bucket", "id").withColumn("first", F.lit(True)).hint("merge"), ["bucket", "id"], "left")
    several = staged(several.withColumn("met", F.coalesce("first", F.lit(False))).drop("first"), "open-members")
    chosen = several.where("met").withColumn("met", F.lit(False))
    likely = _across(chosen, sigs, shingles, threshold, miss).join(pairs, ["a", "b"], "left_anti")
    more = staged(_confirmed(likely, shingles, threshold), "first-links")
    links = links.unionAll(more)
    if not several.where("not met").isEmpty():
        comp = staged(components(links, "a", "b"), "components")
        # what is left: buckets with several components, and members that haven't met the others
        left = several.where("not met").select("bucket").distinct()
        rest = _open_members(several.drop("comp").join(left.hint("merge"), "bucket", "left_semi"), comp)
        likely = _across(staged(rest, "open-rest"), sigs, shingles, threshold, miss).join(pairs, ["a", "b"], "left_anti")
        links = links.unionAll(_confirmed(likely, shingles, threshold))

    # ids of one class, and the representatives that links join
    copies = full.join(reps.withColumnRenamed("id", "rep"), "set_name").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    everything = links.unionAll(copies.where("a <> b"))
    final = components(everything, "a", "b")
    return (
        profile.select("id", "n_shingles")
        .join(final.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            F.coalesce("component", "id").alias("component_id"),
            F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"),
        )
    )


def without_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the smallest id.

    Rows are linked, not ids: texts that share an id, or have none, are told apart by numbers of
    their own beyond the largest id, so only a row whose own text is confirmed goes. Of rows equal in
    id and text the smallest by its other columns stays.
    """
    id_ = F.col(id_col).cast("bigint")
    node = free_name(docs, "_node")
    digest = free_name(docs, "_digest")
    keyed = docs.withColumn(node, id_)
    repeated = staged(docs.groupBy(id_.alias("id")).agg(F.count("*").alias("n")).where("n > 1 or id is null"), "repeated-ids")
    several = None
    if not repeated.isEmpty():
        shared = F.broadcast(repeated) if repeated.count() < 1 << 16 else repeated
        alone = keyed.join(shared, keyed[node].eqNullSafe(F.col("id")), "left_anti")
        several = keyed.join(shared, keyed[node].eqNullSafe(F.col("id")), "left_semi")
        several = several.withColumn(digest, F.coalesce(F.md5(F.col(text_col).cast("string").cast("binary")), F.lit("")))
        others, plain = docs.columns, [c for c, kind in docs.dtypes if "map<" not in kind]
        first = several.groupBy(node, digest).agg(F.min_by(F.struct(*others), F.struct(*plain)).alias("r"))
        several = compactly_staged(first, "texts-that-share-an-id")
        least, last = keyed.agg(F.min(node), F.max(node)).first()
        # beyond the largest id, or below the smallest where no numbers are left
        first_number = (last or 0) + 1 if (last or 0) < 1 << 62 else least - several.count()
        names = several.select(node, digest).withColumn("_by", F.struct(node, digest))
        numbered = staged(number_in_order(names, "_by", "n", first_number).drop("_by"), "numbers-of-texts")
        told = several.withColumnRenamed(node, "_id").withColumnRenamed(digest, "_of").join(
            numbered, F.col("_id").eqNullSafe(F.col(node)) & (F.col("_of") == F.col(digest))
        )
        keyed = alone.unionByName(told.select(*(F.col("r")[c].alias(c) for c in others), F.col("n").alias(node)))
    found = near_duplicates(keyed.select(node, text_col), id_col=node, text_col=text_col, **settings)
    if several is not None:
        # the smallest id of a group counts, not the smallest number; a number without an id comes last
        ids = numbered.select(F.col("n").alias(node), F.col(node).alias("_id"), F.lit(True).alias("_told"))
        at = staged(found.select(node, "component_id"), "rows-of-groups").join(ids, node, "left")
        rank = F.struct(F.coalesce(F.col("_told") & F.col("_id").isNull(), F.lit(False)).alias("none"), F.coalesce("_id", node).alias("id"), F.col(node).alias("n"))
        at = at.withColumn("_rank", rank)
        first = at.groupBy("component_id").agg(F.min("_rank")["n"].alias("_first"))
        found = at.join(first, "component_id").withColumn("kept", F.col(node) == F.col("_first"))
    gone = compactly_staged(found.where(~F.col("kept")).select(F.col(node).alias("_gone")), "near-duplicate-rows")
    return keyed.join(gone, F.col(node) == F.col("_gone"), "left_anti").drop(node)
