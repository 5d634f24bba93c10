"""Temperature mixing of sources, with DataFrame operations only.

Token shares of the sources are raised to an exponent and normalised. The exponent is bisected until
the mixture has a wanted entropy, or until no source repeats more often than allowed. A source's
weight and the budget give its tokens: whole epochs, and for the rest a prefix of a permutation of
blocks. Blocks and their rows are ordered by hashes, so the prefix needs per source only one cut:
the last block, and the last row in it. Rows are then chosen without any exchange of texts.

Defined results: a null source is a source of its own; a null or empty text has no tokens; a source
without tokens has weight 0 and passes once when no budget is given, else not at all; rows equal in
id and text share their fate; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendmart.llm.common import free_name
from spendmart.staging import staged

BLOCK_ROWS = 4096
#: Bisections that one pass over the source totals carries out, and passes.
LEVELS, PASSES = 5, 8


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("bigint")


def row_key(id_col: str, text_col: str, seed: int) -> Column:
    """Orders a source's rows at random: 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"), F.coalesce(F.col(text_col), F.lit(""))))


def _block(key: Column, blocks: Column) -> Column:
    return F.conv(F.substring(key, 1, 12), 16, 10).cast("bigint") % blocks


def _block_key(seed: int, block: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(f"block{seed}"), block.cast("string")))


def _measures(totals: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float, float]]:
    """For each exponent: sum of powers of the shares, entropy in nats, largest power ratio.

    The last is the largest share^(exponent - 1), to which a source's repetitions are in proportion.
    """
    powers = (
        totals.where("tokens > 0")
        .select("share", F.explode(F.array(*map(F.lit, exponents))).alias("e"))
        .select("e", F.log("share").alias("log"), F.pow("share", F.col("e")).alias("p"), F.pow("share", F.col("e") - 1).alias("ratio"))
        .groupBy("e")
        .agg(F.sum("p").alias("z"), F.sum(F.col("p") * F.col("log")).alias("zl"), F.max("ratio").alias("ratio"))
    )
    return {r["e"]: (r["z"], math.log(r["z"]) - r["e"] * r["zl"] / r["z"], r["ratio"]) for r in powers.collect()}


def _bisect(totals: DataFrame, low: float, high: float, too_flat) -> float:
    """The exponent between ``low`` and ``high`` below which ``too_flat(e, measures)`` holds.

    A pass measures every midpoint that its bisections could visit, at a row each.
    """
    for _ in range(PASSES):
        steps = 1 << LEVELS
        points = [low + (high - low) * i / steps for i in range(steps + 1)]
        found = _measures(totals, points[1:-1])
        i, j = 0, steps
        while j - i > 1:
            middle = (i + j) // 2
            if too_flat(points[middle], found[points[middle]]):
                i = middle
            else:
                j = middle
        low, high = points[i], points[j]
    return round(high, 9)


def mixing_plan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    budget: int | None = None,
    max_repeats: float | None = 2.0,
    target_entropy: float | None = None,
    seed: int = 17,
) -> DataFrame:
    """A row per source: source, tokens, blocks, exponent, weight, target_tokens, epochs, and the cut.

    ``max_repeats`` bounds how often a source may pass; ``target_entropy`` (nats) replaces it. With
    no ``budget`` (tokens), the largest source passes exactly once and every other at least once.
    With one, weights share it out.
    """
    narrow = staged(
        docs.select(
            F.col(source_col).alias("source"),
            token_count(F.col(text_col)).alias("tokens"),
            row_key(id_col, text_col, seed).alias("key"),
        ),
        "mixing-rows",
    )
    totals = narrow.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n_rows"))
    totals = staged(totals, "source-totals")
    whole = totals.agg(F.sum("tokens"), F.max("tokens"), F.count("*")).first()
    all_tokens, largest = int(whole[0] or 0), int(whole[1] or 0)
    totals = totals.withColumn("share", F.col("tokens") / F.lit(float(max(all_tokens, 1))))

    exponent, z = 1.0, 1.0
    if all_tokens:
        if target_entropy is not None:
            exponent = _bisect(totals, 0.0, 8.0, lambda e, m: m[1] > target_entropy)
        elif max_repeats is not None:
            base = lambda m: budget / all_tokens / m[0] if budget is not None else 1.0
            top = (largest / all_tokens) if budget is None else 1.0
            exponent = _bisect(
                totals, 0.0, 1.0, lambda e, m: m[2] * base(m) / (top ** (e - 1) if budget is None else 1.0) > max_repeats
            )
        z = _measures(totals, [exponent])[exponent][0]

    weight = F.when(F.col("tokens") > 0, F.pow("share", F.lit(exponent)) / F.lit(z)).otherwise(0.0)
    if budget is None:
        repeats = F.pow(F.col("tokens") / F.lit(float(max(largest, 1))), F.lit(exponent - 1.0))
        target = F.when(F.col("tokens") > 0, F.floor(F.col("tokens") * repeats)).otherwise(0)
        epochs = F.when(F.col("tokens") > 0, F.floor(F.col("target_tokens") / F.col("tokens"))).otherwise(1)
    else:
        target = F.floor(F.lit(float(budget)) * weight)
        epochs = F.when(F.col("tokens") > 0, F.floor(F.col("target_tokens") / F.col("tokens"))).otherwise(0)
    plan = (
        totals.withColumn("weight", weight)
        .withColumn("exponent", F.lit(exponent))
        .withColumn("target_tokens", target.cast("bigint"))
        .withColumn("epochs", epochs.cast("bigint"))
        .withColumn("rest", F.col("target_tokens") - F.col("epochs") * F.col("tokens"))
        .withColumn("blocks", F.ceil(F.col("n_rows") / BLOCK_ROWS).cast("bigint"))
    )
    plan = staged(plan, "source-weights")

    # the block in which the rest ends
    short = plan.select(F.col("source").alias("s"), "blocks", "rest")
    dealt = narrow.join(short, F.col("source").eqNullSafe(F.col("s"))).withColumn("block", _block(F.col("key"), F.col("blocks")))
    blocks = dealt.groupBy("source", "block", "rest").agg(F.sum("tokens").alias("held"))
    order = Window.partitionBy("source").orderBy("block_key", "block")
    ends = blocks.withColumn("block_key", _block_key(seed, F.col("block"))).withColumn("end", F.sum("held").over(order))
    cut_blocks = staged(
        ends.where("end > rest")
        .groupBy("source")
        .agg(
            F.min(F.struct("end", "block_key", "block", "held")).alias("cut")
        )
        .select(F.col("source").alias("s"), "cut.*"),
        "cut-blocks",
    )
    # the last row of that block which still fits; rows equal in key stand or fall together
    inside = dealt.drop("s").join(
        cut_blocks.select("s", F.col("block").alias("b"), (F.col("end") - F.col("held")).alias("before")),
        F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")),
    )
    rows = Window.partitionBy("source", "block").orderBy("key")
    cut_rows = (
        inside.withColumn("sum", F.sum("tokens").over(rows) + F.col("before"))
        .where("sum <= rest")
        .groupBy("source")
        .agg(F.max("key").alias("cut_key"))
        .withColumnRenamed("source", "s2")
    )
    return (
        plan.join(cut_blocks.drop("end", "held"), F.col("source").eqNullSafe(F.col("s")), "left")
        .drop("s")
        .withColumnsRenamed({"block_key": "cut_block_key", "block": "cut_block"})
        .join(cut_rows, F.col("source").eqNullSafe(F.col("s2")), "left")
        .drop("s2", "share")
    )


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", name: str = "mix", seed: int = 17, **options) -> DataFrame:
    """Every row of ``docs`` as often as the mixture takes it, with a struct ``name``: epoch, block,
    n_tokens, weight, target_tokens. Underscores are put in front of ``name`` if it is taken.
    """
    plan = mixing_plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed, **options)
    plan = staged(plan, "mixing-plan")
    key, p, out = free_name(docs, "_key"), free_name(docs, "_plan"), free_name(docs, name)
    at = F.col(p)
    block = _block(F.col(key), at["blocks"])
    earlier = F.struct(_block_key(seed, block), block) < F.struct(at["cut_block_key"], at["cut_block"])
    in_cut = (block == at["cut_block"]) & F.coalesce(F.col(key) <= at["cut_key"], F.lit(False))
    extra = F.when((at["rest"] > 0) & (earlier | in_cut), 1).otherwise(0)
    times = at["epochs"] + extra
    packed = plan.select(F.struct("*").alias(p))
    return (
        docs.withColumn(key, row_key(id_col, text_col, seed))
        .join(packed, F.col(source_col).eqNullSafe(at["source"]))
        .withColumn(out, F.explode(F.when(times > 0, F.sequence(F.lit(0).cast("bigint"), times - 1))))
        .withColumn(
            out,
            F.struct(
                F.col(out).alias("epoch"),
                block.alias("block"),
                token_count(F.col(text_col)).alias("n_tokens"),
                at["weight"].alias("weight"),
                at["target_tokens"].alias("target_tokens"),
            ),
        )
        .drop(key, p)
    )
