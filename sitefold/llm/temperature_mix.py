"""Mixing sources by temperature, in DataFrame operations only.

A source's weight is its token share to the power of an exponent; 1 keeps the shares, 0 makes all
sources equal. The exponent is bisected to the largest that reaches a target entropy; if that would
repeat a source too often, to the smallest that keeps the repetition limit. Weights become whole
documents by permuting blocks: each source is cut into blocks of about equal size by hash, every epoch
deals its blocks in a new order, and the last epoch ends inside one block, at the budget.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitefold.session import materialize

#: Entropy to reach, as a share of the largest possible (equal weights).
TARGET_ENTROPY = 0.97
#: Times a source may be repeated.
MAX_REPEATS = 4.0
#: Tokens of a block; the unit of permutation.
BLOCK_TOKENS = 1 << 20
SEED = 17

_SECTIONS, _ROUNDS = 16, 6  # exponents tried at once, and how often: 16 ** -6 is below 1e-7
_DIGITS = 6


@dataclass(frozen=True)
class Mixture:
    """Exponent, budget in tokens, and a row per source: source, tokens, weight, quota, epochs."""

    exponent: float
    budget: int
    sources: DataFrame


def token_size(text: Column) -> Column:
    """Tokens of a text as the mixture counts them: words between white space. Null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _measures(totals: DataFrame, exponents: list[float]) -> list:
    """For each exponent: entropy of the weights over its largest value, and most repeats of a source
    when the least repeated one is dealt out once. One row per exponent comes to the driver, which sorts them."""
    tried = F.explode(F.array(*[F.lit(float(e)) for e in exponents])).alias("exponent")
    power = F.pow(F.col("tokens") / F.col("all_tokens"), F.col("exponent"))
    found = (
        totals.select("tokens", "all_tokens", tried)
        .withColumn("a", power)
        .withColumn("rate", F.col("a") / F.col("tokens"))
        .groupBy("exponent")
        .agg(
            F.sum("a").alias("z"), F.sum(F.col("a") * F.log("a")).alias("s"), F.count(F.lit(1)).alias("n"),
            F.max("rate").alias("fast"), F.min("rate").alias("slow"),
        )
        .select(
            "exponent",
            F.when(F.col("n") > 1, (F.log("z") - F.col("s") / F.col("z")) / F.log("n")).otherwise(1.0).alias("entropy"),
            (F.col("fast") / F.col("slow")).alias("spread"),
        )
        .collect()
    )
    return sorted(found, key=lambda r: r.exponent)


def _largest(totals: DataFrame, holds) -> float:
    """Largest exponent in [0, 1] at which ``holds``, which is true up to some exponent; 0 if nowhere.
    Bisection in 16 parts at once; the result is rounded down."""
    low, high = 0.0, 1.0
    for _ in range(_ROUNDS):
        step = (high - low) / _SECTIONS
        good = [r.exponent for r in _measures(totals, [low + step * k for k in range(_SECTIONS + 1)]) if holds(r)]
        low = max(good, default=low)
        if not good or low >= high - step / 2:
            break
        high = low + step
    return math.floor(low * 10**_DIGITS) / 10**_DIGITS


def plan(
    sized: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float | None = MAX_REPEATS,
    budget: int | None = None,
) -> Mixture:
    """Weights, quotas and epochs of the sources of ``sized`` (source, n_tokens).

    Without ``budget`` the mixture is as small as it can be with every document in it: the source that
    is repeated least is dealt out exactly once. Sources without tokens are dealt out once and take
    nothing from the budget.
    """
    per_source = materialize(
        sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")),
        "mix-sources",
    )
    filled = per_source.where(F.col("tokens") > 0)
    everything = filled.agg(F.sum("tokens")).first()[0] or 0
    totals = filled.withColumn("all_tokens", F.lit(float(everything or 1)))
    exponent = 1.0
    if everything:
        exponent = _largest(totals, lambda r: r.entropy >= target_entropy)
        if max_repeats is not None:
            # repeats fall as the exponent grows: the smallest allowed is past the largest forbidden
            if _measures(totals, [exponent])[0].spread > max_repeats:
                exponent = min(1.0, round(_largest(totals, lambda r: r.spread > max_repeats) + 10.0**-_DIGITS, _DIGITS))
    share = F.col("tokens") / F.lit(float(everything or 1))
    power = F.when(F.col("tokens") > 0, F.pow(share, F.lit(exponent)))
    powered = per_source.withColumn("power", power)
    top = powered.agg(F.sum("power"), F.max(F.col("tokens") / F.col("power"))).first()
    z, widest = top[0] or 1.0, top[1] or 0.0
    total = round(widest * z) if budget is None else budget
    quota = F.coalesce(F.round(F.col("power") / F.lit(z) * F.lit(float(total))).cast("long"), F.lit(0).cast("long"))
    if budget is None:
        quota = F.greatest(quota, F.col("tokens"))
    sources = powered.select(
        "source", "tokens", "docs", F.coalesce(F.col("power") / F.lit(z), F.lit(0.0)).alias("weight"),
        quota.alias("quota"),
    ).withColumn(
        "epochs",
        F.when(F.col("tokens") > 0, F.ceil(F.col("quota") / F.col("tokens"))).otherwise(F.lit(1)).cast("int"),
    ).withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("long"))
    return Mixture(exponent, int(total), sources)


def _shuffled(*parts: Column | str) -> Column:
    """A pseudo-random order: md5 of the parts."""
    return F.md5(F.concat_ws(":", *[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts]).cast("binary"))


def schedule(sized: DataFrame, mixture: Mixture, seed: int = SEED) -> DataFrame:
    """Every document as often as the mixture deals it out.

    One row per document and epoch: doc_id, source, n_tokens, epoch (from 1), block, slot (the block's
    place in the epoch) and source_offset (tokens of the source dealt out before the block). Sorting
    by source_offset / quota interleaves the sources at their weights. Documents whose order ties
    (repeated rows) are dealt out alike.
    """
    salt = F.lit(str(seed))
    key = _shuffled(salt, F.col("doc_id").cast("string"))
    sources = mixture.sources
    placed = materialize(
        sized.join(sources.select(F.col("source").alias("s"), "blocks"), F.col("source").eqNullSafe(F.col("s")))
        .select(
            "doc_id", "source", "n_tokens",
            (F.conv(F.substring(key, 1, 8), 16, 10).cast("long") % F.col("blocks")).alias("block"),
        ),
        "mix-docs",
    )
    blocks = (
        placed.groupBy("source", "block")
        .agg(F.sum("n_tokens").alias("block_tokens"))
        .join(
            sources.select(F.col("source").alias("s"), "tokens", "quota", "epochs"),
            F.col("source").eqNullSafe(F.col("s")),
        )
        .where(F.col("epochs") > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("epochs"))))
        .withColumn("deal", _shuffled(salt, F.col("epoch").cast("string"), F.col("block").cast("string")))
    )
    epoch = Window.partitionBy("source", "epoch").orderBy("deal", "block")
    dealt = blocks.select(
        F.col("source").alias("s"), F.col("block").alias("b"), "epoch", "block_tokens",
        F.row_number().over(epoch).cast("long").alias("slot"),
        ((F.col("epoch") - 1) * F.col("tokens") + F.coalesce(
            F.sum("block_tokens").over(epoch.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )).alias("source_offset"),
        "quota",
    ).where(
        (F.col("source_offset") < F.col("quota"))
        | (F.col("source_offset") + F.col("block_tokens") <= F.col("quota"))  # a block of empty documents
    )
    rows = placed.join(
        dealt, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))
    ).select("doc_id", "source", "n_tokens", "epoch", "block", "slot", "source_offset",
             (F.col("quota") - F.col("source_offset")).alias("room"), "block_tokens")
    whole = rows.where(F.col("block_tokens") <= F.col("room"))
    # The block in which a source's budget ends: its documents in hash order, up to the budget.
    inside = Window.partitionBy("source", "epoch", "block").orderBy(
        _shuffled(salt, F.col("epoch").cast("string"), F.col("doc_id").cast("string")), "n_tokens"
    )
    cut = (
        rows.where(F.col("block_tokens") > F.col("room"))
        .withColumn("before", F.coalesce(F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .where(F.col("before") < F.col("room"))
        .drop("before")
    )
    return whole.unionByName(cut).drop("room", "block_tokens")


def mix(
    docs: DataFrame, text_col: str = "text", target_entropy: float = TARGET_ENTROPY,
    max_repeats: float | None = MAX_REPEATS, budget: int | None = None, seed: int = SEED,
) -> DataFrame:
    """The schedule of ``docs`` (doc_id, source and a text column; others are not read).

    A null source is a source of its own; null and empty texts have no tokens and go with their block;
    a null id is hashed as the empty text. An empty table gives an empty schedule.
    """
    sized = materialize(
        docs.select("doc_id", "source", token_size(F.col(text_col)).alias("n_tokens")), "mix-sized"
    )
    return schedule(sized, plan(sized, target_entropy, max_repeats, budget), seed)
