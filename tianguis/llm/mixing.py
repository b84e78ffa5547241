"""Temperature mixing of sources.

Every source has a share p of the tokens. Its weight in the mix is p ** x over the sum of these, where x is
found by bisection: 1 keeps the shares, 0 makes all sources equal. The target is an entropy of the mix (as a
part of the largest possible), or a limit on how often a source is repeated. The weights become budgets of
tokens, and the budgets become blocks: each block is a permutation of an equal part of every source's stream.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tianguis.llm.common import stored

SEED = 17
#: Ranges of permutation keys that are summed before a border is looked for inside one of them.
RANGES = 4096
#: Sources whose weights may be broadcast; with more of them the weights are joined by a shuffle.
FEW_SOURCES = 10_000
HALVINGS = 60


@dataclass(frozen=True)
class Target:
    """entropy: part of log(number of sources) to reach; repeats: most epochs of a source while no source gets
    less than ``least`` epochs; the first that is given is used. block_tokens: mean size of a block."""

    repeats: float | None = 2.0
    entropy: float | None = None
    least: float = 1.0
    block_tokens: int = 1 << 22


def _share(column: str, exponent: float):
    return F.exp(exponent * F.log(column))


def _entropy(sources: DataFrame, exponent: float) -> float:
    """Entropy of the mix as a part of the largest possible; one distributed sum."""
    row = sources.select(_share("share", exponent).alias("q")).agg(
        F.sum("q").alias("z"), F.sum(F.col("q") * F.log("q")).alias("s"), F.count("*").alias("n")
    ).first()
    return 1.0 if row["n"] < 2 else (math.log(row["z"]) - row["s"] / row["z"]) / math.log(row["n"])


def exponent(sources: DataFrame, target: Target) -> float:
    """The largest exponent from 0 to 1 that meets the entropy, or the smallest that meets the repetition
    limit, by bisection. A source's epochs are weight times budget over its tokens, so they fall with its
    share: the smallest source is repeated most and the largest least."""
    if target.entropy is not None:
        def meets(x):
            return _entropy(sources, x) >= target.entropy
        low, high, toward_one = 0.0, 1.0, True
    else:
        row = sources.agg(F.min("share").alias("small"), F.max("share").alias("large")).first()
        if row["small"] is None:
            return 1.0

        def meets(x):
            return target.least * math.exp((x - 1) * (math.log(row["small"]) - math.log(row["large"]))) <= target.repeats
        low, high, toward_one = 0.0, 1.0, False
    if meets(0.0) and not toward_one:
        return 0.0
    if toward_one and meets(1.0):
        return 1.0
    for _ in range(HALVINGS if target.entropy is None else 30):
        middle = (low + high) / 2
        if meets(middle) == toward_one:
            low = middle
        else:
            high = middle
    return low if toward_one else high


def _joined(big: DataFrame, small: DataFrame, count: int) -> DataFrame:
    """Bring a few columns by source to many rows: broadcast behind the count, else a salted shuffle join."""
    if count <= FEW_SOURCES:
        return big.join(F.broadcast(small), "source_key")
    salts = F.explode(F.sequence(F.lit(0), F.lit(63)))
    return big.withColumn("salt", F.pmod(F.xxhash64("doc_id", "pick"), F.lit(64)).cast("int")).join(
        small.withColumn("salt", salts), ["source_key", "salt"]
    ).drop("salt")


def weights(light: DataFrame, target: Target) -> DataFrame:
    """(source_key, tokens, share, weight, epochs, quota, full, rest) for each source of ``light``
    (source_key, tokens): epochs is how often its stream is read, quota its budget of tokens, full the whole
    epochs and rest the tokens of the last one. Sources without tokens get one epoch and no weight."""
    sums = light.groupBy("source_key").agg(F.sum("tokens").alias("tokens"))
    total = light.agg(F.sum("tokens")).scalar()
    sources = stored(sums.withColumn("share", F.when(F.col("tokens") > 0, F.col("tokens") / total)))
    known = sources.where("tokens > 0")
    x = exponent(known, target)
    scale = known.agg(F.sum(_share("share", x)).alias("z"), F.max("share").alias("large")).first()
    z, large = scale["z"] or 1.0, scale["large"] or 1.0
    weight = F.coalesce(_share("share", x) / z, F.lit(0.0))
    epochs = F.coalesce(F.lit(target.least) * F.exp((x - 1) * (F.log("share") - math.log(large))), F.lit(1.0))
    out = sources.withColumn("weight", weight).withColumn("epochs", epochs)
    out = out.withColumn("quota", F.floor(F.col("epochs") * F.col("tokens") + 0.5)).withColumn(
        "full", F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1)
    )
    return stored(out.withColumn("rest", F.col("quota") - F.col("full") * F.col("tokens")))


def permutation_key(seed: int = SEED):
    """The place of a row in the permutation of its source."""
    return F.xxhash64(F.lit(seed), "doc_id", F.coalesce(F.col("source"), F.lit("")), F.length("text"))


def mix(docs: DataFrame, target: Target | None = None, seed: int = SEED) -> DataFrame:
    """The columns of ``docs`` (doc_id, text and source needed) for every use of a row in the mix, with
    __source_weight, __epochs, __epoch, __block, __slot.

    Epochs before the last hold every row of their source once; the last holds the first rows of the source's
    permutation, up to the row that reaches the quota. A row's place in the stream of its source is the number of
    tokens before it, over all epochs. Every block has the same budget of tokens of a source and takes the rows that
    begin within it, so it holds its budget up to one row; the order inside a block is __slot. Tokens are words parted
    by white space. A null source is a source of its own; null and empty texts have no tokens and count in whole
    epochs; repeated rows are rows of their own, each with its own place; an empty table gives an empty mix. Names
    that start with two underscores are reserved for the result.

    Places are summed inside one of 4,096 ranges of permutation keys of a source, and added to the sums of the
    ranges before, so no source is ordered as a whole.
    """
    target = target or Target()
    pick = permutation_key(seed)
    key = F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit("")))
    tokens = F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("bigint")
    part = F.shiftright("pick", 52) + RANGES // 2
    light = docs.select(key.alias("source_key"), pick.alias("pick"), tokens.alias("tokens"))
    ranges = stored(light.groupBy("source_key", part.alias("part")).agg(F.sum("tokens").alias("tokens")))
    plan = weights(ranges.select("source_key", "tokens"), target)
    facts = plan.agg(F.count("*").alias("sources"), F.sum("quota").alias("budget")).first()
    blocks = max(1, round((facts["budget"] or 0) / target.block_tokens))

    before = F.sum("tokens").over(Window.partitionBy("source_key").orderBy("part")) - F.col("tokens")
    ranges = ranges.select("source_key", "part", before.alias("before"))
    rows = docs.select(
        F.struct("*").alias("row"), "doc_id", key.alias("source_key"), pick.alias("pick"), tokens.alias("row_tokens"), F.xxhash64("text").alias("hash")
    ).withColumn("part", part)
    order = Window.partitionBy("source_key", "part").orderBy("pick", "doc_id", "hash").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("seen", F.coalesce(F.sum("row_tokens").over(order), F.lit(0))).join(ranges, ["source_key", "part"])
    rows = _joined(rows, plan.select("source_key", "tokens", "weight", "epochs", "full", "rest", "quota"), facts["sources"])
    start = F.col("before") + F.col("seen")
    uses = F.col("full") + (start < F.col("rest")).cast("int")
    rows = rows.where(uses > 0).withColumn("__epoch", F.explode(F.sequence(F.lit(1), uses.cast("int"))))
    place = ((F.col("__epoch") - 1) * F.col("tokens") + start).cast("decimal(28,0)")
    inside = F.least(F.floor(place * blocks / F.col("quota").cast("decimal(20,0)")).cast("bigint"), F.lit(blocks - 1).cast("bigint"))
    return rows.select(
        "row.*",
        F.col("weight").alias("__source_weight"),
        F.col("epochs").alias("__epochs"),
        "__epoch",
        F.when(F.col("quota") > 0, inside).otherwise(F.pmod("pick", F.lit(blocks))).alias("__block"),
        F.xxhash64(F.lit(seed + 1), "__epoch", "pick").alias("__slot"),
    )
