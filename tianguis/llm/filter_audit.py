"""What each filter removes in every order in which the filters could be applied.

Documents are reduced to the set of filters they fail, and counted by part and set. The sets of filters already
applied form a lattice; applying one more is an edge. How many documents an edge removes depends on the set alone,
not on the order in which it was reached, so the 120 orders of five filters share 80 edges. Counting forward how many
orders reach a state and backward how many leave it gives the number of orders through each edge: the weight of its
removals in the Shapley sums. The steps of every order are read from the same edges.
"""

from __future__ import annotations

from collections import Counter
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The filters, in the order of their bits.
FILTERS = "ABCDE"

# What a word is, and the characters that filter D looks for.
WORD = r"[^\x20\x09-\x0D]+"
SIGNS = r"[#$%&*|]"


def states(filters: str = FILTERS) -> tuple[Counter, Counter]:
    """How many orders reach each set of applied filters from none, and how many lead from it to all of them."""
    everything = (1 << len(filters)) - 1
    reach, leave = Counter({0: 1}), Counter({everything: 1})
    for state in range(everything + 1):
        for bit in range(len(filters)):
            if not state >> bit & 1:
                reach[state | 1 << bit] += reach[state]
    for state in range(everything, -1, -1):
        for bit in range(len(filters)):
            if state >> bit & 1:
                leave[state & ~(1 << bit)] += leave[state]
    return reach, leave


def edges(filters: str = FILTERS) -> list[tuple[int, int, int, list[tuple[str, int]]]]:
    """(state, filter bit, orders through the edge, the (order, step) pairs that use it)."""
    reach, leave = states(filters)
    used: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order in permutations(range(len(filters))):
        name, state = "".join(filters[bit] for bit in order), 0
        for step, bit in enumerate(order, 1):
            used.setdefault((state, bit), []).append((name, step))
            state |= 1 << bit
    return [(s, b, reach[s] * leave[s | 1 << b], steps) for (s, b), steps in sorted(used.items())]


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text alone."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {
        "A": F.size(words) < 50,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 65,
        "C": capitals * 100 > F.char_length(text) * 5,
        "D": text.rlike(SIGNS),
    }


def failure_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): documents counted by source and set of failed filters.

    Only digests of texts travel. Rows are counted by doc_id, source and digest first, then by digest and source, so a
    text that a third of all documents share is a handful of rows when its smallest doc_id is looked up.
    """
    text = F.coalesce("text", F.lit(""))
    failed = text_failures(text)
    alone = sum((F.when(failed[f], 1 << FILTERS.index(f)).otherwise(0) for f in "BCD"), F.when(failed["A"], 1).otherwise(0))
    rows = (
        docs.select(
            F.col("doc_id").alias("id"),
            F.coalesce("source", F.lit("")).alias("part"),
            F.sha2(text.cast("binary"), 256).alias("digest"),
            alone.alias("alone"),
        )
        .groupBy("id", "part", "digest", "alone")
        .agg(F.count(F.lit(1)).alias("n"))
        # Rows without a doc_id have no label; they are spread by their digest.
        .withColumn("salt", F.when(F.col("id").isNull(), F.xxhash64("digest", "part")).otherwise(0))
    )
    marks = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("salt"))
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"))
    )
    marked = rows.join(marks, ["id", "salt"], "left").select(
        "id", "part", "digest", "alone", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("is_good", "is_toxic")]
    )
    by_text = marked.groupBy("digest", "alone", "part", "is_good", "is_toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("without_id"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"),
    )
    placed = by_text.withColumn("smallest", F.min("least.id").over(Window.partitionBy("digest")))
    firsts = F.when(F.col("least.id") == F.col("smallest"), F.col("least.n")).otherwise(0) + F.col("without_id")
    either = F.array(
        F.struct(F.col("alone").alias("failed"), firsts.alias("n")),
        F.struct((F.col("alone") + (1 << FILTERS.index("E"))).alias("failed"), (F.col("n") - firsts).alias("n")),
    )
    return (
        placed.select("part", "is_good", "is_toxic", F.explode(either).alias("cell"))
        .where("cell.n > 0")
        .groupBy("part", F.col("cell.failed").alias("failed"))
        .agg(
            F.sum("cell.n").alias("n"),
            F.sum(F.when(F.col("is_good"), F.col("cell.n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("is_toxic"), F.col("cell.n")).otherwise(0)).alias("toxic"),
        )
    )


def audit_sets(sets: DataFrame) -> DataFrame:
    """The audit of counted failure sets: at most 32 rows for each part go in, 600 come out."""
    step = "struct<filter_order: string, step: int>"
    edge_type = f"array<struct<state: int, bit: int, through: bigint, steps: array<{step}>>>"
    rows = ",".join(
        f"struct({s}, {b}, {n}L, array({','.join(f'''struct('{order}', {at})''' for order, at in steps)}))" for s, b, n, steps in edges()
    )
    crossed = sets.select("*", F.explode(F.expr(f"cast(array({rows}) as {edge_type})")).alias("edge"))
    state, bit = F.col("edge.state"), F.expr("1 << edge.bit")
    arrives = F.col("failed").bitwiseAND(state) == 0
    fails = F.col("failed").bitwiseAND(bit) != 0

    def total(which: Column, count: str = "n") -> Column:
        return F.sum(F.when(which, F.col(count)).otherwise(0))

    by_edge = crossed.groupBy("part", "edge").agg(
        total(arrives & ~fails).alias("kept"),
        total(arrives & fails).alias("removed"),
        total(~arrives & fails).alias("redundant"),
        total(F.col("failed") == bit).alias("unique_fails"),
        total(arrives & fails, "good").alias("good_lost"),
        total(arrives & fails, "toxic").alias("toxic_lost"),
    )
    # Sixteen edges apply the same filter.
    shapley = F.sum(F.col("edge.through") * F.col("removed")).over(Window.partitionBy("part", "edge.bit"))
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    weighted = by_edge.withColumn("shapley", shapley)
    return weighted.select("part", *counts, "shapley", F.explode("edge.steps").alias("at")).select(
        "part", "at.filter_order", "at.step", *counts, "shapley"
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each source, order of the five filters and step, with what the step keeps, removes and loses.

    Filters: A under 50 words; B under 65 distinct words in 100; C over 5 capitals in 100 code points; D a sign of
    ``SIGNS``; E the text of a smaller doc_id, anywhere in the table. A null text is empty, a null source is the empty
    one; a row without a doc_id never fails E and makes no other row fail it, nor do rows that repeat the doc_id of
    the first text; labels of a doc_id count if any of its label rows says so, null labels say nothing. Repeated rows
    count each. Other columns are ignored; an empty table gives an empty result.
    """
    return audit_sets(failure_sets(docs, labels))
