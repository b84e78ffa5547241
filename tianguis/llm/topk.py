"""Exact top-k by inner product, a term at a time.

Vectors are sparse rows of integers. A block of candidates is kept as postings: for each term, the rows that
hold it and their weights. A query adds its weight times each posting of each of its terms to a dense array of
scores; the best k of the block are selected by partition, and the blocks' lists are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tianguis.llm.common import stored

SCALE = 1024
#: Candidates and queries of one block; a task holds a block of each, and scores for SLICE queries.
CANDIDATES, QUERIES, SLICE = 1 << 14, 1 << 10, 16
#: Blocks of candidates are dealt into so many slots, and every query block goes to each slot in use.
SLOTS = 4096
#: The largest score.
LIMIT = (1 << 63) - 1

BLOCK = "block bigint, rows binary, ids binary, lengths binary, terms binary, weights binary"


def vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, weights): floor(scale * x) of every component, for rows whose vector is all finite.

    row numbers rows, since vec_id may repeat. Components beyond 64 bits are held at its limits, as scores are.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))  # NaN is the largest of all
    limit = 2.0**63 - 1024
    whole = F.transform(x, lambda v: F.least(F.greatest(F.floor(v * scale).cast("double"), F.lit(-limit)), F.lit(limit)).cast("bigint"))
    return embeddings.where("vec_id is not null and embedding is not null").where(finite).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("weights")
    )


def _blocks(size: int):
    """Pack consecutive rows of a task as sparse blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0
        number = None

        def pack():
            rows, ids, lengths, terms, weights = (np.concatenate([h[i] for h in held]) for i in range(5))
            columns = [pa.array([x.tobytes()], pa.binary()) for x in (rows, ids, lengths, terms, weights)]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *columns], ["block", "rows", "ids", "lengths", "terms", "weights"])

        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                rows, ids = (np.asarray(part.column(i), dtype=np.int64) for i in (0, 1))
                column = part.column(2)
                counts = np.diff(np.asarray(column.offsets))
                values = np.asarray(column.flatten(), dtype=np.int64)
                term = np.arange(len(values)) - np.repeat(np.cumsum(counts) - counts, counts)
                used = values != 0
                owner = np.repeat(np.arange(len(rows)), counts)[used]
                if count and count + len(rows) > size:
                    yield pack()
                    held, count, number = [], 0, None
                if number is None:
                    number = int(rows[0])
                held.append((rows, ids, np.bincount(owner, minlength=len(rows)).astype(np.int64), term[used].astype(np.int32), values[used]))
                count += len(rows)
        if held:
            yield pack()

    return run


def postings(lengths: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term, where its postings start, row of each posting, weight of each posting), by term."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(terms, kind="stable")
    found, starts = np.unique(terms[order], return_index=True)
    return found, np.append(starts, len(order)), owner[order], weights[order]


def dense(starts: np.ndarray, rows: np.ndarray, weights: np.ndarray, count: int) -> dict[int, np.ndarray]:
    """The postings that most rows are in, as weights of all rows: they are added faster, and are at most twice as large."""
    out = {}
    for s in np.flatnonzero(2 * np.diff(starts) > count).tolist():
        out[s] = np.zeros(count, np.int64)
        out[s][rows[starts[s] : starts[s + 1]]] = weights[starts[s] : starts[s + 1]]
    return out


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores outside ``own``, ties to the smaller id, in order."""
    take = np.flatnonzero(~own)
    if len(take) > k:
        value = scores[take]
        least = np.partition(value, len(value) - k)[len(value) - k]
        take = take[value >= least]
    return take[np.lexsort((ids[take], ~scores[take]))][:k]


def beyond(q: dict[str, np.ndarray], c: dict[str, np.ndarray]) -> bool:
    """Whether a score of these blocks might not fit 64 bits: sums wrap, and only the true value tells."""
    most = [float(np.abs(x["weights"].astype(float)).max(initial=0.0)) for x in (q, c)]
    return most[0] * most[1] * float(q["lengths"].max(initial=0)) >= 2.0**62


FOUND = "query_row bigint, query_id bigint, vec_id bigint, score bigint"


def _score(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                q, c = ({n: np.frombuffer(pair[side + n], np.int32 if n == "terms" else np.int64) for n in ("rows", "ids", "lengths", "terms", "weights")} for side in ("q_", "c_"))
                found, starts, rows, weights = postings(c["lengths"], c["terms"], c["weights"])
                full = dense(starts, rows, weights, len(c["ids"]))
                ends = np.cumsum(q["lengths"])
                large = beyond(q, c)
                out = []
                for i in range(0, len(ends), SLICE):
                    last = min(i + SLICE, len(ends))
                    scores = np.zeros((last - i, len(c["ids"])), np.int64)
                    for j in range(i, last):
                        line, rough = scores[j - i], np.zeros(len(c["ids"]) if large else 0)
                        terms = q["terms"][ends[j] - q["lengths"][j] : ends[j]]
                        slot = np.searchsorted(found, terms)
                        for t, s, w in zip(terms, slot, q["weights"][ends[j] - q["lengths"][j] : ends[j]], strict=True):
                            if s < len(found) and found[s] == t:
                                a, b = starts[s], starts[s + 1]
                                if s in full:
                                    line += w * full[s]
                                else:
                                    line[rows[a:b]] += w * weights[a:b]
                                if large:
                                    rough[rows[a:b]] += float(w) * weights[a:b]
                        if large:  # a sum that wrapped on the way is right again at its end, unless the end is beyond
                            line[rough >= 2.0**63] = LIMIT
                            line[rough <= -(2.0**63)] = -LIMIT
                        top = best(line, c["ids"], c["rows"] == q["rows"][j], k)
                        out.append((np.full(len(top), q["rows"][j]), np.full(len(top), q["ids"][j]), c["ids"][top], line[top]))
                if out:
                    columns = [np.concatenate([o[n] for o in out]) for n in range(4)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["query_row", "query_id", "vec_id", "score"])

    return run


def top_k(embeddings: DataFrame, k: int = 10, every: int = 100, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by ``every``, the k rows of highest
    inner product but itself; all, if there are fewer.

    Scores are exact 64-bit integers, held at the limits of these where they would be beyond; ties go to the smaller vec_id. Rows with a null id, a null vector, or a
    null or non-finite component take no part; an empty vector scores 0 with all; missing components count as
    0. A row that repeats a query's id is a query and a candidate of its own. An empty table gives an empty
    result. Queries meet all rows block by block: what is shuffled is a block of queries for each slot of candidate
    blocks, and k results for each query and block.
    """
    rows = stored(vectors(embeddings, scale))
    candidates = rows.mapInArrow(_blocks(CANDIDATES), BLOCK)
    queries = rows.where(F.col("vec_id") % every == 0).mapInArrow(_blocks(QUERIES), BLOCK)
    candidates = stored(candidates.toDF("c_block", *[f"c_{n}" for n in ("rows", "ids", "lengths", "terms", "weights")]))
    queries = queries.toDF("q_block", *[f"q_{n}" for n in ("rows", "ids", "lengths", "terms", "weights")])
    candidates = candidates.withColumn("slot", F.pmod(F.xxhash64("c_block"), F.lit(SLOTS)))
    used = candidates.agg(F.collect_set("slot")).scalar()  # at most SLOTS numbers
    spread = queries.withColumn("slot", F.explode(used))
    pairs = candidates.join(spread, "slot").select(*[f"{s}_{n}" for s in "qc" for n in ("rows", "ids", "lengths", "terms", "weights")])
    scored = pairs.mapInArrow(_score(k), FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
