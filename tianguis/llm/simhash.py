"""SimHash near-duplicates: fingerprints of word shingles, linked through a table of distances to pivots.

Every distinct fingerprint gets a row of Hamming distances to many reference fingerprints (pivots). Two
fingerprints at distance d differ by at most d in every coordinate of that table, so a pair whose largest
coordinate difference is above the limit is discarded without looking at its bits; survivors are verified.
Pairs are looked for only among fingerprints that agree on three of six blocks of bits: with at most three
differing bits, at least three blocks are untouched, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tianguis.llm.common import stored, texts_of
from tianguis.llm.components import LINK, connected_components, spanning

SEED = 42
PIVOTS = 24
#: A larger group of one key is linked through common neighbours instead of by comparing its pairs.
LARGE_GROUP = 256
#: Shingles whose bits are counted at a time.
PART = 1 << 16


def shingle_fingerprint(text: str, shingle: int = 3) -> bytes:
    """Eight bytes, highest first: a bit is set if it is set in over half of the shingles' XXH64."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return bytes(8)
    count, ones, digest, join = max(1, len(words) - shingle + 1), np.zeros(64, np.int64), xxhash.xxh64_digest, b" ".join
    for start in range(0, count, PART):
        hashes = b"".join([digest(join(words[i : i + shingle]), SEED) for i in range(start, min(count, start + PART))])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > count).tobytes()


def fingerprints(docs: DataFrame, shingle: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and fp of every row of ``docs`` (``keep`` and text); fp is the fingerprint as a signed 64-bit integer.
    Null text counts as empty: fingerprint zero."""
    kept = docs.select(*[F.col(c).cast("bigint").alias(c) for c in keep], "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = b"".join(shingle_fingerprint(t, shingle) for t in texts_of(batch.column(len(keep))))
            fps = np.frombuffer(found, ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(fps)], [*keep, "fp"])

    return kept.mapInArrow(run, ", ".join(f"{c} bigint" for c in (*keep, "fp")))


def key_masks(distance: int, bits: int = 64) -> list[int]:
    """Masks of which every two fingerprints within ``distance`` agree on at least one."""
    blocks = 2 * distance if distance > 1 else distance + 2
    edges = [bits * i // blocks for i in range(blocks + 1)]
    block = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(block[i] for i in chosen) for chosen in combinations(range(blocks), blocks - distance)]


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: fixed, spread over the space, the same on every executor."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(4, "little"), SEED) for i in range(count)], np.uint64)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _keyed(masks: np.ndarray):
    """(k, key, node, fp, near) for every mask: near holds the distances to the pivots, a byte each."""
    references = pivots()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, fp = (np.asarray(batch.column(i), dtype=np.int64) for i in (0, 1))
            near = np.bitwise_count(fp.view(np.uint64)[:, None] ^ references[None, :]).astype(np.uint8)
            rows = pa.array([x.tobytes() for x in near], pa.binary())
            for k, mask in enumerate(masks):
                columns = [pa.array(np.full(len(fp), k, np.int32)), pa.array(fp & mask), pa.array(node), pa.array(fp), rows]
                yield pa.RecordBatch.from_arrays(columns, ["k", "key", "node", "fp", "near"])

    return run


def _link_groups(masks: np.ndarray, distance: int, large: int):
    """Links inside the groups of one key, read in the order of (k, key); rows of groups above ``large`` are
    passed on as (node, null, fp)."""

    def pairs(k, node, fp, near, group):
        found = []
        for shift in range(1, len(fp)):
            same = np.flatnonzero(group[shift:] == group[:-shift])
            if not len(same):
                break
            other = same + shift
            apart = np.abs(near[same].astype(np.int16) - near[other]).max(axis=1) <= distance
            same, other = same[apart], other[apart]
            close = np.bitwise_count((fp[same] ^ fp[other]).view(np.uint64)) <= distance
            same, other = same[close], other[close]
            differ = fp[same] ^ fp[other]
            first = np.ones(len(same), bool)  # a pair counts under the first mask on which it agrees
            for j, mask in enumerate(masks):
                first &= ((differ & mask) != 0) | (k[same] <= j)
            found.append(np.stack([node[same[first]], node[other[first]]]))
        return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)

    def out(a, b, fp):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b, fp], ["a", "b", "fp"])

    def members(node, fp):
        return out(node, pa.nulls(len(node), pa.int64()), pa.array(fp, pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, passing = None, None  # the unfinished last group; the key of a large group whose rows pass on
        for batch in batches:
            columns = [np.asarray(batch.column(i)) for i in range(4)]
            columns.append(np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(batch.num_rows, -1))
            if rest is not None:
                columns = [np.concatenate([x, y]) for x, y in zip(rest, columns, strict=True)]
            k, key, node, fp, near = columns
            if passing is not None:
                end = int(np.argmin(np.append((k == passing[0]) & (key == passing[1]), False)))
                if end:
                    yield members(node[:end], fp[:end])
                if end == len(k):
                    rest = None
                    continue
                passing, (k, key, node, fp, near) = None, (x[end:] for x in (k, key, node, fp, near))
            new = np.append(True, (k[1:] != k[:-1]) | (key[1:] != key[:-1]))
            group, starts = np.cumsum(new) - 1, np.flatnonzero(new)
            size = np.diff(np.append(starts, len(k)))
            last = starts[-1]
            whole = (np.arange(len(k)) < last) & (size[group] <= large)
            many = (np.arange(len(k)) < last) & (size[group] > large)
            if size[-1] > large:
                many[last:], passing, rest = True, (k[last], key[last]), None
            else:
                rest = [x[last:] for x in (k, key, node, fp, near)]
            if many.any():
                yield members(node[many], fp[many])
            a, b = pairs(*(x[whole] for x in (k, node, fp, near, group)))
            if len(a):
                a, b = spanning(a, b)
                yield out(a, pa.array(b, pa.int64()), pa.nulls(len(a), pa.int64()))
        if rest is not None and len(rest[0]) > 1:
            k, _, node, fp, near = rest
            a, b = pairs(k, node, fp, near, np.zeros(len(k), np.int64))
            if len(a):
                a, b = spanning(a, b)
                yield out(a, pa.array(b, pa.int64()), pa.nulls(len(a), pa.int64()))

    return run


def _neighbours(distance: int):
    """(at, far, node): every bit string within distance - distance // 2 of a fingerprint; far is 0 where it is
    within distance // 2 too."""
    near, far = distance // 2, distance - distance // 2
    changes = [(n, sum(1 << b for b in chosen)) for n in range(far + 1) for chosen in combinations(range(64), n)]
    flips, beyond = _signed([c for _, c in changes]), np.array([n > near for n, _ in changes], np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, fp = (np.asarray(batch.column(i), dtype=np.int64) for i in (0, 1))
            for i in range(0, len(fp), 64):
                at = (fp[i : i + 64, None] ^ flips[None, :]).ravel()
                columns = [at, np.tile(beyond, len(fp[i : i + 64])), np.repeat(node[i : i + 64], len(flips))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["at", "far", "node"])

    return run


def _link_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order (at, far, node): every row links to the first of its ``at`` if that one is not far."""
    at_before, hub_before, good_before = None, 0, False
    for batch in batches:
        at, far, node = (np.asarray(batch.column(i), dtype=np.int64) for i in range(3))
        new = np.append(at_before is None or at[0] != at_before, at[1:] != at[:-1])
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        hubs, good = node[starts], far[starts] == 0
        if not new[0]:
            hubs, good, group = np.append(hub_before, hubs), np.append(good_before, good), group + 1
        linked = good[group] & (node != hubs[group])
        at_before, hub_before, good_before = at[-1], hubs[-1], good[-1]
        if linked.any():
            a, b = spanning(node[linked], hubs[group][linked])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def links_within(nodes: DataFrame, distance: int = 3, large_group: int = LARGE_GROUP) -> DataFrame:
    """Links (a, b) that connect exactly what pairs of ``nodes`` (node, fp; distinct fp) at most ``distance``
    bits apart connect.

    A group of one key above ``large_group`` is not compared pairwise. Each of its fingerprints names all bit
    strings within the larger half of the distance; a string that some fingerprint reaches within the smaller
    half links all that name it. That is exact, and linear in the group.
    """
    masks = _signed(key_masks(distance))
    keyed = nodes.select("node", "fp").mapInArrow(_keyed(masks), "k int, key bigint, node bigint, fp bigint, near binary")
    groups = keyed.repartition("k", "key").sortWithinPartitions("k", "key", "fp")
    found = stored(groups.mapInArrow(_link_groups(masks, distance, large_group), f"{LINK}, fp bigint"))
    members = found.where("fp is not null").select(F.col("a").alias("node"), "fp").distinct()
    named = members.mapInArrow(_neighbours(distance), "at bigint, far int, node bigint")
    named = named.repartition("at").sortWithinPartitions("at", "far", "node")
    return found.where("fp is null").select("a", "b").union(named.mapInArrow(_link_neighbours, LINK))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, large_group: int = LARGE_GROUP) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text; other columns are ignored).

    fingerprint: 16 lowercase hex digits. Fingerprints at most ``distance`` bits apart are linked;
    component_id is the smallest doc_id that links reach, the row's own included. Null text counts as empty;
    empty texts share fingerprint zero, which links like any other. Repeated rows are returned each. A row
    with a null doc_id gets its fingerprint, and the component of that fingerprint if another row has an id.
    An empty table gives an empty result.
    """
    marked = stored(fingerprints(docs, shingle))
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null")
    roots = connected_components(links_within(nodes, distance, large_group))
    classes = stored(
        nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    )
    return marked.join(classes, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def distinct_documents(docs: DataFrame, shingle: int = 3, distance: int = 3, large_group: int = LARGE_GROUP) -> DataFrame:
    """One row of each group of near copies in ``docs`` (doc_id and text needed), with all its columns.

    Rows are grouped by the links of their fingerprints, whatever their ids, so texts without a link are never taken
    for copies because an id repeats, and rows without a doc_id are grouped like any other. The row with the smallest
    doc_id stays, null ids last, ties by the text's hashes; of rows that repeat id and text one stays. An empty table
    gives an empty result. Names that start with two underscores are reserved.
    """
    text = F.coalesce("text", F.lit(""))
    marks = {"__id": F.col("doc_id").cast("bigint"), "__one": F.xxhash64(text), "__two": F.xxhash64(F.lit(SEED), text)}
    ident = list(marks)
    marked = stored(fingerprints(docs.select(*[c.alias(n) for n, c in marks.items()], "text"), shingle, tuple(ident)))
    nodes = marked.select(F.col("fp").alias("node"), "fp").distinct()
    roots = connected_components(links_within(nodes, distance, large_group))
    groups = marked.join(roots, F.col("fp") == F.col("node"), "left").withColumn("group", F.coalesce("root", "fp"))
    first = Window.partitionBy("group").orderBy(F.col("__id").asc_nulls_last(), "__one", "__two")
    kept = groups.withColumn("n", F.row_number().over(first)).where("n = 1").select(*[F.col(c).alias(f"k{c}") for c in ident])
    rows = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in marks.items()])
    same = [F.col(c).eqNullSafe(F.col(f"k{c}")) for c in ident]
    once = Window.partitionBy(*ident).orderBy("__one")
    found = rows.join(kept, same[0] & same[1] & same[2]).withColumn("n", F.row_number().over(once)).where("n = 1")
    return found.select("row.*")
