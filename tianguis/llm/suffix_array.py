"""Exact removal of repeated byte strings through suffix arrays built by the difference-cover algorithm.

A string of ``length`` bytes that starts at two places holds the same anchor at the same offset in both: the
smallest hash of its short substrings. So the windows of a document fall into runs that share an anchor, and
equal windows meet when runs are dealt out by their anchor's substring. Runs that are equal as a whole get one
name and only the first of a name goes on. Each task then builds suffix arrays of the runs it was dealt:
triples at two of three positions are sorted, the string of their names is solved by recursion, the remaining
suffixes are merged in, and neighbours in the array whose prefixes agree on ``length`` bytes are repeats.
An anchor with more different runs than a block holds is dealt out again: first by the halves of what its windows
share with it, then, should that still be too much, window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tianguis.llm.common import stored

LENGTH = 100
#: Bytes of the substrings whose hashes choose anchors.
GRAM = 24
#: Bytes of one suffix array.
BLOCK = 1 << 18
#: Bytes of a text that are hashed at a time.
PART = 1 << 20
NO_ID = -(2**63)

_U = np.uint64


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of positive integers by difference cover modulo 3; a shorter prefix sorts first."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    if n > 1 << 20:
        raise ValueError("a block holds at most 2**20 symbols")
    s = np.concatenate([s, np.zeros(3, s.dtype)]).astype(np.int64)
    base = int(s.max()) + 1
    if base > n + 2 and base**3 >= 2**62:  # large symbols: use their ranks
        s = np.concatenate([np.unique(s[:n], return_inverse=True)[1] + 1, np.zeros(3, np.int64)])
        base = int(s.max()) + 1
    first, second = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)  # a dummy keeps the parts comparable
    sampled = np.concatenate([first, second])
    triple = (s[sampled] * base + s[sampled + 1]) * base + s[np.minimum(sampled + 2, n + 2)]
    order = np.argsort(triple, kind="stable")
    names = np.empty(len(sampled), np.int64)
    names[order] = np.cumsum(np.append(True, triple[order][1:] != triple[order][:-1]))
    if names.max() < len(sampled):
        order = suffix_array(names)
    rank = np.zeros(n + 4, np.int64)
    rank[sampled[order]] = np.arange(1, len(order) + 1)
    cover = sampled[order]
    cover = cover[cover < n]
    rest = np.arange(0, n, 3)
    top = n + 4
    rest_key = s[rest] * top + rank[rest + 1]
    order = np.argsort(rest_key, kind="stable")
    rest, rest_key = rest[order], rest_key[order]
    one, two = cover[cover % 3 == 1], cover[cover % 3 == 2]
    smaller = np.searchsorted(s[one] * top + rank[one + 1], rest_key)
    pair = (s[two] * base + s[two + 1]) * top + rank[two + 2]
    smaller += np.searchsorted(pair, (s[rest] * base + s[rest + 1]) * top + rank[rest + 2])
    out = np.empty(n, np.int64)
    at = smaller + np.arange(len(rest))
    free = np.ones(n, bool)
    free[at] = False
    out[at], out[free] = rest, cover
    return out


def _loads(data: bytes, count: int, offset: int) -> np.ndarray:
    return np.ndarray((count,), "<u8", buffer=data, offset=offset, strides=(1,))


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(first window, anchor, last window, anchor's hash) of every run of windows with one anchor."""
    count, width = len(data) - length + 1, length - gram + 1
    grams = len(data) - gram + 1
    h = _loads(data, grams, 0) * _U(0x9E3779B97F4A7C15)
    h ^= h >> _U(32)
    h += _loads(data, grams, 8)
    h *= _U(0xC2B2AE3D27D4EB4F)
    h ^= h >> _U(29)
    h += _loads(data, grams, 16)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    keyed = (h & _U(0xFFFFFFFF00000000)) | np.arange(grams, dtype=np.uint64)
    keyed = np.concatenate([keyed, np.full(-grams % width, ~_U(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(keyed, axis=1).ravel()
    behind = np.minimum.accumulate(keyed[:, ::-1], axis=1)[:, ::-1].ravel()
    best = (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & _U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, best[1:] != best[:-1]))
    return first, best[first], np.append(first[1:], count) - 1, h[best[first]].view(np.int64)


def _name(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data)


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


RUNS = "key bigint, name bigint, doc bigint, twin bigint, place bigint"
OPEN = "doc bigint, twin bigint, place bigint, key bigint, kind int"
CONTEXT = "key bigint, doc bigint, twin bigint, start bigint, anchor int, data binary"
FOUND = "doc bigint, twin bigint, start bigint, n bigint, key bigint, anchor int, data binary"
REPEAT, TO_SORT = 0, 1


def _batch(schema: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), [f.split()[0] for f in schema.split(", ")])


def _longs(batch: pa.RecordBatch, count: int) -> list[np.ndarray]:
    return [np.asarray(batch.column(i), dtype=np.int64) for i in range(count)]


def placed(start, count, anchor):
    return (start << 15) | (count << 8) | anchor


def _sent(held: list[np.ndarray]) -> pa.RecordBatch:
    """RUNS rows. One whose name came before among them is a repeat whatever else there is: its place is complemented
    and its key replaced, so that a text that all documents share does not fill one task."""
    rows = np.concatenate(held, axis=1)
    rows = rows[:, np.lexsort(rows[::-1])]
    same = rows[:, 1:] == rows[:, :-1]
    again = np.append(False, same[:2].all(axis=0) & ~same.all(axis=0))
    rows[0, again] = (rows[2, again] * 1_000_003) ^ (rows[4, again] * 7_368_787)
    rows[1, again] = rows[0, again]
    rows[4, again] = ~rows[4, again]
    return _batch(RUNS, *map(pa.array, rows))


def _runs(length: int, gram: int):
    """(key, name, doc, twin, place) for each run of windows; place packs its first window, how many there are and
    where its anchor is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[np.ndarray] = []
            size = 0
            for doc, twin, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data = (text or "").encode()
                for part in range(0, max(0, len(data) - length + 1), PART):
                    piece = data[part : part + PART + length - 1]
                    lo, at, hi, key = anchors(piece, length, gram)
                    name = _signed([_name(piece[i:j]) for i, j in zip(lo.tolist(), (hi + length).tolist(), strict=True)])
                    same = np.ones(len(lo), np.int64)
                    held.append(np.stack([key, name, same * doc, same * twin, placed(part + lo, hi - lo + 1, at - lo)]))
                    size += len(lo)
                    if size > 1 << 17:
                        yield _sent(held)
                        held, size = [], 0
            if held:
                yield _sent(held)

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of RUNS. A row whose name came before is a repeat; the first rows of names go on if
    their key has two names or more. Rows that are equal throughout count once."""
    before: np.ndarray | None = None
    kept: np.ndarray | None = None  # the first row of a key, until another name of the key comes
    seen: tuple[int, int] | None = None
    several = False

    def rows(found: np.ndarray, kind: int) -> pa.RecordBatch:
        key, _, doc, twin, place = found
        return _batch(OPEN, *map(pa.array, (doc, twin, place, key)), pa.array(np.full(len(key), kind, np.int32)))

    for batch in batches:
        x = np.stack(_longs(batch, 5))
        fresh = np.append(before is None or (x[:, 0] != before).any(), (x[:, 1:] != x[:, :-1]).any(axis=0))
        before = x[:, -1]
        known = x[:, fresh & (x[4] < 0)]
        if known.shape[1]:
            known[4] = ~known[4]
            yield rows(known, REPEAT)
        x = x[:, fresh & (x[4] >= 0)]
        if not x.shape[1]:
            continue
        key, name = x[0], x[1]
        again = np.append(seen == (key[0], name[0]), (key[1:] == key[:-1]) & (name[1:] == name[:-1]))
        if again.any():
            yield rows(x[:, again], REPEAT)
        firsts = x[:, ~again]
        old_key = seen[0] if seen is not None else None
        seen = (key[-1], name[-1])
        if not firsts.shape[1]:
            continue
        was_kept = kept is not None
        if was_kept:
            firsts = np.concatenate([kept, firsts], axis=1)
        k = firsts[0]
        differs = k[1:] != k[:-1]
        shared = np.append(False, ~differs) | np.append(~differs, False)
        if several and not was_kept and old_key is not None and k[0] == old_key:
            run = int(np.argmin(np.append(k == k[0], False)))
            shared[:run] = True
        open_end = not shared[-1]
        kept = firsts[:, -1:] if open_end else None
        several = not open_end
        if shared.any():
            yield rows(firsts[:, shared], TO_SORT)


def _contexts(length: int):
    """The bytes of runs: rows (doc, twin, text, runs) give CONTEXT rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, twin, text, runs in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                data = text.encode()
                for i in range(0, len(runs), 1 << 13):
                    rows = [(r["key"], r["place"] >> 15, r["place"] >> 8 & 127, r["place"] & 255) for r in runs[i : i + (1 << 13)]]
                    parts = [data[lo : lo + n + length - 1] for _, lo, n, _ in rows]
                    yield _batch(
                        CONTEXT, pa.array([r[0] for r in rows]), pa.array([doc] * len(rows)), pa.array([twin] * len(rows)),
                        pa.array([r[1] for r in rows]), pa.array([r[3] for r in rows], pa.int32()), pa.array(parts, pa.binary()),
                    )

    return run


def _common(rows: np.ndarray) -> np.ndarray:
    """Longest common prefix of each row with either neighbour."""
    differ = rows[1:] != rows[:-1]
    equal = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.maximum(np.append(equal, 0), np.append(0, equal))


def _side(key: np.ndarray, parts: list[bytes], width: int) -> np.ndarray:
    """How far each part agrees with its nearest neighbour of the same key in sorted order."""
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(len(parts), width)
    order = np.lexsort((np.ascontiguousarray(raw).view(f"S{width}").ravel(), key))
    out = np.empty(len(parts), np.int64)
    tagged = np.concatenate([key[order].view(np.uint8).reshape(-1, 8), raw[order]], axis=1)
    out[order] = np.maximum(_common(tagged) - 8, 0)
    return out


def repeats_in_block(key, doc, twin, start, anchor, data: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(doc, twin, start) of windows in these contexts that equal a window that starts earlier.

    Contexts of one key must all be here. Windows that agree with no neighbour of their key for long enough on
    both sides of the anchor are left out before the suffix array is built.
    """
    right = _side(key, [d[a:] for d, a in zip(data, anchor.tolist(), strict=True)], length)
    left = _side(key, [d[:a][::-1] for d, a in zip(data, anchor.tolist(), strict=True)], length)
    count = np.array([len(d) for d in data]) - length + 1
    lo = np.maximum(0, anchor - left)
    hi = np.minimum(count, anchor - (length - right) + 1)
    some = np.flatnonzero(lo < hi)
    empty = np.zeros(0, np.int64)
    if not len(some):
        return empty, empty, empty
    lo, hi = lo[some], hi[some]
    sizes = hi - lo + length  # with a separator
    body = b"".join(data[i][a : b + length - 1] + b"\0" for i, a, b in zip(some.tolist(), lo.tolist(), hi.tolist(), strict=True))
    text = np.frombuffer(body, np.uint8).astype(np.int64) + 2
    ends = np.cumsum(sizes)
    text[ends - 1] = 1
    offset = np.arange(len(text)) - np.repeat(ends - sizes, sizes)
    window = offset <= np.repeat(sizes - 1 - length, sizes)
    array = suffix_array(text)
    array = array[window[array]]
    body += bytes(length + 8)
    same = np.append(False, np.ones(len(array) - 1, bool))
    for i in [*range(0, length - 7, 8), length - 8]:  # compare adjacent prefixes, eight bytes at a time
        words = _loads(body, len(text), i)[array]
        same[1:] &= words[1:] == words[:-1]
    group = np.cumsum(~same)
    which = np.repeat(some, sizes)[array]
    where = start[which] + offset[array] + np.repeat(lo, sizes)[array]
    order = np.lexsort((where, twin[which], doc[which], group))
    later = order[np.append(False, group[order][1:] == group[order][:-1])]
    return doc[which[later]], twin[which[later]], where[later]


def _sort_blocks(length: int, block: int):
    """CONTEXT rows in the order of their key give FOUND rows: repeats (data null), and the contexts of keys
    that are too large for a block, to be dealt out by window."""

    def found(doc, twin, start):
        n = len(doc)
        return _batch(FOUND, pa.array(doc), pa.array(twin), pa.array(start), pa.array(np.ones(n, np.int64)),
                      pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()))

    def solve(held):
        columns = [np.concatenate([h[i] for h in held]) for i in range(5)]
        data = [d for h in held for d in h[5]]
        once = np.unique(np.stack(columns[1:4]), axis=1, return_index=True)[1]  # a row given twice counts once
        return found(*repeats_in_block(*[c[once] for c in columns], [data[i] for i in once], length))

    def passed(part):
        key, doc, twin, start, anchor, data = part
        return _batch(FOUND, pa.array(doc), pa.array(twin), pa.array(start), pa.array(np.zeros(len(doc), np.int64)),
                      pa.array(key), pa.array(anchor.astype(np.int32)), pa.array(data, pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0  # whole keys
        current, current_size, current_key, passing = [], 0, None, False
        for batch in batches:
            columns = [*_longs(batch, 5), batch.column(5).to_pylist()]
            key = columns[0]
            cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(key)], strict=True):
                part = [c[i:j] for c in columns]
                if current_key is None or key[i] != current_key:
                    held, size = held + current, size + current_size
                    if size >= block:
                        yield solve(held)
                        held, size = [], 0
                    current, current_size, current_key, passing = [], 0, key[i], False
                if not passing:
                    current.append(part)
                    current_size += sum(map(len, part[5]))
                    if current_size > block:
                        passing = True
                        for p in current:
                            yield passed(p)
                        current, current_size = [], 0
                else:
                    yield passed(part)
        held += current
        if held:
            yield solve(held)

    return run


def _halves(length: int, gram: int):
    """Contexts of keys that are too large, dealt out anew by more of what their windows share: those that start up
    to ``most`` bytes before the anchor hold what follows it, the others what precedes it. Two rows a context."""
    most = (length - gram) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, twin, start, anchor, data in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                low = max(0, anchor - most)
                if low <= len(data) - length:
                    out.append((xxhash.xxh64_intdigest(data[anchor : anchor + length - most], 1), doc, twin, start + low, anchor - low, data[low:]))
                if anchor > most:
                    head = data[: anchor - most - 1 + length]
                    out.append((xxhash.xxh64_intdigest(data[anchor - most - 1 : anchor + gram], 2), doc, twin, start, anchor, head))
            if out:
                key, doc, twin, start, anchor, data = zip(*out, strict=True)
                columns = [pa.array(_signed(key)), *(pa.array(x, pa.int64()) for x in (doc, twin, start)), pa.array(anchor, pa.int32())]
                yield _batch(CONTEXT, *columns, pa.array(data, pa.binary()))

    return run


def _windows(length: int):
    """RUNS rows of one window each, for contexts that were too many for a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for doc, twin, start, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                parts = [data[i : i + length] for i in range(len(data) - length + 1)]
                one = np.ones(len(parts), np.int64)
                places = placed(start + np.arange(len(parts)), 1, 0)
                key = _signed([xxhash.xxh64_intdigest(p) for p in parts])
                held.append(np.stack([key, _signed(list(map(_name, parts))), one * doc, one * twin, places]))
            if held:
                yield _sent(held)

    return run


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """(doc, twin, start, n): runs of n windows, from byte start, that equal windows that start earlier.
    ``docs`` has (doc, twin, text); (doc, twin) is unique and orders the documents."""
    if not gram <= length <= gram + 120 or gram < 24:
        raise ValueError("gram is 24 or more, and length from gram to gram + 120")
    runs = docs.select("doc", "twin", "text").mapInArrow(_runs(length, gram), RUNS)
    order = ("key", "name", "doc", "twin", "place")
    settled = stored(runs.repartition("key").sortWithinPartitions(*order).mapInArrow(_settle, OPEN))
    wanted = settled.where(F.col("kind") == TO_SORT).groupBy("doc", "twin").agg(F.collect_list(F.struct("key", "place")).alias("runs"))
    contexts = docs.select("doc", "twin", "text").join(wanted, ["doc", "twin"]).mapInArrow(_contexts(length), CONTEXT)
    found = stored(contexts.repartition("key").sortWithinPartitions("key").mapInArrow(_sort_blocks(length, block), FOUND))
    large = found.where("data is not null").select("doc", "twin", "start", "anchor", "data")
    large = large.mapInArrow(_halves(length, gram), CONTEXT).repartition("key").sortWithinPartitions("key")
    again = stored(large.mapInArrow(_sort_blocks(length, block), FOUND))
    many = again.where("data is not null").select("doc", "twin", "start", "data").mapInArrow(_windows(length), RUNS)
    many = many.repartition("key", "name").sortWithinPartitions(*order).mapInArrow(_settle, OPEN)
    pair = [F.shiftright("place", 15).alias("start"), F.shiftright("place", 8).bitwiseAND(127).alias("n")]
    return (
        settled.where(F.col("kind") == REPEAT).select("doc", "twin", *pair)
        .union(found.where("data is null").select("doc", "twin", "start", "n"))
        .union(again.where("data is null").select("doc", "twin", "start", "n"))
        .union(many.where(F.col("kind") == REPEAT).select("doc", "twin", *pair))
    )


def kept_bytes(data: bytes, starts: np.ndarray, counts: np.ndarray, length: int = LENGTH) -> tuple[bytes, int]:
    """What is left of ``data`` without the windows, and the number of maximal runs that went."""
    if not len(starts):
        return data, 0
    order = np.argsort(starts, kind="stable")
    lo, hi = starts[order], np.maximum.accumulate(starts[order] + counts[order] + length - 1)
    new = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
    lo, hi = lo[new].tolist(), hi[np.append(new[1:] - 1, len(hi) - 1)].tolist()
    return b"".join(data[i:j] for i, j in zip([0, *hi], [*lo, len(data)], strict=True)), len(lo)


def deduplicate(
    docs: DataFrame, keep: list[str], length: int = LENGTH, gram: int = GRAM, block: int = BLOCK, texts: bool = True
) -> DataFrame:
    """Columns ``keep`` of each row of ``docs`` (doc_id, text) in the struct ``row``, with n_bytes, n_removed, n_spans,
    kept_sha256 and kept_text, judged on whole texts as UTF-8. kept_text leaves out characters of which only a
    part is left; it is null where the text was, and everywhere unless ``texts``.

    A byte goes if a string of ``length`` bytes covers it that starts earlier too: in a document with a
    smaller doc_id, or before it in its own. Null text counts as empty. A null doc_id sorts before all others.
    Rows with one doc_id and different texts are ordered by a hash of the text; rows that agree in both count
    as one document and get the same result each. An empty table gives an empty result.
    """
    marked = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(str(NO_ID)).cast("bigint")).alias("doc"),
        F.xxhash64(F.col("doc_id").isNull(), "text").alias("twin"),
        "text",
        F.struct(*keep).alias("row"),
    )
    ranges = repeated_ranges(marked.select("doc", "twin", "text"), length, gram, block)
    ranges = stored(ranges.groupBy("doc", "twin").agg(F.collect_set(F.struct("start", "n")).alias("ranges")))
    schema = marked.select("row").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    schema = schema.add("kept_sha256", "string").add("kept_text", "string")
    names = schema.names

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = (text or "").encode()
                at = np.array([(r["start"], r["n"]) for r in found or []], np.int64).reshape(-1, 2)
                kept, spans = kept_bytes(data, at[:, 0], at[:, 1], length)
                out.append((len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore") if texts and text is not None else None))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = [pa.array([o[i] for o in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    joined = marked.join(ranges, ["doc", "twin"], "left").select("row", "text", "ranges")
    return joined.mapInArrow(finish, schema)
