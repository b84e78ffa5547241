"""Document fingerprints from prefix polynomial hashes.

A text is the polynomial of its code points. With the prefix sums of code point times power, modulo two primes,
the hash of any span follows from two entries, so spans are compared in constant time and the longest common
extension of two places is found by bisection. A fingerprint is the hash of the whole text and, for likeness, the
smallest hashes of its windows of a fixed width, which are spans like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Code points of a window, and smallest window hashes that a fingerprint keeps.
WINDOW, KEPT = 24, 64
#: Hex digits of a kept hash, from its high bits.
DIGITS = 10
#: Code points that are worked on at a time.
PART = 1 << 19
#: Documents of one range of ids, and ranges at most: with more documents, ranges are longer.
RANGE_ROWS, RANGES = 500, 1 << 14

# Two primes below 2**31 and a base for each.
PRIMES, BASES = (2147483647, 2147483629), (911382323, 972663749)

_U = np.uint64
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(which: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, at least ``count`` of each."""
    p, base = PRIMES[which], BASES[which]
    found = _powers.get(which, (np.ones(1, np.uint64), np.ones(1, np.uint64)))
    while len(found[0]) < count:
        n = len(found[0])
        found = tuple(np.concatenate([x, x * _U(pow(b, n, p)) % _U(p)]) for x, b in zip(found, (base, pow(base, -1, p)), strict=True))
        _powers[which] = found
    return found


class PrefixHash:
    """Prefix sums of one text; ``span`` and ``extension`` use them. The first ``same`` entries of another one can
    be taken over, where the texts agree so far."""

    def __init__(self, code: np.ndarray, like: PrefixHash | None = None, same: int = 0):
        self.length = len(code)
        self.sums, self.inverse = [], []
        for which, p in enumerate(PRIMES):
            power, inverse = powers(which, len(code) + 1)
            start = like.sums[which][: same + 1] if like is not None else np.zeros(1, np.uint64)
            sums = np.empty(len(code) + 1, np.uint64)
            sums[: len(start)] = start
            for first in range(len(start) - 1, len(code), PART):
                last = min(first + PART, len(code))
                terms = (code[first:last].astype(np.uint64) + _U(1)) * power[first:last] % _U(p)
                sums[first + 1 : last + 1] = (sums[first] + np.cumsum(terms, dtype=np.uint64)) % _U(p)
            self.sums.append(sums)
            self.inverse.append(inverse)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of code points start to end; equal spans have equal hashes wherever they are."""
        parts = []
        for p, sums, inverse in zip(PRIMES, self.sums, self.inverse, strict=True):
            parts.append((sums[end] + _U(p) - sums[start]) % _U(p) * inverse[start] % _U(p))
        return parts[0] << _U(32) | parts[1]

    def span(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])

    def windows(self, width: int, first: int = 0) -> np.ndarray:
        """Hashes of all windows from ``first`` on, spread over all 64 bits; a shorter text is one window."""
        last = max(self.length - width, 0)
        out = np.empty(max(0, last + 1 - first), np.uint64)
        for at in range(first, last + 1, PART):
            start = np.arange(at, min(at + PART, last + 1))
            out[at - first : at - first + len(start)] = mixed(self.spans(start, np.minimum(start + width, self.length)))
        return out

    def extension(self, at: int, other: PrefixHash, other_at: int) -> int:
        """Length of the longest common extension from two places, by bisection."""
        low, high = 0, min(self.length - at, other.length - other_at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(at, at + middle) == other.span(other_at, other_at + middle):
                low = middle
            else:
                high = middle - 1
        return low


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Polynomial hashes spread over all 64 bits."""
    h = (hashes ^ (hashes >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(32))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def smallest(hashes: np.ndarray, count: int = KEPT) -> np.ndarray:
    """The smallest different values, in order."""
    wanted = count
    while True:
        part = np.partition(hashes, wanted)[:wanted] if len(hashes) > wanted else hashes
        found = np.unique(part)
        if len(found) >= count or len(part) == len(hashes):
            return found[:count]
        wanted *= 4


def written(whole: int, kept: np.ndarray) -> str:
    """16 digits of the whole text's hash and DIGITS of each kept one, smallest first."""
    return f"{whole:016x}" + "".join(f"{x >> 64 - 4 * DIGITS:0{DIGITS}x}" for x in kept.tolist())


def likeness(one: str, other: str) -> float:
    """Estimated part of their windows that two texts share, from their fingerprints alone; 1 for equal ones.

    Among the smallest hashes of both texts together, those that both have estimate the overlap over the union;
    the part shared of a text's own windows follows from that.
    """
    if one == other:
        return 1.0
    a, b = ({f[i : i + DIGITS] for i in range(16, len(f), DIGITS)} for f in (one, other))
    union = sorted(a | b)[:KEPT]
    overlap = sum(x in a and x in b for x in union) / max(1, len(union))
    return 2 * overlap / (1 + overlap)


class Fingerprint:
    """Fingerprints of a text and of edited forms that share its beginning."""

    def __init__(self, text: str):
        self.code = codes(text)
        self.hash = PrefixHash(self.code)
        self.windows = self.hash.windows(WINDOW) if len(self.code) else np.zeros(0, np.uint64)
        self.text = written(self.hash.span(0, self.hash.length), smallest(self.windows))

    def edited(self, code: np.ndarray, same: int) -> str:
        """Of a text that agrees with this one on its first ``same`` code points: only the rest is hashed anew."""
        if not len(code):
            return written(0, self.windows[:0])
        whole = PrefixHash(code, self.hash, same)
        head = max(0, same - WINDOW + 1) if len(code) >= WINDOW <= len(self.code) else 0
        rest = whole.windows(WINDOW, head)
        return written(whole.span(0, whole.length), smallest(np.concatenate([self.windows[:head], rest])))


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, shared_prefix bigint"
)


def edited_text(text: str, following: str) -> tuple[str, int]:
    """The last third of a text replaced by the first as many code points, or all, of another; and what stayed."""
    same = len(text) - len(text) // 3
    return text[:same] + following[: len(text) // 3], same


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (place, doc_id, text, guest) in order, guests last in their range: a row for each but guests, compared
    with the one after it in its range."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
    before: tuple | None = None  # (place, doc_id, text, Fingerprint) that waits for its next
    for batch in batches:
        out = []
        for place, doc_id, text, guest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text or ""
            now = Fingerprint(text)
            if before is not None and before[0] == place:
                _, old_id, old_text, old = before
                changed, same = edited_text(old_text, text)
                edited = old.edited(codes(changed), same)
                digest = hashlib.sha256(changed.encode()).hexdigest()
                shared = old.hash.extension(0, now.hash, 0)
                out.append((old_id, len(old_text), digest, old.text, edited, likeness(old.text, edited), likeness(old.text, now.text), shared))
            before = (place, doc_id, text, now) if not guest else None
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names)


def _range_of(cuts: list[int], step: int = 128):
    """Number of cuts at or below doc_id, in two steps of short scans."""
    every = F.lit(cuts).cast("array<bigint>")
    count = lambda x: F.size(F.filter(x, lambda c: c <= F.col("doc_id")))
    before = F.greatest(count(F.lit(cuts[::step]).cast("array<bigint>")) - 1, F.lit(0)) * step
    return before + count(F.slice(every, before + 1, step))


def compare_neighbours(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprint every row of ``docs`` (doc_id, text; others are ignored) and its edited text: the last
    third of its code points replaced by the first as many, or all, of the next document in descending
    doc_id; the last one's next is the first.

    near_edited and near_next are likenesses of fingerprints, shared_prefix the longest common extension from the
    start of the text and the next one. Null text counts as empty; empty texts have equal fingerprints. Rows with
    one doc_id are ordered by text; a null doc_id comes last. A single row is its own next. An empty table gives
    an empty result. Documents are dealt out by ranges of ids; the first of each range also goes to the one
    before it, so texts are shuffled once. The driver sees the borders of the ranges: ``RANGES`` at most.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    count = min(docs.count() // range_rows, RANGES)
    cuts: list[int] = []
    if count > 1:
        borders = F.percentile_approx("doc_id", [i / count for i in range(1, count)], 10 * count)
        cuts = sorted(set(docs.agg(borders).first()[0] or []))
    # Range 0 holds the largest ids, the last one null ids too.
    place = F.lit(len(cuts)) - _range_of(cuts) if cuts else F.lit(0)
    rows = docs.withColumn("place", place)
    heads = sorted((r["place"], r["head"]) for r in rows.groupBy("place").agg(F.max("doc_id").alias("head")).collect())
    sent = [(at, head, heads[i - 1][0]) for i, (at, head) in enumerate(heads)]
    guests = spark.createDataFrame(sent, "place int, head bigint, to int")
    seat = lambda at, guest: F.struct(F.col(at).alias("place"), F.lit(guest).alias("guest"))
    seats = F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.array(seat("place", 0), seat("to", 1))).otherwise(F.array(seat("place", 0)))
    dealt = rows.join(F.broadcast(guests), "place").select("doc_id", "text", F.explode(seats).alias("seat"))
    dealt = dealt.select("seat.place", "doc_id", "text", "seat.guest").repartition("place")
    order = ("place", "guest", F.desc_nulls_last("doc_id"), "text")
    return dealt.sortWithinPartitions(*order).mapInArrow(_compare, SCHEMA)
