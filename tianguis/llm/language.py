"""Language identification of mixed texts: scripts narrow the candidates, a character model scores each word,
and Viterbi with a price for switching labels spans of words."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tianguis.llm.common import STEP_CHARS, steps, texts_of

UNKNOWN = "und"
#: Buckets that character trigrams are hashed to: the size of the model for each language.
BUCKETS = 1 << 16
#: Price of a switch between two words, in nats.
SWITCH = 8.0
#: Share of a language's letters from which a script counts as one of its scripts.
SCRIPT_SHARE = 0.005

# First code points of ranges with one script, in order.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "other"), (0x0750, "Arabic"), (0x0780, "other"), (0x08A0, "Arabic"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "other"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"),
    (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"), (0x1780, "Khmer"), (0x1800, "Mongolian"),
    (0x18B0, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "other"), (0x2C60, "Latin"),
    (0x2C80, "other"), (0x2DE0, "Cyrillic"), (0x2E00, "other"), (0x2E80, "Han"), (0x3040, "Kana"),
    (0x3100, "other"), (0x3130, "Hangul"), (0x3190, "other"), (0x31F0, "Kana"), (0x3200, "other"),
    (0x3400, "Han"), (0xA000, "other"), (0xA720, "Latin"), (0xA800, "other"), (0xAC00, "Hangul"),
    (0xD800, "other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "other"), (0xFB1D, "Hebrew"),
    (0xFB50, "Arabic"), (0xFE00, "other"), (0xFE70, "Arabic"), (0xFF00, "other"), (0xFF21, "Latin"),
    (0xFF5B, "other"), (0xFF66, "Kana"), (0xFFA0, "other"), (0x20000, "Han"),
]
SCRIPT_STARTS = np.array([start for start, _ in SCRIPTS])
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_IDS = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _letters[0]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def words(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of a text as words: each word's first letter (by its number among the letters), each letter's
    trigram bucket and script. A trigram holds the letters on both sides, or a border."""
    is_letter = letters()[code]
    at = np.flatnonzero(is_letter)
    if not len(at):
        return at, at, at
    padded = np.concatenate([[0], np.where(is_letter, code, 0), [0]]).astype(np.uint64)
    mixed = padded[at] * np.uint64(0x9E3779B97F4A7C15) + padded[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + padded[at + 2] * np.uint64(0x165667B19E3779F9)
    bucket = (((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(48)).astype(np.int64) % BUCKETS
    first = np.flatnonzero(np.append(True, np.diff(at) > 1))
    return first, bucket, SCRIPT_IDS[np.searchsorted(SCRIPT_STARTS, code[at], side="right") - 1]


@dataclass(frozen=True)
class Model:
    """languages in order; logs[bucket, language]; scripts[script, language] tells who uses a script."""

    languages: list[str]
    logs: np.ndarray
    scripts: np.ndarray


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of trigrams (at their bucket) and letters by script (beyond the buckets), by language."""
    size = BUCKETS + len(SCRIPT_NAMES)
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
        for lang, text in zip(langs, texts, strict=True):
            sum_ = sums.setdefault(lang, np.zeros(size, np.int64))
            for i in range(0, len(text), 1 << 20):  # a word cut here counts as two
                _, bucket, script = words(codes(text[i : i + (1 << 20)]))
                sum_ += np.bincount(np.concatenate([bucket, BUCKETS + script]), minlength=size)
    for lang, sum_ in sums.items():
        at = np.flatnonzero(sum_)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sum_[at])], ["lang", "at", "n"]
        )


def fit(labelled: DataFrame) -> Model:
    """Learn from all rows of ``labelled`` (lang, text) with a lang. The driver gets the model alone: at most
    ``BUCKETS`` and a few sums for each language, however many rows there are."""
    rows = labelled.where("lang is not null and text is not null").select("lang", "text")
    found = rows.mapInArrow(_counts, "lang string, at int, n bigint").groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    sums = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(languages)))
    sums[found["at"], np.searchsorted(languages, found["lang"])] = found["n"]
    grams, scripts = sums[:BUCKETS], sums[BUCKETS:]
    share = 0.9 * grams / np.maximum(grams.sum(axis=0), 1) + 0.1 / BUCKETS
    used = scripts >= np.maximum(SCRIPT_SHARE * scripts.sum(axis=0), 1)
    used[~used.any(axis=1)] = True  # a script nobody was seen with excludes nobody
    return Model(languages, np.log(share).astype(np.float32), used)


def word_scores(code: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(score of each word in each language, letters of each word). Languages that do not use the script of
    most letters of a word are out of the question for it."""
    first, bucket, script = words(code)
    length = np.diff(np.append(first, len(bucket))) if len(first) else first
    if not len(first) or not model.languages:
        return np.zeros((len(first), len(model.languages)), np.float32), length
    scores = np.add.reduceat(model.logs[bucket], first, axis=0)
    possible = np.add.reduceat(model.scripts[script].astype(np.int32), first, axis=0)
    out = possible < possible.max(axis=1, keepdims=True)
    return np.where(out, scores - 1000, scores), length


def text_scores(text: str, model: Model, most: int = STEP_CHARS) -> tuple[np.ndarray, np.ndarray]:
    """``word_scores`` of a text; a very long one is scored in parts that end between words."""
    parts, start = [], 0
    while start < len(text) or not parts:
        end = min(start + most, len(text))
        while end < len(text) and text[end].isalpha() and text[end - 1].isalpha():
            end += 1
        parts.append(word_scores(codes(text[start:end]), model))
        start = end
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def viterbi(scores: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """The best label of every word of every text. All texts advance together, longest first, a word a step."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order])
    out: list[np.ndarray] = [np.zeros(len(s), np.int8 if s.shape[1] < 128 else np.int32) for s in scores]
    most = int(lengths[0]) if len(lengths) else 0
    if not most:
        return out
    ends = np.searchsorted(-lengths, -np.arange(most), side="left")  # texts that still have word t
    starts = np.concatenate([[0], np.cumsum(ends)])
    count = scores[0].shape[1]
    flat = np.empty((starts[-1], count), np.float32)
    for row, i in enumerate(order):
        flat[starts[: lengths[row]] + row] = scores[i]
    came = np.zeros((starts[-1], count), bool)  # whether the best way into this label is a switch
    best_before = np.zeros(starts[-1], np.int32)
    value = flat[: ends[0]].astype(np.float64)
    final = np.zeros(len(order), np.int64)
    for t in range(1, most):
        n, rows = ends[t], slice(starts[t], starts[t + 1])
        final[n : ends[t - 1]] = value[n:].argmax(axis=1)
        value = value[:n]
        top = value.argmax(axis=1)
        jump = value[np.arange(n), top][:, None] - switch
        came[rows], best_before[rows] = jump > value, top
        value = np.maximum(value, jump) + flat[rows]
    final[: ends[most - 1]] = value.argmax(axis=1)
    label = final.copy()
    picked = np.empty(starts[-1], np.int32)
    for t in range(most - 1, -1, -1):
        n = ends[t]
        rows = starts[t] + np.arange(n)
        picked[rows] = label[:n]
        if t:
            label[:n] = np.where(came[rows, label[:n]], best_before[rows], label[:n])
    for row, i in enumerate(order):
        out[i][:] = picked[starts[: lengths[row]] + row]
    return out


def spans(text: str | None, model: Model, switch: float = SWITCH) -> list[tuple[str, int]]:
    """The text's words as maximal spans of one language: (language, words)."""
    scores, _ = text_scores(text or "", model)
    label = viterbi([scores], switch)[0]
    cuts = np.flatnonzero(np.append(True, label[1:] != label[:-1])) if len(label) else []
    return [(model.languages[label[i]], int(j - i)) for i, j in zip(cuts, np.append(cuts[1:], len(label)), strict=True)] if len(label) else []


def predict(docs: DataFrame, model: Model, keep: list[str], switch: float = SWITCH) -> DataFrame:
    """Columns ``keep`` of ``docs`` with lang_pred and score, from the column text alone.

    lang_pred is the language with most letters over the spans of the text, the first in order on a tie, and
    score its share of the letters. A text that is null, empty or without a letter gets ``und`` and 0, and so
    does everything if the model has no language. Repeated rows get the same answer each; whole texts count.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = texts_of(batch.column(batch.num_columns - 1))
            found: list[tuple[str, float]] = []
            for i, j in steps([len(t) for t in texts]):
                scored = [text_scores(t, model) for t in texts[i:j]]
                for (_, length), label in zip(scored, viterbi([s for s, _ in scored], switch) if model.languages else scored, strict=True):
                    if not len(length) or not model.languages:
                        found.append((UNKNOWN, 0.0))
                        continue
                    share = np.bincount(label, length, minlength=len(model.languages)) / length.sum()
                    found.append((model.languages[int(share.argmax())], float(share.max())))
            columns = [batch.column(k) for k in range(len(keep))]
            columns += [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def lettered(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (text; others are kept) whose text has a letter, by the same letters as ``predict``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([any(map(str.isalpha, t)) for t in texts_of(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def learns(doc_id: str = "doc_id"):
    """Whether a document may be learned from: crc32 of its id as text, modulo 3, is not 1."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 != 1


def identify(docs: DataFrame, keep: list[str], switch: float = SWITCH) -> DataFrame:
    """Learn from the documents that may be learned from, then predict all. A null doc_id is not learned from."""
    return predict(docs, fit(docs.where(learns()).select("lang", "text")), keep, switch)
