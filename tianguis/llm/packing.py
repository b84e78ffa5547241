"""Packing tokens into sequences of equal attention cost.

A piece of n tokens costs n * LINEAR + n * n * QUADRATIC. Documents go, longest first, to the sequence with
the lowest cost so far that has room for them; a document that no sequence has room for is cut.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tianguis.llm.common import texts_of

SEQUENCE, END_ID = 2048, 1
#: Cost of a token by itself, and of attending to one token: the linear part of a layer is about as dear as
#: attending to a few thousand tokens.
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
#: Tokens packed together inside a task: bounds memory, and far more than one sequence.
BLOCK_TOKENS = 1 << 19
#: Words, and parts of texts between white space, whose tokens a worker keeps; others are tokenized each time.
CACHED_WORDS = 500_000
#: After every sequence.
NOTHING = (float("inf"), -1, -1)

# The characters on which the tokenizer's normalizer (NFC, white space, lower case) is known to do no
# more than lower-case and part at white space; the letters and numbers among them; its word pattern over these.
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u017f\u2010-\u2027\u2030-\u205e\u20ac]*")
LETTERS, NUMBERS = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+")
LONG_TEXT = 1 << 20


def byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes each byte as: itself if it is printable, else the next free one."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Ids(dict):
    """Ids by text, found by ``make`` and kept for the first CACHED_WORDS texts."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, text: str) -> bytes:
        ids = self.make(text)
        if len(self) < CACHED_WORDS:
            self[text] = ids
        return ids


class WordTokens:
    """Token ids of texts, as little-endian 32-bit integers: what the tokenizer gives, mostly from memory.

    Plain texts are lower-cased and parted at white space; each part is cut by the word pattern, and a word is given
    to the tokenizer's own model. All other texts go through the tokenizer whole. With ``added_tokens`` the tokenizer
    is used as loaded, so the names of its added tokens are those tokens; texts that hold one go through it whole
    too. Without, the names are text like any other.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self.letters = byte_letters()
        self.words = Ids(self.word)
        self.parts = Ids(self.part)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        if not word.isascii():
            word = "".join([self.letters[b] for b in word.encode()])
        return np.array([t.id for t in self.tokenizer.model.tokenize(word)], "<u4").tobytes()

    def part(self, part: str) -> bytes:
        found = WORD.findall(part)
        return self.words[part] if found == [part] else b"".join([self.words[w] for w in found])

    def text(self, text: str) -> bytes:
        if len(text) > LONG_TEXT:
            return b"".join([self.portion(part) for part in portions(text)])
        return self.portion(text)

    def portion(self, text: str) -> bytes:
        if PLAIN.fullmatch(text) and not any(name in text for name in self.added):
            return b"".join(map(self.parts.__getitem__, text.lower().split()))
        return self.whole(text)


def portions(text: str) -> Iterator[str]:
    """Cut a very long text before white space, which the tokenizer drops; a word longer than that stays whole."""
    start = 0
    while start < len(text):
        end = min(start + LONG_TEXT // 2, len(text))
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[start:end]
        start = end


def capacities(total: int, sequence: int = SEQUENCE) -> list[int]:
    """Lengths of sequences that hold exactly ``total`` tokens: full ones, and powers of two for the rest,
    which need no padding either."""
    full, rest = divmod(total, sequence)
    return [sequence] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def cost(n: int) -> float:
    return n * LINEAR + n * n * QUADRATIC


class Open:
    """Sequences by the room they have left: the cheapest of those with enough of it, found and changed in the
    logarithm of the sequence's length."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.by_room: list[list] = [[] for _ in range(self.size)]
        self.least: list = [NOTHING] * (2 * self.size)  # a tree over rooms: the least (cost, sequence, room) below

    def _changed(self, room: int) -> None:
        node = room + self.size
        self.least[node] = self.by_room[room][0] if self.by_room[room] else NOTHING
        while node > 1:
            node >>= 1
            self.least[node] = min(self.least[2 * node], self.least[2 * node + 1])

    def put(self, cost_so_far: float, s: int, room: int) -> None:
        heapq.heappush(self.by_room[room], (cost_so_far, s, room))
        self._changed(room)

    def take(self, need: int) -> tuple[float, int, int] | None:
        """The cheapest sequence with room for ``need`` tokens, the first of equals, taken out; None if there is none."""
        found, low, high = NOTHING, need + self.size, 2 * self.size
        while low < high:
            if low & 1:
                found, low = min(found, self.least[low]), low + 1
            low, high = low >> 1, high >> 1
        if found is NOTHING:
            return None
        heapq.heappop(self.by_room[found[2]])
        self._changed(found[2])
        return found


def pack(lengths: list[int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of pieces that fill the sequences of ``capacities`` exactly.

    Documents go longest first, ties by position, each to the cheapest sequence that has room for it. Only a document
    that is longer than a sequence is cut beforehand, into whole sequences and a rest; another one only if no
    sequence has room for it, and then it fills the cheapest one.
    """
    rooms = capacities(sum(lengths), sequence)
    queue = [(-min(sequence, n - at), d, at) for d, n in enumerate(lengths) for at in range(0, n, sequence)]
    heapq.heapify(queue)
    open_ = Open(sequence)
    for s, room in enumerate(rooms):
        open_.put(0.0, s, room)
    out = []
    while queue:
        negative, d, at = heapq.heappop(queue)
        n = -negative
        spent, s, room = open_.take(n) or open_.take(1)
        put = min(n, room)
        out.append((d, at, put, s, rooms[s] - room))
        if put < room:
            open_.put(spent + cost(put), s, room - put)
        if put < n:
            heapq.heappush(queue, (put - n, d, at + put))
    return out


SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, sequence_tokens bigint, ids binary"


def pack_documents(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, added_tokens: bool = False) -> DataFrame:
    """A row for each piece of each row of ``docs`` (doc_id, text; others are ignored), with its token ids as
    little-endian unsigned 32-bit integers. ``added_tokens`` tells whether names of added tokens in a text are these
    tokens, as in the tokenizer as loaded, or text.

    Blocks of rows are packed inside their task, without a shuffle; a sequence id is the partition's number
    and a counter. A document that is longer than a block makes a block of its own with what came before it.
    Null and empty texts are the end id alone. Repeated rows and null ids are packed as rows of their own; an
    empty table gives no sequence.
    """
    state: list[WordTokens] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state.append(WordTokens(tokenizer_path, added_tokens))
        words, next_id = state[0], TaskContext.get().partitionId() << 33
        ids: list = []
        tokens: list[bytes] = []
        held = 0

        def flush():
            nonlocal next_id
            lengths = [len(t) // 4 for t in tokens]
            pieces = pack(lengths, sequence)
            pieces.sort(key=lambda p: (p[3], p[4]))
            rooms = capacities(sum(lengths), sequence)
            body = [tokens[d][4 * at : 4 * (at + n)] for d, at, n, _, _ in pieces]
            columns = [
                pa.array([ids[p[0]] for p in pieces], pa.int64()),
                pa.array([p[1] for p in pieces], pa.int64()),
                pa.array([p[2] for p in pieces], pa.int64()),
                pa.array([zlib.crc32(b) for b in body], pa.int64()),
                pa.array([lengths[p[0]] for p in pieces], pa.int64()),
                pa.array([next_id + p[3] for p in pieces], pa.int64()),
                pa.array([p[4] for p in pieces], pa.int64()),
                pa.array([rooms[p[3]] for p in pieces], pa.int64()),
                pa.array(body, pa.binary()),
            ]
            next_id += len(rooms)
            return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                ids.append(doc_id)
                tokens.append(words.text(text) + end)
                held += len(tokens[-1]) // 4
                if held >= BLOCK_TOKENS:
                    yield flush()
                    ids, tokens, held = [], [], 0
        if ids:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
