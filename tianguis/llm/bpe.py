"""Byte-level BPE with a segment tree over the bytes of a piece.

A text is cut into pieces by a pattern. The leaf of a byte position holds the rank of the pair that starts there, the
inner nodes the leftmost least of their leaves, so the root names the next pair to merge. A merge links its neighbours
together and changes three leaves: its own, the one it swallowed and the one before; their paths to the root are
updated. That is logarithmic work for each merge, so a piece of a million letters takes seconds.

Short pieces are merged side by side: one tree each, stacked in an array, a merge of every tree at a time. A longer
piece has a tree of its own. Both follow the same rule as the tiktoken library: a piece that is a token is that token;
otherwise the pair of the lowest rank merges first, the leftmost of equals.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tianguis.llm.common import steps, texts_of

#: Bytes up to which pieces are merged side by side; longer ones have a tree of their own.
SHORT_PIECE = 64
#: Pieces merged side by side.
STACK = 1 << 13
#: Code points of texts that are encoded together, unless a single text is longer.
TOGETHER = 2 << 20
#: No pair starts here.
NONE = np.int32((1 << 31) - 1)

# The pattern of the public vocabularies, which ``cut`` follows, and the contractions in it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
SPACE, LETTER, NUMBER, OTHER = range(4)
BEFORE_SPACE = regex.compile(r"\S(?=\s)")


class NotInVocabulary(ValueError):
    """A byte or an id that the vocabulary does not have."""


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file of lines ``base64 rank``."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every stretch, one stretch after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + lengths, lengths) + np.arange(total)


class Gather:
    """Byte strings by number, looked up for a whole array of numbers at once."""

    def __init__(self, values: list[bytes]):
        self.lengths = np.array([len(v) for v in values], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(values), np.uint8)

    def __call__(self, numbers: np.ndarray) -> bytes:
        return self.bytes[ragged(self.starts[numbers], self.lengths[numbers])].tobytes()


class Vocabulary:
    """Ranks, the pairs that make each token, and the bytes of each id."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise NotInVocabulary("every single byte must be a token")
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.of_two_bytes = np.full((256, 256), NONE, np.int32)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.of_two_bytes[token[0], token[1]] = rank
        self.base = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = rank
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int32)
        self.tokens = pa.array(list(ranks), pa.large_binary())
        self.token_ranks = np.array(list(ranks.values()), np.int32)
        tokens = [b""] * self.base
        for token, rank in ranks.items():
            tokens[rank] = token
        self.known = np.array([bool(t) for t in tokens])
        self.spell = Gather(tokens)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; NONE where there is no such token or an id is negative."""
        keys = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        found = (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0) if len(self.pair_keys) else np.zeros(len(keys), bool)
        return np.where(found, self.pair_ranks[at] if len(self.pair_keys) else NONE, NONE)

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= self.base or not self.known[ids].all()):
            raise NotInVocabulary("an id is not in the vocabulary")
        return self.spell(ids)


def merge_one(piece: bytes, vocabulary: Vocabulary) -> np.ndarray:
    """Ids of one piece, with a tree of its own."""
    n = len(piece)
    size = 1 << max(n - 1, 1).bit_length()
    pairs, base, none = vocabulary.pairs, vocabulary.base, 1 << 62
    token = array("q", vocabulary.of_byte[np.frombuffer(piece, np.uint8)].astype(np.int64).tobytes())
    after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    leaves = np.full(size, none)
    values = np.frombuffer(token, np.int64)
    ranks = vocabulary.ranks_of(values[:-1], values[1:]).astype(np.int64)
    leaves[: n - 1] = np.where(ranks == NONE, none, ranks * size + np.arange(n - 1))
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].reshape(-1, 2).min(axis=1))
    tree = array("q", np.concatenate([[none], *reversed(levels)]).tobytes())
    del leaves, levels

    def put(position: int, value: int) -> None:
        node = position + size
        tree[node] = value
        while node > 1:
            node >>= 1
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left < right else right
            if tree[node] == least:
                break
            tree[node] = least

    def rank_at(left: int, right: int) -> int:
        rank = pairs.get(token[left] * base + token[right])
        return none if rank is None else rank * size + left

    while tree[1] < none:
        rank, at = divmod(tree[1], size)
        gone = after[at]
        following, previous = after[gone], before[at]
        token[at], token[gone] = rank, -1
        after[at] = following
        put(gone, none)
        if following < n:
            before[following] = at
            put(at, rank_at(at, following))
        else:
            put(at, none)
        if previous >= 0:
            put(previous, rank_at(previous, at))
    ids = np.frombuffer(token, np.int64)
    return ids[ids >= 0].astype(np.int32)


def merge_stack(raw: np.ndarray, n: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces side by side, and how many each has. A row of ``raw`` holds the bytes of a piece, ``n`` of them,
    in a power of two of columns; each step merges one pair of every piece that still has one."""
    rows, size = raw.shape
    shift = size.bit_length() - 1
    place = np.arange(size, dtype=np.int32)
    # Positions of all pieces are numbered through; a piece has one more column, which takes what has no place: what
    # would be written beyond the end of a piece or before its beginning.
    wide = size + 1
    token = np.full((rows, wide), -1, np.int32)
    token[:, :size] = np.where(place < n[:, None], vocabulary.of_byte[raw], -1)
    after = np.empty((rows, wide), np.int16)
    after[:] = np.arange(1, wide + 1)
    after[np.arange(rows), n - 1] = size
    before = np.empty((rows, wide), np.int16)
    before[:] = np.arange(-1, size)
    before[:, 0] = size
    tree = np.full((rows, 2 * size), NONE, np.int32)
    ranks = vocabulary.of_two_bytes[raw[:, :-1], raw[:, 1:]]
    ranks[place[:-1] >= n[:, None] - 1] = NONE
    tree[:, size : 2 * size - 1] = np.where(ranks == NONE, NONE, (ranks << shift) + place[:-1])
    width = size
    while width > 1:
        width //= 2
        below = tree[:, 2 * width : 4 * width]
        tree[:, width : 2 * width] = np.minimum(below[:, ::2], below[:, 1::2])

    token, after, before, tree = token.ravel(), after.ravel(), before.ravel(), tree.ravel()
    root = 2 * size * np.arange(rows)
    line = wide * np.arange(rows)
    live = np.nonzero(tree[root + 1] < NONE)[0]
    root, line = root[live], line[live]
    while len(root):
        least = tree[root + 1]
        rank, at = least >> shift, least & (size - 1)
        here = line + at
        gone = after[here]
        swallowed = line + gone
        following, previous = after[swallowed], before[here]
        token[here], token[swallowed] = rank, -1
        after[here] = following
        before[line + following] = at
        own = vocabulary.ranks_of(rank, token[line + following])
        earlier = vocabulary.ranks_of(token[line + previous], rank)
        tree[root + size + gone] = NONE
        tree[root + size + at] = np.where(own == NONE, NONE, (own << shift) + at)
        some = previous < size
        back = previous[some]
        tree[root[some] + size + back] = np.where(earlier == NONE, NONE, (earlier << shift) + previous)[some]
        top = np.concatenate([root, root, root[some]])
        node = np.concatenate([at, gone, back]) + size
        for _ in range(shift):
            node >>= 1
            below = top + 2 * node
            tree[top + node] = np.minimum(tree[below], tree[below + 1])
        going = tree[root + 1] < NONE
        root, line = root[going], line[going]
    token = token.reshape(rows, wide)[:, :size]
    left = token >= 0
    return token[left], left.sum(axis=1)


def merge_all(pieces: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of many pieces (an Arrow array of large strings): all ids in some order, and where those of each piece
    start and how many there are."""
    offsets = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
    spelt = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
    begins, sizes = offsets[:-1], np.diff(offsets)
    whole = pc.index_in(pieces.cast(pa.large_binary()), value_set=vocabulary.tokens).fill_null(-1).to_numpy()
    counts = np.ones(len(pieces), np.int64)
    starts = np.zeros(len(pieces), np.int64)
    is_whole = whole >= 0
    found = [vocabulary.token_ranks[whole[is_whole]]]
    starts[is_whole] = np.arange(len(found[0]))
    total = len(found[0])

    def add(places: np.ndarray, ids: np.ndarray, each: np.ndarray) -> None:
        nonlocal total
        counts[places] = each
        starts[places] = total + np.cumsum(each) - each
        found.append(ids)
        total += len(ids)

    size, rest = 2, np.nonzero(~is_whole)[0]
    while size <= SHORT_PIECE:
        fits = sizes[rest] <= size
        chosen, rest = rest[fits], rest[~fits]
        for start in range(0, len(chosen), STACK):
            part = chosen[start : start + STACK]
            cells = begins[part][:, None] + np.arange(size)
            raw = spelt[np.minimum(cells, len(spelt) - 1)]
            add(part, *merge_stack(raw, sizes[part], vocabulary))
        size *= 2
    for i in rest.tolist():
        ids = merge_one(spelt[begins[i] : begins[i] + sizes[i]].tobytes(), vocabulary)
        add(np.array([i]), ids, np.array([len(ids)]))
    return np.concatenate(found), starts, counts


def _kinds() -> np.ndarray:
    """What each code point is to the pattern: white space, a letter, a number, or anything else."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for start, end in ((0, 0xD800), (0xE000, 0x110000)):
        points = "".join(map(chr, range(start, end)))
        for kind, name in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for run in regex.findall(name, points):
                kinds[ord(run[0]) : ord(run[-1]) + 1] = kind
    return kinds


def cut(points: np.ndarray, first: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the matches of PATTERN begin in code points; ``first`` says where texts begin.

    Matches are runs of one kind. The last of several white spaces before something else stands alone, or, if it is
    a space, begins what follows. A contraction begins at an apostrophe that begins a match.
    """
    kind = kinds[points]
    begins = first.copy()
    begins[1:] |= kind[1:] != kind[:-1]
    after_space = np.nonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~first[1:])[0] + 1
    begins[after_space - 1] = True
    begins[after_space] = points[after_space - 1] != 32
    quotes = np.nonzero(begins & (points == 39))[0]
    for ending in ENDINGS:
        at = quotes[quotes + len(ending) < len(points)]
        for i, letter in enumerate(ending, 1):
            at = at[(points[at + i] == ord(letter)) & ~first[at + i]]
        begins[at + 1] = False
        end = at + 1 + len(ending)
        begins[end[end < len(points)]] = True
    return np.nonzero(begins)[0]


class Encoder:
    """Encodes texts; pieces that repeat among them are merged once."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(read_ranks(path))
        self.kinds = _kinds()

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        lengths = np.array([len(t) for t in texts])
        ends = np.cumsum(lengths)
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        if not len(points):
            return [np.zeros(0, np.int32)] * len(texts)
        first = np.zeros(len(points), bool)
        first[(ends - lengths)[lengths > 0]] = True
        begins = cut(points, first, self.kinds)
        width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        offsets = np.append(0, np.cumsum(width, dtype=np.int64))[np.append(begins, len(points))]
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(joined.encode())]
        pieces = pa.Array.from_buffers(pa.large_string(), len(begins), buffers).dictionary_encode()
        found, starts, counts = merge_all(pieces.dictionary, self.vocabulary)
        number = pieces.indices.to_numpy()
        ids = found[ragged(starts[number], counts[number])]
        upto = np.append(0, np.cumsum(counts[number]))[np.searchsorted(begins, ends)]
        return np.split(ids, upto[:-1])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for start, end in steps([len(t) for t in texts], TOGETHER):
            if end - start == 1 and len(texts[start]) > TOGETHER:
                yield np.concatenate([self.encode_batch([part])[0] for part in portions(texts[start])])
            else:
                yield from self.encode_batch(texts[start:end])


def portions(text: str) -> Iterator[str]:
    """Cut a very long text before runs of white space, where matches begin whatever surrounds them."""
    start = 0
    while start < len(text):
        found = BEFORE_SPACE.search(text, start + TOGETHER) if start + TOGETHER < len(text) else None
        end = found.end() if found else len(text)
        yield text[start:end]
        start = end


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process."""
    return Encoder(path)


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    values = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _with(df: DataFrame, source: str, keep: list[str], added: dict[str, str], work) -> DataFrame:
    """``keep`` of every row and the columns that ``work`` makes of ``source``."""
    rows = df.select(F.struct(*keep).alias("row"), source)
    schema = T.StructType([rows.schema["row"], *[T.StructField(n, T._parse_datatype_string(t)) for n, t in added.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *work(batch.column(1))], ["row", *added])

    done = rows.mapInArrow(run, schema)
    return done.select(*[F.col("row").getField(c).alias(c) for c in keep], *added)


def encode_documents(docs: DataFrame, keep: list[str], path: str) -> DataFrame:
    """``keep`` of every row of ``docs`` and ``ids``, the token ids of its text.

    A null or empty text has no ids; repeated rows stay; a column of docs named like a result must not be kept;
    an empty table gives an empty result. Special tokens are text like any other. The file at ``path`` is read by
    each worker, so every executor needs it there. Nothing is shuffled. A row's ids are held at once, the pieces of
    a very long text are not.
    """
    return _with(docs, "text", keep, {"ids": "array<int>"}, lambda c: [_lists(list(encoder(path).encode(texts_of(c))))])


def decode_documents(rows: DataFrame, keep: list[str], path: str) -> DataFrame:
    """``keep`` of every row and ``decoded``, the bytes that its ``ids`` stand for. Null counts as no ids, a null or
    unknown id raises ``NotInVocabulary``."""

    def work(column):
        spell, out = encoder(path).vocabulary.decode, []
        for ids in column:
            values = ids.values if ids.is_valid else pa.array([], pa.int32())
            if values.null_count:
                raise NotInVocabulary("an id is null")
            out.append(spell(values.to_numpy()))
        return [pa.array(out, pa.binary())]

    return _with(rows, "ids", keep, {"decoded": "binary"}, work)


def round_trip(docs: DataFrame, keep: list[str], path: str) -> DataFrame:
    """``encode_documents`` and ``decode_documents`` in one pass: ``keep``, ``ids`` and ``decoded``."""

    def work(column):
        ids = list(encoder(path).encode(texts_of(column)))
        decoded = [encoder(path).vocabulary.decode(i) for i in ids]
        return [_lists(ids), pa.array(decoded, pa.binary())]

    return _with(docs, "text", keep, {"ids": "array<int>", "decoded": "binary"}, work)


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document, by the rules of ``encode_documents``."""
    done = round_trip(docs, ["doc_id"], path)
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
