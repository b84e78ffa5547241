"""SimHash, language ID, suffix-array dedup, packing and mixing against brute force on small tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tianguis.llm import language, mixing, packing, simhash, suffix_array
from tianguis.llm import entry
from tianguis.llm.common import steps
from tianguis.llm.components import connected_components

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, ranges int, doc string"


def docs(spark, texts, source="s", extra=True):
    """Documents with clashing extra columns; None stays null."""
    rows = [(i, t, "en", source, None if t is None else len(t), "x", 1, "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


ODD = [None, "", " \t", "a", "Ünïcode — 𝔘 text", "word " * 3000, "same text here now", "same text here now", "1 2 3"]


def brute_simhash(rows, shingle=3, distance=3):
    prints = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        parts = [b" ".join(words[j : j + shingle]) for j in range(max(1, len(words) - shingle + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for x in ids:
        for y in ids:
            if x < y and (prints[x] ^ prints[y]).bit_count() <= distance:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: (f"{prints[i]:016x}", find(i)) for i in ids}


@pytest.mark.parametrize("large", [256, 2])
def test_simhash(spark, large):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(6)]
    near = [" ".join(rng.choice(words) if rng.random() < 0.01 else w for w in rng.choice(base).split()) for _ in range(60)]
    texts = ODD + base + near + base[:2]
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs(spark, texts), large_group=large).collect()}
    assert found == brute_simhash(list(enumerate(texts)))
    assert len({c for _, c in found.values()}) < len(texts) - 20


def test_simhash_on_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in entry.op2_simhash(spark, FOLDER).collect()}
    assert found == brute_simhash(rows)


def test_simhash_null_ids_and_empty(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    frame = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (None, "other")], "doc_id bigint, text string")
    found = Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(frame).collect())
    assert found == {(None, 4): 1, (4, 4): 2, (None, None): 1}


def test_every_pair_within_the_distance_shares_a_key():
    rng = random.Random(2)
    masks = simhash.key_masks(3)
    assert len(masks) == 20
    for _ in range(500):
        flip = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(flip & m == 0 for m in masks)


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(10, 90)] + [(7, 7), (None, 3), (1, 2), (2, 1), (1, 2)]
    rng.shuffle(links)
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint").repartition(5)).collect()}
    expected = {i: 100 for i in range(100, 161)} | {i: 5 for i in [5, *range(10, 90)]} | {1: 1, 2: 1}
    assert found == expected
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_language_on_documents(spark):
    rows = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    found = entry.op4_language(spark, "/root/testdata/sf0.01").collect()
    assert Counter(r.doc_id for r in found) == Counter(rows.keys())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == rows[r.doc_id].lang for r in held) >= 0.98 * len(held)


def test_language_cases(spark):
    train = spark.createDataFrame(
        [("en", "the cat and the dog were here with that thing"), ("de", "der hund und die katze sind nicht hier für das ding"),
         ("ru", "кошка и собака были здесь"), (None, "zzz"), ("xx", None)], "lang string, text string")
    model = language.fit(train)
    assert model.languages == ["de", "en", "ru"]
    assert language.spans("the cat and the dog собака были the dog and the cat", model) == [("en", 5), ("ru", 2), ("en", 5)]
    mixed = language.spans("the cat and the dog were here with that thing der hund und die katze sind nicht hier", model)
    assert [lang for lang, _ in mixed] == ["en", "de"]
    texts = [*ODD, "the dog", "the dog", "der hund " * 50000]
    frame = docs(spark, texts).withColumnRenamed("row", "score")
    found = {r.doc_id: r for r in language.predict(frame, model, ["doc_id", "lang"]).collect()}
    assert [found[i].lang_pred for i in (0, 1, 2, 8)] == ["und"] * 4
    assert found[9].lang_pred == found[10].lang_pred == "en" and found[11].lang_pred == "de"
    long = "the cat and the dog " * 40 + "der hund und die katze " * 40
    for most in (7, 64, 10**6):
        scores, length = language.text_scores(long, model, most)
        whole, letters = language.word_scores(language.codes(long), model)
        assert np.array_equal(scores, whole) and np.array_equal(length, letters)
    empty = language.fit(train.limit(0))
    assert {r.lang_pred for r in language.predict(frame, empty, ["doc_id"]).collect()} == {"und"}
    assert language.predict(frame.limit(0), model, ["doc_id"]).count() == 0


def test_viterbi_matches_brute_force():
    rng = np.random.default_rng(4)
    scores = [rng.normal(size=(n, 3)).astype(np.float32) * 4 for n in (0, 1, 5, 3, 9, 9)]
    for s, got in zip(scores, language.viterbi(scores, 2.0), strict=True):
        if len(s):
            best = max(np.ndindex(*[3] * len(s)), key=lambda p: sum(s[i, x] for i, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:], strict=False)))
            value = lambda p: sum(s[i, x] for i, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:], strict=False))  # noqa: B023, E731
            assert value(got) == pytest.approx(value(best))


def test_suffix_array():
    rng = np.random.default_rng(5)
    for n in [0, 1, 2, 3, 4, 5, 6, 7, 50, 333]:
        for top in (2, 3, 300):
            s = rng.integers(1, top, n)
            assert list(suffix_array.suffix_array(s)) == sorted(range(n), key=lambda i: list(s[i:]))


def brute_repeats(rows, length):
    """rows: (key, bytes), distinct, in order."""
    first, out = {}, {}
    for k, data in sorted(rows):
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if data[i : i + length] in first:
                gone[i : i + length] = True
            else:
                first[data[i : i + length]] = True
        spans = int(np.sum(gone & ~np.append(False, gone[:-1])))
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out[k] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def removed(df):
    return {r.row.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("block", [suffix_array.BLOCK, 700])
def test_repeats(spark, block):
    rng = random.Random(6)
    passages = ["".join(rng.choice("abé ") for _ in range(rng.choice([90, 120, 300]))) for _ in range(12)]
    texts = ["".join(rng.choice([*passages, "xyzé" * rng.randint(1, 9), str(rng.random()) * 5]) for _ in range(rng.randint(0, 9))) for _ in range(60)]
    texts += [None, "", "a" * 500, "ab" * 700, texts[3], "q" * 99, "q" * 100, "q" * 101, "\0" * 250, "z" + "\0" * 160]
    found = removed(suffix_array.deduplicate(docs(spark, texts), ["doc_id"], block=block))
    assert found == brute_repeats([(i, (t or "").encode()) for i, t in enumerate(texts)], 100)
    assert suffix_array.deduplicate(docs(spark, []), ["doc_id"]).count() == 0


def test_repeated_rows_and_null_ids(spark):
    rng = random.Random(7)
    text = "".join(rng.choice("abcdef ") for _ in range(400))
    frame = spark.createDataFrame([(5, text), (5, text), (None, text[:200]), (9, text)], "doc_id bigint, text string")
    found = sorted((r.row.doc_id or 0, r.n_removed) for r in suffix_array.deduplicate(frame, ["doc_id"]).collect())
    assert found == [(0, 0), (5, 200), (5, 200), (9, 400)]


def test_repeats_in_documents(spark):
    rows = [(r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in entry.op5_suffix_array(spark, FOLDER).collect()}
    assert found == brute_repeats(rows, 100)


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return t


def check_pieces(rows, texts, tokenizer):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
        total += at
    assert padding <= 0.01 * total


def test_packing(spark, tokenizer):
    texts = [*ODD, "It's we'll CAFÉ ＦＵＬＬ ½ x²  <|endoftext|> 12,34 é ﬁ", "ΟΔΟΣ İstanbul ǅ \x1f \x85 x", "naïve–dash… 'tis", "a" * 5000, "long words " * 120000]
    frame = docs(spark, texts)
    rows = packing.pack_documents(frame, public_tokenizers.path("word_bpe_49k.json")).collect()
    check_pieces(rows, dict(enumerate(texts)), tokenizer)
    assert all(len(r.ids) == 4 * r.length for r in rows)
    assert packing.pack_documents(docs(spark, []), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_packing_documents(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    check_pieces(entry.op6_packing(spark, FOLDER).collect(), texts, tokenizer)


def plain_pack(lengths, rooms, cheapest):
    """The rule of the packing with a search through all sequences; else each to the first with room, in order."""
    left, spent, out = list(rooms), [0.0] * len(rooms), []
    waiting = [(min(2048, n - at), d, at) for d, n in enumerate(lengths) for at in range(0, n, 2048)]
    while waiting:
        if cheapest:
            waiting.sort(key=lambda w: (-w[0], w[1], w[2]))
        n, d, at = waiting.pop(0)
        fits = [s for s, room in enumerate(left) if room >= n]
        usable = fits or [s for s, room in enumerate(left) if room]
        s = min(usable, key=lambda s: (spent[s], s)) if cheapest else usable[0]
        put = min(n, left[s])
        out.append((d, at, put, s, rooms[s] - left[s], bool(fits)))
        left[s] -= put
        spent[s] += packing.cost(put)
        if put < n:
            waiting.append((n - put, d, at + put))
    return out


def test_packing_takes_the_cheapest_sequence_and_cuts_only_for_want_of_room():
    rng = random.Random(8)
    lengths = [int(rng.lognormvariate(5.5, 1)) + 1 for _ in range(2000)]
    rooms = packing.capacities(sum(lengths))
    pieces = packing.pack(lengths)
    plain = plain_pack(lengths, rooms, cheapest=True)
    assert pieces == [p[:5] for p in plain]
    cut = {d for d, at, n, *_, whole in plain if not whole}
    assert all(len([p for p in pieces if p[0] == d]) == 1 for d, n in enumerate(lengths) if n <= 2048 and d not in cut)

    def costs(found, skip=()):
        full = [0.0] * len(rooms)
        for p in found:
            full[p[3]] += packing.cost(p[2])
        return np.std([c for s, (c, r) in enumerate(zip(full, rooms, strict=True)) if r == 2048 and s not in skip])

    in_order = plain_pack(lengths, rooms, cheapest=False)
    assert costs(pieces) < costs(in_order)
    # A document over half a sequence makes its sequence dear whatever is put beside it; the others are nearly equal.
    long = [{p[3] for p in found if p[2] > 1024} for found in (pieces, in_order)]
    assert costs(pieces, long[0]) < 0.5 * costs(in_order, long[1])
    assert list(steps([5, 5, 5, 100, 1], 10)) == [(0, 2), (2, 3), (3, 4), (4, 5)]


def test_mixing(spark):
    rng = random.Random(9)
    rows = []
    for source, count in (("big", 900), ("mid", 300), ("small", 60), (None, 40), ("blank", 3)):
        rows += [(len(rows) + i, "w " * rng.randint(1, 30) if source != "blank" else " ", source, "x") for i in range(count)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, weight string").repartition(4)
    tokens = {r[0]: len(r[1].split()) for r in rows}
    source = {r[0]: r[2] for r in rows}
    mass = Counter()
    for i, n in tokens.items():
        mass[source[i]] += n
    for target in (mixing.Target(repeats=3.0, block_tokens=2000), mixing.Target(repeats=None, entropy=0.9, block_tokens=2000)):
        found = mixing.mix(frame, target).collect()
        weight = {r.source: r.__getitem__("__source_weight") for r in found}
        epochs = {r.source: r.__getitem__("__epochs") for r in found}
        assert sum(weight.values()) == pytest.approx(1)
        if target.entropy:
            h = -sum(w * np.log(w) for w in weight.values() if w) / np.log(4)
            assert h == pytest.approx(0.9, abs=1e-6)
        else:
            assert max(epochs.values()) == pytest.approx(3)
        assert min(epochs.values()) == pytest.approx(1)
        used, times, blocks = Counter(), defaultdict(Counter), defaultdict(Counter)
        longest = max(tokens.values())
        for r in found:
            used[r.source] += tokens[r.doc_id]
            times[r.source][r.doc_id] += 1
            blocks[r["__block"]][r.source] += tokens[r.doc_id]
        for s, m in mass.items():
            if m:
                assert 0 <= used[s] - round(epochs[s] * m) <= longest
            assert set(times[s]) == {i for i in source if source[i] == s}
            assert max(times[s].values()) - min(times[s].values()) <= 1
        total = sum(used.values())
        for s in mass:
            assert used[s] / total == pytest.approx(weight[s], abs=0.01)
        assert len(blocks) == max(1, round(total / 2000))
        for s, m in mass.items():
            for b in range(len(blocks)) if m else ():
                assert abs(blocks[b][s] - round(epochs[s] * m) / len(blocks)) <= longest
    assert mixing.mix(frame.limit(0)).count() == 0
    assert isinstance(mixing.mix(frame).schema["weight"].dataType, T.StringType)


def test_mixing_places_every_row_by_brute_force(spark):
    """Epochs and blocks of every use, from the permutation keys alone."""
    rng = random.Random(4)
    rows = [(i % 70, "w " * rng.randint(0, 9), rng.choice(["a", "a", "a", "b", None])) for i in range(400)]
    rows += [(7, "same text here", "c")] * 300 + [(8, "other", "d")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    target = mixing.Target(repeats=1.5, block_tokens=100)
    keys = frame.select("source", "doc_id", "text", mixing.permutation_key().alias("pick"), F.xxhash64("text").alias("hash")).collect()
    streams = defaultdict(list)
    for k in sorted(keys, key=lambda k: (k.pick, k.doc_id, k.hash)):
        streams[k.source].append((k.doc_id, k.text, len(k.text.split())))
    found = mixing.mix(frame, target).collect()
    epochs = {r.source: r["__epochs"] for r in found}
    assert max(epochs.values()) == pytest.approx(1.5)
    mass = {s: sum(n for *_, n in rows) for s, rows in streams.items()}
    quota = {s: int(epochs[s] * m + 0.5) for s, m in mass.items()}
    blocks = max(1, round(sum(quota.values()) / 100))
    expected = Counter()
    for s, stream in streams.items():
        for epoch in range(1, quota[s] // mass[s] + 2):
            before = 0
            for doc_id, text, n in stream:
                place = (epoch - 1) * mass[s] + before
                if epoch <= quota[s] // mass[s] or place < quota[s]:
                    expected[s, doc_id, text, epoch, min(place * blocks // quota[s], blocks - 1)] += 1
                before += n
    assert Counter((r.source, r.doc_id, r.text, r["__epoch"], r["__block"]) for r in found) == expected
    copies = sum(r.source == "c" for r in found)
    assert 0 <= 3 * copies - quota["c"] < 3  # equal rows are used up to the quota, no further
