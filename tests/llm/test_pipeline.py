"""The pipeline's stages against brute force, each on what the one before it kept."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from test_corpus_a import brute_repeats, brute_simhash
from tokenizers import Tokenizer

import corpus_pipeline
from tianguis.llm import entry, mixing
from tianguis.llm.common import stored

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.fixture(scope="module")
def stages(spark):
    """Name to (rows given, rows returned); documents of the supplied table and some odd ones."""
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select(*COLUMNS).collect()]
    odd = [(900_001, None, "en", None, None), (900_002, "", "en", "a", 0), (900_003, "12 34", None, "a", 5),
           (None, docs[3][1], "en", "b", 1), docs[5], (900_004, docs[7][1], "zz", "c", 9)]
    given, out = docs + odd, {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, frame(spark, given).repartition(3), FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert result.columns == COLUMNS
        rows = [tuple(r) for r in result.collect()]
        out[name] = (given, rows)
        given = rows
    return out


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "SimHash near-dedup", "suffix-array dedup", "mixing sources to target weights", "packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_language_stage_rejects_texts_without_words_alone(stages):
    given, rows = stages["language ID"]
    gone = Counter(given) - Counter(rows)
    assert not Counter(rows) - Counter(given)
    assert {r[0] for r in gone} == {900_001, 900_002, 900_003}


def test_one_near_copy_stays(stages):
    given, rows = stages["SimHash near-dedup"]
    known = {r[0]: r[1] for r in given if r[0] is not None}
    roots = {i: root for i, (_, root) in brute_simhash(list(known.items())).items()}
    assert sorted(r[0] for r in rows if r[0] is not None) == sorted(set(roots.values()))
    assert not [r for r in rows if r[0] is None]  # the row without an id repeats another's text
    assert not Counter(rows) - Counter(given)
    assert len(rows) < len(given) - 10


def test_near_copies_are_told_by_their_texts_not_by_their_ids(spark):
    text = {k: " ".join(f"{k}{i % 37}word{i}" for i in range(60)) for k in "abcd"}
    rows = [(5, "a"), (5, "b"), (None, "c"), (None, "c"), (7, "c"), (None, "d"), (9, "a"), (9, "a"), (11, "b")]
    given = frame(spark, [(i, text[k], "en", k, 1) for i, k in rows] + [(12, None, "en", "n", 0), (13, "", "en", "n", 0)])
    found = corpus_pipeline.near_duplicates(spark, given.repartition(4), FOLDER).collect()
    assert sorted(((r[0], r[3]) for r in found), key=str) == sorted([(5, "a"), (5, "b"), (7, "c"), (None, "d"), (12, "n")], key=str)
    assert corpus_pipeline.near_duplicates(spark, given.limit(0), FOLDER).count() == 0


def test_repeated_passages_go(stages):
    given, rows = stages["suffix-array dedup"]
    least = -1
    texts = [(least if r[0] is None else r[0], (r[1] or "").encode()) for r in given]
    expected = brute_repeats(texts, 100)
    found = {least if r[0] is None else r[0]: r for r in rows}
    for i, data in texts:
        n, removed, _, _ = expected[i]
        if removed == n and n:
            assert i not in found
            continue
        kept = found[i][1].encode()
        assert n - removed - 6 <= len(kept) <= n - removed or not removed and kept == data
        assert found[i][4] == len(found[i][1])
    assert any(e[1] for e in expected.values())


def test_mix_keeps_all_and_meets_the_weights(stages):
    given, rows = stages["mixing sources to target weights"]
    times = Counter(rows)
    assert set(times) == set(given) and max(times.values()) <= 2
    mass, used = Counter(), Counter()
    for r in given:
        mass[r[3]] += len((r[1] or "").split())
    for r in rows:
        used[r[3]] += len((r[1] or "").split())
    assert max(used[s] / mass[s] for s in mass) <= 2 + 0.1 and min(used[s] / mass[s] for s in mass) >= 1
    largest = max(mass, key=mass.get)
    assert used[largest] == mass[largest]
    assert used[min(mass, key=mass.get)] > mass[min(mass, key=mass.get)]
    assert mixing.Target().repeats == 2.0


def test_packed_pieces_hold_every_token_once(stages):
    given, rows = stages["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    wanted = Counter()
    for r in given:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        wanted[r[0], len(ids), zlib.crc32(ids.tobytes())] += 1
    pieces, sequences = defaultdict(list), defaultdict(list)
    for doc_id, start, length, crc, total, sequence, offset, room, ids in rows:
        assert len(ids) == 4 * length and crc == zlib.crc32(ids)
        pieces[doc_id].append((start, ids, total))
        sequences[sequence].append((offset, length, room))
    assert sum(len(p[1]) for ps in pieces.values() for p in ps) == sum(4 * n * k for (_, n, _), k in wanted.items())
    for (doc_id, n, crc), copies in wanted.items():
        if copies == 1:
            body = b"".join(ids for _, ids, _ in sorted(pieces[doc_id]))
            assert len(body) == 4 * n and zlib.crc32(body) == crc
    for parts in sequences.values():
        at = 0
        for offset, length, room in sorted(parts):
            assert offset == at
            at += length
        assert at == room <= 2048


def test_language_stage_keeps_mixed_texts_and_unlabelled_tables(spark):
    learned = {"en": "the cat and the dog were here with that thing ", "de": "der hund und die katze sind nicht hier für das ding ",
               "ru": "кошка и собака были здесь вместе с другими "}
    rows = [(i, text * 20, lang, "s", 0) for i in range(30) for lang, text in learned.items()]
    rows += [(101, "".join(text * 20 for text in learned.values()), None, "s", 0), (102, "12 !", None, "s", 0), (103, None, None, "s", 0), (104, "", None, "s", 0)]
    given = frame(spark, rows)
    whole = Counter(tuple(r) for r in corpus_pipeline.language_id(spark, given, FOLDER).collect())
    assert whole == Counter(r for r in rows if r[0] < 102)
    unlabelled = [(*r[:2], None, *r[3:]) for r in rows]
    found = Counter(tuple(r) for r in corpus_pipeline.language_id(spark, frame(spark, unlabelled), FOLDER).collect())
    assert found == Counter(r for r in unlabelled if r[0] < 102)


def test_mix_is_in_the_order_of_its_blocks(spark):
    rows = [(i, "w " * 40, "en", "big" if i % 10 else "small", 80) for i in range(600)]
    given = frame(spark, rows).repartition(3)
    order = sorted(mixing.mix(given).collect(), key=lambda r: (r["__block"], r["__slot"]))
    found = [r.doc_id for r in stored(corpus_pipeline.mix_sources(spark, given, FOLDER)).collect()]
    assert found == [r.doc_id for r in order]
    assert not any(a == b for a, b in zip(found, found[1:], strict=False))


def test_added_tokens_are_those_of_the_tokenizer_as_loaded(spark, tmp_path):
    texts = ["end <|endoftext|> here", "<|startoftext|>", "a <|ENDOFTEXT|> b", "é <|endoftext|><|startoftext|> ½", "<|endoftext|", "word <|endoftext|> " * 70_000]
    given = frame(spark, [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)])
    given.write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for t in texts]
    pieces = defaultdict(list)
    for r in corpus_pipeline.pack(spark, given, FOLDER).collect():
        pieces[r.doc_id].append((r.start, bytes(r.ids)))
    for r in entry.op6_packing(spark, str(tmp_path)).collect():
        ids = expected[r.doc_id][4 * r.start : 4 * (r.start + r.length)]
        assert r.ids_crc32 == zlib.crc32(ids) and 4 * r.doc_tokens == len(expected[r.doc_id])
    assert [b"".join(ids for _, ids in sorted(pieces[i])) for i in range(len(texts))] == expected


def test_stages_on_empty_tables(spark):
    empty = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and all(r.length > 0 and r.offset + r.length <= r.sequence_tokens for r in rows)
