"""Byte-level BPE, filter audit and conversation repair against other libraries and brute force."""

import base64
import hashlib
import random
from collections import Counter
from itertools import permutations, product

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tianguis.llm import bpe, entry, filter_audit, repair

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [None, "", " ", "a", "'", "''s", "x'll don't 'til we've", "  two  spaces \n\n end  ", "é𝔘ßα漢字", "same", "same", "a" * 70, "ab" * 3000,
       "\x1c\x85　x", "12 3٣४ ½", "w" + "ord " * 60000]


def docs(spark, texts):
    rows = [(i, t, "s", "x", 1, 2.0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, decoded string, row int, piece double").repartition(3)


# Byte-level BPE


@pytest.fixture(scope="module")
def reference():
    with open(VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(VOCABULARY)


def test_pieces_are_the_matches_of_the_pattern(encoder):
    assert bpe.PATTERN == public_tokenizers.PATTERN
    pattern, rng = regex.compile(bpe.PATTERN), random.Random(2)
    letters = "'srevmltdLS  \n\t   1٣½!,é漢\x1c-"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)]
    points = np.array([ord(c) for t in texts for c in t], np.uint32)
    ends = np.cumsum([len(t) for t in texts])
    first = np.zeros(len(points), bool)
    first[[e - len(t) for e, t in zip(ends, texts, strict=True) if t]] = True
    begins = set(bpe.cut(points, first, encoder.kinds).tolist())
    at = 0
    for text in texts:
        assert {at + m.start() for m in pattern.finditer(text)} == {b for b in begins if at <= b < at + len(text)}, repr(text)
        at += len(text)


def test_every_code_point_is_of_its_kind(encoder):
    for point in [*range(0x3000), *range(0x3000, 0x110000, 37)]:
        if not 0xD800 <= point < 0xE000:
            c = chr(point)
            kind = bpe.SPACE if regex.match(r"\s", c) else bpe.LETTER if regex.match(r"\p{L}", c) else bpe.NUMBER if regex.match(r"\p{N}", c) else bpe.OTHER
            assert encoder.kinds[point] == kind


def test_ids_are_those_of_the_library(encoder, reference):
    rng = random.Random(3)
    texts = [t or "" for t in ODD] + [" " * 9000, "".join(rng.choice("abcdefgh") for _ in range(40_000)), "x  y" * 700_000]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), rng.randrange(0x1F300, 0x1F6FF)])) for _ in range(300)) for _ in range(200)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert encoder.vocabulary.decode(ids) == text.encode()


def test_one_tree_and_many_agree_with_the_plain_rule(encoder):
    vocabulary, rng = encoder.vocabulary, random.Random(5)

    def plain(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            pairs = [(vocabulary.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in vocabulary.ranks]
            if not pairs:
                return [vocabulary.ranks[p] for p in parts]
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    pieces = [bytes(rng.choice(b"aeinrst \xc3\xa9") for _ in range(rng.randrange(2, 65))) for _ in range(400)]
    for piece in pieces:
        assert bpe.merge_one(piece, vocabulary).tolist() == plain(piece)
        size = 1 << max(len(piece) - 1, 1).bit_length()
        raw = np.frombuffer(piece.ljust(size, b"\0"), np.uint8).reshape(1, -1)
        ids, count = bpe.merge_stack(raw, np.array([len(piece)]), vocabulary)
        assert ids.tolist() == plain(piece) and count.tolist() == [len(ids)]


def test_documents_go_round(spark, reference):
    frame = docs(spark, ODD)
    found = {r.doc_id: r for r in bpe.digest_documents(frame, VOCABULARY).collect()}
    encoded = bpe.encode_documents(frame, ["doc_id", "row"], VOCABULARY)
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode_documents(encoded, ["doc_id"], VOCABULARY).collect()}
    for i, text in enumerate(ODD):
        ids = reference.encode_ordinary(text or "")
        want = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
        assert (found[i].n_tokens, found[i].ids_sha256, found[i].decoded_sha256) == (len(ids), *want)
        assert back[i] == (text or "").encode()
    assert bpe.digest_documents(frame.limit(0), VOCABULARY).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert bytes(bpe.decode_documents(nothing, ["doc_id"], VOCABULARY).first().decoded) == b""
    with pytest.raises(Exception, match="NotInVocabulary"):
        bpe.decode_documents(spark.createDataFrame([(1, [60_000])], "doc_id bigint, ids array<int>"), ["doc_id"], VOCABULARY).collect()


def test_bpe_query(spark, reference):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = entry.op11_bpe(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# Filter audit


def brute_audit(rows, good, toxic):
    """rows: (doc_id, text, source). Every order applied to the rows one filter after the other."""
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    judged = []
    for doc_id, text, source in rows:
        text = text or ""
        words = regex.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        fails |= {"A"} if len(words) < 50 else set()
        fails |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else set()
        fails |= {"D"} if any(c in "#$%&*|" for c in text) else set()
        fails |= {"E"} if doc_id is not None and doc_id > least[text] else set()
        judged.append((source or "", fails, doc_id in good, doc_id in toxic))
    out, removed = {}, Counter()
    for part in {j[0] for j in judged}:
        mine = [j for j in judged if j[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(mine)
            for step, letter in enumerate(order, 1):
                gone = [j for j in left if letter in j[1]]
                left = [j for j in left if letter not in j[1]]
                failing = [j for j in mine if letter in j[1]]
                removed[part, letter] += len(gone)
                out[part, order, step] = [len(left), len(gone), len(failing) - len(gone), sum(j[1] == {letter} for j in mine), sum(j[2] for j in gone), sum(j[3] for j in gone)]
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_by_applying_every_order(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(rng.choices(words[: rng.choice([5, 40, 120])], k=rng.choice([10, 60, 90]))) + rng.choice(["", "", " # 5%", " ABCDEF" * 9]) for _ in range(25)]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(120)]
    rows += [(None, texts[0], "a"), (None, texts[0], "a"), (500, None, "c"), (501, "", "c"), (3, rows[3][1], rows[3][2]), (7, texts[1], "b"), (502, "\x0b \t", "d")]
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 120, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (900, 1, 1)]
    frame = spark.createDataFrame([(*r, 1, "x", 0) for r in rows], "doc_id bigint, text string, source string, id int, digest string, n int").repartition(5)
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").repartition(3)
    found = filter_audit.audit(frame, labels).collect()
    good, toxic = ({i for i, *m in marks if m[k] == 1 and i is not None} for k in (0, 1))
    expected = brute_audit(rows, good, toxic)
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found} == expected
    assert len(found) == len(expected)
    assert filter_audit.audit(frame.limit(0), labels).count() == 0
    assert sum(r.good_lost for r in filter_audit.audit(frame, labels.limit(0)).collect()) == 0


def test_paths_through_the_lattice():
    reach, leave = filter_audit.states()
    assert reach[31] == leave[0] == 120 and sum(n for _, _, n, _ in filter_audit.edges()) == 600
    assert all(n == len(steps) for _, _, n, steps in filter_audit.edges())
    assert all(reach[s] * leave[s] == sum(n for t, _, n, _ in filter_audit.edges() if t == s) for s in range(31))


# Conversation repair


def legal(initials):
    return regex.fullmatch(r"(s?(ua)+)?", initials) is not None


def brute_repair(rows):
    """The least (cost, audit) over all edits, with at most two turns inserted in each gap."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    for chosen in product(*[[None, row.initial, "u!", "a!"] for row in rows]):
        for inserted in product(gaps, repeat=len(rows) + 1):
            cost, audit, shown = 3 * len(inserted[0]), "I" * len(inserted[0]), inserted[0]
            for row, pick, more in zip(rows, chosen, inserted[1:], strict=True):
                if pick is None:
                    cost, audit = cost + 4, audit + "D"
                elif row.must_go:
                    break
                else:
                    cost += (3 if row.truncated else 0) + (3 if "!" in pick else 0)
                    audit, shown = audit + ("R" if "!" in pick else "K"), shown + (pick[0] if pick else "?")
                cost, audit, shown = cost + 3 * len(more), audit + "I" * len(more), shown + more
            else:
                if legal(shown) and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def repaired(rows, block, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", block)
    found = repair.Repair()
    for row in rows:
        found.add(row)
    return found.result()


def test_repairs_are_the_cheapest_of_all(monkeypatch):
    rng = random.Random(7)
    for n in [0, 1, 1, 2, 2, 2, *[3] * 25]:
        rows = [repair.Row(rng.choice("suax "), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]
        want = brute_repair(rows)
        assert repaired(rows, 128, monkeypatch) == want and repaired(rows, 1, monkeypatch) == want


def test_blocks_of_any_size_give_the_same_repair(monkeypatch):
    rng = random.Random(8)
    for n in (5, 40, 300):
        rows = [repair.Row(rng.choice("suaua"), rng.random() < 0.1, rng.random() < 0.1) for _ in range(n)]
        whole = repaired(rows, 1000, monkeypatch)
        assert all(repaired(rows, block, monkeypatch) == whole for block in (1, 2, 7, 64))


def test_agenda_finalises_in_order_of_weight():
    final = repair.lightest({"a": (1, "x"), "b": (2, "y")}, [(("a",), "c"), (("a", "b"), "d"), (("c", "b"), "d"), (("d",), "goal")], goal="goal")
    assert final["d"] == (3, "xy") and list(final) == sorted(final, key=final.get)
    assert "e" not in repair.lightest({"a": (0, "")}, [(("a", "missing"), "e")])


def test_an_audit_can_be_applied(spark):
    rewriter = repair.Rewriter("IKDRI")
    turns = [*rewriter.row("assistant", "x"), *rewriter.row("user", "gone"), *rewriter.row("tool", "z"), *rewriter.rest()]
    assert turns == ["user:", "assistant:x", "user:z", "assistant:"]


ROWS = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 3, "user", "Go"), (1, 3, "user", "Go"), (1, None, "system", "Be good."),
    (2, 0, "assistant", " \t"), (3, 0, None, None), (None, 0, "user", "No id."), (None, 1, "assistant", "Right!"),
    (4, 5, "user", "a?"), (4, 5, "assistant", "b!"), (5, 0, "", "no role."), (6, 0, "user", "long " * 30000 + "."), (6, 1, "user", "é "),
]


def test_repairs_of_odd_conversations(spark):
    frame = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "conv_id bigint, turn bigint, role string, text string, copies int, found string")
    done = repair.digest_repairs(repair.damaged(frame.repartition(4)))
    found = {r.conv_id: r for r in done.collect()}
    assert set(found) == {r[0] for r in ROWS} and done.count() == len(found)
    turns = repair.repaired_turns(repair.damaged(frame))
    by_conv = {}
    for r in turns.orderBy("conv_id", "place").collect():
        by_conv.setdefault(r.conv_id, []).append((r.place, r.turn))
    for i, r in found.items():
        mine = by_conv.get(i, [])
        assert [p for p, _ in mine] == list(range(len(mine)))
        assert legal("".join(t.split(":", 1)[0][:1] for _, t in mine))
        assert r.repaired_sha256 == hashlib.sha256("\n".join(t for _, t in mine).encode()).hexdigest()
    plain = frame.select("conv_id", "turn", "role", "text", F.lit(0).alias("copies"))
    for r in repair.digest_repairs(plain).collect():
        assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.digest_repairs(repair.damaged(frame.limit(0))).count() == 0


def test_faults_are_counted_once_and_in_order(spark):
    rows = [(1, 0, "user", "Hi.", 1), (1, 1, "user", "Hi.", 1), (1, 2, "user", " ", 1), (1, 2, "user", " ", 1), (1, 4, "assistant", "cut", 2), (1, 9, "tool", "x.", 0)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, copies int")
    r = repair.digest_repairs(frame).first()
    assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == (1, 2, 2, 1, 4, 19, "KDDDKD")
    assert r.repaired_sha256 == hashlib.sha256(b"user:Hi.\nassistant:cut").hexdigest()
