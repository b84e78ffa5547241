"""URL filter, document fingerprints, license scan, chat formatting and top-k against brute force."""

import dataclasses
import hashlib
import random
import re
from collections import defaultdict
from re import _parser as parser

import numpy as np
import pytest

duckdb = pytest.importorskip("duckdb")

from pyspark.sql import functions as F  # noqa: E402

from checks.compare import TABLES, difference  # noqa: E402
from tianguis.llm import chat, entry, fingerprint, license_texts, licenses, topk, url_filter  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", " \n", "a", "ab", "abc", "é𝔘", "same text", "same text", "long " * 20000]


def docs(spark, texts):
    rows = [(i, t, "s", "x", 1, 2.0) for i, t in enumerate(texts)]
    schema = "doc_id bigint, text string, source string, words string, place int, head double"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.mark.parametrize("name", sorted(entry.SQL))
def test_query_matches_its_sql(spark, name):
    connection = duckdb.connect()
    for table in (*TABLES, "embeddings", "conversations", "documents", "labels"):
        connection.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    query, sql = entry.QUERIES[name], entry.SQL[name]
    small = {"op9_top_k": "rank", "op12_filter_audit": "step"}.get(name)
    if small:  # the comparison knows bigint only
        query = lambda s, d: entry.QUERIES[name](s, d).withColumn(small, F.col(small).cast("bigint"))
        sql = f"SELECT * REPLACE (CAST({small} AS BIGINT) AS {small}) FROM ({sql})"
    assert difference(spark, connection, name, query, sql, FOLDER) == ""


# URL filter


def brute_url(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in url_filter.RULES:
        top, tail = rule.split("/", 1)
        if (host == top or host.endswith("." + top)) and path.startswith("/" + tail) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, *(best or (None, None))


URLS = [
    None, "", "no scheme", "http://", "http://a.org", "http://a.org/", "https://X.Example.ORG/es/1?x#y", "https://example.org/en/12",
    "https://example.org/en/2", "https://badexample.org/es/", "ftp://b.com/fr/x", "http://b.com/de/", "http://com/de/://x", "a://b://c/d",
    "http://Österreich.com/de/ä\nb", "http://h?q/x", "http://h#f", "http://cheappills.net/buy", "http://freebets.net/", "http://www.spam-farm.net/en/3",
    "http://gardenclub.net/roses", "http://" + "a" * 5000 + ".net/" + "b/" * 5000, "x" * 200000, "y" * 100000 + "://z.org/" + "q" * 100000, "http://u:p@x.org:80/a",
]


def test_url_filter(spark):
    frame = spark.createDataFrame([(i, u, "h", "w") for i, u in enumerate([*URLS, URLS[6]])], "page_id bigint, url string, host string, words string")
    found = {r.page_id: r for r in url_filter.judge(frame).collect()}
    assert len(found) == len(URLS) + 1
    for i, u in enumerate([*URLS, URLS[6]]):
        host, path, rule, verdict = brute_url(u)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule), u
        assert found[i].verdict == verdict if rule else found[i].verdict in ("allow", "block")
    by_url = {u: found[i] for i, u in enumerate(URLS)}
    for u in URLS[17:20]:
        assert by_url[u].verdict == "block", u
    for u in (None, "http://gardenclub.net/roses", "http://h#f"):
        assert by_url[u].verdict == "allow", u
    assert by_url["http://cheappills.net/buy"].words.split()[:2] == ["cheap", "pills"]
    assert by_url["http://gardenclub.net/roses"].words.split()[:2] == ["garden", "club"]
    assert url_filter.judge(frame.limit(0)).count() == 0


def test_url_filter_on_pages(spark):
    rows = {r.page_id: r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url").collect()}
    found = entry.op1_url_filter(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.page_id for r in found) == sorted(rows)
    for r in found:
        host, path, rule, verdict = brute_url(rows[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if re.search("spam|pills|bets|adult", host) else "allow")), r


def test_every_counted_word_splits_names(spark):
    """More words seen once than any cap keeps: each still splits the host that runs it together with another."""
    name = lambda i: "".join(chr(97 + (i * 7919 // 17**k) % 17) for k in range(5)) + "zz"
    made = sorted({name(i) for i in range(60_000)})
    assert len(made) > 50_000
    rows = [(i, "http://h-1.net/" + "/".join(made[i : i + 50])) for i in range(0, len(made), 50)]
    rows += [(-1, f"http://{made[5]}{made[-7]}.net/")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").repartition(3)
    found = {r.page_id: r.words.split() for r in url_filter.judge(pages).where("page_id < 0").collect()}
    assert found[-1][:2] == [made[5], made[-7]]


LURES, PLAIN = "wager dealer chips payout croupier blackjack".split(), "trowel compost seedling pottery kettle linen".split()


def made_urls(seeded):
    """Unwanted sites use words that no list has, some of them beside a listed one; others use words of their own."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(3000):
        bad = i % 10 == 0
        own = [str(w) for w in rng.choice(LURES if bad else PLAIN, 2)]
        listed = [str(rng.choice(["casino", "slots", "poker"] if bad else ["garden", "kitchen"]))] if i % 20 < 10 and seeded else []
        rows.append((bad, [*listed, own[0], "net"], ["en", str(rng.choice(["page", "item", "list"])), own[1]]))
    return rows


def precision_and_recall(model, rows):
    found = [(bad, model.score([*h, *p]) > url_filter.THRESHOLD) for bad, h, p in rows]
    hits = sum(bad and said for bad, said in found)
    return hits / max(1, sum(said for _, said in found)), hits / max(1, sum(bad for bad, _ in found))


def test_words_beside_listed_ones_are_learnt():
    """Held-out urls hold no listed word at all, so a list by itself finds none of them."""
    rows = made_urls(True)
    model = url_filter.fit_words((h, p) for _, h, p in rows)
    assert precision_and_recall(url_filter.fit_words([]), made_urls(False))[1] == 0
    precision, recall = precision_and_recall(model, made_urls(False))
    assert precision >= 0.95 and recall >= 0.95
    once = url_filter.fit_words([*((h, p) for _, h, p in rows), (["casino", "zebra"], []), (["lyre", "net"], [])])
    assert once.score(["zebra"]) < 0 and once.score(["lyre"]) < 0  # seen once: no verdict


def test_urls_with_their_listed_words_hidden(spark, monkeypatch):
    """Learnt from one half of the supplied urls with five listed words, tried on the other half without them: what tells
    an unwanted site is then a word that stood beside one. Half the urls are some 55 to block, so not every word is learnt."""
    monkeypatch.setattr(url_filter, "BAD", {"pills", "bets", "casino", "adult", "spam"})
    monkeypatch.setattr(url_filter, "GOOD", set(url_filter.WANTED) - {"farm"})
    monkeypatch.setattr(url_filter, "COMPOUND_SIZES", [])
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    urls = pages.select("page_id", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    rows = [(r.page_id, r.host_words, r.path_words) for r in url_filter.segmented(urls).collect()]
    model = url_filter.fit_words((h, p) for i, h, p in rows if i % 2)
    tried = []
    for i, host, path in rows:
        if i % 2 == 0:
            seen = url_filter.seen_as(host, path)
            tried.append((bool(seen.block), list(seen.words.elements()), []))
    assert sum(bad for bad, _, _ in tried) > 20
    precision, recall = precision_and_recall(model, tried)
    assert precision >= 0.95 and recall >= 0.5, (precision, recall)


def test_split_of_long_runs_is_the_most_probable():
    words = url_filter.word_model({"the": 90.0, "green": 4.0})
    for name in ("z" * 40 + "green" + "q" * 30 + "the", "greenthe" * 12, "x" * 70):
        best = [0.0]
        for end in range(1, len(name) + 1):
            best.append(max(best[i] + words.logs.get(name[i:end], words.floor - url_filter.LETTER * (end - i)) for i in range(end)))
        got = words.split(name)
        assert "".join(got) == name
        assert sum(words.logs.get(w, words.floor - url_filter.LETTER * len(w)) for w in got) == pytest.approx(best[-1])


def test_split_is_the_most_probable():
    words = url_filter.word_model({"the": 90.0, "green": 4.0})

    def brute(name):
        def ways(rest):
            if not rest:
                yield []
            for n in range(1, len(rest) + 1):
                for more in ways(rest[n:]):
                    yield [rest[:n], *more]

        value = lambda way: sum(words.logs.get(w, words.floor - url_filter.LETTER * len(w)) for w in way)
        return max(map(value, ways(name))), value(words.split(name))

    for name in ("greenhouse", "thegreens", "zzq", "alphabet", "bookshops"):
        best, got = brute(name)
        assert got == pytest.approx(best)


# Fingerprints


def brute_neighbours(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for n, (i, text) in enumerate(rows):
        text, following = text or "", rows[(n + 1) % len(rows)][1] or ""
        m = len(text) // 3
        edited = text[: len(text) - m] + following[:m]
        windows = lambda t: {t[j : j + 24] for j in range(max(1, len(t) - 23))} if t else set()
        a, b, c = windows(text), windows(edited), windows(following)
        like = lambda x, y: 2 * len(x & y) / (len(x) + len(y)) if x | y else 1.0
        prefix = next((j for j, (x, y) in enumerate(zip(text, following, strict=False)) if x != y), min(len(text), len(following)))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), prefix, like(a, b), like(a, c)))
    return out


@pytest.mark.parametrize("range_rows", [5, 500])
def test_fingerprints(spark, range_rows):
    rng = random.Random(1)
    texts = [*ODD, *["".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 900))) for _ in range(40)]]
    texts[20] = texts[19][:-5] + "12345"
    frame = docs(spark, texts)
    found = fingerprint.compare_neighbours(frame, range_rows).collect()
    expected = brute_neighbours(list(enumerate(texts)))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.shared_prefix) for r in found) == sorted(e[:4] for e in expected)
    by_id = {r.doc_id: r for r in found}
    for i, _, _, _, edited, following in expected:
        assert by_id[i].near_edited == pytest.approx(edited, abs=0.25)
        assert by_id[i].near_next == pytest.approx(following, abs=0.25)
    assert by_id[7].fingerprint == by_id[8].fingerprint and by_id[8].near_next == 1 and by_id[0].fingerprint == by_id[1].fingerprint
    whole = {i: fingerprint.Fingerprint(t or "").text for i, t in enumerate(texts)}
    assert all(by_id[i].fingerprint == f for i, f in whole.items())
    ordered = sorted(enumerate(texts), reverse=True)
    for n, (i, text) in enumerate(ordered):
        assert by_id[i].edited_fingerprint == fingerprint.Fingerprint(fingerprint.edited_text(text or "", ordered[(n + 1) % len(ordered)][1] or "")[0]).text


def test_fingerprints_of_repeated_and_null_ids(spark):
    rows = [(None, "nobody"), (5, "five b"), (5, "five a"), (5, "five a"), (None, None), (9, "nine")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for range_rows in (1, 500):
        found = fingerprint.compare_neighbours(frame, range_rows).collect()
        assert sorted(((r.doc_id or 0, r.edited_sha256) for r in found)) == sorted((e[0] or 0, e[2]) for e in brute_neighbours(rows))
    alone = fingerprint.compare_neighbours(frame.where("doc_id = 9")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1
    assert fingerprint.compare_neighbours(frame.limit(0)).count() == 0


def test_prefix_hashes():
    rng = random.Random(2)
    text = "".join(rng.choice("ab") for _ in range(400))
    h = fingerprint.PrefixHash(fingerprint.codes(text))
    for _ in range(300):
        i, j, n = rng.randrange(380), rng.randrange(380), rng.randrange(1, 8)
        assert (h.span(i, i + n) == h.span(j, j + n)) == (text[i : i + n] == text[j : j + n])
        far = next((k for k in range(400) if text[i + k : i + k + 1] != text[j + k : j + k + 1] or max(i, j) + k >= 400), 400)
        assert h.extension(i, h, j) == far


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = "".join(random.Random(6).choice("abc ") for _ in range(3000))
    whole = fingerprint.Fingerprint(text)
    monkeypatch.setattr(fingerprint, "PART", 64)
    parts = fingerprint.Fingerprint(text)
    assert parts.text == whole.text and np.array_equal(parts.windows, whole.windows)
    edited, same = fingerprint.edited_text(text, text[500:])
    assert parts.edited(fingerprint.codes(edited), same) == fingerprint.Fingerprint(edited).text


def test_fingerprints_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    found = entry.op3_fingerprint(spark, FOLDER).collect()
    expected = brute_neighbours(rows)
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == sorted(e[:3] for e in expected)


# Licenses


def brute_licenses(text, rules):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(licenses.WORD, lower)
    places, base = [], set()
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        at = [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]
        places += at
        base |= {label} if at else set()
    joined = " " + " ".join(words) + " "
    hits = []
    for n, r in enumerate(rules):
        if r.keyword in joined:
            hits += [(m.start(), m.end(), r.priority, -n, r) for m in re.finditer(r.pattern, joined, re.ASCII)]

    def inside(a, b):
        if not (b[0] <= a[0] and a[1] <= b[1] and b[2] >= a[2]) or a is b:
            return False
        return (a[0], a[1]) != (b[0], b[1]) or (b[2], b[3]) > (a[2], a[3])

    kept = [h for h in hits if not any(inside(h, other) for other in hits)]
    labels = base | {h[4].label for h in kept}
    score = max([h[4].confidence for h in kept] + [0.5 * bool(base)])
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


LICENSE_TEXTS = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-2.0-or-later",
    "the MIT\tLICENSE mit license MİT License", "GNU Lesser General Public License v2.1 and the Affero General Public License",
    "mit license " * 300, "dedicated to the public domain; all rights reserved", "license: ISC", "cc_by  4.0", "Licensed under BSD-3-Clause",
    "general public license general public license", "permit licenses of admit licensed", "Permission (MIT-License)", "mitlicense ümit license",
]


def test_licenses(spark):
    rules = licenses.rules()
    assert 200 < len(rules) < 1000
    texts = [*ODD, *LICENSE_TEXTS, "x " + " y ".join(LICENSE_TEXTS)]
    found = {r.doc_id: tuple(r)[1:] for r in licenses.scan(docs(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert found[i] == brute_licenses(text, rules), text and text[:60]
    assert found[10][5] == "apache,apache-2.0" and found[12][5] == "cc-by-nc-4.0" and found[13][5] == "gpl,gpl-3.0"
    assert licenses.scan(docs(spark, [])).count() == 0


def test_every_name_passes_the_gates(spark):
    """A text that holds a rule's words must reach the rules, whatever its case."""
    texts = []
    for _, _, name, _ in licenses.LICENSES:
        plain = name.split("|")[0] if not name.startswith("(") else name
        for _ in range(9):
            plain = re.sub(r"\((?:\?:)?([^()|]*)[^()]*\)\??", r"\1", plain)
        texts.append(re.sub(r"\[c?s?(.)\]|\\d|v\?|(\w)\?", lambda m: m[1] or ("3" if m[0] == "\\d" else m[2] or ""), plain).upper())
    found = {r.doc_id: r.labels for r in licenses.scan(docs(spark, texts)).collect()}
    missing = [texts[i] for i, labels in found.items() if not labels]
    assert not missing


def written(pattern):
    """Every text that a name or identifier of the tables stands for; a digit is 3."""
    out = {""}
    for op, value in pattern:
        kind = str(op)
        if kind == "LITERAL":
            ways = {chr(value)}
        elif kind == "IN":
            ways = {chr(x) if str(o) == "LITERAL" else "3" for o, x in value}
        elif kind == "BRANCH":
            ways = set().union(*[written(p) for p in value[1]])
        elif kind == "SUBPATTERN":
            ways = written(value[-1])
        else:
            assert kind == "MAX_REPEAT" and tuple(value[:2]) == (0, 1)
            ways = {""} | written(value[2])
        out = {a + b for a in out for b in ways}
    return out


def test_every_alternative_is_found_as_without_keywords(spark):
    rules = licenses.rules()
    ungated = [dataclasses.replace(r, keyword="") for r in rules]
    texts = ["Released under the Expat License", "see the Internet Systems Consortium License"]
    for _, keyword, name, short in licenses.LICENSES:
        for plain in sorted(written(parser.parse(name))):
            assert keyword in plain, plain
            texts += [f"x {plain}.", f"Released under the {plain}.", f"subject to the {plain}"]
        texts += [f"SPDX-License-Identifier: {i}" for i in sorted(written(parser.parse(short))) if i]
    found = {r.doc_id: tuple(r)[1:] for r in licenses.scan(docs(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert found[i] == brute_licenses(text, ungated), text
        assert found[i][5], text
    assert found[0][5] == "mit" and found[1][5] == "isc"


def example(pattern):
    """A text that a sentence of the tables stands for."""
    out = ""
    for op, value in pattern:
        kind = str(op)
        if kind in ("ASSERT", "ASSERT_NOT"):
            continue
        if kind == "LITERAL":
            out += chr(value)
        elif kind == "IN":
            out += "x"
        elif kind == "BRANCH":
            out += example(value[1][0])
        elif kind == "SUBPATTERN":
            out += example(value[-1])
        else:
            out += example(value[2]) * value[0]
    return out


def test_every_sentence_is_found_as_without_keywords(spark):
    ungated = [dataclasses.replace(r, keyword="") for r in licenses.rules()]
    plain = [example(parser.parse(sentence)) for _, _, sentence in license_texts.SIGNATURES]
    assert all(keyword in text for (_, keyword, _), text in zip(license_texts.SIGNATURES, plain, strict=True))
    assert len(set(plain)) == len(plain) > 100
    found = {r.doc_id: tuple(r)[1:] for r in licenses.scan(docs(spark, [f"Note: {t.upper()}.\n" for t in plain])).collect()}
    for i, text in enumerate(plain):
        assert found[i] == brute_licenses(f"Note: {text.upper()}.\n", ungated), text
        assert license_texts.SIGNATURES[i][0] in found[i][5].split(",") and found[i][6] >= 0.9, text


def tried(text, rules):
    """The rules that a text's words let through, as the scan does."""
    words = re.findall(licenses.WORD, text.lower())
    joined = " " + " ".join(words) + " "
    return [r for r in rules if set(r.words) & set(words) and (not r.word or r.word in words) and r.keyword in joined]


def test_parts_of_words_do_not_reach_the_rules(spark):
    rules = licenses.rules()
    assert not tried("Beered devils x submit permits discs trails, licensing zlibs of republicans copyrightable", rules)
    assert not tried("a license for x to submit permits, discs, zlibs and trails", rules)
    plan = licenses.scan(docs(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Contains(") <= 5  # the phrases and the keywords: no list of words is searched for one by one


def test_words_are_parted_at_each_character(spark):
    texts = [chr(c).join(["", "MIT", "License", "x", ""]) for c in range(128)] + [c + "mit license" + c for c in "\u0130\u212a\u00a0\u0085𝔘"]
    texts += [f"Licensed under the MIT license{c}GPL" for c in "\u212a\u0130-é"] + ["\x00", "[^\\", "  \t mit \n\n license  ", "MIT L\u0130CENSE", "GNU GP\u212a"]
    found = {r.doc_id: tuple(r)[1:] for r in licenses.scan(docs(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert found[i] == brute_licenses(text, licenses.rules()), repr(text)


def test_given_rules_bring_their_words(spark):
    rules = [licenses.Rule("zork", "zork", " zorks?(?= )", 1, 0.7, ("zork", "zorks")), licenses.Rule("b", "b", " b a(?= )", 1, 0.6, ("b",), "a")]
    found = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs(spark, ["a ZORK.", "zorks", "b a", "b", "MIT License"]), rules).collect()}
    assert found == {0: ("zork", 0.7), 1: ("zork", 0.7), 2: ("b", 0.6), 3: ("", 0.0), 4: ("mit", 0.5)}


# Beginnings of license texts as they are pasted, without the name.
BODIES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies""",
    "bsd-2-clause": """2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS""",
    "bsd-3-clause": """* Neither the name of the Example Institute nor the names of its contributors
  may be used to endorse or promote products derived from this software""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice appear""",
    "apache-2.0": """you may not use this file except in compliance with the License.
# Unless required by applicable law or agreed to in writing, software""",
    "gpl-2.0": """it under the terms published by the Free Software Foundation; either version 2 of the License, or
# (at your option) any later version.""",
    "gpl-3.0": """The licenses for most software and other practical works are designed
to take away your freedom to share and change the works.""",
    "mpl-2.0": "/* This Source Code Form is subject to the terms of",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def test_bodies_without_a_name_are_found(spark):
    found = {r.doc_id: r for r in licenses.scan(docs(spark, list(BODIES.values()))).collect()}
    for i, label in enumerate(BODIES):
        assert label in found[i].labels.split(",") and found[i].score >= 0.9, label
        assert found[i].n_base == 0


def test_licenses_in_documents(spark):
    rules = licenses.rules()
    rows = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in entry.op7_licenses(spark, "/root/testdata/sf0.01").collect():
        assert tuple(r)[1:] == brute_licenses(rows[r.doc_id], rules)


def test_licenses_run_in_the_engine(spark):
    plan = licenses.scan(docs(spark, ["a"]).select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Chat

ALPHABET = ["\\", "#", "###", "### ", "</turn>", "</turn>\n", ":\n", ":\\\n", "\n", "a", "", "### assistant:\n", "\\\\", "é𝔘"]


def test_chat_round_trip():
    rng = random.Random(3)
    for _ in range(3000):
        turns = [("".join(rng.choices(ALPHABET, k=rng.randint(0, 3))), "".join(rng.choices(ALPHABET, k=rng.randint(0, 8)))) for _ in range(rng.randint(0, 4))]
        rendered = "".join(chat.render_turn(*t)[0] for t in turns)
        assert [(t.role, t.text) for t in chat.parse(rendered)] == turns
    for broken in ("x", "### a", "### a:\n", "### a:\nb</turn>", "### a:\\\nb\\</turn>\n"):
        with pytest.raises(chat.NotReadable):
            chat.parse(broken)


def test_chat_conversations(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), "".join(rng.choices(ALPHABET, k=5)) or None, 0) for c in (1, 2, None) for t in range(20)]
    rows += [rows[0], (1, None, "assistant", "first", 0), (3, 0, None, None, 0), (4, 0, "assistant", "x" * 200000, 0)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, part int").repartition(3)
    by_conversation = defaultdict(list)
    for c, t, role, text, _ in rows:
        by_conversation[c].append((t is not None, t or 0, role or "", text or ""))
    parts = defaultdict(dict)
    for r in chat.format_conversations(frame).collect():
        parts[r.conv_id][r.part] = r.rendered
    found = {r.conv_id: r for r in chat.digest_conversations(frame).collect()}
    assert set(found) == set(parts) == set(by_conversation)
    for c, turns in by_conversation.items():
        turns = [(role, text) for *_, role, text in sorted(turns)]
        whole = "".join(parts[c][n] for n in range(len(turns)))
        assert [(t.role, t.text) for t in chat.parse(whole)] == turns
        r = found[c]
        loss = "".join(text for role, text in turns if role == "assistant")
        masked = "".join(whole[a:b] if whole[a - 2] == ":" else chat.unescape(whole[a:b]) for a, b in r.loss_spans)
        assert masked == loss and r.loss_chars == len(loss) and r.formatted_chars == len(whole) and r.n_turns == len(turns)
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    assert chat.digest_conversations(frame.limit(0)).count() == 0


# Top k


def brute_top(rows, k, every):
    usable = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (i, v) in enumerate(usable):
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for m, (j, w) in enumerate(usable) if m != n)
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("size", [7, 1 << 14])
def test_top_k(spark, size, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * (rng.random(6) < 0.6)).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200, None), (201, [None] * 6), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (300, []), (None, [1.0]), (10, rows[10][1]), (10, rows[10][1])]
    rows += [(400 + i, rows[3][1]) for i in range(5)] + [(500, [1.0, 2.0]), (501, [0.5] * 9)]
    monkeypatch.setattr(topk, "CANDIDATES", size)
    monkeypatch.setattr(topk, "QUERIES", size)
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<float>, row int, block int").repartition(3)
    found = sorted(map(tuple, topk.top_k(frame, 10, 10).collect()))
    assert found == brute_top(rows, 10, 10)
    few = topk.top_k(frame.where("vec_id < 4"), 10, 10)
    assert few.count() == 3 and topk.top_k(frame.limit(0)).count() == 0


def test_examples_are_bounded_and_the_same_for_any_partitions(spark):
    rows = [(f"site{i % 7}-{chr(97 + i % 26)}{chr(97 + i % 11)}x.net", "/" + "abcdefgh"[i % 8] * (2 + i % 5) + "/common") for i in range(400)]
    urls = spark.createDataFrame([*rows * 3, ("", "/x")], "host string, path string")
    few = [sorted(map(tuple, url_filter.examples(urls.repartition(n), 10).select("host", "path").collect())) for n in (1, 4)]
    assert few[0] == few[1] and len(few[0]) == 10
    assert url_filter.examples(urls, 10_000).count() == len(set(rows))
