"""License detection by ordered signature rules, in built-in functions alone.

Rules are regular expressions over the words of a text, lower-cased and parted by single spaces. Rules are tried
only on texts that have one of their words, and a rule only if its own word and its keyword are there. Its matches are intervals of that string; an interval inside another one of
the same or a higher priority is suppressed, so a version beats the bare family name and a notice beats a mention.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tianguis.llm.license_texts import SIGNATURES, STEMS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a text once its A-Z are lower-cased, and what parts them: character by character, since the engine looks
#: those up in one table, while it tries ranges one after another.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = "[" + "".join(f"\\x{c:02X}" for c in [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]) + "]+"

# Phrases that are always counted, with their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Licenses as label, keyword, name and short identifier; both as regular expressions over words. Every
# alternative of a name holds the keyword; names without it have a row of their own, which repeats no identifier.
LICENSES = [
    ("mit", "mit", r"mit license|mit expat license", r"mit"),
    ("mit", "expat", r"expat license", ""),
    ("mit-0", "mit", r"mit no attribution(?: license)?|mit 0 license", r"mit 0"),
    ("x11", "x11", r"x11 license|mit x11 license", r"x11"),
    ("isc", "isc", r"isc license", r"isc"),
    ("isc", "internet systems", r"internet systems consortium license", ""),
    ("bsd", "bsd", r"bsd licen[cs]e|bsd style licen[cs]e", r"bsd"),
    ("bsd", "berkeley", r"berkeley software distribution license", ""),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: license)?", r"bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: license)?", r"bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?", r"bsd 4 clause"),
    ("0bsd", "bsd", r"(?:zero clause bsd|bsd zero clause|bsd 0 clause)(?: license)?", r"0bsd"),
    ("apache", "apache", r"apache (?:software )?license", r"apache"),
    ("apache-1.1", "apache", r"apache (?:software )?license(?: version)? v?1 1", r"apache 1 1"),
    ("apache-2.0", "apache", r"apache (?:software )?license(?: version)? v?2(?: 0)?", r"apache 2 0"),
    ("gpl", "general public", r"(?:gnu )?general public licen[cs]e", r"gpl"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: version)? v?1(?: 0)?", r"gpl 1 0(?: only| or later)?"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: version)? v?2(?: 0)?", r"gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: version)? v?3(?: 0)?", r"gpl 3 0(?: only| or later)?"),
    ("gpl-short", "gpl", r"gnu gpl|gpl licen[cs]ed?|gplv[123]", r"gplv[123]"),
    ("lgpl", "lesser general public", r"(?:gnu )?lesser general public licen[cs]e", r"lgpl"),
    ("lgpl-2.0", "library general public", r"(?:gnu )?library general public licen[cs]e(?: version)? v?2(?: 0)?", r"lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", "lesser general public", r"(?:gnu )?lesser general public licen[cs]e(?: version)? v?2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "lesser general public", r"(?:gnu )?lesser general public licen[cs]e(?: version)? v?3(?: 0)?", r"lgpl 3 0(?: only| or later)?"),
    ("agpl", "affero general public", r"(?:gnu )?affero general public licen[cs]e", r"agpl"),
    ("agpl-3.0", "affero general public", r"(?:gnu )?affero general public licen[cs]e(?: version)? v?3(?: 0)?", r"agpl 3 0(?: only| or later)?"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[cs]e", r"gfdl"),
    ("gfdl-1.3", "free documentation", r"(?:gnu )?free documentation licen[cs]e(?: version)? v?1 3", r"gfdl 1 3(?: only| or later)?"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e", r"mpl"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e(?: version)? v?1 1", r"mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e(?: version)? v?2(?: 0)?", r"mpl 2 0"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e(?: version)? v?1(?: 0)?", r"epl 1 0"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e(?: version)? v?2(?: 0)?", r"epl 2 0"),
    ("epl", "eclipse", r"eclipse public licen[cs]e", r"epl"),
    ("cddl-1.0", "common development", r"common development and distribution licen[cs]e", r"cddl 1 0"),
    ("cpl-1.0", "common public", r"common public licen[cs]e", r"cpl 1 0"),
    ("eupl-1.2", "european union", r"european union public licen[cs]e", r"eupl 1 [12]"),
    ("artistic", "artistic", r"artistic licen[cs]e", r"artistic"),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e(?: version)? v?2(?: 0)?", r"artistic 2 0"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", r"zlib"),
    ("libpng", "libpng", r"libpng licen[cs]e", r"libpng"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e", r"bsl 1 0"),
    ("busl-1.1", "business source", r"business source licen[cs]e", r"busl 1 1"),
    ("unlicense", "unlicense", r"the unlicense|unlicense org", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", r"wtfpl"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?", r"cc0 1 0"),
    ("cc-by", "cc by", r"cc by", r"cc by"),
    ("cc-by-3.0", "cc by", r"cc by 3 0", r"cc by 3 0"),
    ("cc-by-4.0", "cc by", r"cc by 4 0", r"cc by 4 0"),
    ("cc-by-sa-3.0", "cc by", r"cc by sa 3 0", r"cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc by", r"cc by sa 4 0", r"cc by sa 4 0"),
    ("cc-by-sa", "cc by", r"cc by sa", r"cc by sa"),
    ("cc-by-nc-3.0", "cc by", r"cc by nc 3 0", r"cc by nc 3 0"),
    ("cc-by-nc-4.0", "cc by", r"cc by nc 4 0", r"cc by nc 4 0"),
    ("cc-by-nc", "cc by", r"cc by nc", r"cc by nc"),
    ("cc-by-nc-sa-4.0", "cc by", r"cc by nc sa(?: 4 0)?", r"cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc by", r"cc by nc nd(?: 4 0)?", r"cc by nc nd 4 0"),
    ("cc-by-nd-4.0", "cc by", r"cc by nd(?: 4 0)?", r"cc by nd 4 0"),
    ("cc-attribution", "creative commons", r"creative commons attribution(?: \d 0)?(?: international| unported)?(?: licen[cs]e)?", r"cc attribution"),
    ("cc-attribution-sharealike", "creative commons", r"creative commons attribution share ?alike(?: \d 0)?(?: international| unported)?(?: licen[cs]e)?", r"cc attribution sharealike"),
    ("cc-attribution-noncommercial", "creative commons", r"creative commons attribution non ?commercial(?: \d 0)?(?: international| unported)?(?: licen[cs]e)?", r"cc attribution noncommercial"),
    ("odbl-1.0", "open database", r"open database licen[cs]e", r"odbl 1 0"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution licen[cs]e", r"odc by 1 0"),
    ("pddl-1.0", "open data commons", r"open data commons public domain dedication", r"pddl 1 0"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[cs]e", r"ofl 1 1"),
    ("psf-2.0", "python software", r"python software foundation licen[cs]e", r"psf 2 0"),
    ("php-3.01", "php", r"php licen[cs]e", r"php 3 01"),
    ("ruby", "ruby", r"ruby licen[cs]e", r"ruby"),
    ("openssl", "openssl", r"openssl licen[cs]e", r"openssl"),
    ("openrail", "rail", r"open ?rail(?: m)?(?: licen[cs]e)?", r"openrail"),
    ("openrail", "responsible ai", r"responsible ai licen[cs]e", ""),
    ("public-domain", "public domain", r"(?:dedicated to|released (?:in)?to|placed in(?:to)?|in) the public domain", r"public domain"),
    ("proprietary", "rights reserved", r"all rights reserved", r"proprietary"),
]

# Ways to state a license as form, priority (higher wins) and confidence, around a name or identifier.
UNDER = r"(?:licen[cs]ed|released|distributed|published|available|provided|redistributed|offered|shared) (?:\w+ )?under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:gnu )?"
FORMS = [
    ("notice", 3, 0.95, "name", UNDER + "(?:{})"),
    ("notice-id", 3, 0.9, "id", r"licen[cs]ed (?:\w+ )?under (?:the )?(?:{})(?: licen[cs]e)?"),
    ("terms", 2, 0.85, "name", r"(?:subject to|governed by|covered by|under|see|terms of) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:{})"),
    ("tag", 4, 1.0, "id", r"spdx licen[cs]e identifier (?:{})"),
    ("field", 3, 0.9, "id", r"licen[cs]e (?:name |type |is )?(?:{})"),
    ("mention", 1, 0.7, "name", r"(?:{})"),
]
#: Priorities are 1 to this.
PRIORITIES = 4
#: Every match of a name or identifier in one of the forms holds one of these as a word.
NAME_WORDS = (
    "license", "licence", "licensed", "licenced", "bsd", "freebsd", "gpl", "gplv1", "gplv2", "gplv3", "unlicense", "wtfpl", "cc0", "cc",
    "commons", "attribution", "rail", "openrail", "domain", "reserved",
)


@dataclass(frozen=True)
class Rule:
    """A text with a match holds the keyword, and as words one of ``words`` and, unless it is empty, ``word``."""

    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float
    words: tuple[str, ...]
    word: str = ""


def _without_groups(pattern: str) -> str:
    """The pattern with a + for each of its outermost groups."""
    while "(" in pattern:
        pattern = re.sub(r"\([^()]*\)", "+", pattern)
    return pattern


def _beginning(pattern: str) -> str:
    """The characters, a space first, with which every match of a name or identifier begins."""
    flat = _without_groups(pattern)
    if "|" in flat:
        return commonprefix([_beginning(p) for p in flat.split("|")])
    head = re.match(r"[^\\\[(?+]*", pattern)[0]
    rest = pattern[len(head) :]
    if rest.startswith("?"):
        return f" {head[:-1]}"
    return f" {head} " if not rest or rest.startswith("(?: ") else f" {head}"


def _plain_words(sentence: str) -> list[str]:
    """The words of the sentence that stand outside of its groups."""
    return [w for w in _without_groups(sentence).split(" ") if re.fullmatch("[a-z]+", w)]


def rules() -> list[Rule]:
    """Every license in every form, in the order of the tables, then the sentences of license texts and headers."""
    out = []
    for label, keyword, name, short in LICENSES:
        for _, priority, confidence, kind, form in FORMS:
            if kind == "id" and not short:
                continue
            filled = name if kind == "name" else short
            needs = max(_beginning(filled), keyword if kind == "name" else "", key=len)
            word = max(re.findall("(?<= )[^ ]+(?= )", needs), key=len, default="")
            out.append(Rule(label, needs, " " + form.format(filled) + "(?= )", priority, confidence, NAME_WORDS, word))
    for label, keyword, sentence in SIGNATURES:
        plain = _plain_words(sentence)
        gate = next(w for w in plain if w.startswith(STEMS))
        out.append(Rule(label, keyword, f" {sentence}(?= )", PRIORITIES, 0.98, (gate,), max(plain, key=len)))
    return out


def _literal(found: list[Rule]) -> Column:
    """The rules by word and keyword, as an array of structs (word, keyword, rules)."""
    groups: dict[tuple[str, str], list[Column]] = {}
    for i, r in enumerate(found):
        groups.setdefault((r.word, r.keyword), []).append(
            F.struct(F.lit(r.label).alias("label"), F.lit(r.pattern).alias("pattern"), F.lit(r.priority).alias("priority"),
                     F.lit(r.confidence).alias("confidence"), F.lit(i).alias("at"))
        )
    return F.array(*[
        F.struct(F.lit(word).alias("word"), F.lit(keyword).alias("keyword"), F.array(*group).alias("rules"))
        for (word, keyword), group in groups.items()
    ])


def _words(words: set[str]) -> Column:
    return F.array(*[F.lit(w) for w in sorted(words)])


def _intervals(words: Column, rule: Column, matches: Column) -> Column:
    """A rule's matches as structs (start, last): what is between the matches gives their places."""
    between = F.split(words, rule["pattern"], -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,last:int>>").alias("out"))

    def step(state, x):
        begin = state["at"] + F.length(x["a"])
        end = begin + F.length(F.coalesce(x["b"], F.lit("")))
        out = F.when(x["b"].isNull(), state["out"]).otherwise(
            F.array_append(state["out"], F.struct(begin.alias("start"), (end - 1).alias("last")))
        )
        return F.struct(end.alias("at"), out.alias("out"))

    zipped = F.transform(F.arrays_zip(between.alias("a"), matches.alias("b")), lambda z: F.struct(z["a"].alias("a"), z["b"].alias("b")))
    return F.aggregate(zipped, start, step, lambda state: state["out"])


def detections(present: Column, words: Column, found: list[Rule]) -> Column:
    """All matches in the order of their start, longer and stronger ones first; ``present`` has the rules' words that the
    text has, and an empty one."""
    own = F.filter(_literal(found), lambda g: F.array_contains(present, g["word"]))
    tried = F.flatten(F.transform(F.filter(own, lambda g: F.contains(words, g["keyword"])), lambda g: g["rules"]))
    searched = F.transform(
        tried, lambda r: F.struct(r.alias("rule"), F.regexp_extract_all(words, r["pattern"], F.lit(0)).alias("matches"))
    )
    hits = F.flatten(
        F.transform(
            F.filter(searched, lambda s: F.size(s["matches"]) > 0),
            lambda s: F.transform(
                _intervals(words, s["rule"], s["matches"]),
                lambda x: F.struct(
                    x["start"].alias("start"), (-x["last"]).alias("back"), (-s["rule"]["priority"]).alias("weak"), s["rule"]["at"].alias("at"),
                    s["rule"]["label"].alias("label"), s["rule"]["confidence"].alias("confidence"),
                ),
            ),
        )
    )
    return F.array_sort(hits)


def surviving(hits: Column) -> Column:
    """Distinct labels and the highest confidence of the intervals that none of their priority or above contains.
    In the order of ``detections`` an interval lies inside an earlier one if it ends no later."""
    start = F.struct(
        F.array_repeat(F.lit(-1), PRIORITIES).alias("reach"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("score"),
    )

    def step(state, x):
        last, priority = -x["back"], -x["weak"]
        inside = F.exists(F.slice(state["reach"], priority, PRIORITIES), lambda r: r >= last)
        reach = F.transform(state["reach"], lambda r, i: F.when(i + 1 == priority, F.greatest(r, last)).otherwise(r))
        return F.struct(
            reach.alias("reach"),
            F.when(inside, state["labels"]).otherwise(F.array_union(state["labels"], F.array(x["label"]))).alias("labels"),
            F.when(inside, state["score"]).otherwise(F.greatest(state["score"], x["confidence"])).alias("score"),
        )

    return F.aggregate(hits, start, step)


def _places(words: Column, phrase: str) -> Column:
    """Numbers of the words at which the phrase starts."""
    parts = phrase.split(" ")
    most = F.size(words) - len(parts)
    here = lambda i: F.reduce(
        F.array(*[F.get(words, i + n) == p for n, p in enumerate(parts)]), F.lit(True), lambda a, b: a & b
    )
    return F.when(most < 0, F.array().cast("array<int>")).otherwise(F.filter(F.sequence(F.lit(0), F.greatest(most, F.lit(0))), here))


def scan(docs: DataFrame, found: list[Rule] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row of ``docs``
    (doc_id, text; others are ignored).

    Base columns count the fixed phrases at every place, overlaps included; labels adds those of the surviving
    rules, sorted and joined by commas, and score is the highest confidence: 0 without a license, 0.5 where only a
    phrase was found. Null text counts as empty; ids may be null or repeat; an empty table gives an empty result.
    Nothing is shuffled.
    """
    found = rules() if found is None else found
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # On ASCII alone, ``lower`` changes A-Z and nothing else, and faster.
    exact = F.when(F.octet_length("text") == F.length("text"), F.lower("text")).otherwise(F.translate("text", UPPER, LOWER))
    rows = docs.select("doc_id", F.array_remove(F.split(exact, GAP), "").alias("words"))
    gate = _words({w for r in found for w in r.words} | {p.split(" ")[-1] for p, _ in PHRASES})
    words = F.when(F.arrays_overlap("words", gate), F.col("words")).otherwise(F.array().cast("array<string>"))
    rows = rows.select("doc_id", F.size("words").cast("bigint").alias("n_words"), words.alias("words"))
    joined = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    present = F.array_append(F.array_intersect("words", _words({r.word for r in found})), F.lit(""))
    rows = rows.select("doc_id", "n_words", "words", joined.alias("joined"), F.when(F.size("words") > 0, present).alias("present"))
    places = [F.when(F.contains("joined", F.lit(f" {p} ")), _places(F.col("words"), p)).otherwise(F.array().cast("array<int>")) for p, _ in PHRASES]
    rows = rows.select(
        "doc_id",
        "n_words",
        *[p.alias(f"places{i}") for i, p in enumerate(places)],
        F.when(F.size("words") > 0, surviving(detections(F.col("present"), F.col("joined"), found))).alias("kept"),
    )
    every = F.concat(*[F.col(f"places{i}") for i in range(len(PHRASES))])
    base = F.array_sort(F.array_distinct(F.filter(
        F.array(*[F.when(F.size(f"places{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)]), lambda x: x.isNotNull()
    )))
    more = F.array_sort(F.array_union(base, F.coalesce("kept.labels", F.array().cast("array<string>"))))
    score = F.greatest(F.coalesce("kept.score", F.lit(0.0)), F.when(F.size(base) > 0, 0.5).otherwise(0.0))
    return rows.select(
        "doc_id",
        "n_words",
        F.size(every).cast("bigint").alias("n_base"),
        F.array_min(every).cast("bigint").alias("first_word"),
        F.array_max(every).cast("bigint").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(more, ",").alias("labels"),
        score.alias("score"),
    )
