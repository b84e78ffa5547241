"""URL filter: rules by host and path first, then a naive Bayes model over the words of host and path.

Names in hosts are often several words run together. A unigram model of words, counted over all urls and started
from two hand-written lists, splits them by Viterbi: the split with the highest product of word probabilities.
Multinomial naive Bayes then scores the words of host and path against the two classes. It learns by expectation
maximisation from urls of which only those with a listed word in their host are labelled, and never counts that word.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tianguis.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"

# Rules as (verdict, host and beginning of the path).
RULES = [(ALLOW, "org/"), (BLOCK, "example.org/es/"), (BLOCK, "example.org/en/1"), (ALLOW, "com/fr/"), (BLOCK, "com/de/")]

# Words that start the model, of sites one wants and of sites one does not.
WANTED = """about academy action album api archive art article articles author beach bike bird blog blue board book
books bread bridge brown bus business cafe calendar camp car cat category chess church city class cloud club code
college community company contact cook cooking course culture daily data dev dictionary docs dog download edu
education energy event events family farm film finance fish food forest forum friend garden gov green guide health
help history home hotel house info island jobs journal kids kitchen lab language law learn library life list local
magazine map market media men mobile museum music nature network news north office online open paper park people
photo photos place planet post press project publish radio read recipe recipes red report research river road
school science sea shop show site small social society soft software space sport sports star start state stock
store story street student studio study style support team tech test theatre time tools town train travel tree
university video view village water weather web wiki women wood word work world writer year young""".split()
UNWANTED = """adult bet bets betting bingo bitcoin-doubler bonus buy-followers cams casino casinos cheap cialis
clickbait cracked credit-fix crypto-double dating-hookup diploma-mill doorway earn-fast escort escorts fake-rolex
followers free-bets free-spins gambling get-rich hookup jackpot keygen levitra lottery malware nude odds payday
pharmacy phishing pills pirated poker porn porno rolex-replica replica roulette scam seo-links sex slots spam spins
torrent viagra warez webcam weight-loss-pills xanax xxx""".split()

#: Listed words and names of several words, and how many words such a name has, the most first.
GOOD, BAD = set(WANTED), set(UNWANTED)
COMPOUNDS = {w for w in (*WANTED, *UNWANTED) if "-" in w}
COMPOUND_SIZES = sorted({w.count("-") + 1 for w in COMPOUNDS}, reverse=True)
#: Letters of a word at most.
WORD_LETTERS = 24
#: Urls and their characters that share one lookup; parts of words that a task holds before it passes them on.
CHUNK_ROWS, CHUNK_CHARS, HELD_PARTS = 4096, 1 << 22, 200_000
#: Urls of each class that the classifier is fitted on at most, by a hash of the url.
LABELLED = 20_000
#: Weight of each listed word, in seen ones; rounds of expectation maximisation.
LISTED, ROUNDS = 50, 6
#: Counts that each word has beforehand, and blocked words that both classes are taken to share.
SHRINK, SMOOTHING = 12.0, 1000.0
#: Price of each letter of an unknown word.
LETTER = 1.0
#: Log odds from which a url is blocked: both classes cost the same, unwanted ones are the rarer.
THRESHOLD = 0.0
PRIOR_BLOCK = 0.2

TOKEN = re.compile(r"[^\W_]+")


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``, or nothing."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def matched(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null: its host is the url's or a parent of it, and its
    path begins the url's. Of equally long rules, the first in order of their text."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        top, _, rest = text.partition("/")
        fits = ((host == top) | host.endswith("." + top)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


@dataclass
class Words:
    """Unigram model: log probability of each word, and of an unknown run of letters by its length."""

    logs: dict[str, float]
    floor: float
    memory: dict[str, list[str]] = field(default_factory=dict)

    def split(self, name: str) -> list[str]:
        """The most probable split of a run of letters and digits; on a tie, the one with the longer last word."""
        if name.isdigit():
            return [name]
        known = self.memory.get(name)
        if known is not None:
            return known
        best: list[tuple[float, int]] = [(0.0, 0)]
        far = (-math.inf, 0)  # the best start of a run that is too long for a word, so unknown
        for end in range(1, len(name) + 1):
            options = []
            if end > WORD_LETTERS:
                start = end - WORD_LETTERS - 1
                far = max(far, (best[start][0] + LETTER * start, -start))
                options.append((far[0] + self.floor - LETTER * end, far[1]))
            for start in range(max(0, end - WORD_LETTERS), end):
                part = name[start:end]
                log = self.logs.get(part, self.floor - LETTER * len(part))
                options.append((best[start][0] + log, -start))
            value, start = max(options)
            best.append((value, -start))
        out, end = [], len(name)
        while end:
            out.append(name[best[end][1] : end])
            end = best[end][1]
        out.reverse()
        if len(self.memory) < 100_000:
            self.memory[name] = out
        return out


@dataclass
class Bayes:
    """Log odds of a word for the class block over allow; unknown words say nothing."""

    odds: dict[str, float]
    prior: float

    def score(self, words: list[str]) -> float:
        return self.prior + sum(self.odds.get(w, 0.0) for w in merged(words))


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def words_of(host: str, path: str, model: Words) -> list[str]:
    return [w for t in (*tokens(host), *tokens(path)) for w in model.split(t)]


def word_counts(urls: DataFrame) -> DataFrame:
    """(word, n) of the words that the paths of all ``urls`` (host, path) and the parts of their hosts write apart; a part
    that is one run of letters may be a compound and doesn't count."""
    apart = F.array_join(F.filter(F.split("host", r"\."), lambda part: F.rlike(part, F.lit(r"[^\p{L}]"))), "/")
    runs = F.explode(F.regexp_extract_all(F.lower(F.concat_ws("/", apart, "path")), F.lit(r"(\p{L}+)"), F.lit(1)))
    counts = urls.select(runs.alias("word")).where(F.length("word").between(2, WORD_LETTERS)).groupBy("word").agg(F.count("*").alias("n"))
    return stored(counts)


def word_model(found: dict[str, float], seen: float | None = None) -> Words:
    """Counts enter by their root, so that the words of one large site do not crowd out the listed ones. ``seen`` is the
    sum of the roots of all counts, if ``found`` has only those that are asked for."""
    counts = {w: math.sqrt(n) for w, n in found.items()}
    seen = sum(counts.values()) if seen is None else seen
    for listed in (*WANTED, *UNWANTED):
        for w in listed.split("-"):
            counts[w] = counts.get(w, 0.0) + LISTED
            seen += LISTED
    return Words({w: math.log(n / seen) for w, n in counts.items()}, math.log(1 / seen))


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (page_id, host, path) with the number of their chunk: some neighbours inside a partition."""
    chunk, rows, chars = TaskContext.get().partitionId() << 33, 0, 0
    for batch in batches:
        numbers = []
        for host, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            rows, chars = rows + 1, chars + len(host) + len(path)
            numbers.append(chunk)
            if rows >= CHUNK_ROWS or chars >= CHUNK_CHARS:
                chunk, rows, chars = chunk + 1, 0, 0
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], ["page_id", "host", "path", "chunk"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, word): every part of every run of the rows (host, path, chunk) that a count may exist for. Runs and parts
    that a chunk repeats are mostly named once."""
    held: set[str] = set()
    runs: set[str] = set()
    at = None

    def out():
        found = pa.RecordBatch.from_arrays([pa.array([at] * len(held), pa.int64()), pa.array(list(held), pa.string())], ["chunk", "word"])
        held.clear()
        return found

    for batch in batches:
        for host, path, chunk in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if chunk != at:
                if held:
                    yield out()
                runs.clear()
                at = chunk
            for name in (*tokens(host), *tokens(path)):
                if name in runs or name.isdigit():
                    continue
                runs.add(name)
                for start in range(len(name) - 1):
                    held.update([name[start:end] for end in range(start + 2, min(start + WORD_LETTERS, len(name)) + 1)])
                    if len(held) > HELD_PARTS:
                        yield out()
    if held:
        yield out()


def segmented(urls: DataFrame) -> DataFrame:
    """``urls`` (page_id, host, path) with host_words and path_words, the most probable splits under the counts of all
    words of all urls.

    The counts are never gathered: the parts of the runs of a chunk of rows meet them in a join by word, and the counts
    that a chunk needs come to it by its number. So a word is looked up once a chunk, however common it is.
    """
    counts = word_counts(urls)
    root = F.sqrt("n").cast("decimal(28,12)")  # its sum does not depend on the order
    seen = float(counts.agg(F.sum(root)).first()[0] or 0)
    kind = urls.schema["page_id"].dataType.simpleString()
    rows = stored(urls.select("page_id", "host", "path").mapInArrow(_chunked, f"page_id {kind}, host string, path string, chunk bigint"))
    parts = rows.select("host", "path", "chunk").mapInArrow(_parts, "chunk bigint, word string")
    known = parts.join(counts, "word").select("chunk", "word", "n")

    def split(rows: pa.Table, known: pa.Table) -> pa.Table:
        model = word_model(dict(zip(known["word"].to_pylist(), known["n"].to_pylist(), strict=True)), seen)
        words = [pa.array([words_of(t, "", model) for t in rows[c].to_pylist()], pa.list_(pa.string())) for c in ("host", "path")]
        return pa.table([*(rows[c] for c in ("page_id", "host", "path")), *words], ["page_id", "host", "path", "host_words", "path_words"])

    schema = f"page_id {kind}, host string, path string, host_words array<string>, path_words array<string>"
    return rows.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(split, schema)


def examples(urls: DataFrame, labelled: int) -> DataFrame:
    """The first ``labelled`` different rows of ``urls`` (host, path, and what follows from them) by hash."""
    known = stored(urls.where("host <> ''").distinct().withColumn("hash", F.xxhash64("host", "path")))
    share = min(1.0, 1.2 * labelled / max(1, known.count()))  # of the range of hashes: holds a few more than needed
    known = known.where(F.col("hash") <= int(-(2**63) + share * (2**64 - 2049)))
    return known.orderBy("hash", "host", "path").limit(labelled)


@dataclass
class Row:
    """What the classifier sees of a url: its words without the listed ones, and its class where a listed one tells."""

    words: Counter
    block: float | None


def merged(words: list[str]) -> list[str]:
    """Words with the listed names of several words put together again."""
    out: list[str] = []
    at = 0
    while at < len(words):
        size = next((n for n in COMPOUND_SIZES if "-".join(words[at : at + n]) in COMPOUNDS), 1)
        out.append("-".join(words[at : at + size]))
        at += size
    return out


def seen_as(host_words: list[str], path_words: list[str]) -> Row:
    """A host with an unwanted word is an example to block, one with wanted words alone an example to allow, any other one
    has no label. The words that label are hidden from what is counted, so that all others are judged by the company
    they keep and not by the lists."""
    host, path = merged(host_words), merged(path_words)
    block = 1.0 if any(w in BAD for w in host) else 0.0 if any(w in GOOD for w in host) else None
    return Row(Counter(w for w in (*host, *path) if w not in BAD and w not in GOOD), block)


def fit_words(rows: Iterable[tuple[list[str], list[str]]], rounds: int = ROUNDS) -> Bayes:
    """Multinomial naive Bayes by expectation maximisation over the words of host and path of each url.

    Urls without a label start as ones to allow. In each round the classes' word counts are taken anew from the labelled
    urls and, by their last probability to be blocked, the others. Each word has counts beforehand, split as all counts
    are: ``SHRINK``, so that a word that was seen once says little, and its share of all words for ``SMOOTHING`` blocked
    ones, so that the words of every url say little too. A listed word has ``LISTED`` more in its class.
    """
    seen = [seen_as(h, p) for h, p in rows]
    shares = [0.0 if r.block is None else r.block for r in seen]
    odds: dict[str, float] = {}
    prior = math.log(PRIOR_BLOCK / (1 - PRIOR_BLOCK))
    for turn in range(rounds):
        counts: dict[str, list[float]] = {}
        for row, share in zip(seen, shares, strict=True):
            for w, n in row.words.items():
                both = counts.setdefault(w, [0.0, 0.0])
                both[0] += n * (1 - share)
                both[1] += n * share
        allow, block = (math.fsum(c[side] for c in counts.values()) for side in (0, 1))
        part = block / (allow + block) if allow and block else PRIOR_BLOCK
        total = {w: a + b for w, (a, b) in counts.items()}
        for listed, side in ((GOOD, 0), (BAD, 1)):
            for w in listed:
                counts.setdefault(w, [0.0, 0.0])[side] += LISTED
        usual = (1 - part) / part  # allowed words for each blocked one
        odds = {}
        for w, (a, b) in counts.items():
            own = SHRINK * part + SMOOTHING * total.get(w, 0.0) / max(1.0, allow + block)
            odds[w] = math.log((b + own) / (a + own * usual) * usual)
        if turn < rounds - 1:
            scores = [prior + sum(n * odds[w] for w, n in r.words.items()) for r in seen]
            shares = [r.block if r.block is not None else 1 / (1 + math.exp(-max(-50.0, min(50.0, s)))) for r, s in zip(seen, scores, strict=True)]
    return Bayes(odds, prior)


def judge(pages: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, words) for each row of ``pages`` (page_id, url; others are
    ignored): the verdict is that of the longest rule that fits, else the model's; score is the model's log odds
    for block, words what host and path were split into.

    A null url, and one without ``://``, has an empty host and path, no rule, no words, and is allowed. Runs of
    letters of any length are split. Ids may be null or repeat; an empty table gives an empty result.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = stored(segmented(urls))
    learned = examples(urls.select("host", "path", "host_words", "path_words"), LABELLED).select("host_words", "path_words")
    sent = pages.sparkSession.sparkContext.broadcast(fit_words(map(tuple, learned.collect())))
    rule, verdict = matched(F.col("host"), F.col("path"), RULES if rules is None else rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bayes = sent.value
        for batch in batches:
            found = [[*h, *p] for h, p in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True)]
            scores = [bayes.score(w) if w else bayes.prior for w in found]
            columns = [*batch.columns[:5], pa.array(scores, pa.float64()), pa.array([" ".join(w) for w in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict", "score", "words"])

    kind = urls.schema["page_id"].dataType.simpleString()
    scored = urls.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "host_words", "path_words").mapInArrow(
        run, f"page_id {kind}, host string, path string, rule string, verdict string, score double, words string"
    )
    model = F.when(F.col("score") > THRESHOLD, BLOCK).otherwise(ALLOW)
    return scored.withColumn("verdict", F.coalesce("verdict", model))
