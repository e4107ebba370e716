"""Toxicity (7): a weighted lexicon matched by Aho-Corasick over folded text.

Folding maps homoglyphs and digit or symbol substitutions to plain letters and
joins letters that are spelled out; a word with accents is matched with and
without them.  The lexicon is learned from labelled rows: beginnings of words
(closed by ``$`` when whole) that toxic rows hold far more often, with their
log odds as weight.  Words around a match that occur in rows that aren't toxic
become exception phrases; a match inside one does not count.  A document's
score is a logistic function of its matches' weights, also taken by length.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from issuelens.llm.common import pick, small_batches, staged

#: Letters of other scripts that look like Latin ones, and signs written for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
#: A learned entry has these sizes, counted in letters.
SHORTEST, LONGEST = 3, 14
#: An entry is held by so many toxic rows at least and has at least this weight.
LEAST_ROWS, LEAST_WEIGHT = 5, 2.0
#: At most so many labelled rows are learned from; with more, those of least hash are taken.
MOST_ROWS = 20_000
COUNTS = pa.schema([("toxic", pa.int32()), ("term", pa.string()), ("n_rows", pa.int64()), ("types", pa.int64())])

_ODD = re.compile(r"[^\x00-\x7f]")
_TOKEN = re.compile(r"[^\W_]+(?:[@$]+[^\W_]+)*|[@$][^\W_]+")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_][.*_\-·• ]){3,}[^\W_](?![^\W_])")


def _letter(c: str) -> str:
    """A look-alike's letter; compatibility forms (full width and the like) are resolved."""
    return "".join(HOMOGLYPHS.get(x, x) for x in unicodedata.normalize("NFKC", c))


def _bare(word: str) -> str:
    """The word without accents."""
    return "".join(x for x in unicodedata.normalize("NFD", word) if not unicodedata.combining(x))


_LETTERS: dict[str, str] = {}


def fold(text: str) -> list[str]:
    """The text's words in folded form.

    Digits and signs count as letters only inside a word that has letters too,
    so numbers stay numbers.  Signs behind a word are no part of it.
    """
    text = text.lower()
    if _ODD.search(text):
        other = {}
        for c in set(text):
            if c > "\x7f":
                if c not in _LETTERS:
                    _LETTERS[c] = _letter(c)
                if _LETTERS[c] != c:
                    other[c] = _LETTERS[c]
        if other:
            text = text.translate(str.maketrans(other)).lower()
    text = _SPACED.sub(lambda m: re.sub(r"[.*_\-·• ]", "", m[0]), text)
    out = []
    for w in _TOKEN.findall(text):
        if not w.isalpha() and any(c.isalpha() for c in w):
            w = "".join([SUBSTITUTES.get(c, c) for c in w])
        out.append(w)
    return out


def terms(word: str) -> set[str]:
    """Beginnings of the word and the whole word (``$`` at the end), with and without accents."""
    out = set()
    for w in (word,) if word.isascii() else (word, _bare(word)):
        out.update(w[:n] for n in range(SHORTEST, min(len(w), LONGEST) + 1))
        if SHORTEST <= len(w) <= LONGEST:
            out.add(w + "$")
    return out


@dataclass
class Lexicon:
    """Weights of entries, exception phrases (word before, word, word after) and the logistic's numbers (bias last)."""

    weights: dict[str, float]
    exceptions: set[tuple[str, str, str]]
    slopes: tuple[float, ...] = (0.0, 0.0, 0.0, -4.0)


def choose(toxic_types: dict[str, int], other_types: dict[str, int], all_types: list[int]) -> dict[str, float]:
    """Weights of the entries among terms, by the distinct words with each in toxic and other rows.

    ``all_types`` are the distinct words of the other and of the toxic rows.
    """
    base = math.log((all_types[1] + 1) / (all_types[0] + 1))
    weights = {t: math.log((n + 0.5) / (other_types.get(t, 0) + 1.5)) - base for t, n in toxic_types.items()}
    # of nested beginnings that the same words have, the longest open one
    longer: Counter = Counter()
    for t, n in toxic_types.items():
        if not t.endswith("$") and n > longer[t[:-1]]:
            longer[t[:-1]] = n
    weights = {t: w for t, w in weights.items() if w >= LEAST_WEIGHT and longer[t] < 0.95 * toxic_types[t]}
    # of the rest those that weigh more than every shorter one
    return {t: w for t, w in weights.items() if all(weights.get(t[:n], 0.0) < w - 0.1 for n in range(SHORTEST, len(t)))}


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Logistic regression by Newton's method with a light pull towards zero (the last column is the bias)."""
    w = np.zeros(x.shape[1])
    pull = np.r_[np.full(x.shape[1] - 1, 0.05), 1e-3]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + pull * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Matcher:
    """The lexicon's automaton over a text's distinct folded words, joined as ``^word$``."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.machine = ahocorasick.Automaton()
        for t, w in lexicon.weights.items():
            self.machine.add_word("^" + t, w)
        if lexicon.weights:
            self.machine.make_automaton()

    def matches(self, words: list[str]) -> dict[str, float]:
        """Words that match an entry, each with the greatest weight of its entries."""
        if not self.lexicon.weights:
            return {}
        places, owners, parts, at = [], [], [], 0
        for w in words:
            for form in (w,) if w.isascii() else (w, _bare(w)):
                places.append(at)
                owners.append(w)
                parts.append(f"^{form}$")
                at += len(form) + 2
        out: dict[str, float] = {}
        for end, weight in self.machine.iter("".join(parts)):
            w = owners[bisect_right(places, end) - 1]
            if weight > out.get(w, 0.0):
                out[w] = weight
        return out

    def strengths(self, words: list[str]) -> tuple[float, float, float]:
        """The matches' weight (a word's further occurrences by their logarithm), its logarithm, and that per 1000 words."""
        counts = Counter(words)
        weights = self.matches(list(counts))
        if not weights:
            return 0.0, 0.0, 0.0
        if self.lexicon.exceptions:
            for i in range(1, len(words) - 1):
                if words[i] in weights and (words[i - 1], words[i], words[i + 1]) in self.lexicon.exceptions:
                    counts[words[i]] -= 1
        total = sum(w * (1 + math.log(counts[t])) for t, w in weights.items() if counts[t] > 0)
        return total / 10, math.log1p(total), math.log1p(1000 * total / len(words))

    def score(self, text: str | None) -> float:
        *slopes, bias = self.lexicon.slopes
        x = bias + sum(a * b for a, b in zip(slopes, self.strengths(fold(text)) if text else (0.0,) * 3, strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of doc_id as text is 1 modulo 3 (a null id is never learned from)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """(text, toxic) of at most ``most_rows`` labelled documents outside the held-out third, those of least hash.

    A doc_id labelled more than once takes its greatest label, a document that
    repeats counts once.  Labels without a document, and null labels, are left out.
    """
    y = pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null")
    y = y.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max(F.col("toxic").cast("int")) > 0).cast("int").alias("toxic"))
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    y = y.where(~held_out(F.col("doc_id"))).join(d.select("doc_id").distinct(), "doc_id", "left_semi")
    y = y.withColumn("rank", F.xxhash64("doc_id")).orderBy("rank", "doc_id").limit(most_rows)
    return d.join(F.broadcast(y.drop("rank")), "doc_id").groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Lexicon:
    """The lexicon learned from :func:`sample`, counted by tasks; only entries and three numbers a row reach the driver.

    Too few labelled rows leave the lexicon empty; every score is then the same.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = staged(sample(docs, labels, most_rows).select("text", "toxic"))

    def counted(known: dict[str, int] | None):
        """Terms of toxic rows (``known`` null), or the known terms and all distinct words of either class."""

        def run(batches):
            for b in batches:
                here, with_ = Counter(), Counter()
                for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                    types = set(fold(text or ""))
                    found = Counter(t for w in types for t in terms(w) if known is None or t in known)
                    here.update({(y, t): n for t, n in found.items()})
                    with_.update([(y, t) for t in found])
                    here[y, ""] += len(types)
                keys = list(here)
                yield pa.RecordBatch.from_pydict({"toxic": [k[0] for k in keys], "term": [k[1] for k in keys], "n_rows": [with_[k] for k in keys], "types": [here[k] for k in keys]}, schema=COUNTS)

        return run

    def total(source: DataFrame, known: dict[str, int] | None) -> DataFrame:
        return source.mapInArrow(counted(known), "toxic int, term string, n_rows long, types long").groupBy("toxic", "term").agg(F.sum("n_rows").alias("n_rows"), F.sum("types").alias("types"))

    toxic = {r.term: r.types for r in total(rows.where("toxic = 1"), None).where(f"n_rows >= {LEAST_ROWS} and term <> ''").collect()}
    other, all_types = {}, [0, 0]
    for r in total(rows, toxic).collect():
        if not r.term:
            all_types[r.toxic] = r.types
        elif not r.toxic:
            other[r.term] = r.types
    lexicon = Lexicon(choose(toxic, other, all_types), set())

    def contexts(batches):
        matcher = Matcher(lexicon)
        for b in batches:
            out = []
            for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                words = fold(text or "")
                matched = matcher.matches(list(set(words)))
                if matched:
                    around = {(words[i - 1], w, words[i + 1]) for i, w in enumerate(words) if w in matched and 0 < i < len(words) - 1}
                    out.extend((*k, y) for k in around)
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string()] * 3 + [pa.int32()], strict=True)], names=["before", "word", "after", "toxic"])

    met = rows.mapInArrow(contexts, "before string, word string, after string, toxic int").groupBy("before", "word", "after")
    met = met.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).where("n >= 2 and toxic = 0")
    lexicon.exceptions = {(r.before, r.word, r.after) for r in met.collect()}

    def measured(batches):
        matcher = Matcher(lexicon)
        for b in batches:
            x = [matcher.strengths(fold(t or "")) for t in b.column("text").to_pylist()]
            cols = list(zip(*x, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.float64()) for c in cols), b.column("toxic")], names=["a", "b", "c", "toxic"])

    x = np.array([tuple(r) for r in rows.mapInArrow(measured, "a double, b double, c double, toxic int").collect()], float).reshape(-1, 4)
    if len(x):
        lexicon.slopes = tuple(logistic(np.c_[x[:, :3], np.ones(len(x))], x[:, 3]).tolist())
    return lexicon


def toxicity(docs: DataFrame, lexicon: Lexicon, limit: float = 0.7) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1) and predicted (score >= ``limit``).

    Only the text decides the score; a null or empty text gets the score of no
    match.  Rows map one to one (repeated rows, null ids); other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    given = spark.sparkContext.broadcast(lexicon)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches):
        matcher = Matcher(given.value)
        for b in batches:
            scores = [matcher.score(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(scores, pa.float64())], schema=schema)

    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    d = d.withColumn("held_out", held_out(F.col("doc_id")))
    d = d.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return d.withColumn("predicted", (F.col("score") >= limit).cast("int"))
