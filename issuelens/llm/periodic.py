"""Periodic run detection (11): online sparse diagonal DP over the words of a text.

Words lie on diagonals: on the diagonal of lag q word i matches word i - q.  A
run of period q is a stretch of matches that nothing extends.  Words are taken
from left to right; each one's earlier occurrences name the lags that it
matches, a table holds the active lags and how far each one's matches reach,
and a diagonal that ends with enough matches emits its run at once.

What keeps the earlier occurrences few, and loses no run of at least three
periods:

* A lag below ``NEAR`` is looked for among the word's last neighbours.
* On a lag of b to 2b - 1 words (b a power of two) a run has so many matches
  in a row that it is enough to look for earlier occurrences of the b words
  that begin at a place.  Hence a word that is merely frequent costs nothing.
* Places whose b words come again within b / 2 words lie in a run of a smaller
  period and are left out: a run whose smallest period is b or more also has
  places where they don't, in each period.  Each other place has at most three
  earlier occurrences at such lags.

So a text of n words takes some n log n steps, also if it repeats one word.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import ArrayType, StructType

from issuelens.llm.common import mix, pick, rolling, small_batches, words_of

#: Lags below this (a power of two) are tried for every word.
NEAR = 8
#: Words that are compared at once where a diagonal is followed; doubled as it goes on.
STRIDE = 64


def _near_runs(keys: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the stretches of words that match the word ``lag`` before them."""
    if len(keys) <= lag:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    turns = np.diff(np.r_[0, (keys[lag:] == keys[:-lag]).view(np.int8), 0])
    return np.flatnonzero(turns == 1) + lag, np.flatnonzero(turns == -1) + lag


def _either(flags: np.ndarray, size: int) -> np.ndarray:
    """Per element whether a flag between it and its neighbours is set."""
    out = np.zeros(size, bool)
    out[1:] |= flags
    out[:-1] |= flags
    return out


def _turns(size: int, *columns: np.ndarray) -> np.ndarray:
    """Per element whether a column differs from the element before; the first one does."""
    out = np.ones(size, bool)
    if size:
        out[1:] = False
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out


def earlier(keys: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, lag) of earlier occurrences at lags of ``NEAR`` up to ``longest``; of matches in a row the first ones are enough."""
    h = mix(keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at, b = np.arange(len(keys)), NEAR
    while b <= longest and len(at):
        grams = rolling(h, b)
        at = at[at < len(grams)]
        x = grams[at]
        order = np.argsort(x, kind="stable")
        x, p = x[order], at[order]
        again = _either(x[1:] == x[:-1], len(x))
        x, p = x[again], p[again]
        at = np.sort(p)  # longer grams repeat only where shorter ones do
        lone = ~_either((x[1:] == x[:-1]) & (p[1:] - p[:-1] <= b // 2), len(x))
        x, p = x[lone], p[lone]
        for t in (1, 2, 3):
            lag = p[t:] - p[:-t]
            ok = (x[t:] == x[:-t]) & (lag >= b) & (lag < 2 * b)
            i, lag = p[t:][ok], lag[ok]
            order = np.lexsort((i, lag))
            i, lag = i[order], lag[order]
            # the b words from a place match, so the next place on the diagonal within them tells nothing new
            new = _turns(len(i), lag)
            new[1:] |= i[1:] - i[:-1] > b
            yield i[new], lag[new]
        b *= 2


def _reach(keys: np.ndarray, i: int, lag: int) -> tuple[int, int]:
    """(first, end) of the stretch of matches around word i on a diagonal; equal if i itself doesn't match."""
    end, step = i, STRIDE
    while end < len(keys):
        a = keys[end : end + step]
        bad = np.flatnonzero(a != keys[end - lag : end - lag + len(a)])
        if len(bad):
            end += int(bad[0])
            break
        end, step = end + len(a), step * 2
    first, step = i, STRIDE
    while end > i and first > lag:
        n = min(step, first - lag)
        bad = np.flatnonzero(keys[first - n : first] != keys[first - n - lag : first - lag])
        if len(bad):
            first -= n - 1 - int(bad[-1])
            break
        first, step = first - n, step * 2
    return first, end


def find_runs(keys: np.ndarray, longest: int, min_length: int = 6, min_exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in the order of start and period.

    ``keys`` are numbers for words; texts that follow each other must have
    no key in common.  ``longest`` bounds the length of a text.
    """
    if min_exponent < 3:
        raise ValueError("runs of fewer than three periods are not looked for")
    starts, lengths, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for q in range(1, min(NEAR, longest // min_exponent + 1)):
        first, end = _near_runs(keys, q)
        ok = end - first + q >= max(min_length, min_exponent * q)
        starts.append(first[ok] - q)
        lengths.append(end[ok] - first[ok] + q)
        periods.append(np.full(int(ok.sum()), q, np.int64))
    seen = list(earlier(keys, longest // min_exponent))
    if seen:
        words, lags = (np.concatenate(c) for c in zip(*seen, strict=True))
        order = np.lexsort((lags, words))
        active: dict[int, int] = {}  # lag -> where its matches end
        found = []
        for i, lag in zip(words[order].tolist(), lags[order].tolist(), strict=True):
            if active.get(lag, 0) > i:
                continue
            first, end = _reach(keys, i, lag)
            active[lag] = end
            if end - first + lag >= max(min_length, min_exponent * lag):
                found.append((first - lag, end - first + lag, lag))
        if found:
            for out, column in zip((starts, lengths, periods), np.array(found, np.int64).T, strict=True):
                out.append(column)
    start, length, period = map(np.concatenate, (starts, lengths, periods))
    # a multiple of a run's period gives the same stretch again: the smallest period is the run's
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = _turns(len(start), start, length)
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period, the first one of equals."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


RUN = StructType().add("start", "long").add("length", "long").add("period", "long")
_RUN_PA = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _measured(texts: list[str | None], min_length: int, min_exponent: int) -> list[pa.Array]:
    """n_words, runs, best and collapsed_text of a batch of texts."""
    words = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    vocab: dict[bytes, int] = {}
    number = count()
    ids = np.fromiter((vocab[w] if w in vocab else vocab.setdefault(w, next(number)) for ws in words for w in ws), np.int64, int(ends[-1]) if len(ends) else 0)
    keys = ids + np.repeat(np.arange(len(words)), sizes) * max(1, len(vocab))  # no word of one text equals one of another
    start, length, period = find_runs(keys, int(sizes.max(initial=0)), min_length, min_exponent)
    gone = np.zeros(len(keys), bool)
    if len(start):  # stretches of positions, however they overlap
        turns = np.zeros(len(keys) + 1, np.int64)
        np.add.at(turns, start + period, 1)
        np.add.at(turns, start + length, -1)
        gone = np.cumsum(turns[:-1]) > 0
    doc = np.searchsorted(ends, start, side="right")
    start = start - (ends - sizes)[doc]
    bounds = np.searchsorted(doc, np.arange(len(words) + 1))
    runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], fields=list(_RUN_PA)))
    rows = list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
    best, kept = [], []
    for k, (w, i, j, end) in enumerate(zip(words, bounds[:-1].tolist(), bounds[1:].tolist(), ends.tolist(), strict=True)):
        found = _best(rows[i:j])
        best.append(None if found is None else dict(zip(("start", "length", "period"), found, strict=True)))
        kept.append(b" ".join([w[x] for x in np.flatnonzero(~gone[end - len(w) : end]).tolist()] if found else w))
    return [pa.array(sizes, pa.int64()), runs, pa.array(best, _RUN_PA), pa.array(kept, pa.binary()).cast(pa.string())]


def periodic_runs(docs: DataFrame, carry: tuple[str, ...] = (), min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """Per document: doc_id, the columns ``carry``, n_words, runs, best, collapsed_text.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  A run is a stretch of
    words whose smallest period is q, of at least ``min_length`` words and
    ``min_exponent`` (3 or more) periods, that no neighbouring word extends
    keeping that period; ``runs`` has them by start, then period.  ``best`` is the one
    of the greatest length / period (ties: least start, then period), null
    without runs.  ``collapsed_text`` is the words that no run holds after its
    first period, joined by one space.  Null, empty and blank texts have no
    words, no runs and an empty collapsed text; a row without an id is handled
    like any other; repeated rows give a row each; columns that aren't named
    are ignored; an empty table gives an empty one.  A row is handled in one
    task, together with as many others as an Arrow batch holds.
    """
    small_batches(docs.sparkSession)
    carry = tuple(c for c in carry if c != "doc_id")
    d = pick(docs, "doc_id", "text", *(c for c in carry if c != "text"))
    d = d.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, F.col("text").alias("_text"))
    types = StructType(list(d.drop("_text").schema.fields)).add("n_words", "long").add("runs", ArrayType(RUN)).add("best", RUN).add("collapsed_text", "string")

    def run(batches):
        for b in batches:
            cols = [b.column(c) for c in types.names[: 1 + len(carry)]]
            yield pa.RecordBatch.from_arrays([*cols, *_measured(b.column("_text").to_pylist(), min_length, min_exponent)], names=types.names)

    return d.mapInArrow(run, types)


def planted(doc_id: Column, text: Column) -> Column:
    """The text whose tail repeats, for one row of ten by the checksum of its id; the other texts unchanged.

    With h = crc32 of the id's digits, g = h div 10 and n words: if h mod 10 is 0, the words from
    a = g mod n on become repetitions of the first p = 1 + (n - a) div (3 + g mod 8) of them.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(s: Column) -> Column:
        n = F.size(s["w"]).cast("long")
        a = F.pmod(s["g"], n)
        p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + F.pmod(s["g"], F.lit(8)))).cast("long")

        def tail(t: Column) -> Column:
            rest = n - t["a"]
            again = F.flatten(F.array_repeat(F.slice(s["w"], (t["a"] + 1).cast("int"), t["p"].cast("int")), F.ceil(rest / t["p"]).cast("int")))
            return F.concat_ws(" ", F.slice(s["w"], F.lit(1), t["a"].cast("int")), F.slice(again, F.lit(1), rest.cast("int")))

        return F.when(n > 0, F.transform(F.array(F.struct(a.alias("a"), p.alias("p"))), tail)[0]).otherwise(F.lit(""))

    bound = F.transform(F.array(F.struct(F.floor(h / 10).cast("long").alias("g"), words.alias("w"))), repeated)[0]
    return F.when((F.pmod(h, F.lit(10)) == 0) & text.isNotNull(), bound).otherwise(text)
