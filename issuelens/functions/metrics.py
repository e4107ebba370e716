"""Column expressions for code metrics of one file or one codebase.

Halstead counts and complexity here are *lexical*: they work on any language
through the token pattern of :mod:`issuelens.functions.text`.  The Python-only
exact mode lives in :mod:`issuelens.operators.pyblocks`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import (BLANK_LINE_CHARS, CONTROL_LINE, FUNCTION_LINE_JAVA, HANGING_BRACE, OPERATOR_START, code_only, lex_operands,
                   lex_operators, scannable, string_literals)

# ---------------------------------------------------------------------------
# Fixed values of the maintainability index formula (reference constants,
# including its use of a raw comment-line count inside the sine term).
MI_BASE = 171 * 1.8
MI_VOLUME = 5.2
MI_COMPLEXITY = 0.23
MI_LOC = 16.2
MI_COMMENT = 50.0
MI_COMMENT_SCALE = 2.46
MI_NORM = 171.0
# Keywords that count as decision points in lexical complexity (default list).
DEFAULT_DECISIONS = ("if", "elif", "for", "foreach", "while", "case", "catch", "except",
                     "and", "or", "&&", "||")
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Spark does not share a subexpression between the branches of a CASE, so an
    expensive value used in several branches (or fields) would be recomputed;
    binding it through a one-element array keeps one evaluation per row.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def maintainability_index(volume, complexity, sloc, comments) -> Column:
    """maintainability index; NULL without a Halstead volume.

    100.0 when the volume or the LOC is not positive; NULL when a positive
    volume meets a codebase whose complexity could not be measured (the
    reference aborts there).
    """
    packed = F.struct(_c(volume).cast("double").alias("v"), _c(complexity).cast("double").alias("cc"),
                      _c(sloc).cast("double").alias("s"), _c(comments).cast("double").alias("k"))
    return let(packed, lambda p: _mi(p["v"], p["cc"], p["s"], p["k"]))


def _mi(v, cc, s, k) -> Column:
    raw = (F.lit(MI_BASE) - F.lit(MI_VOLUME) * F.log(v.cast("double"))
           - F.lit(MI_COMPLEXITY) * cc.cast("double")
           - F.lit(MI_LOC) * F.log(s.cast("double"))
           + F.lit(MI_COMMENT) * F.sin(F.sqrt(F.lit(MI_COMMENT_SCALE) * F.radians(k.cast("double")))))
    scaled = F.least(F.greatest(F.lit(0.0), raw * F.lit(100.0) / F.lit(MI_NORM)), F.lit(100.0))
    return (F.when(v.isNull(), F.lit(None).cast("double"))
            .when((v <= 0) | (s <= 0), F.lit(100.0))
            .when(cc.isNull(), F.lit(None).cast("double"))
            .otherwise(scaled))


def halstead_counts(tokens) -> Column:
    """F4 inputs: distinct/total operators (h1, N1) and operands (h2, N2) of a token array."""
    toks = _c(tokens)
    ops = F.filter(toks, lambda t: t.rlike(OPERATOR_START))
    opnds = F.filter(toks, lambda t: ~t.rlike(OPERATOR_START))
    return split_counts(ops, opnds)


def split_counts(ops, opnds) -> Column:
    """F4 inputs from separate operator and operand arrays."""
    ops, opnds = _c(ops), _c(opnds)
    return F.struct(
        F.size(F.array_distinct(ops)).cast("bigint").alias("h1"),
        F.size(F.array_distinct(opnds)).cast("bigint").alias("h2"),
        F.size(ops).cast("bigint").alias("N1"),
        F.size(opnds).cast("bigint").alias("N2"),
    )


def halstead_measures(h1, h2, n1, n2) -> Column:
    """length, vocabulary, volume, difficulty, effort (doubles) from the counts."""
    h1, h2, n1, n2 = (_c(x).cast("double") for x in (h1, h2, n1, n2))
    length = n1 + n2
    vocab = h1 + h2
    volume = F.when(vocab > 0, length * F.log2(vocab)).otherwise(F.lit(0.0))
    difficulty = F.when(h2 > 0, (h1 * n2) / (F.lit(2.0) * h2)).otherwise(F.lit(0.0))
    return F.struct(length.alias("length"), vocab.alias("vocabulary"), volume.alias("volume"),
                    difficulty.alias("difficulty"), (difficulty * volume).alias("effort"))


def truncate_int(x) -> Column:
    """``int(round(x, 2))`` -- half-even rounding to 2 places, then toward zero."""
    return F.bround(_c(x).cast("double"), 2).cast("bigint")


def file_halstead(text, ops=None, opnds=None) -> Column:
    """Per-file Halstead figures, integerised as the reference sums them (A10 input).

    ``ops`` / ``opnds`` may pass already extracted operator / operand arrays of
    ``text`` (see :func:`operators_and_operands`).
    """
    if ops is None:
        return let(scannable(text), lambda s: let(operators_and_operands(s), lambda t: _integerised(split_counts(t["ops"], t["opnds"]))))
    return _integerised(split_counts(ops, opnds))


def operators_and_operands(scanned) -> Column:
    """F4 tokens of a :func:`~issuelens.functions.text.scannable` text.

    Comments hold none; a string literal is one operand, whatever is in it.
    """
    code = code_only(scanned)
    return F.struct(lex_operators(code).alias("ops"), F.concat(lex_operands(code), string_literals(scanned)).alias("opnds"))


def _integerised(counts) -> Column:
    def integerise(c):
        m = halstead_measures(c["h1"], c["h2"], c["N1"], c["N2"])
        return F.struct(
            m["length"].cast("bigint").alias("halstead_length"),
            m["vocabulary"].cast("bigint").alias("halstead_vocabulary"),
            truncate_int(m["volume"]).alias("halstead_volume"),
            truncate_int(m["difficulty"]).alias("halstead_difficulty"),
            truncate_int(m["effort"]).alias("halstead_effort"),
        )
    return let(counts, integerise)


def function_complexities(code, decisions=DEFAULT_DECISIONS) -> Column:
    """cyclomatic complexity of each function of a file, in order, from its code without comments and strings.

    A line's depth is the number of braces open before it, then its
    indentation.  A line that opens a function starts a block when none is
    open; the block goes on while lines are deeper than its first.  Its complexity is 1 +
    its decision tokens + the functions inside it.
    """
    dec = F.array(*[F.lit(d) for d in decisions])

    def measured(line):
        hits = (F.size(F.filter(lex_operands(line), lambda t: F.array_contains(dec, t)))
                + F.size(F.filter(lex_operators(line), lambda t: F.array_contains(dec, t))))
        closed = F.length(F.regexp_extract(line, r"^[ \t]*(\}*)", 1))
        opens = F.length(line) - F.length(F.replace(line, F.lit("{"), F.lit("")))
        closes = F.length(line) - F.length(F.replace(line, F.lit("}"), F.lit("")))
        at = F.length(F.regexp_extract(line, r"^([ \t]*)", 1))
        starts = F.when(line.rlike(r"^[ \t]*\{"), 1).otherwise(0)
        return F.struct((starts - closed).alias("lead"), at.alias("indent"), (opens - closes).alias("braces"), hits.cast("bigint").alias("hits"),
                        (line.rlike(FUNCTION_LINE_JAVA) & ~line.rlike(CONTROL_LINE)).alias("opens"))

    lines = F.filter(F.split(F.regexp_replace(_c(code), HANGING_BRACE, ") {"), "\n", -1), lambda l: l.rlike(BLANK_LINE_CHARS))
    none, nothing = F.lit(None).cast("int"), F.array().cast("array<bigint>")
    start = F.struct(F.lit(0).alias("braces"), none.alias("b"), none.alias("i"), F.lit(0).cast("bigint").alias("cur"), nothing.alias("done"))

    def step(s, x):
        depth = s["braces"] + x["lead"]
        inside = F.coalesce((depth > s["b"]) | ((depth == s["b"]) & (x["indent"] > s["i"])), F.lit(False))
        begins = ~inside & x["opens"]
        return F.struct(
            (s["braces"] + x["braces"]).alias("braces"),
            F.when(inside, s["b"]).when(begins, depth).alias("b"),
            F.when(inside, s["i"]).when(begins, x["indent"]).alias("i"),
            F.when(inside, s["cur"] + x["hits"] + x["opens"].cast("bigint")).when(begins, x["hits"] + 1).otherwise(F.lit(0)).cast("bigint").alias("cur"),
            F.when(~inside & s["b"].isNotNull(), F.concat(s["done"], F.array(s["cur"]))).otherwise(s["done"]).alias("done"))

    return F.aggregate(F.transform(lines, measured), start, step,
                       lambda s: F.when(s["b"].isNotNull(), F.concat(s["done"], F.array(s["cur"]))).otherwise(s["done"]))


def lexical_complexity(text, decisions=DEFAULT_DECISIONS, code=None) -> Column:
    """Mean complexity of a file's functions, rounded to 2 places.

    A file without functions cannot be measured and yields NULL ("broken").
    ``code`` may pass the already extracted code of ``text``.
    """
    code = code_only(scannable(text)) if code is None else _c(code)
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return let(function_complexities(code, decisions),
               lambda c: F.when(F.size(c) > 0, F.bround(total(c).cast("double") / F.size(c).cast("double"), 2)))


def null_placeholder() -> Column:
    """coupling / cohesion are constant NULL placeholders."""
    return F.lit(None).cast("double")


def null_to_empty(arr) -> Column:
    """a missing embedding becomes an empty array."""
    return F.coalesce(_c(arr), F.array().cast("array<float>"))
