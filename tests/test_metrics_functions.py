"""F3 goldens, F4 / F6 against hand formulas, F5 lexical complexity."""

import math

import pytest
from pyspark.sql import functions as F

from issuelens.functions.metrics import (file_halstead, function_complexities, halstead_counts, let, lexical_complexity,
                                         maintainability_index, operators_and_operands, truncate_int)
from issuelens.functions.text import code_only, lex_tokens, scannable

MI_GOLDEN = [
    (None, 1.0, 1, 1, None),
    (0.0, 1.0, 5, 1, 100.0),
    (10.0, 1.0, 0, 1, 100.0),
    (5000.0, 4.5, 20000, 17, 81.72279339002094),
    (5000.0, 4.5, 20000, 0, 59.67198658102357),
    (5000.0, 4.5, 200000, 9000, 58.99379185011633),
    (1e7, 30.0, 5000000, 9000, 1.9554987784884477),
]


def test_maintainability_index_golden(spark):
    df = spark.createDataFrame([r[:4] for r in MI_GOLDEN], "v double, cc double, s bigint, k bigint")
    got = [r[0] for r in df.select(maintainability_index("v", "cc", "s", "k")).collect()]
    for g, (*_, want) in zip(got, MI_GOLDEN):
        if want is None:
            assert g is None
        else:
            assert g == pytest.approx(want, rel=1e-12)


def test_mi_null_complexity_with_volume_is_null(spark):
    df = spark.createDataFrame([(50.0, None, 10, 2), (50.0, None, 0, 2)], "v double, cc double, s bigint, k bigint")
    assert [r[0] for r in df.select(maintainability_index("v", "cc", "s", "k")).collect()] == [None, 100.0]


def _py_halstead(tokens):
    ops = [t for t in tokens if not (t[0].isalnum() or t[0] == "_")]
    ods = [t for t in tokens if t[0].isalnum() or t[0] == "_"]
    h1, h2, n1, n2 = len(set(ops)), len(set(ods)), len(ops), len(ods)
    h, n = h1 + h2, n1 + n2
    vol = n * math.log(h, 2) if h else 0
    diff = (h1 * n2) / (2.0 * h2) if h2 else 0
    return h1, h2, n1, n2, n, h, int(round(vol, 2)), int(round(diff, 2)), int(round(diff * vol, 2))


def test_halstead_against_formulas(spark):
    texts = ["x = a + b * 2", "if a and b: return a || b", "", "+++ --- x", "foo(bar, baz) == qux != 3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(lex_tokens("t").alias("toks"), halstead_counts(lex_tokens("t")).alias("c"),
                     file_halstead("t").alias("h")).collect()
    for r in rows:
        want = _py_halstead(r.toks)
        assert (r.c.h1, r.c.h2, r.c.N1, r.c.N2) == want[:4]
        assert (r.h.halstead_length, r.h.halstead_vocabulary, r.h.halstead_volume, r.h.halstead_difficulty,
                r.h.halstead_effort) == want[4:]


def test_truncate_int_half_even_then_toward_zero(spark):
    df = spark.createDataFrame([(2.994,), (2.996,), (0.125,), (7.0,)], "x double")
    assert [r[0] for r in df.select(truncate_int("x")).collect()] == [2, 3, 0, 7]


def test_strings_and_comments_hold_no_tokens(spark):
    texts = {
        'x = "a + b" # c + d': (["="], ["x", '"a + b"']),
        "u = 'it\\'s # no comment' + v // w * 2": (["=", "+"], ["u", "v", "'it\ue002s # no comment'"]),
        's = """two\nlines # of * text"""\n/* y = 1\n "open */ z /= 3': (["=", "/="], ["s", "z", "3", '"""two\nlines # of * text"""']),
        "a = `t ${b}\n` - \"\" # 'q": (["=", "-"], ["a", "`t ${b}\n`", '""']),
        'p = "never closed\nq = 1 /* never closed + r': (["=", "=", "/", "*", "+"], ["p", "never", "closed", "q", "1", "never", "closed", "r"]),
        'd = "\\\\" + e': (["=", "+"], ["d", "e", '"\ue004"']),
        "": ([], []),
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.k.ops, r.k.opnds) for r in df.select("t", let(scannable("t"), operators_and_operands).alias("k")).collect()}
    assert got == texts


def test_unclosed_comments_are_scanned_in_seconds(spark):
    df = spark.createDataFrame([("/* a " * 200_000,), ("'" * 300_001,), ('x = "\\u0041\\u0042" ' * 50_000,)], "t string")
    assert [len(r.k.ops) for r in df.select(let(scannable("t"), operators_and_operands).alias("k")).collect()] == [400_000, 0, 50_000]


THREE = """
import os
if os.sep and os.name: pass
def first(a, b):
    if a and b:
        return "if or while"  # for
    return a
class C:
    def second(self):
        for x in self:
            def inner(y): return y or x
            while x: x = inner(x)

    z = 1 if x else 2
def third(): return 1
"""
BRACES = """
#include <x.h>
static int first(int a)
{
  if (a && b) { while (a) { a--; } }
label:
  return a || 1;
}
class K {
  int second() { return 1; }
  void third(int x) {
    switch (x) { case 1: break; case 2: break; }
  }
  int field = a && b;
}
const f = (x) => {
  return x ? y : z; // if
};
if (main) { run(); }
"""


def test_functions_of_a_file(spark):
    none = ["x = 1\nif a and b: pass\n", "", "\n \n", "class A:\n  pass", "}}}\n{"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([THREE, BRACES, *none])], "i int, t string")
    found = function_complexities(code_only(scannable("t")))
    got = df.select("i", found.alias("c"), lexical_complexity("t").alias("cc")).orderBy("i").collect()
    # first: if, and; second: for, inner, or, while; third: nothing
    assert (got[0].c, got[0].cc) == ([3, 5, 1], 3.0)
    # first: if, &&, while, ||; second: nothing; third: case, case; the arrow function: nothing
    assert (got[1].c, got[1].cc) == ([5, 1, 3, 1], 2.5)
    assert [(r.c, r.cc) for r in got[2:]] == [([], None)] * len(none)


def test_decisions_are_a_parameter(spark):
    df = spark.createDataFrame([("def f():\n  if a and b\n  for x\n\n   \n  y",), ("z",)], "t string")
    assert [r[0] for r in df.select(lexical_complexity("t", ("if", "and", "for"))).collect()] == [4.0, None]
    assert [r[0] for r in df.select(lexical_complexity("t", ("y",))).collect()] == [2.0, None]
