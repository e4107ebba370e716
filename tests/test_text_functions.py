"""F1 / F2 goldens (FIXTURES C) and equality with a scanner of its own on random texts."""

import random
import time

from pyspark.sql import functions as F

from issuelens.functions.text import comment_lines, has_suffix, is_text, loc, references_issue

def _blanks(code, i):
    while i < len(code) and code[i].isspace():
        i += 1
    return i


def _line_end_before(code, lo, hi):
    """The last place in lo..hi that is a line end or the end of the text, or None."""
    for k in range(hi, lo - 1, -1):
        if k == len(code) or code[k] == "\n":
            return k
    return None


def _not_code(code, i):
    """End of the stretch that is no code and begins at ``i`` (``i`` itself if there is none)."""
    j = _blanks(code, i)
    if i == 0 or code[i - 1] == "\n":
        if code[j:j + 2] == "//" or code[j:j + 1] == "#":
            return (code + "\n").index("\n", j)
        k = _line_end_before(code, i, j)
        if k is not None and k > i:
            return k
        if code[j:j + 2] == "/*":
            close = code.find("*/", j + 2)
            while close >= 0:
                k = _line_end_before(code, close + 2, _blanks(code, close + 2))
                if k is not None:
                    return k
                close = code.find("*/", close + 1)
    if code[j:j + 3] in ('"""', "'''"):
        ends = [p for p in (code.find('"""', j + 3), code.find("'''", j + 3)) if p >= 0]
        if ends:
            return min(ends) + 3
    return i


def py_loc(code):
    kept, i = [], 0
    while i < len(code):
        end = _not_code(code, i)
        if end == i:
            kept.append(code[i])
            end = i + 1
        i = end
    return sum(1 for line in "".join(kept).splitlines() if line.strip())


def py_comments(code):
    n, i = 0, 0
    while i < len(code):
        if code[i] == "#" or code[i:i + 2] == "//":
            n, i = n + 1, (code + "\n").index("\n", i)
        elif code[i:i + 2] == "/*" and (close := code.find("*/", i + 2)) >= 0:
            n, i = n + 1 + code.count("\n", i, close), close + 2
        else:
            i += 1
    return n


GOLDEN = [
    ("a=1\n# c\n\n\nb=2\n  // x\n/* p\n q */\nc=3 # t\n\"\"\"doc\nstr\"\"\"\ndef f():\n    '''d'''\n    pass\n", 5, 5),
    ("", 0, 0),
    ("\n\n", 0, 0),
    ("/* a */ x\ny */\nz", 1, 1),
    ("x = \"\"\"abc\"\"\" + y\n\"\"\"q\"\"\"; k", 1, 0),
    ("#a\n#b", 0, 2),
    ("a\r\n\r\n#b\r\nc", 2, 1),
    ("\n#x\n\n  /* a\nb */  \n\n  z\n", 1, 3),
    ("u = 'http://h/p'  # see", 1, 1),
    ("#include <x>\nint a;", 1, 1),
    ("a = 1 /* x */\nb /* y\nz\nw */ c", 4, 4),
]


def _eval(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", loc("t").alias("l"), comment_lines("t").alias("c")).collect()
    return {r.i: (r.l, r.c) for r in rows}


def test_golden_loc_and_comments(spark):
    got = _eval(spark, [g[0] for g in GOLDEN])
    for i, (text, l, c) in enumerate(GOLDEN):
        assert got[i] == (l, c), repr(text)
        assert (py_loc(text), py_comments(text)) == (l, c)


def test_equal_to_a_line_scanner_on_random_texts(spark):
    rnd = random.Random(7)
    alphabet = ["a", "b", " ", "  ", "\t", "\n", "\r", "#", "//", "/*", "*/", '"""', "'''", "x=1", "\x0b",
                "\x0c", "\x85", "\xa0", "\x1c", "\x1f", "    ", "　", '"', "*", "/", " ", "é"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 50))) for _ in range(12000)]
    got = _eval(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == (py_loc(t), py_comments(t)), repr(t)


def test_long_whitespace_runs_keep_counts(spark):
    texts = [" " * 5000 + "x\n" + "\t" * 3000 + '"""d"""\n' + " " * 4000, "a\n" + " \t" * 2000 + "\n# c"]
    got = _eval(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == (py_loc(t), py_comments(t))


def test_a_megabyte_of_comments_that_never_fill_a_line_takes_seconds(spark):
    texts = ["/* a */ x\n" * 100_000, "/* a\n" * 200_000, "//* a\n" * 50_000 + "/* b\n" * 100_000]
    start = time.time()
    got = _eval(spark, texts)
    assert time.time() - start < 15
    assert got == {0: (100_000, 100_000), 1: (200_000, 0), 2: (100_000, 50_000)}


def test_suffix_reference_and_utf8(spark):
    df = spark.createDataFrame([("a/b.py", "Fix #12 and #7", bytes.fromhex("ff61")),
                                ("a/b.PY", "see #3", bytes.fromhex("c3a9"))], "p string, m string, b binary")
    r = df.select(has_suffix("p", (".py", ".js")).alias("s"), references_issue(F.col("m"), 1).alias("r1"),
                  references_issue(F.col("m"), 12).alias("r12"), is_text("b").alias("u")).collect()
    assert [tuple(x) for x in r] == [(True, True, True, False), (False, False, False, True)]


def test_java_classes_hold_the_same_characters(spark):
    """The classes written for Java's engine against those that RE2 takes, over the whole basic plane."""
    from issuelens.functions import text as T

    chars = spark.createDataFrame([(chr(i),) for i in range(0x10000) if not 0xD800 <= i < 0xE000], "ch string")
    pairs = [(T.W, T.W_JAVA), (f"[{T.HSPACE_CHARS}]", T.HSPACE_JAVA), (f"[{T.LINE_SEP_CHARS}]", T.LINE_SEP_JAVA),
             (T.W.replace(r"\n", ""), T.W_IN_LINE_JAVA)]
    other = [F.count_if(F.col("ch").rlike(a) != F.col("ch").rlike(b)) for a, b in pairs]
    assert list(chars.agg(*other).first()) == [0] * len(pairs)


def test_function_lines_for_java(spark):
    from issuelens.functions.text import FUNCTION_LINE, FUNCTION_LINE_JAVA

    rnd = random.Random(4)
    parts = ["def", "func", "function", "x", "_", "$", ".", " ", "(", ")", "{", "=>", "\U0001F600", "9", ";"]
    lines = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(7))) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in lines], "l string")
    got = df.select("l", F.col("l").rlike(FUNCTION_LINE).alias("a"), F.col("l").rlike(FUNCTION_LINE_JAVA).alias("b")).collect()
    assert [r.l for r in got if r.a != r.b] == [] and 100 < sum(r.a for r in got) < 2900


def test_the_last_closing_is_found_as_fast_as_a_plain_scan(spark):
    """Finding it took over ten times as long as replacing in the same text."""
    from issuelens.functions.text import scannable

    df = spark.createDataFrame([("value = first + second\n" * 20_000,)] * 8, "t string").repartition(1).cache()
    df.count()

    def seconds(c):
        best = 1e9
        for _ in range(3):
            began = time.time()
            df.agg(F.sum(F.length(c))).collect()
            best = min(best, time.time() - began)
        return best

    assert seconds(scannable("t")) < 8 * seconds(F.regexp_replace("t", "=[0-9]", "")) + 0.2
