"""Column expressions over source text: line counts, comment lines, tokens, paths.

Every function returns a ``Column`` built only from Spark's own expressions
(regex, arrays, higher-order functions), so it runs inside whole-stage codegen
on the executors.  The regular expressions are written so that Java's regex
engine (Spark) and RE2 (DuckDB, used by the oracle) find the same matches as
Python's ``re`` module: whitespace is an explicit class equal to Python's
``str.isspace`` set and ``.`` is spelt ``[^\\n]``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# File suffixes kept when the tree before an issue's first commit is read:
CODE_SUFFIXES_BEFORE = (".py", ".js", ".java", ".cpp", ".c", ".rb", ".go", ".ts", ".dart", ".html")
# File suffixes kept when the tree after an issue's last commit is read:
CODE_SUFFIXES_AFTER = (".py", ".js", ".java", ".cpp", ".c", ".rb", ".go", ".ts")
# Texts that mark a failed issue-description lookup:
NOT_FOUND_MARK = "(not found)"
ERROR_MARK = "(error fetching description)"
# ---------------------------------------------------------------------------

# Python's whitespace set (str.isspace), as a character class usable by Java and RE2.
WS_CHARS = (r"\t\n\x{0B}\f\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
W = f"[{WS_CHARS}]"
NON_WS = f"[^{WS_CHARS}]"
# Line boundaries of Python's str.splitlines().
LINE_SEP_CHARS = r"\n\r\x{0B}\f\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}"
# Whitespace that is not a line boundary for either ``re`` or ``splitlines``.
HSPACE_CHARS = r"\t \x{1F}\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}"
# The same classes for Java: single characters below 256 share one bit set, and one
# range test rules out all others, so a letter costs two tests instead of one for each part.
_WIDE_SPACE = r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]]"
W_JAVA = rf"[\t\n\x0B\f\r\x1C\x1D\x1E\x1F\x20\x85\xA0{_WIDE_SPACE}]"
W_IN_LINE_JAVA = rf"[\t\x0B\f\r\x1C\x1D\x1E\x1F\x20\x85\xA0{_WIDE_SPACE}]"
HSPACE_JAVA = r"[\t\x20\x1F\xA0[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]]]"
LINE_SEP_JAVA = r"[\n\r\x0B\f\x1C\x1D\x1E\x85[\x{2028}-\x{2029}]]"

# Fixed values (continued): the reference's two patterns.  They are spelt out
# without verbose-mode layout, with Python's \s written as the class W and
# Python's "." as [^\n], so that Java's engine and RE2 match exactly like
# Python's re (nothing else is changed).
# Code-line filter: whole-line // and # comments, blank lines, block comments that
# fill their lines, and triple-quoted strings with the whitespace before them.
LOC_STRIP = (
    rf"^{W}*//[^\n]*$|^{W}*#[^\n]*$|^{W}*$|^{W}*/\*[\s\S]*?\*/{W}*$"
    rf"|{W}*(?:\"\"\"|''')[\s\S]*?(?:\"\"\"|''')"
)
# Java needs UNIX_LINES so that ^ and $ stop only at \n, like Python's re.
LOC_STRIP_JAVA = "(?md)" + LOC_STRIP.replace(W, W_JAVA)
LOC_STRIP_RE2 = "(?m)" + LOC_STRIP

# Comment matches: // to end of line, # to end of line, /* ... */ (not anchored).
COMMENT = r"(//[^\n]*|#[^\n]*|/\*[\s\S]*?\*/)"
# (end of the reference's patterns)

# Lexical tokens for Halstead counts and lexical complexity.
LEX_TOKEN = r"([A-Za-z_][A-Za-z0-9_]*|[0-9]+|[-+*/%=<>!&|^~]+)"
OPERATOR_START = r"^[-+*/%=<>!&|^~]"
# The same tokens by kind: the two character classes are disjoint and every
# token is a maximal run, so extracting each kind on its own gives exactly the
# operands / operators of LEX_TOKEN, in order, without a regex per token.
LEX_OPERAND = r"([A-Za-z_][A-Za-z0-9_]*|[0-9]+)"
LEX_OPERATOR = r"([-+*/%=<>!&|^~]+)"
# One scan with the states of a lexer: a comment (the pattern above), or a string
# literal as group 1.  The leftmost match wins, so a comment sign inside a string is
# part of the string, and a quote inside a comment part of the comment.
SCAN = (r"//[^\n]*|#[^\n]*|/\*[\s\S]*?\*/"
        r"|(\"\"\"[\s\S]*?\"\"\"|'''[\s\S]*?'''|\"[^\"\n]*\"|'[^'\n]*'|`[^`]*`)")
# Escaped backslashes and quotes become private characters before the scan.
ESCAPES = (("\\\\", "\ue004"), ("\\\"", "\ue001"), ("\\'", "\ue002"), ("\\`", "\ue003"))
# An opening brace on its own line goes up to the parenthesis before it.
HANGING_BRACE = r"\)[ \t\r]*\n[ \t\r\n]*\{"
# Lines that open a function: a keyword, a name with parentheses before a brace, or an arrow before a brace ...
FUNCTION_LINE = (r"(^|[^A-Za-z0-9_$.])(def|function|func)([^A-Za-z0-9_]|\z)"
                 r"|[A-Za-z0-9_$>\]][ \t]*\([^;{}]*\)[^;(){}=]*\{|=>[ \t]*\{")
# The same lines for Java, whose engine is about ten times as fast with what may not stand around the keyword.
FUNCTION_LINE_JAVA = (r"(?<![A-Za-z0-9_$.])(?:def|function|func)(?![A-Za-z0-9_])"
                      r"|[A-Za-z0-9_$>\]][ \t]*\([^;{}]*\)[^;(){}=]*\{|=>[ \t]*\{")
# ... unless they start with one of these words.
CONTROL_LINE = (r"^[ \t}]*(if|else|elif|for|foreach|while|switch|case|catch|do|try|return|with|when|match|loop|unless|until"
                r"|synchronized|using|lock)([^A-Za-z0-9_]|\z)")
BLANK_LINE_CHARS = r"[^ \t\r\f\x0B]"
# Word tokens fed to the static vector lookup.
WORD_TOKEN = r"([A-Za-z]+)"

# Commit-message references: '#' followed by an optionally signed digit run.
ISSUE_REF = r"#(-?[0-9]+)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def squeeze_hspace(text) -> Column:
    """Collapse runs of non-newline whitespace to one space.

    The line filter treats all whitespace characters alike and never ends a
    match inside such a run, so collapsing them keeps every LOC count while
    removing the quadratic backtracking of ``\\s*(\"\"\"|''')`` on long runs.
    """
    return F.regexp_replace(_c(text), HSPACE_JAVA + "{2,}", " ")


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once (bound as a lambda variable)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _after_last(text: Column, closing: str, opening: str, instead: str) -> Column:
    """``text`` with ``opening`` replaced behind the last match of ``closing``.

    A block comment that opens behind the last possible closing can't match,
    yet every such opening would make the engine scan to the end of the text.
    One greedy match finds the last closing; the rest gets its openings
    blotted out, so the comment patterns stay linear in the text.
    """
    def blotted(t):
        # "." with (?s) is any character, as [\s\S] is, but Java runs over it more than ten times as fast
        head = F.length(F.regexp_extract(t, rf"(?ds)\A(.*{closing})", 1))
        return _once(head, lambda n: F.concat(
            F.substring(t, F.lit(1), n), F.regexp_replace(F.substring(t, n + F.lit(1), F.length(t)), opening, instead)))

    return _once(text, blotted)


def loc(text) -> Column:
    """lines of code of one file (non-blank lines left after the filter).

    A closing that fills its line is one followed by blanks up to a line end.
    Openings at line starts become two letters: the line stays a line.
    """
    h = W_IN_LINE_JAVA
    text = _after_last(squeeze_hspace(text), rf"\*/(?={h}*(?:\n|\z))", rf"(?md)^({h}*)/\*", "$1xx")
    cleaned = F.regexp_replace(text, LOC_STRIP_JAVA, "")
    return count_lines_with_text(cleaned, LINE_SEP_JAVA + "+")


def count_lines_with_text(text, separators: str) -> Column:
    """Lines (pieces between ``separators`` runs) holding a non-space character.

    Splitting on separator runs and testing each piece with a ``find`` is ~5x
    faster in Java than counting whole-line regex matches.
    """
    pieces = F.split(_c(text), separators)
    return F.coalesce(F.size(F.filter(pieces, lambda l: l.rlike(NON_WS))), F.lit(0)).cast("bigint")


def comment_lines(text) -> Column:
    """comment lines of one file; a block comment counts each of its lines.

    Openings behind the last closing are blotted out, but for those behind a
    slash or at the very start of that rest, which may be parts of ``//``.
    """
    text = _after_last(_c(text), r"\*/", r"(?<=[^/])/\*", "xx")
    matches = F.regexp_extract_all(text, F.lit("(?d)" + COMMENT), 1)
    return F.aggregate(
        matches, F.lit(0).cast("bigint"),
        lambda acc, m: acc + F.size(F.split(m, "\n", -1)).cast("bigint"),
    )


def has_suffix(path, suffixes) -> Column:
    """``path.endswith(tuple(suffixes))``, case-sensitive."""
    p = _c(path)
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | p.endswith(s)
    return cond


def references_issue(message, issue_id) -> Column:
    """``'#N' in message`` -- a substring test, so '#1' also matches '#12'."""
    n = issue_id if isinstance(issue_id, Column) else F.lit(issue_id)
    return _c(message).contains(F.concat(F.lit("#"), n.cast("string")))


def is_text(content) -> Column:
    """P5: content decodes as UTF-8."""
    return F.is_valid_utf8(_c(content).cast("string"))


def decode_utf8(content) -> Column:
    return F.decode(_c(content), "UTF-8")


def scannable(text) -> Column:
    """``text`` as :data:`SCAN` takes it; comment openings that nothing closes are broken up, so the scan stays linear."""
    t = _c(text)
    for seen, instead in ESCAPES:
        t = F.replace(t, F.lit(seen), F.lit(instead))
    return _after_last(t, r"\*/", r"/\*", "/ *")


def code_only(scanned) -> Column:
    """The code of a :func:`scannable` text: a blank for each comment and string literal."""
    return F.regexp_replace(_c(scanned), SCAN, " ")


def string_literals(scanned) -> Column:
    """The string literals of a :func:`scannable` text, in order."""
    return F.filter(F.regexp_extract_all(_c(scanned), F.lit(SCAN), 1), lambda s: s != "")


def lex_tokens(text) -> Column:
    return F.regexp_extract_all(_c(text), F.lit(LEX_TOKEN), 1)


def lex_operands(text) -> Column:
    return F.regexp_extract_all(_c(text), F.lit(LEX_OPERAND), 1)


def lex_operators(text) -> Column:
    return F.regexp_extract_all(_c(text), F.lit(LEX_OPERATOR), 1)


def word_tokens(text) -> Column:
    return F.regexp_extract_all(_c(text), F.lit(WORD_TOKEN), 1)
