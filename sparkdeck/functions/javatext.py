"""Column expressions that reproduce the JVM text rules of the line jobs.

All of them are native Spark expressions (regexp_replace / split / size), so
they stay inside whole-stage codegen and never leave the JVM.

Rules kept (see SURVEY §2.0):

* ``String.trim()`` strips every char <= U+0020 (tab, CR, NUL ...); Spark's
  ``trim`` only strips spaces.
* ``String.split(re)`` drops trailing empty fields and keeps a leading empty
  field when the string starts with a (non zero-width) separator.
* ``split("\\s+")`` on an empty line gives one empty token, on a line of
  blanks gives no token at all.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes of the JVM rules.
#   Java String.trim() removes code points U+0000..U+0020.
#   Java regex \s is [ \t\n\x0B\f\r].
JTRIM_SET = "".join(chr(i) for i in range(0x21))
JAVA_WS_SET = " \t\n\x0b\f\r"
JAVA_WS = r"[ \t\n\x0B\f\r]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jtrim(c) -> Column:
    """Java ``String.trim()`` (a native set trim, no regex)."""
    return F.trim(_col(c), F.lit(JTRIM_SET))


def is_blank(c) -> Column:
    """True when the Java-trimmed string is empty (or the value is NULL)."""
    c = _col(c)
    return c.isNull() | (F.length(jtrim(c)) == 0)


def literal_sep(sep: str) -> str:
    """Regex for a literal delimiter (``|`` must be escaped for split)."""
    return re.escape(sep)


def jsplit(c, sep_regex: str, literal: str | None = None) -> Column:
    """Java ``String.split(sep_regex)``: trailing empty fields removed.
    For a one-character ``literal`` separator the trailing run is cut with a
    native ``rtrim``; otherwise with an anchored regex."""
    if literal is not None and len(literal) == 1:
        stripped = F.rtrim(_col(c), F.lit(literal))
    else:
        stripped = F.regexp_replace(_col(c), rf"(?:{sep_regex})+\z", "")
    return F.split(stripped, sep_regex, -1)


def java_tokens(line) -> Column:
    """Tokens of ``line.split("\\\\s+")`` as an array, JVM rules included."""
    line = _col(line)
    stripped = F.rtrim(line, F.lit(JAVA_WS_SET))
    return (F.when(line == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, f"{JAVA_WS}+", -1)))


def text_lines(text) -> Column:
    """Lines of a whole text as a line reader sees them: ``\\n``, ``\\r\\n``
    or ``\\r`` end a line; a final terminator does not open an empty line."""
    text = _col(text)
    # CRLF and CR become LF by literal replacement, then a one-character
    # split (no regex alternation evaluated per character).
    unified = F.translate(F.replace(text, F.lit("\r\n"), F.lit("\n")), "\r", "\n")
    body = (F.when(unified.endswith("\n"), unified.substr(F.lit(1), F.length(unified) - 1))
            .otherwise(unified))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))
