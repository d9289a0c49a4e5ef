"""Column expressions over text: words, tokens and n-grams. All run inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Character classes (bodies, to be put in brackets) that equal Python's ``\w`` and ``\s`` on str.
# Java's Unicode ``\w`` would keep combining marks; its Unicode ``\s``, switched on by UNICODE at the
# start of a pattern, lacks the four ASCII separators. Spelled out, the spaces would cost four times as much.
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x1c-\x1f"
UNICODE = "(?U)"
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
BOUNDARY = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_any(c: Column | str, literals: Sequence[str]) -> Column:
    """Cheap byte search that guards an expensive regular expression."""
    found = F.lit(False)
    for text in literals:
        found = found | F.contains(_col(c), F.lit(text))
    return found


def is_blank(c: Column | str) -> Column:
    """Null, empty or white space only."""
    return ~F.coalesce(_col(c).rlike(f"{UNICODE}[^{SPACE}]"), F.lit(False))


def strip(c: Column | str) -> Column:
    """Remove white space (Unicode sense) at both ends."""
    return F.btrim(_col(c), F.lit(SPACES))


def word_count(c: Column | str) -> Column:
    """Number of white-space separated words; 0 for null."""
    return F.coalesce(F.regexp_count(_col(c), F.lit(f"{UNICODE}[^{SPACE}]+")), F.lit(0)).cast("long")


def has_words(c: Column | str, n: int) -> Column:
    """At least ``n`` words. Stops at the n-th word instead of counting them all; false for null."""
    more = f"(?:[^{SPACE}]++[{SPACE}]++){{{n - 1}}}"
    return F.coalesce(_col(c).rlike(rf"{UNICODE}\A[{SPACE}]*+{more}[^{SPACE}]"), F.lit(False))


def char_count(c: Column | str) -> Column:
    """Number of code points; 0 for null."""
    return F.coalesce(F.length(_col(c)), F.lit(0)).cast("long")


def word_tokens(c: Column | str, min_len: int = 1) -> Column:
    """Runs of word characters that are at least ``min_len`` long."""
    return F.regexp_extract_all(_col(c), F.lit(rf"[{WORD}]{{{min_len},}}"), 0)


def spaced_words(c: Column | str) -> Column:
    """The runs of word characters with single spaces between them (and perhaps at the ends): one replacement, no array."""
    return F.regexp_replace(_col(c), f"[^{WORD}]+", " ")


def join_tokens(tokens: Column) -> Column:
    """Tokens as one string with single spaces: the input of :func:`word_ngrams`."""
    return F.array_join(tokens, " ")


def word_ngrams(joined: Column | str, lo: int, hi: int) -> Column:
    """Word n-grams, lo..hi words, of a string made by :func:`join_tokens`.

    A look-ahead captures the n-gram at each token and the match consumes only the first token, so
    one linear regex pass per n yields all overlapping n-grams.
    """
    passes = []
    for n in range(lo, hi + 1):
        more = f"(?: [^ ]+){{{n - 1}}}" if n > 1 else ""
        passes.append(F.regexp_extract_all(_col(joined), F.lit(f"(?=([^ ]+{more}))[^ ]+"), 1))
    return passes[0] if len(passes) == 1 else F.concat(*passes)


def squeeze_spaces(c: Column | str) -> Column:
    """Runs of two or more white-space characters become one space (character n-grams do this first)."""
    return F.regexp_replace(_col(c), f"{UNICODE}[{SPACE}]{{2,}}", " ")


def char_ngrams(c: Column | str, lo: int, hi: int) -> Column:
    """Character n-grams, lo..hi code points, over the whole string.

    The match consumes one code point and looks ahead for n of them: linear in the text, while
    ``substr`` at every position would walk the UTF-8 bytes from the start each time.
    """
    passes = [F.regexp_extract_all(_col(c), F.lit(f"(?s)(?=(.{{{n}}}))."), 1) for n in range(lo, hi + 1)]
    return passes[0] if len(passes) == 1 else F.concat(*passes)


def pad_words(c: Column | str) -> Column:
    """Each word with one space on both sides, on a line of its own: input of :func:`char_wb_ngrams`."""
    inner = F.regexp_replace(strip(c), f"{UNICODE}[{SPACE}]+", " \n ")
    return F.when(is_blank(c), F.lit("")).otherwise(F.concat(F.lit(" "), inner, F.lit(" ")))


def char_wb_ngrams(padded: Column | str, lo: int, hi: int) -> Column:
    """Character n-grams inside the padded words; a padded word shorter than ``lo`` is emitted once."""
    passes = [
        F.regexp_extract_all(_col(padded), F.lit(f"(?=([^\n]{{{n}}}))[^\n]"), 1) for n in range(lo, hi + 1)
    ]
    if lo > 3:  # the shortest padded word has three characters
        passes.append(F.regexp_extract_all(_col(padded), F.lit(f"(?m)^([^\n]{{1,{lo - 1}}})$"), 1))
    return passes[0] if len(passes) == 1 else F.concat(*passes)


def literal_pattern(text: str) -> str:
    """The text as a regular expression that matches it literally, in Java and elsewhere."""
    return re.sub(r"([^A-Za-z0-9 ])", r"\\\1", text)


def display_label(c: Column | str) -> Column:
    """``INFORMATION-TECHNOLOGY`` -> ``Information Technology``."""
    return F.initcap(F.replace(_col(c), F.lit("-"), F.lit(" ")))


def preview(c: Column | str, n: int) -> Column:
    """First ``n`` characters, with an ellipsis when the text is longer."""
    c = _col(c)
    return F.when(F.length(c) > n, F.concat(F.substr(c, F.lit(1), F.lit(n)), F.lit("..."))).otherwise(c)
