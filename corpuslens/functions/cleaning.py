"""The domain-preserving text cleaner: one function per step, and the steps as one operator.

The order of the steps is part of their meaning. Every step is a JVM expression except the HTML
entity and compatibility-decomposition steps, for which Spark has no builtin: those rows, and only
those (text holding ``&`` or a non-ASCII character), go through one Arrow UDF.
"""

from __future__ import annotations

import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpuslens.functions.fixed import CANONICAL_TOKENS, PROTECTED_TOKENS
from corpuslens.functions.text import BOUNDARY, SPACE, UNICODE, WORD, _col, contains_any, literal_pattern, strip

# Entity patterns (URL, e-mail, phone), tags.
URL = rf"(?iU)https?://[^{SPACE}]+|www\.[^{SPACE}]+"
EMAIL = rf"{BOUNDARY}[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}{BOUNDARY}"
# A phone number starts with a digit or a parenthesis: looked at first, it spares the boundary test elsewhere.
PHONE = rf"{UNICODE}(?=[(0-9])\(?{BOUNDARY}[0-9]{{3}}\)?[-.{SPACE}]?[0-9]{{3}}[-.{SPACE}]?[0-9]{{4}}{BOUNDARY}"
TAG = r"<[^>]+>"

# Every protected token holds one of these.
PROTECTED_MARKS = ["c++", "c#", ".net", ".js", "ci/cd", "tcp/ip", "pl/sql", "t-sql"]


def _decoder(unescape: bool, tags: bool, normalise: bool):
    """Arrow UDF for the rows the JVM cannot finish. Nested, so that it ships by value."""

    def decode(texts: pd.Series) -> pd.Series:
        import html
        import re
        import unicodedata

        tag = re.compile("<[^>]+>")

        def one(text):
            if unescape:
                text = html.unescape(text)
            if tags:
                text = tag.sub(" ", text)
            return unicodedata.normalize("NFKD", text) if normalise else text

        return texts.map(one, na_action="ignore")

    return F.pandas_udf(decode, returnType=T.StringType())


def _where(condition: Column, c: Column, udf) -> Column:
    # Rows outside the condition travel to Python as nulls, at no cost per character.
    return F.coalesce(udf(F.when(condition, c)), c)


def unescape_html(c: Column | str) -> Column:
    """HTML entities to characters."""
    c = _col(c)
    return _where(F.contains(c, F.lit("&")), c, _decoder(True, False, False))


def strip_tags(c: Column | str) -> Column:
    """Each tag to one space."""
    return F.regexp_replace(_col(c), TAG, " ")


def decompose(c: Column | str) -> Column:
    """Unicode compatibility decomposition (NFKD)."""
    c = _col(c)
    return _where(F.octet_length(c) > F.length(c), c, _decoder(False, False, True))


def protect_tokens(c: Column | str) -> Column:
    """Technical tokens to placeholders; a token counts when white space precedes it."""
    c = _col(c)
    out = c
    for token, placeholder in PROTECTED_TOKENS.items():
        pattern = rf"{UNICODE}(?<=[{SPACE}]){literal_pattern(token)}(?=[{SPACE}.,;:!?)/])"
        out = F.regexp_replace(out, pattern, f" {placeholder} ")
    return F.when(contains_any(c, PROTECTED_MARKS), out).otherwise(c)


def mask_urls(c: Column | str) -> Column:
    c = _col(c)
    return F.when(contains_any(F.lower(c), ["http", "www."]), F.regexp_replace(c, URL, " weburl ")).otherwise(c)


def mask_emails(c: Column | str) -> Column:
    c = _col(c)
    return F.when(F.contains(c, F.lit("@")), F.regexp_replace(c, EMAIL, " emailaddr ")).otherwise(c)


def mask_phones(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), PHONE, " phonenum ")


def strip_punct(c: Column | str) -> Column:
    """Everything but word characters and white space to one space each (bullets and dashes too)."""
    return F.regexp_replace(_col(c), f"{UNICODE}[^{WORD}{SPACE}]", " ")


def restore_tokens(c: Column | str) -> Column:
    """Placeholders to their final spelling."""
    c = _col(c)
    out = c
    for placeholder, final in CANONICAL_TOKENS.items():
        out = F.replace(out, F.lit(placeholder), F.lit(final))
    return F.when(F.contains(c, F.lit("token_")), out).otherwise(c)


def collapse_spaces(c: Column | str) -> Column:
    """Runs of blanks, then runs of newlines, to one space each; ends stripped."""
    return strip(F.regexp_replace(F.regexp_replace(_col(c), r"[ \t]{2,}|\t", " "), r"\n+", " "))


def clean_text(df: DataFrame, in_col: str, out_col: str, lower: bool = True) -> DataFrame:
    """Add ``out_col``: the cleaned form of ``in_col``.

    One narrow pass without a shuffle. Each step is a projection of its own because it reads its
    input twice (guard and work); the optimizer must not inline the previous step into both.
    """
    work = f"__{out_col}"
    text = F.col(work)
    df = df.withColumn(work, F.coalesce(F.col(in_col).cast("string"), F.lit("")))
    foreign = F.contains(text, F.lit("&")) | (F.octet_length(text) > F.length(text))
    decoded = _decoder(True, True, True)(F.when(foreign, text))
    df = df.withColumn(f"{work}_decoded", decoded)
    df = df.withColumn(work, F.coalesce(F.col(f"{work}_decoded"), strip_tags(text))).drop(f"{work}_decoded")
    padded = F.concat(F.lit(" "), F.lower(text) if lower else text, F.lit(" "))
    df = df.withColumn(work, padded)
    for step in (protect_tokens, mask_urls, mask_emails, mask_phones, strip_punct, restore_tokens):
        df = df.withColumn(work, step(text))
    return df.withColumn(out_col, collapse_spaces(text)).drop(work)


def clean_text_simple(c: Column | str) -> Column:
    """The fallback cleaner: lower case, ASCII letters and digits only, single spaces."""
    ascii_only = F.regexp_replace(F.lower(_col(c)), f"{UNICODE}[^a-zA-Z0-9{SPACE}]", " ")
    return strip(F.regexp_replace(ascii_only, f"{UNICODE}[{SPACE}]+", " "))


class TextCleaner(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """:func:`clean_text` as a pipeline stage; saved and loaded like any other stage."""

    lower = Param(Params._dummy(), "lower", "lower-case the text", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol: str = "text", outputCol: str = "clean", lower: bool = True):
        super().__init__()
        self._setDefault(inputCol="text", outputCol="clean", lower=True)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return clean_text(dataset, self.getInputCol(), self.getOutputCol(), self.getOrDefault(self.lower))
