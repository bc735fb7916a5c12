"""Removal of HTML, CSS and office markup from stored text."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .text import nfc, strip

# Java flags giving the matching rules the patterns were written for: ``d`` makes only a
# line feed end a line, ``U`` makes \s \w \b and case folding follow Unicode.
_TEXT = "(?isdU)"
_LINE = "(?imdU)"

# What marks a text as holding markup.
TRIGGER = _TEXT + "|".join([
    r"mso-", r"mso-level-text", r"mso-level-tab-stop", r"mso-level-number-position",
    r"@list", r"MsoNormal",
    r"<\s*(?:html|body|table|tbody|tr|td|div|span|p|a|ul|ol|li|strong|br|style)\b",
    r"</\s*(?:html|body|table|tbody|tr|td|div|span|p|a|ul|ol|li|strong|style)\s*>",
    r"&nbsp;",
    r"(?:font-family|font-size|line-height|margin-|padding-|list-style-type)\s*:",
])

# An office body comment, cut to its label when office marks occur.
OFFICE_BODY = _TEXT + r"\bBody:\s*<!--"
OFFICE_MARKS = _TEXT + r"mso-|MsoNormal|@list|/\*\s*Font Definitions\s*\*/"

# Fixed values: (pattern, replacement) in the order they apply before entities are decoded.
BEFORE_ENTITIES = [
    (_TEXT + r"<!--.*?-->", " "),
    (_TEXT + r"<!--.*", " "),
    (_TEXT + r"<\s*(script|style|head|meta)[^>]*>.*?</\s*\1\s*>", " "),
    (_TEXT + r"/\*\s*(?:Font|Style|List) Definitions\s*\*/.*?(?=(?:<body|<div|<p|Body:|From:|To:|Subject:)|$)", " "),
    (_TEXT + r"@(?:font-face|list)[^{]*\{.*?\}", " "),
    (_LINE + r"^\s*(?:p|li|div|span|\.)?[\w. #,-]*Mso[\w. #,-]*(?:\{|$).*?$", " "),
    (_LINE + r"^\s*(?:@page|div\.WordSection|p\.xmso|li\.xmso|span\.xemailstyle|span\.emailstyle).*?$", " "),
    (_TEXT + r"\{[^{}]*(?:mso-|font-family|font-size|list-style-type)[^{}]*\}", " "),
    (_TEXT + r"(?:mso-[\w-]+|font-family|font-size|margin(?:-[\w-]+)?|padding(?:-[\w-]+)?|text-indent|line-height|color|background|list-style-type)\s*:[^;{}]+;?", " "),
    (_TEXT + r"<\s*br\s*/?\s*>", "\n"),
    (_TEXT + r"<\s*li[^>]*>", "\n- "),
    (_TEXT + r"</\s*(p|div|li|tr|h[1-6]|ul|ol|table)\s*>", "\n"),
    (_TEXT + r"<\s*/?\s*(?:html|body|table|tbody|tr|td|div|span|p|a|ul|ol|li|strong|style)\b[^>\n]*(?:>|$)", " "),
    (_TEXT + r"<[^>]+>", " "),
]

# Blank-space tidying after entities are decoded.
AFTER_ENTITIES = [
    (r"[ \t\f\x0B]+", " "),
    (r"\n[ \t]+", "\n"),
    (r"[ \t]+\n", "\n"),
    (r"\n{3,}", "\n\n"),
]


@F.pandas_udf(T.StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """HTML5 entities; the JVM libraries at hand know only the HTML4 ones."""
    return texts.map(html.unescape, na_action="ignore")


def has_markup(c: Column) -> Column:
    return F.coalesce(c.rlike(TRIGGER), F.lit(False))


def with_clean_text(df: DataFrame, name: str, out: str | None = None) -> DataFrame:
    """Put the cleaned text of column ``name`` into ``out`` (default: in place); text that
    triggers nothing stays as it is.

    Each step is its own column because the next uses it more than once.  Only texts that
    hold an entity travel to the Python worker; all others go there as null.
    """
    df = df.withColumn("_hit", has_markup(F.col(name)))
    df = df.withColumn("_lines", F.when(F.col("_hit"), F.regexp_replace(F.col(name), r"\r\n?", "\n")))
    text = F.when(F.col("_lines").rlike(OFFICE_BODY) & F.col("_lines").rlike(OFFICE_MARKS),
                  F.regexp_replace(F.col("_lines"), OFFICE_BODY + ".*", "Body:")).otherwise(F.col("_lines"))
    for pattern, replacement in BEFORE_ENTITIES:
        text = F.regexp_replace(text, pattern, replacement)
    df = df.withColumn("_plain", text)
    df = df.withColumn("_decoded", unescape(F.when(F.col("_plain").contains("&"), F.col("_plain"))))
    df = df.withColumn("_decoded", F.coalesce("_decoded", "_plain"))
    text = nfc(F.col("_decoded"))
    for pattern, replacement in AFTER_ENTITIES:
        text = F.regexp_replace(text, pattern, replacement)
    return df.withColumn(out or name, F.when(F.col("_hit"), strip(text)).otherwise(F.col(name))).drop("_hit", "_lines", "_plain", "_decoded")
