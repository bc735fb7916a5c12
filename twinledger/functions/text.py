"""Text normalisation: blank rules, canonical comparison form, repair, cells, patterns."""

from __future__ import annotations

import fnmatch
import re

from pyspark.sql import Column, functions as F

# The words that count as "no value" in each vocabulary.
BLANK_IN_KEYS = ("", "nan", "none", "null")
BLANK_IN_LOADS = BLANK_IN_KEYS + ("<na>",)
BLANK_IN_METADATA = BLANK_IN_LOADS + ("#n/a", "n/a", "na")
TRUTHY = ("true", "t", "yes", "y", "1")

# Damaged character sequences and what they stand for, in order.
MOJIBAKE = (
    ("‚Äì", "–"),
    ("Äì", "–"),
    ("â€“", "–"),
    ("â€”", "—"),
    ("â€˜", "‘"),
    ("â€™", "’"),
    ("â€œ", "“"),
    ("â€�", "”"),
    ("\u00c2 ", " "),
    ("\u00a0", " "),
)

# Unicode white space plus the four separators that Python also strips, as a regular
# expression class and as the characters themselves.
_SPACE = r"[\s\x1c-\x1f]"
_SPACES = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def _non_ascii(c: Column) -> Column:
    return F.octet_length(c) != F.length(c)


def strip(c: Column) -> Column:
    """Trim all Unicode white space (Spark's ``trim`` removes only the space character)."""
    return F.btrim(c, F.lit(_SPACES))


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, rf"(?U){_SPACE}+", " "))


def unless_blank(text: Column, blanks: tuple[str, ...]) -> Column:
    """Null for trimmed text that is one of the (short) blank words."""
    short = F.length(text) <= max(map(len, blanks))
    return F.when(~(short & F.lower(text).isin(*blanks)), text)


def _without(c: Column, blanks: tuple[str, ...]) -> Column:
    return unless_blank(strip(c.cast("string")), blanks)


def strip_plain(c: Column) -> Column:
    """:func:`strip` of a column that costs little to evaluate again: text that begins and ends with a
    printable ASCII character, nearly all of it, is passed through without scanning."""
    return F.when(F.ascii(c).between(33, 126) & F.ascii(F.right(c, F.lit(1))).between(33, 126), c).otherwise(strip(c))


def strip_name(name: str) -> Column:
    return strip_plain(F.col(name))


def key_text(c: Column) -> Column:
    return _without(c, BLANK_IN_KEYS)


def load_text(c: Column) -> Column:
    return _without(c, BLANK_IN_LOADS)


def metadata_text(c: Column) -> Column:
    return _without(c, BLANK_IN_METADATA)


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c.cast("string"))).isin(*TRUTHY), F.lit(False))


def is_blank(c: Column) -> Column:
    return load_text(c).isNull()


def _composed(c: Column, compatibility: bool) -> Column:
    # The Unicode library that Spark itself ships does the composition inside the JVM;
    # plain ASCII text is already composed and never reaches it.
    return F.when(
        _non_ascii(c),
        F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(compatibility)),
    ).otherwise(c)


def nfc(c: Column) -> Column:
    return _composed(c, False)


def nfkc(c: Column) -> Column:
    return _composed(c, True)


def canonical(c: Column) -> Column:
    """The form in which two values are compared."""
    return collapse(nfkc(c))


def repaired(c: Column) -> Column:
    text = nfc(c)
    for bad, good in MOJIBAKE:
        text = F.replace(text, F.lit(bad), F.lit(good))
    return F.when(_non_ascii(c), text).otherwise(c)


def one_line(c: Column) -> Column:
    """Line breaks of any kind become the two characters backslash and n."""
    return F.regexp_replace(c, r"\r\n|\r|\n", r"\\n")


def cell(c: Column) -> Column:
    """A CSV cell: null is empty, one line."""
    return F.coalesce(one_line(c), F.lit(""))


def truncated(c: Column, limit: int = 2000) -> Column:
    text = cell(c)
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("...[truncated]"))).otherwise(text)


def is_api_name(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\A[A-Za-z][A-Za-z0-9_]*\z"), F.lit(False))


def is_field_path(c: Column) -> Column:
    """Only the last dotted segment is tested."""
    return is_api_name(F.substring_index(c, ".", -1))


def glob(c: Column, pattern: str) -> Column:
    """Case-sensitive shell pattern over the whole value; plain prefixes, suffixes and names
    need no regular expression."""
    text = F.coalesce(c, F.lit(""))
    if pattern == "*":
        return F.lit(True)
    if not set(pattern[1:-1] + pattern[:1].replace("*", "") + pattern[-1:].replace("*", "")) & set("*?["):
        head, tail = pattern.startswith("*"), pattern.endswith("*")
        word = pattern[head:len(pattern) - tail]
        if head and tail:
            return text.contains(word)
        return text.endswith(word) if head else text.startswith(word) if tail else text == word
    expr = re.sub(r"\\[Zz]$", "", fnmatch.translate(pattern))
    return text.rlike(rf"\A{expr}\z")


def first_glob(obj: Column, field: Column, specs) -> Column:
    """The first matching ``Object.Field`` or bare field spec, else null."""
    ordered = dict.fromkeys(s.strip() for s in specs or () if s.strip())
    hits = []
    for spec in ordered:
        o, f = spec.split(".", 1) if "." in spec else ("*", spec)
        hits.append(F.when(glob(obj, o) & glob(field, f), F.lit(spec)))
    return F.coalesce(*hits) if hits else F.lit(None).cast("string")


def joined(items: Column, separator: str = "; ") -> Column:
    """Join the non-blank items of an array."""
    return F.array_join(F.filter(items, lambda x: F.length(strip(x)) > 0), separator)


def name_candidates(field: Column) -> Column:
    """Target names to try for a source field, best first."""
    snake = F.regexp_replace(field, r"(?<!^)(?=[A-Z])", "_")
    plain = F.array_distinct(F.array(field, F.concat(field, F.lit("__c")), F.concat(snake, F.lit("__c"))))
    return (F.when(field == "Id", F.array(F.lit("External_Id__c"), F.lit("Line_Item_Schedule_Id__c")))
             .when(field.endswith("__c"), F.array(field)).otherwise(plain))
