"""Nested literals in single or double quotes (lists, tuples, dicts, numbers, None) rewritten as JSON.

The text is cut into tokens; a fold over their kinds, with a stack of open brackets, tells whether they
nest and follow each other as they must; then each token is spelled as JSON.  All of it is column expressions;
what several of them use, or one for each token, is worked out once (``_let``), so the time follows the length of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_TEXT = r"""[uU]?'(?:[^'\\\n]|\\[\s\S])*'|[uU]?"(?:[^"\\\n]|\\[\s\S])*\""""
_NUMBER = r"[+-]?(?:0[xX][0-9a-fA-F_]+|0[oO][0-7_]+|0[bB][01_]+|(?:[0-9][0-9_]*)?\.[0-9][0-9_]*(?:[eE][+-]?[0-9]+)?|[0-9][0-9_]*\.?(?:[eE][+-]?[0-9]+)?)"
_TOKEN = rf"\s+|{_TEXT}|{_NUMBER}|[A-Za-z_][A-Za-z0-9_]*|[\s\S]"
# Part of a text between the quotes: an escape, or what needs none.
_PIECE = r"\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\[0-7]{1,3}|\\[\s\S]|[^\\]+"
# Escapes that JSON spells alike, and those it spells otherwise.
_ALIKE = ("\\\\", "\\n", "\\t", "\\r", "\\b", "\\f")
_OTHER = {"\\'": "'", '\\"': '\\"', "\\a": "\\u0007", "\\v": "\\u000b", "\\\n": ""}
_NAMES = {"None": "null", "True": "true", "False": "false"}


def _let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once per row, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _json_text(c: Column) -> Column:
    """The inside of a JSON string that spells a text."""
    escaped = F.regexp_extract(F.to_json(F.array(c)), r"(?s)\A\[\"(.*)\"\]\z", 1)
    return F.when(c.rlike(r'["\\\x00-\x1F]'), escaped).otherwise(c)


def _unit(number: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(number)), 4, "0"))


def _piece(p: Column) -> Column:
    code = F.conv(F.substring(p, 3, 8), 16, 10).cast("long")
    rest = code - 0x10000
    wide = F.concat(_unit(F.lit(0xD800) + F.floor(rest / 1024).cast("long")), _unit(F.lit(0xDC00) + rest % 1024))
    out = F.when(~p.startswith("\\"), _json_text(p)).when(p.isin(*_ALIKE), p)
    for bad, good in _OTHER.items():
        out = out.when(p == bad, F.lit(good))
    return (out.when(p.rlike(r"\A\\x[0-9a-fA-F]{2}\z"), F.concat(F.lit("\\u00"), F.substring(p, 3, 2)))
               .when(p.rlike(r"\A\\u[0-9a-fA-F]{4}"), p)
               .when(p.rlike(r"\A\\U[0-9a-fA-F]{8}"), F.when(code < 0x10000, _unit(code)).when(code < 0x110000, wide))
               .when(p.rlike(r"\A\\[0-7]"), _unit(F.conv(F.substring(p, 2, 3), 8, 10).cast("long")))
               .when(p.rlike(r"\A\\[xuUN]"), F.lit(None).cast("string"))  # broken, or a character by name
               .otherwise(F.concat(F.lit("\\\\"), _json_text(F.substring(p, 2, 9)))))


def _text(token: Column) -> Column:
    """A quoted text as the inside of a JSON string; null if an escape is broken."""
    def inside(inner):
        pieces = F.transform(F.regexp_extract_all(inner, F.lit(_PIECE), F.lit(0)), _piece)
        spelled = _let(pieces, lambda ps: F.when(F.exists(ps, lambda p: p.isNull()), None).otherwise(F.array_join(ps, "")))
        return F.when(inner.contains("\\"), spelled).otherwise(_json_text(inner))
    return _let(F.regexp_extract(token, r"""(?s)\A[uU]?['"](.*)['"]\z""", 1), inside)


def _number(token: Column) -> Column:
    """A number as JSON; null where the spelling is none of Python's."""
    plain = F.regexp_replace(F.regexp_replace(token, "_", ""), r"\A\+", "")
    sign, size = F.when(plain.startswith("-"), "-").otherwise(""), F.regexp_replace(plain, r"\A-", "")
    short = F.regexp_replace(F.regexp_replace(size, r"\A\.", "0."), r"\.(?=\z|[eE])", ".0")
    led = F.regexp_replace(short, r"\A0+(?=[0-9])", "")
    whole = size.rlike(r"\A[0-9]+\z")
    return (F.when(token.rlike(r"__|_\z|_[.eE]|[.]_|\A[+-]?_"), None)
             .when(size.rlike(r"\A0[xXoObB]"), F.concat(sign, _based(size)))
             .when(whole & size.rlike(r"\A0+[1-9]"), None)  # 007
             .otherwise(F.concat(sign, led)))


def _based(size: Column) -> Column:
    digits = F.substring(size, 3, 60)
    return F.when(size.rlike(r"\A0[xX]"), F.conv(digits, 16, 10)).when(size.rlike(r"\A0[oO]"), F.conv(digits, 8, 10)).otherwise(F.conv(digits, 2, 10))


def _kind(token: Column) -> Column:
    """One letter per token: s text, v other value, a bracket, comma or colon itself, ! anything else."""
    return (F.when(token.rlike(r"""\A[uU]?['"]""") & (F.length(token) > 1), "s")
             .when(token.isin("[", "]", "(", ")", "{", "}", ",", ":"), token)
             .when(token.rlike(r"\A[+-]?[0-9.]") & token.rlike(r"[0-9]"), "v")
             .when(token.isin(*_NAMES), "v").otherwise("!"))


def _nests(kinds: Column) -> Column:
    """Whether the tokens are one literal.  The stack holds open brackets: ``[``, ``(`` without a comma so far, ``t`` with one,
    ``{`` where a key and ``d`` where a value is due.  Due is V (a value), E (a value or the end), C (a comma or the end), K (a colon)."""
    start = F.struct(F.lit("").alias("stack"), F.lit("V").alias("due"), F.lit("").alias("before"))

    def step(s, k):
        stack, due, before = s["stack"], s["due"], s["before"]
        top = F.right(stack, F.lit(1))
        popped = F.left(stack, F.length(stack) - 1)
        free = due.isin("V", "E")
        after = F.when(top == "{", "K").otherwise("C")
        value = free | ((k == "s") & (before == "s") & due.isin("C", "K"))
        opens = k.isin("[", "(", "{")
        closes = ((k == "]") & (top == "[") | (k == "}") & top.isin("d", "{") & ~((top == "{") & (due == "K")) | (k == ")") & top.isin("t", "(")) & due.isin("C", "E")
        closes = closes & ~((top == "d") & (due == "E")) & ~((k == ")") & (top == "(") & (due == "C"))
        below = F.right(popped, F.lit(1))
        comma = (k == ",") & (due == "C") & (stack != "")
        colon = (k == ":") & (due == "K")
        made = F.when(top == "d", F.concat(popped, F.lit("{"))).when(top == "(", F.concat(popped, F.lit("t"))).otherwise(stack)
        return (F.when(due == "!", s)
                 .when(k.isin("s", "v") & value, F.struct(stack.alias("stack"), after.alias("due"), k.alias("before")))
                 .when(opens & free, F.struct(F.concat(stack, k).alias("stack"), F.lit("E").alias("due"), k.alias("before")))
                 .when(closes, F.struct(popped.alias("stack"), F.when(below == "{", "K").otherwise("C").alias("due"), k.alias("before")))
                 .when(comma, F.struct(made.alias("stack"), F.lit("E").alias("due"), k.alias("before")))
                 .when(colon, F.struct(F.concat(popped, F.lit("d")).alias("stack"), F.lit("V").alias("due"), k.alias("before")))
                 .otherwise(F.struct(stack.alias("stack"), F.lit("!").alias("due"), k.alias("before"))))
    return F.aggregate(kinds, start, step, lambda s: (s["stack"] == "") & (s["due"] == "C"))


def literal_json(c: Column) -> Column:
    """JSON of a literal, null if the text is none.  Tuples become lists and texts that follow each other become one.  Sets, bytes,
    complex numbers, raw and formatted texts, characters by name, keys of a dict that are no text, and a value in plain
    parentheses are not covered and give null."""
    tokens = F.filter(F.regexp_extract_all(c, F.lit(_TOKEN), F.lit(0)), lambda t: ~t.rlike(r"\A\s"))
    return _let(tokens, lambda ts: _let(F.transform(ts, _kind), lambda kinds: _spelled(ts, kinds)))


def _spelled(tokens: Column, kinds: Column) -> Column:
    """The tokens as JSON; null if they are no literal."""
    def joined(x, i):
        ahead, behind = F.get(kinds, i + 1), F.get(kinds, i - 1)
        first, end = F.coalesce(behind, F.lit("")) != "s", F.coalesce(ahead, F.lit("")) != "s"
        return (F.when(x["k"] == "s", F.concat(F.when(first, '"').otherwise(""), x["t"], F.when(end, '"').otherwise("")))
                 .when((x["k"] == ",") & (i < F.size(kinds) - 1) & ahead.isin("]", ")", "}"), "")
                 .otherwise(x["t"]))
    spelled = F.transform(F.arrays_zip(tokens.alias("t"), kinds.alias("k")), lambda x: F.struct(
        x["k"].alias("k"), F.when(x["k"] == "s", _text(x["t"])).when(x["t"].isin(*_NAMES), _name(x["t"])).when(x["k"] == "v", _number(x["t"]))
        .when(x["k"] == "(", "[").when(x["k"] == ")", "]").otherwise(x["t"]).alias("t")))
    # A key is a text: the token ahead of a colon.
    unkeyed = F.exists(F.sequence(F.lit(0), F.greatest(F.size(kinds) - 1, F.lit(0))), lambda i: (F.get(kinds, i) == ":") & (F.coalesce(F.get(kinds, i - 1), F.lit("")) != "s"))
    good = _nests(kinds) & ~F.coalesce(unkeyed, F.lit(False))
    told = _let(spelled, lambda xs: F.when(~F.exists(xs, lambda x: x["t"].isNull()), F.array_join(F.transform(xs, joined), "")))
    return F.when(F.coalesce(good, F.lit(False)), told)


def _name(token: Column) -> Column:
    return F.when(token == "None", "null").when(token == "True", "true").otherwise("false")
