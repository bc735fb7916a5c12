import html
import re
import unicodedata
import zlib

from pyspark.sql import functions as F, types as T

from twinledger.functions import failures, markup, payload, text, values
from twinledger.sources.extract import join_bucket


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_strip_and_canonical_follow_unicode(spark, table):
    words = ["", " a ", "\tb\n", " c　", "\x1fd\x1c", "ａ１２  ﬁ", "é \r\n x", "plain", None, "​z"]
    df = table("x", [(w,) for w in words]).coalesce(1)
    assert column(df, text.strip(F.col("x"))) == [w.strip() if w is not None else None for w in words]
    assert column(df, text.strip_name("x")) == [w.strip() if w is not None else None for w in words]
    want = [" ".join(unicodedata.normalize("NFKC", w).split()) if w is not None else None for w in words]
    assert column(df, text.canonical(F.col("x"))) == want


def test_nfkc_matches_unicodedata_widely(spark, table):
    chars = [chr(c) for c in range(0xA0, 0x3100) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    df = table("x", [(c,) for c in chars]).coalesce(1)
    got = column(df, text.nfkc(F.col("x")))
    assert got == [unicodedata.normalize("NFKC", c) for c in chars]


def test_blank_vocabularies_differ(spark, table):
    df = table("x", [("<NA>",), ("N/A",), (" none ",), ("x",), (None,)]).coalesce(1)
    assert column(df, text.key_text(F.col("x"))) == ["<NA>", "N/A", None, "x", None]
    assert column(df, text.load_text(F.col("x"))) == [None, "N/A", None, "x", None]
    assert column(df, text.metadata_text(F.col("x"))) == [None, None, None, "x", None]


def test_float_text_is_python_repr(spark):
    numbers = [0.0, 1.0, -2.5, 1e7, 123456789.125, 1e15, 1e16, 1.5e-5, 0.0001, 0.00012, 3.0e22, -1e-7, 144449.04, float("inf"), float("nan")]
    df = spark.createDataFrame([(n,) for n in numbers], "x double").coalesce(1)
    assert column(df, values.float_text(F.col("x"))) == [repr(n) for n in numbers]


def test_stored_spellings(spark):
    df = spark.sql("select true as b, named_struct('z', 1, 'a', 'x') as s, cast(3 as bigint) as i")
    schema = df.schema
    got = df.select(*[values.stored(F.col(f.name), f.dataType).alias(f.name) for f in schema]).first()
    assert tuple(got) == ("True", '{"a":"x","z":1}', "3")
    assert isinstance(schema["s"].dataType, T.StructType)


def test_coerced_and_equivalent(spark, table):
    df = table("x kind", [("-3.9", "int"), ("TRUE", "boolean"), ("abc", "double"), (" nan ", "string"), (" keep ", "string"), ("1e7", "currency")]).coalesce(1)
    assert column(df, values.coerced(F.col("x"), F.col("kind"))) == ["-3", "true", None, None, " keep ", "10000000.0"]
    assert column(df, values.is_bad_number(F.col("x"), F.col("kind"))) == [False, False, True, False, False, False]
    pairs = table("a b kind", [("1.0", "1", "double"), ("", None, "int"), ("x ", "x", "string"), ("true", "TRUE", "boolean"), ("a", "b", "string"), (None, "1", "int")]).coalesce(1)
    assert column(pairs, values.equivalent(F.col("a"), F.col("b"), F.col("kind"))) == [True, True, True, True, False, False]


def test_bucket_is_crc32(spark, table):
    keys = ["001A", " 001A ", "é", "x" * 50]
    df = table("k", [(k,) for k in keys + ["", "  "]]).coalesce(1)
    want = [f"{zlib.crc32(k.strip().encode()) % 32:03d}" for k in keys] + ["missing", "missing"]
    assert column(df, join_bucket(F.col("k"))) == want


def test_bucket_numbers_are_padded_without_a_formatter(spark, table):
    keys = ["001A", "\t001A\u00a0", "é", "x" * 50, "\u2003z", "7", "8", "9"]
    df = table("k", [(k,) for k in keys]).coalesce(1)
    for buckets in (7, 1000, 5000):
        out = df.select(join_bucket(F.col("k"), buckets).alias("b"))
        assert [r.b for r in out.collect()] == [f"{zlib.crc32(k.strip().encode()) % buckets:03d}" for k in keys]
        assert "format_string" not in out._jdf.queryExecution().toString()


def test_globs(spark, table):
    cases = [("Orders", "Id"), ("Orders", "OwnerId"), ("Orders", "Owner.Id"), ("Customer", "Name"), ("Orders", "customer"), ("Orders", "id")]
    df = table("o f", cases).coalesce(1)
    got = column(df, text.first_glob(F.col("o"), F.col("f"), ["*.Owner.Id", "Id", "Orders.cust*", "[A-C]*.N?me", "*Id", "Id"]))
    assert got == ["Id", "*Id", "*.Owner.Id", "[A-C]*.N?me", "Orders.cust*", None]


MARKUP = [
    ("plain & text", "plain & text"),
    ("<p>Hello&nbsp;&amp; bye</p><br/>x", "Hello\u00a0& bye\n\nx"),
    ("a<script>if (x) { '</p>' }</script>b <b>c</b> <p>", "a b c"),
    ("x <!-- never closed <p>", "x"),
    ("Body: <!-- /* Font Definitions */ p.MsoNormal {mso-style:x} --> tail", "Body:"),
    ("mso-style: 1; word", "word"),
    ("<b>not a trigger</b>", "<b>not a trigger</b>"),
    (None, None),
]


def python_clean(value):
    """The same patterns under Python's own regular expressions."""
    flags = lambda p: p.replace("(?isdU)", "(?is)").replace("(?imdU)", "(?im)")
    if value is None or not re.search(flags(markup.TRIGGER), value):
        return value
    t = value.replace("\r\n", "\n").replace("\r", "\n")
    hit = re.search(flags(markup.OFFICE_BODY), t)
    if hit and re.search(flags(markup.OFFICE_MARKS), t):
        t = t[:hit.start()] + "Body:"
    for p, r in markup.BEFORE_ENTITIES:
        t = re.sub(flags(p), r, t)
    t = unicodedata.normalize("NFC", html.unescape(t))
    for p, r in markup.AFTER_ENTITIES:
        t = re.sub(p, r, t)
    return t.strip()


def test_markup(spark, table):
    df = table("x", [(m,) for m, _ in MARKUP]).coalesce(1)
    assert column(markup.with_clean_text(df, "x", "y"), F.col("y")) == [w for _, w in MARKUP]


def test_markup_equals_python_on_whole_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html")
    odd = "<P style='x'>a\r\n<li >b</LI>\u2028 .MsoNormal x{\nq}\n@page y\n&lt;c&gt; &notit; &#x80; e\u0301</P>"
    more = spark.createDataFrame([(odd,), ("{ a: font-size } \x85 <td>x",), ("@font-face {x:\n y} @list l0 {z}\n\n\n\n<div>k",)], "html string")
    got = markup.with_clean_text(pages.unionByName(more), "html", "clean").collect()
    assert len(got) == 53
    for r in got:
        assert r.clean == python_clean(r.html)


ERRORS = [
    ('[{"message":"m1","errorCode":"C1","fields":["A"," ","B"]}]', ("C1", "A; B", "m1")),
    ("[{'message': 'm2', 'errorCode': 'C2', 'fields': ['A']}]", ("C2", "A", "m2")),
    ('{"errors":[{"statusCode":"","errorCode":"E","message":"m3","fields":"X"}]}', ("E", "X", "m3")),
    ('{"errors":"all bad"}', ("", "", "all bad")),
    ('{"duplicateResult":{},"message":"m4","fields":[]}', ("DUPLICATES_DETECTED", "", "m4")),
    ("""boom {"x": 'errorCode': 'C5', "message": "it's"}""", ("C5", "", "it")),
    ("Failed  at https://a/b\nnow", ("", "", "Failed at URL now")),
    ("[]", ("", "", "[]")), ('["text"]', ("", "", '["text"]')), (None, ("", "", "")),
    ('Malformed. Response content: [{"message":"m6","errorCode":"C6"}]', ("C6", "", "m6")),
]


def test_error_forms(spark, table):
    df = failures.with_parsed_error(table("message", [(m,) for m, _ in ERRORS]).coalesce(1))
    got = [tuple(r) for r in df.select("error_code", "error_fields", "error_message").collect()]
    assert got == [w for _, w in ERRORS]


def test_error_category_precedence(spark, table):
    cases = [("skip", "", "related record not found", "Missing Related Record"), ("skip", "", "target X not found", "Missing Related Record"),
             ("skip", "", "x", "Loader Skip"), ("update", "STRING_TOO_LONG", "validation failed", "Validation Rule"),
             ("update", "", "duplicate validation", "Duplicate Rule / Duplicate Value"), ("update", "odd_code", "", "ODD_CODE"), ("update", "", "", "Unclassified")]
    df = table("o c m want", cases).coalesce(1)
    assert column(df, failures.category(F.col("o"), F.col("c"), F.col("m"))) == [c[3] for c in cases]


def test_masking(spark, table):
    df = table("x", [("at /sobjects/Account/001000000000001AAA on a01123456789012  x",), ("Member Id 'q' or the campaign id 'r'",), (None,)]).coalesce(1)
    assert column(df, failures.masked(F.col("x"))) == ["at /Account/<SF_ID> on <SF_ID> x", "member id '<MEMBER_ID>' or the campaign id '<CAMPAIGN_ID>'", ""]


def test_payload_json_keeps_nulls_and_diff_wins(spark):
    df = spark.sql("select map('b', 'x', 'a', cast(null as string)) as d, map('a', 'under', 'c', '1') as l")
    got = df.select(payload.to_text(F.col("d")), payload.to_text(payload.merged(F.col("l"), F.col("d")))).first()
    assert tuple(got) == ('{"a":null,"b":"x"}', '{"a":null,"b":"x","c":"1"}')


def test_items_json(spark):
    df = spark.sql("""select array(named_struct('name','B','ext_field',cast(null as string),'value','q"x'),
        named_struct('name','A','ext_field','External_Id__c','value','1'), named_struct('name','C','ext_field',cast(null as string),'value',cast(null as string))) as e""")
    assert column(df, payload.items_json(F.col("e"))) == ['{"A":{"External_Id__c":"1"},"B":"q\\"x","C":null}']


def test_malformed_payload(spark, table):
    df = table("x", [('{"a":1}',), ("[1]",), ("oops",), ("",), (None,)]).coalesce(1)
    assert column(df, payload.is_malformed(F.col("x"))) == [False, True, True, False, False]


def test_whole_numbers_are_exact(spark, table):
    texts = ["12345678901234567890", "-12345678901234567890", "1e30", "9223372036854775808", "-7.9", "7.9", "1e37", "inf", "-Infinity", "1e38", "x"]
    df = table("x kind", [(t, "int") for t in texts])
    got = column(df, values.coerced(F.col("x"), F.col("kind")))
    assert got == [str(int(float(t))) for t in texts[:7]] + [None] * 4
    assert column(df, values.is_bad_number(F.col("x"), F.col("kind"))) == [False] * 7 + [True] * 4
