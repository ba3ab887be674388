"""Scalar functions on hand-derived cases, and against plain Python on random text."""

import random
import re
import unicodedata
from datetime import UTC, date, datetime
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from siftwell.functions import text as t
from siftwell.functions.dates import parse_datetime
from siftwell.functions.keywords import Keywords
from siftwell.functions.page import read_page


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("f", "value", "expected"),
    [
        (t.normalize, "  AÇÃO  é½ ", "acao e12"),
        (t.normalize, None, ""),
        (t.normalize, "ﬁm ™ “x”", "fim tm x"),
        (t.slug_title, "https://x/a/alta-do-dolar-2024/", "alta do dolar"),
        (t.slug_title, "https://x/a/nota.ghtml", "nota.ghtml"),
        (t.section, "https://x/", None),
        (t.section, "https://x//Mercados/y", "Mercados"),
        (t.url_path, "https://a.b/c/d;p=1?q", "/c/d"),
        (t.url_path, "https://a b/c d#x", "/c d"),
        (t.url_path, None, ""),
        (t.url_origin, "https://a.b:8/c", "https://a.b:8"),
        (t.percent_decode, "a+b%20c%zz%C3%A7", "a+b c%zzç"),
        (t.percent_decode, "%ff%41", "�A"),
        (t.split_values, "Ibovespa; Selic | IBOVESPA , Ação", ["Ibovespa", "Selic", "IBOVESPA", "Ação"]),
        (t.content_tokens, "Alta para o dólar", ["alta", "dolar"]),
        (t.url_key, "abc", "a9993e364706816aba3e25717850c26c9cd0d89d"),
    ],
)
def test_text(spark, f, value, expected):
    assert one(spark, value, f) == expected


def test_distinct_values_keep_the_first_spelling(spark):
    assert one(spark, ["Ibovespa", "Selic", "IBOVESPA", " ", "Ação", "acao"], t.distinct_values, "array<string>") == ["Ibovespa", "Selic", "Ação"]


def test_normalize_equals_decomposition_for_code_points(spark):
    def plain(x):
        return re.sub(r"\s+", " ", unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode().lower()).strip()

    texts = ["".join(map(chr, range(k, k + 64))) for k in [*range(1, 0x3000, 64), *range(0xFB00, 0xFFF0, 64), *range(0x1D400, 0x1D800, 64)]]
    rows = spark.createDataFrame([(x,) for x in texts], "v string").select("v", t.normalize(F.col("v")).alias("r")).collect()
    assert [r.v for r in rows if r.r != plain(r.v)] == []


def test_urls_equal_the_standard_library(spark):
    random.seed(4)
    urls = ["https://h/" + "".join(random.choice("ab/;?#%c3%A7 -.1") for _ in range(12)) for _ in range(300)]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", t.url_path(F.col("u")).alias("p"), t.percent_decode(F.col("u")).alias("d")).collect()
    assert [r for r in rows if r.p != urlparse(r.u).path] == []
    assert [r for r in rows if r.d != unquote(r.u)] == []


@pytest.mark.parametrize(
    ("moment", "key", "start", "end"),
    [("2025-04-21", "2025-W17", date(2025, 4, 21), date(2025, 4, 27)), ("2021-01-03", "2020-W53", date(2020, 12, 28), date(2021, 1, 3)), ("2024-12-30", "2025-W01", date(2024, 12, 30), date(2025, 1, 5))],
)
def test_weeks(spark, moment, key, start, end):
    ts = F.lit(moment).cast("timestamp")
    row = spark.range(1).select(t.week_key(ts), t.week_start(ts), t.week_end(ts)).first()
    assert tuple(row) == (key, start, end)


def test_iso_timestamp(spark):
    stamps = [datetime(2025, 4, 21, 10, 30, tzinfo=UTC), datetime(2025, 4, 21, 10, 30, 0, 5, tzinfo=UTC)]
    rows = spark.createDataFrame([(s,) for s in stamps], "v timestamp").select(t.iso_timestamp(F.col("v"))).collect()
    assert [r[0] for r in rows] == [s.isoformat() for s in stamps]


def test_dates(spark):
    cases = {
        "2025-04-21": datetime(2025, 4, 21), "2025-04-21T07:30:00-03:00": datetime(2025, 4, 21, 10, 30), "Mon, 21 Apr 2025 10:00:00 GMT": datetime(2025, 4, 21, 10), "1 Dec 2025 10:05:06.25 -0330": datetime(2025, 12, 1, 13, 35, 6, 250000), "Tue, 31 Feb 2025 10:00 UTC": None,
        "05/04/2024": datetime(2024, 5, 4), "nonsense": None, "": None, "2025-13-40": None, "99999999999999999999": None,
    }
    rows = spark.createDataFrame([(k,) for k in [*cases, None]], "v string").select("v", parse_datetime(F.col("v")).cast("timestamp_ntz").alias("r")).collect()
    assert {r.v: r.r for r in rows if r.v is not None} == cases


@pytest.mark.parametrize(
    ("words", "text", "hits"),
    [({"jcp de r$"}, "aprova jcp de r$ 0,50", 1), ({"jcp de r$"}, "aprova jcp de r$0,50", 0), ({"b3"}, "ab3 xb3", 0), ({"b3"}, "na b3-sa", 1), ({"tesouro", "tesouro direto", "s&p 500"}, "tesouro direto e s&p 500", 3)],
)
def test_keywords(spark, words, text, hits):
    assert one(spark, text, Keywords(words).count) == hits
    assert one(spark, text, Keywords(words).any) == (hits > 0)


def test_keywords_equal_a_pattern(spark):
    random.seed(5)
    words = ["ab", "b", "a b", "b-a", "a&"]
    texts = ["".join(random.choice("ab &-c") for _ in range(10)) for _ in range(400)]
    rows = spark.createDataFrame([(x,) for x in texts], "v string").select("v", Keywords(words).count(F.col("v")).alias("n")).collect()
    assert [r for r in rows if r.n != sum(bool(re.search(rf"(?<![a-z0-9]){re.escape(w)}(?![a-z0-9])", r.v)) for w in words)] == []


def test_description_and_sentiment(spark):
    row = spark.range(1).select(
        t.sanitize_description(F.lit("Bolsa sobe 1% com Petrobras"), F.lit("Ibovespa fecha em alta")), t.sanitize_description(F.lit("Ibovespa sobe"), F.lit("O Ibovespa")),
        t.sanitize_description(F.lit("Qualquer coisa"), F.lit("a b")), t.sentiment_text(F.lit("T"), F.lit(None).cast("string")), t.sentiment_text(F.lit("T"), F.lit("D")),
    ).first()
    assert tuple(row) == (None, "Ibovespa sobe", "Qualquer coisa", "Titulo: T", "Titulo: T\nResumo: D")


PAGE = """<html><head><meta property="og:title" content="  "><meta name="twitter:title" content=" A &amp; B ">
<meta name="description" content="short"><meta property="og:description" content="exactly twenty chars">
<meta name="pubdate" content="bad"><script type="application/ld+json">{"datePublished" : "2025-04-21T07:30:00-03:00"}</script>
<meta name="keywords" content="Ibovespa; Selic | IBOVESPA"><title>x</title></head>
<body><h1>H <b>one</b></h1><a rel="tag" href="/x">Ação</a><a rel="tag nofollow" href="/y">no</a><a href="/tag/z">selic</a></body>"""


def test_page_metadata():
    assert read_page(PAGE) == ("A & B", "exactly twenty chars", datetime(2025, 4, 21, 10, 30, tzinfo=UTC), ["Ibovespa", "Selic", "Ação"])
    assert read_page("<title> </title><h1>H</h1>") == ("", None, None, [])
    assert read_page("<h1>H <b>one</b></h1><p class='x subtitle'>" + "y" * 20) == ("H one", "y" * 20, None, [])
    assert read_page(None) == (None, None, None, [])
    assert read_page("<h2>" + "z" * 19 + "</h2>")[1] is None
