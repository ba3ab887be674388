"""Rules, keyed operators, sources and the whole run, on small fixtures."""

import http.server
import json
import threading
from datetime import datetime
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

from siftwell.operators import relational as r
from siftwell.operators.rules import Rules
from siftwell.plans import pipeline
from siftwell.plans.config import RunConfig
from siftwell.sources import fetching, jsonl, sitemaps
from siftwell.sources.publishers import publishers
from siftwell.streaming.resume import incremental

RULES = Rules()
HOST = "https://www.infomoney.com.br"


def test_early_rules(spark):
    cases = {
        "/mercados/ibovespa-fecha-em-alta/": None, "/negocios/empresa-anuncia-fusao/": "low_score", "/economia/mercado-em-queda/": "low_score",
        "/mercados/fed-mantem-juros/": "exterior_only", "/mercados/fed-eleva-juros-e-ibovespa-cai/": None, "/mercados/petrobras-lucro-no-2-tri/": "company_results",
        "/mercados/lucro-das-empresas-no-2-tri/": "low_score", "/mercados/vale-a-pena-investir-no-tesouro/": "generic_title", "/mercados/destaques-do-ibovespa/": None,
        "/mercados/destaques-da-bolsa/": "roundup", "/esg/ibovespa/": "section", "/a/fundos/ibovespa/": "path", "/mercados/nada-disso/": "no_signal",
    }
    rows = spark.createDataFrame([(HOST + p, None, p.split("/")[1]) for p in cases], "url string, title string, section string")
    assert {x.url.removeprefix(HOST): x.reject_reason for x in RULES.early_reason(rows).collect()} == cases


def test_gross_match(spark):
    cases = [("InfoMoney", "/fundos/x/", False), ("InfoMoney", "/consumo/dolar-sobe/", True), ("InfoMoney", "/consumo/receita-de-bolo/", False), ("InfoMoney", "/esg", False), ("other", "/a/selic-hoje", True), ("Exame", "/Economia/x", True)]
    rows = spark.createDataFrame([(s, HOST + p) for s, p, _ in cases], "s string, u string")
    assert [x[0] for x in rows.select(RULES.gross_match(F.col("s"), F.col("u"))).collect()] == [c[2] for c in cases]


def test_home_context(spark):
    texts = ["dolar sobe e fecha a r$ 5,50", "dolar sobe ante o iene", "governo discute selic"]
    assert [x[0] for x in spark.createDataFrame([(x,) for x in texts], "v string").select(RULES.home_context(F.col("v"))).collect()] == [True, False, True]


def test_record_rules(spark):
    rows = [
        ("Dólar sobe ante o iene", None, "mercados", [], "no_home_context"), ("Ibovespa fecha em alta", "Selic e juros no Brasil", "mercados", ["Bolsa"], None),
        ("Ao vivo", "Ibovespa", "mercados", [], "roundup"), ("Governo define regras", "Banco do Brasil e juros", "politica", [], "strict_section"),
        ("Itau divulga balanco", None, "mercados", [], "company_results"), ("Fed sobe juros", None, "mercados", [], "exterior_only"), ("x", None, "esg", None, "section"),
    ]
    df = spark.createDataFrame([(f"{HOST}/{s}/x", *x[:4], i) for i, x in enumerate(rows) for s in [x[2]]], "url string, title string, description string, section string, tags array<string>, i int")
    surface = F.concat_ws(" ", "title", "description", F.array_join("tags", " "))
    out = RULES.record_reason(df.withColumns(RULES.signal_counts(surface))).orderBy("i").collect()
    assert [x.reject_reason for x in out] == [x[4] for x in rows]


def test_latest_per_key_keeps_the_first_of_equals(spark):
    rows = spark.createDataFrame([("u", 10, 1), ("u", 10, 2), ("u", 9, 3), (None, 1, 4)], "url string, at int, seq int")
    assert sorted((x.url or "", x.seq) for x in r.latest_per_key(rows, "url", "at", "seq").collect()) == [("", 4), ("u", 1)]


def test_round_robin(spark):
    rows = [("Valor Econômico", i) for i in range(3)] + [("InfoMoney", 3)] + [("Exame", 4), ("Exame", 5)]
    df = spark.createDataFrame(rows, "source string, id int").withColumn("g", F.lit(1))
    out = r.round_robin(df, ["g"], "source", RULES.priority(F.col("source")), r.shuffle_key(F.col("id"), 42)).orderBy("turn", "source_priority").collect()
    assert "".join(x.source[0] for x in out) == "VIEVEV"


def test_seen_rows_are_left_out(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "url string")
    assert sorted(str(x.url) for x in r.without_seen(df, spark.createDataFrame([("a",), (None,)], "url string")).collect()) == ["None", "b"]


INDEX = """<s:sitemapindex xmlns:s="http://www.sitemaps.org/schemas/sitemap/0.9">
<s:sitemap><s:loc> https://www.infomoney.com.br/post-sitemap1.xml </s:loc><s:lastmod>2025-04-22</s:lastmod></s:sitemap>
<s:sitemap><s:loc>https://www.infomoney.com.br/other.xml</s:loc><s:lastmod>2025-04-22</s:lastmod></s:sitemap>
<s:sitemap><s:loc>https://www.infomoney.com.br/post-sitemap2.xml</s:loc></s:sitemap><s:sitemap><s:loc> </s:loc></s:sitemap></s:sitemapindex>"""
URLS = f"""<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:n="http://www.google.com/schemas/sitemap-news/0.9">
<url><loc> {HOST}/mercados/ibovespa-fecha-em-alta/ </loc><lastmod>2025-04-22</lastmod><n:news><n:publication_date>2025-04-21T07:30:00-03:00</n:publication_date><n:title>Ibovespa fecha em alta</n:title></n:news></url>
<url><loc>{HOST}/mercados/x/</loc><lastmod>2025-04-22</lastmod></url><url><loc>{HOST}/mercados/y/</loc><lastmod>2025-04-22</lastmod><n:news><n:publication_date>bad</n:publication_date></n:news></url><url><loc></loc></url></urlset>"""


def test_sitemaps(spark):
    rows = sitemaps.url_set(spark.createDataFrame([(1, URLS), (2, "<broken")], "k int, text string")).orderBy("k", "loc").collect()
    assert [(x.k, (x.loc or "").removeprefix(HOST), x.published_at and x.published_at.isoformat(), x.title, bool(x.error)) for x in rows] == [
        (1, "/mercados/ibovespa-fecha-em-alta/", datetime(2025, 4, 21, 10, 30).isoformat(), "Ibovespa fecha em alta", False), (1, "/mercados/x/", datetime(2025, 4, 22).isoformat(), None, False),
        (1, "/mercados/y/", None, None, False), (2, "", None, None, True),
    ]
    index = sitemaps.sitemap_index(spark.createDataFrame([(INDEX,)], "text string"))
    assert index.count() == 3
    chosen = publishers()[0].select(index, "2025-05-01", "2025-05-10", None)
    assert [x.url for x in chosen.collect()] == [f"{HOST}/post-sitemap1.xml"]


def test_sitemaps_by_date(spark):
    _, valor, exame = publishers()
    index = spark.createDataFrame([("https://valor.globo.com/sitemap/valor/2025/04/21_1.xml",), ("https://valor.globo.com/sitemap/valor/2025/04/30_1.xml",), ("x",)], "loc string")
    assert valor.select(index, "2025-04-20", "2025-04-22", None).count() == 1
    day = "<sitemapindex xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>" + "".join(f"<sitemap><loc>https://exame.com/artigos/2025-04/{d}/sitemap.xml</loc></sitemap>" for d in (20, 25)) + "</sitemapindex>"
    months = spark.createDataFrame([("https://exame.com/artigos/2025-04/sitemap.xml",), ("https://exame.com/artigos/2025-06/sitemap.xml",)], "loc string")
    fetch = fetching.stored(spark.createDataFrame([("https://exame.com/artigos/2025-04/sitemap.xml", day)], "url string, text string"))
    assert [x.url for x in exame.select(months, "2025-04-20", "2025-04-22", fetch).collect()] == ["https://exame.com/artigos/2025-04/20/sitemap.xml"]


def test_stated_pause():
    def pause(text):
        rules = RobotFileParser()
        rules.parse(text.splitlines())
        return fetching.stated_pause(rules, "siftwell/0.1")

    assert pause("User-agent: *\nDisallow: /x") is None
    assert pause("User-agent: *\nCrawl-delay: 2\nRequest-rate: 1/5") == 2.0
    assert pause("User-agent: *\nRequest-rate: 1/5") == 5.0
    assert pause("User-agent: siftwell\nCrawl-delay: 3\n\nUser-agent: *\nCrawl-delay: 2") == 3.0


class _Site(http.server.BaseHTTPRequestHandler):
    def do_GET(self):
        pages = {"/robots.txt": (301, "/moved.txt"), "/moved.txt": (200, "User-agent: *\nDisallow: /no"), "/a": (200, "text é"), "/to": (302, "/a"), "/loop": (302, "/loop"), "/tono": (302, "/no/1")}
        status, body = pages.get(self.path, (404, "none"))
        self.send_response(status)
        if status in (301, 302):
            self.send_header("Location", body)
        self.send_header("Content-Type", "text/plain; charset=utf-8")
        self.end_headers()
        self.wfile.write(body.encode())

    def log_message(self, *args):
        pass


def test_http_fetcher(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    urls = spark.createDataFrame([(base + p,) for p in ("/a", "/to", "/loop", "/no/1", "/tono", "/missing")], "url string")
    out = {x.url.removeprefix(base): (x.status, x.text, x.final_url) for x in fetching.HttpFetcher(delay=0.0)(urls).collect()}
    kept = spark.createDataFrame([("k", base + p, base + p, "t", "ok") for p in ("/a", "/no/2")], fetching.SCHEMA)
    again = {x.url.removeprefix(base): (x.status, x.text) for x in fetching.HttpFetcher(delay=0.0, workers=2).permitted(kept).collect()}
    server.shutdown()
    assert again == {"/a": ("ok", "t"), "/no/2": ("blocked", None)}
    assert out["/a"] == ("ok", "text é", base + "/a") and out["/to"] == ("ok", "text é", base + "/a")
    assert out["/no/1"][0] == out["/tono"][0] == "blocked"
    assert out["/loop"][0].startswith("failed") and out["/missing"][0].startswith("failed")


def test_bronze(spark, tmp_path):
    path = str(tmp_path / "bronze")
    rows = [("k1", "u1", "u1", "t", "ok"), ("k1", "u1", "u1", "t", "ok"), ("k2", "u2", None, None, "blocked")]
    fetching.store(path, spark.createDataFrame(rows, fetching.SCHEMA))
    bronze = spark.read.parquet(path)
    assert bronze.count() == 1
    wanted = spark.createDataFrame([("u1",), ("u2",)], "url string")
    assert [x.url for x in fetching.missing(wanted, bronze).collect()] == ["u2"]
    assert [x.text for x in fetching.stored(bronze)(wanted).collect()] == ["t"]


def test_seen_urls(spark, tmp_path):
    f = tmp_path / "out.jsonl"
    assert jsonl.seen_urls(spark, str(f)).count() == 0
    f.write_text('{"url": "a", "x": 1}\n\n{"url": "b"}\n{"url": ""}\n{"url": "a"}\n{"url": "c')
    assert sorted(x.url for x in jsonl.seen_urls(spark, str(f)).collect()) == ["a", "b"]


ARTICLE = "<html><head><title>Ibovespa fecha em alta &amp; selic sobe</title><meta name='description' content='O Ibovespa subiu com a Selic e o Brasil.'><meta name='keywords' content='Bolsa'></head></html>"


def _web(spark):
    rows = [("https://www.infomoney.com.br/sitemap_index.xml", INDEX), (f"{HOST}/post-sitemap1.xml", URLS), (f"{HOST}/mercados/ibovespa-fecha-em-alta/", ARTICLE)]
    return fetching.stored(spark.createDataFrame(rows, "url string, text string"))


def test_whole_run_and_resume(spark, tmp_path):
    config = RunConfig("2025-04-01", "2025-04-30", str(tmp_path / "out"), resume=True, metrics=str(tmp_path / "metrics"))
    of = publishers()[:1]
    assert pipeline.run(spark, _web(spark), config, of=of) == 1
    assert [(x.source, x.n) for x in spark.read.json(str(tmp_path / "metrics/sources")).collect()] == [("InfoMoney", 2)]
    assert [(x.week_key, x["pool"], x.rejected, x.passed, x.approved) for x in spark.read.json(str(tmp_path / "metrics/weeks")).collect()] == [("2025-W17", 2, 1, 1, 1)]
    assert pipeline.run(spark, _web(spark), config, of=of) == 0
    lines = [json.loads(x) for f in (tmp_path / "out").rglob("part-*") for x in f.read_text().splitlines()]
    assert len(lines) == 1
    assert list(lines[0]) == ["source", "url", "published_at", "week_key", "week_start", "week_end", "tags", "title", "description", "sentiment_text"]
    assert lines[0]["published_at"] == "2025-04-21T10:30:00+00:00" and lines[0]["week_key"] == "2025-W17" and lines[0]["tags"] == ["Bolsa"]
    assert lines[0]["sentiment_text"] == "Titulo: Ibovespa fecha em alta & selic sobe\nResumo: O Ibovespa subiu com a Selic e o Brasil."


def test_a_record_is_made_once(spark):
    """The filter on the reason doesn't repeat what records are made of: two look for words, three read paths."""
    rows = spark.sql("SELECT 'InfoMoney' AS source, 'u' AS url, timestamp '2025-04-21' AS published_at, 't' AS title, 's' AS section")
    out = pipeline.records(pipeline.enrich(rows, _web(spark), RunConfig("2025-04-01", "2025-04-30", "out"), RULES))
    found = out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(")
    assert found <= 5


def test_config_order():
    with pytest.raises(ValueError):
        RunConfig("2025-01-02", "2025-01-01")


def test_in_turns(spark):
    rows = spark.createDataFrame([("InfoMoney", "u1", "w", 0), ("Exame", "u2", "w", 0), ("InfoMoney", "u3", "w", 0)], "source string, url string, week_key string, weekday int")
    assert [x.source[0] for x in pipeline.in_turns(rows, RULES, 42).collect()] == ["I", "E", "I"]


def test_newest_candidate(spark):
    """The newest stays; of equally new ones the first by source priority, then by title."""
    rows = [("Exame", "u", 2, "A"), ("InfoMoney", "u", 3, "Zulu"), ("InfoMoney", "u", 3, "Alpha"), ("Exame", "u", 3, "0"), ("Exame", "w", None, None), ("Exame", "w", 1, "x")]
    df = spark.createDataFrame([(a, b, c and datetime(2025, 4, c), d, None) for a, b, c, d in rows], "source string, url string, published_at timestamp, title string, section string")
    assert sorted((x.url, x.source, x.title) for x in pipeline.newest(df, RULES).collect()) == [("u", "InfoMoney", "Alpha"), ("w", "Exame", "x")]


def test_stream_appends_what_is_new(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    config = RunConfig("2025-04-01", "2025-04-30", out)
    row = [("InfoMoney", f"{HOST}/mercados/ibovespa-fecha-em-alta/", datetime(2025, 4, 21), None, "mercados")]
    for _ in range(2):
        spark.createDataFrame(row, "source string, url string, published_at timestamp, title string, section string").write.mode("append").parquet(inbox)
        q = incremental(spark, inbox, str(tmp_path / "state"), _web(spark), config)
        q.awaitTermination()
    assert spark.read.json(out).count() == 1


def test_arguments():
    from siftwell.__main__ import arguments

    config, bronze = arguments(["--start-date", "2025-01-01", "--end-date", "2025-01-31", "--resume", "--cache-dir", "b", "--workers", "3"])
    assert (config.start_date, config.end_date, config.resume, config.workers, bronze) == ("2025-01-01", "2025-01-31", True, 3, "b")
    with pytest.raises(ValueError):
        arguments(["--start-date", "2025-02-01", "--end-date", "2025-01-31"])


def test_cached_fetches_once(spark, tmp_path):
    asked = []

    def live(urls):
        asked.extend(x.url for x in urls.collect())
        return urls.selectExpr("sha1(url) AS url_key", "url", "url AS final_url", "'t' AS text", "'ok' AS status")

    fetch = fetching.cached(spark, str(tmp_path / "bronze"), live)
    one = spark.createDataFrame([("u1",)], "url string")
    two = spark.createDataFrame([("u1",), ("u2",)], "url string")
    assert fetch(one).count() == 1 and sorted(x.url for x in fetch(two).collect()) == ["u1", "u2"]
    assert asked == ["u1", "u2"]
