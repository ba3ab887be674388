"""Robots rules, HTTP trouble, the data source, sitemaps, large dictionaries, the seen table, and runs that end early."""

import dataclasses
import http.server
import json
import random
import re
import socket
import threading
from collections import Counter, defaultdict, deque
from datetime import datetime, timedelta
from urllib.robotparser import RobotFileParser
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from siftwell.functions import keywords
from siftwell.functions.text import normalize_value
from siftwell.operators import relational as r
from siftwell.operators.rules import Rules
from siftwell.plans import pipeline
from siftwell.plans.config import RunConfig
from siftwell.plans.vocabulary import DEFAULT
from siftwell.sources import datasource, fetching, jsonl, robots, sitemaps
from siftwell.sources.publishers import Changed, Publisher
from siftwell.sources.seen import SeenUrls
from siftwell.streaming.resume import incremental

RULES = Rules()


# --- robots.txt ---------------------------------------------------------------------------


def test_robots_decide_like_the_standard_parser(spark):
    rnd = random.Random(5)
    chars = ["a", "b", "/", "/a/", "?", "#", ";", "%2F", "%3f", "%3B", "é", "%C3%A9", " ", "*", "$", "~", "+", "&", "=", "%zz", ":", "//", "A", ".", "@", "'", "%00", "%ff"]
    path = lambda: "".join(rnd.choice(chars) for _ in range(rnd.randrange(7)))
    agents = ["*", "siftwell", "Sift", "other", "bot", "", "siftwell/0.1"]

    def text():
        line = lambda: rnd.choice(["User-agent: " + rnd.choice(agents)] * 2 + ["Disallow: " + rnd.choice(["", "/"]) + path()] * 4 + ["Allow: /" + path()] * 2 + ["", "# c", "Crawl-delay: 3", "Request-rate: 1/5", "junk", "Disallow: *"])
        return "\n".join(line() for _ in range(rnd.randrange(12)))

    texts = {f"http://h{i}": text() for i in range(120)}
    urls = sorted({(o, o + rnd.choice("/?#") + path()) for o in texts for _ in range(6)})
    table = robots.rules(spark.createDataFrame([*texts.items(), ("http://none", None)], "origin string, text string"))
    df = spark.createDataFrame([*urls, (None, "http://none/x"), (None, "http://unknown/x"), (None, None)], "o string, url string")
    for agent in ("siftwell/0.1", "nobody", "bot"):
        got = {x.url: x.allowed for x in robots.permissions(df, table, agent).collect()}
        assert len(got) == len(urls) + 3 and got["http://none/x"] and got["http://unknown/x"] and got[None]
        for origin, url in urls:
            plain = RobotFileParser()
            plain.parse(texts[origin].splitlines())
            assert got[url] == plain.can_fetch(agent, url), (agent, url, texts[origin])


def test_robots_pauses(spark):
    texts = [("a", "User-agent: *\nCrawl-delay: 2\nRequest-rate: 1/5"), ("b", "User-agent: *\nRequest-rate: 1/5\nDisallow: /x"), ("c", "User-agent: siftwell\nCrawl-delay: 3\n\nUser-agent: *\nDisallow: /"), ("d", "Disallow: /")]
    got = {x.origin: (x.pause, [(p.prefix, p.allow) for p in x.rules]) for x in robots.for_agent(robots.rules(spark.createDataFrame(texts, "origin string, text string")), "siftwell/0.1").collect()}
    assert got == {"a": (2.0, []), "b": (5.0, [("/x", False)]), "c": (3.0, [])}


# --- HTTP -----------------------------------------------------------------------------------


class _Shaky(http.server.BaseHTTPRequestHandler):
    """Resets the first connection for a page; /cut promises more than it sends, the first time."""

    asked: Counter = Counter()

    def do_GET(self):
        self.asked[self.path] += 1
        if self.path == "/robots.txt":
            self.send_error(404)
            return
        if self.path == "/reset" and self.asked[self.path] == 1:
            self.connection.setsockopt(socket.SOL_SOCKET, socket.SO_LINGER, b"\1\0\0\0\0\0\0\0")
            self.connection.close()
            return
        if self.path == "/busy" and self.asked[self.path] < 3:
            self.send_error(503)
            return
        self.send_response(200)
        self.send_header("Content-Length", "9" if self.path == "/cut" and self.asked[self.path] == 1 else "4")
        self.end_headers()
        self.wfile.write(b"text")

    def log_message(self, *args):
        pass


def _served(handler):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server, f"http://127.0.0.1:{server.server_port}"


def test_broken_connections_are_tried_again():
    server, base = _served(_Shaky)
    _Shaky.asked.clear()
    session = fetching._Session(fetching.HttpFetcher(delay=0.0, backoff=0.01, timeout=5))
    rows = [session.row(base + p) for p in ("/reset", "/cut", "/busy")]
    server.shutdown()
    server.server_close()
    assert [x[3:] for x in rows] == [("text", "ok")] * 3
    assert _Shaky.asked == {"/robots.txt": 1, "/reset": 2, "/cut": 2, "/busy": 3}


def test_an_origin_that_is_down_is_asked_once(monkeypatch):
    with socket.socket() as s:
        s.bind(("127.0.0.1", 0))
        base = f"http://127.0.0.1:{s.getsockname()[1]}"  # bound, not listening
        session = fetching._Session(fetching.HttpFetcher(delay=0.0, backoff=0.0, tries=3))
        asked = []
        request = session.request
        monkeypatch.setattr(session, "request", lambda url, timeout: asked.append(url) or request(url, timeout))
        rows = [session.row(f"{base}/{i}") for i in range(4)]
    assert asked == [f"{base}/robots.txt"]
    assert all(x[4].startswith("failed: robots.txt:") and x[3] is None for x in rows)


class _Ruled(http.server.BaseHTTPRequestHandler):
    def do_GET(self):
        found = {"/robots.txt": "User-agent: *\nDisallow: /no", "/a": "A", "/b": "é"}.get(self.path)
        self.send_response(200 if found else 404)
        self.end_headers()
        self.wfile.write((found or "none").encode())

    def log_message(self, *args):
        pass


def test_pages_as_a_data_source(spark):
    datasource.register(spark)
    server, base = _served(_Ruled)
    other, there = _served(_Ruled)
    urls = "\n".join([f"{base}/a", f"{base}/no/1", f"{there}/b", "", f"{base}/a", f"{there}/missing"])
    df = spark.read.format(datasource.NAME).option("urls", urls).option("delay", "0.0").option("tries", "1").load()
    assert df.dtypes == [(c.split()[0], "string") for c in fetching.SCHEMA.split(", ")]
    assert df.rdd.getNumPartitions() == 2
    got = {x.url: (x.status, x.text) for x in df.collect()}
    server.shutdown()
    other.shutdown()
    assert got == {f"{base}/a": ("ok", "A"), f"{base}/no/1": ("blocked", None), f"{there}/b": ("ok", "é"), f"{there}/missing": ("failed: HTTP 404", None)}
    assert spark.read.format(datasource.NAME).load().count() == 0
    with pytest.raises(Exception, match="no such option"):
        spark.read.format(datasource.NAME).option("urls", base).option("speed", "9").load().count()


# --- sitemaps -------------------------------------------------------------------------------

_S, _N = sitemaps._SITEMAP, sitemaps._NEWS
_MAPS = [
    f'<?xml version="1.0" encoding="UTF-8"?><!-- c > --><urlset xmlns="{_S}" xmlns:news="{_N}" xmlns:image="i"><url><loc> https://x/1 </loc><image:image><image:loc>no</image:loc></image:image><lastmod>2025-01-01</lastmod>'
    "<news:news><news:publication_date>d</news:publication_date><news:title>A &amp; <![CDATA[<b> & <url>]]>]]&gt;</news:title></news:news></url><url><loc>two</loc><loc>three</loc></url></urlset>",
    "<broken", f"<urlset xmlns='{_S}'/>", None, "", "plain", f"<urlset xmlns='{_S}'><url><loc>a</loc></url><url><loc>b</loc></urlset>", f"<urlset xmlns='{_S}'><url/><url></url><url><loc/></url></urlset>",
    f"<urlset xmlns='{_S}'><url><loc>a</loc></url></urlset> trailing", f"<urlset xmlns='{_S}'><url><loc>a&nbsp;</loc></url></urlset>", f"<urlset xmlns='{_S}'><url><loc><![CDATA[ open</loc></url></urlset>",
    f"<s:urlset xmlns:s='{_S}' xmlns:n='{_N}'><s:url><s:loc>q</s:loc><n:news><n:title> t </n:title></n:news></s:url><url><loc>none</loc></url></s:urlset>",
    f"<n:urlset xmlns:n='{_S}' xmlns:s='{_N}'><n:url><n:loc>q</n:loc><s:news><s:title> t </s:title></s:news></n:url></n:urlset>", "<urlset><url><loc>in no namespace</loc></url></urlset>",
    f"<urlset xmlns='other' xmlns:a='{_S}'><url><loc>x</loc></url><a:url><a:loc> y\n</a:loc><loc>z</loc></a:url></urlset>",
    f"<a:r xmlns:a='{_S}' xmlns='{_N}'><a:url><a:loc>y</a:loc><news><title>T</title><publication_date>P</publication_date></news></a:url></a:r>",
    f"<urlset xmlns='{_S}'><url><loc>http://x/?a=1&amp;b=2&#233;</loc><lastmod/></url></urlset>\n<!-- end -->\n", f"<urlset xmlns='{_S}'>" + "".join(f"<url><loc>{i}</loc></url>" for i in range(5000)) + "</urlset>",
]


def _plain_map(xml):
    try:
        root = ElementTree.fromstring(xml or "")
    except ElementTree.ParseError:
        return [None]
    fields = (f"{{{_S}}}loc", f"{{{_N}}}news/{{{_N}}}title")
    return [x for x in (tuple((e.findtext(f) or "").strip() for f in fields) for e in root.findall(f"{{{_S}}}url")) if x[0]]


def test_sitemaps_read_like_the_standard_parser(spark):
    df = spark.createDataFrame(list(enumerate(_MAPS)), "k int, text string")
    out = sitemaps.url_set(df.withColumn("url", F.lit("clash")))
    got = defaultdict(list)
    for x in out.collect():
        got[x.k].append(None if x.error else (x.loc, x.title or ""))
    assert {k: got[k] for k in range(len(_MAPS))} == {k: _plain_map(x) for k, x in enumerate(_MAPS)}
    assert "Python" not in sitemaps._rows(df, "text", "url", {"loc": lambda e: sitemaps._first(e["s:loc"])})._jdf.queryExecution().executedPlan().toString()


# --- dictionaries ---------------------------------------------------------------------------


@pytest.mark.parametrize("few", [0, 1000])
def test_large_dictionaries_find_what_patterns_find(spark, few, monkeypatch):
    monkeypatch.setattr(keywords, "MANY_PHRASES", few)
    monkeypatch.setattr(keywords, "MANY_WORDS", few)
    rnd = random.Random(3)
    make = lambda n: "".join(rnd.choice(["a", "b", "c1", "dd", "e"]) + rnd.choice([" ", "-", " & ", "$", "/", ". ", " "]) for _ in range(n)).strip()
    words = [make(rnd.randrange(1, 4)).strip(" .-&/") for _ in range(60)] + ["r$", "$ a", "-b", "a&b", "a  b", "s&p 500", "a.", "c1 dd e a", "%"]
    texts = [" ".join(make(rnd.randrange(9)).split()) for _ in range(200)] + ["", "r$ 5", "r$5", "s&p 500", "xs&p 500", "s&p 5000"]
    k, every = keywords.Keywords(words), {normalize_value(x) for x in words} - {""}
    assert bool(k.runs) == (few == 0)
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", k.count(F.col("x")).alias("n"), k.any(F.col("x")).alias("any")).collect()
    for x in rows:
        hits = sum(bool(re.search(rf"(?<![a-z0-9]){re.escape(q)}(?![a-z0-9])", texts[x.i])) for q in every)
        assert (x.n, x.any) == (hits, hits > 0), texts[x.i]


# --- the seen table -------------------------------------------------------------------------


def test_seen_table_skips_nothing_wrongly(spark, tmp_path):
    urls = lambda a, b: spark.createDataFrame([(f"https://x/{i}",) for i in range(a, b)], "url string")
    # filters that are far too small say maybe of nearly everything; results stay right
    for name, bits in (("full", 64), ("roomy", 1 << 14)):
        table = SeenUrls(spark, str(tmp_path / name), buckets=8, bits=bits)
        assert table.unseen(urls(0, 5)).count() == 5
        table.add(urls(0, 300).union(urls(0, 10)))
        table.add(urls(250, 400).union(spark.createDataFrame([(None,)], "url string")))
        batch = urls(350, 450).union(urls(440, 450)).union(spark.createDataFrame([(None,), (None,)], "url string"))
        got = Counter(x.url for x in table.unseen(batch).collect())
        assert got == Counter([None, None] + [f"https://x/{i}" for i in range(400, 450)] + [f"https://x/{i}" for i in range(440, 450)])
        assert table.seen(batch).count() == 50
        if name == "roomy":
            assert table.maybe(urls(1000, 3000)).count() < 60
    assert table.unseen(batch.limit(0)).count() == 0


def test_a_small_batch_reads_its_own_buckets(spark, tmp_path):
    table = SeenUrls(spark, str(tmp_path / "seen"), buckets=32, bits=1 << 12)
    table.add(spark.range(2000).selectExpr("concat('u', id) AS url"))
    one = spark.createDataFrame([("u7",)], "url string")
    table.seen(one).collect()
    bucket = one.select(table._bucket(F.col("url"))).first()[0]
    for part, schema in (("filters", "words array<bigint>"), ("urls", "url string")):
        plan = table._read(part, schema, [bucket])._jdf.queryExecution().executedPlan().toString()
        assert f"= {bucket})], PushedFilters" in plan
        files = table._read(part, schema, [bucket]).select("*", F.input_file_name().alias("f")).select("f").distinct().collect()
        assert len(files) == 1 and f"bucket={bucket}/" in files[0].f
    assert table.unseen(spark.createDataFrame([("v1",)], "url string")).count() == 1


# --- turns ----------------------------------------------------------------------------------


def _dealt(rows, seed):
    """Order of a day's rows (source, moment, url): sources in turn, each shuffled by one generator."""
    generator, queues = random.Random(seed), {}
    for source, moment, url in sorted(rows, key=lambda x: (x[1], x[0], x[2])):
        queues.setdefault(source, []).append(url)
    for q in queues.values():
        generator.shuffle(q)
    queues = {s: deque(queues[s]) for s in sorted(queues, key=lambda s: (DEFAULT.source_priority.get(s, 99), s))}
    out = []
    while any(queues.values()):
        out += [q.popleft() for q in queues.values() if q]
    return out


@pytest.mark.parametrize("seed", [42, 7])
def test_turns_of_the_seeded_generator(spark, seed):
    rnd = random.Random(seed)
    start = datetime(2025, 4, 21)
    rows = [(rnd.choice(["InfoMoney", "Exame", "Valor Econômico", "other"]), start + timedelta(hours=rnd.randrange(24 * 9)), f"u{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "source string, published_at timestamp, url string")
    df = df.withColumns({"week_key": F.date_format(F.date_trunc("week", "published_at"), "yyyy-MM-dd"), "weekday": F.weekday("published_at")})
    got = pipeline.in_turns(df, RULES, seed, exact=True).collect()
    days = defaultdict(list)
    for x in rows:
        days[x[1].date()].append(x)
    assert [x.url for x in got] == [u for day in sorted(days) for u in _dealt(days[day], seed + day.weekday())]
    assert sorted(x.url for x in pipeline.in_turns(df, RULES, seed).collect()) == sorted(x[2] for x in rows)


# --- runs by week ---------------------------------------------------------------------------

#: Few words, so that plans are small.
_SMALL = Rules(
    dataclasses.replace(
        DEFAULT, core=frozenset({"ibovespa"}), brazil=frozenset({"selic", "brasil"}), focus=frozenset({"selic", "ibovespa"}), foreign=frozenset({"fed"}), home=frozenset({"brasil"}), metrics=frozenset({"lucro"}),
        periods=frozenset({"ano"}), aggregates=frozenset({"bancos"}), announcements=frozenset({"lucro de"}), generic_titles=frozenset({"no radar"}),
    )
)
_HOST = "https://news.example"
_ONE = Publisher("InfoMoney", f"{_HOST}/index.xml", (Changed((f"{_HOST}/map",), 45, 3),))
_DAYS = [datetime(2025, 4, d) for d in (8, 9, 15, 16, 22, 23)]  # two in each of three weeks


def _site(spark, broken=()):
    url = lambda i: f"{_HOST}/mercados/ibovespa-fecha-em-alta-{i}/"
    entries = "".join(f"<url><loc>{url(i)}</loc><lastmod>{d:%Y-%m-%d}T10:00:00Z</lastmod></url>" for i, d in enumerate(_DAYS)) + f"<url><loc>{url(99)}</loc></url>"  # one has no moment
    rows = [(f"{_HOST}/index.xml", f"<sitemapindex xmlns='{_S}'><sitemap><loc>{_HOST}/map1.xml</loc><lastmod>2025-04-20</lastmod></sitemap></sitemapindex>"), (f"{_HOST}/map1.xml", f"<urlset xmlns='{_S}'>{entries}</urlset>")]
    rows += [(url(i), f"<title>Ibovespa sobe {i}</title><meta name='description' content='O Ibovespa subiu com a Selic no Brasil.'>") for i in range(len(_DAYS))]
    pages = fetching.stored(spark.createDataFrame(rows, "url string, text string"))

    def fetch(urls):
        asked = {x.url for x in urls.select("url").collect()}
        if asked & {url(i) for i in broken}:
            raise OSError("the network is gone")
        return pages(urls)

    return fetch


def _lines(path):
    return [json.loads(x) for f in sorted(path.rglob("part-*")) if f.suffix == ".json" for x in f.read_text().splitlines()]


@pytest.mark.parametrize("seen", [False, True])
def test_a_run_that_ends_early_goes_on_where_it_stopped(spark, tmp_path, seen):
    out = tmp_path / "out"
    config = lambda **x: RunConfig("2025-04-01", "2025-04-30", str(out), weeks_per_commit=1, seen=str(tmp_path / "seen") if seen else None, metrics=str(tmp_path / "metrics"), **x)
    with pytest.raises(OSError):
        pipeline.run(spark, _site(spark, broken=[3]), config(), _SMALL, [_ONE])
    assert [x["title"] for x in _lines(out)] == ["Ibovespa sobe 0", "Ibovespa sobe 1"]
    assert {p.name for p in out.iterdir() if p.is_dir()} == {"week=2025-W15"}
    # later weeks are lost, the first one is kept and not asked for again
    assert pipeline.run(spark, _site(spark, broken=[0, 1]), config(resume=True), _SMALL, [_ONE]) == 4
    assert [x["title"] for x in _lines(out)] == [f"Ibovespa sobe {i}" for i in range(6)]
    if seen:
        return
    weeks = {x.week_key: (x["pool"], x.passed, x.approved) for x in spark.read.json(str(tmp_path / "metrics/weeks")).collect()}
    assert weeks == {"2025-W16": (2, 2, 2), "2025-W17": (2, 2, 2)}
    assert [(x.source, x.n) for x in spark.read.json(str(tmp_path / "metrics/sources")).collect()] == [("InfoMoney", 6)]
    assert pipeline.run(spark, _site(spark), config(resume=True), _SMALL, [_ONE]) == 0
    assert len(_lines(out)) == 6
    # without resuming all is written anew, once
    assert pipeline.run(spark, _site(spark), config(), _SMALL, [_ONE]) == 6
    assert [x["title"] for x in _lines(out)] == [f"Ibovespa sobe {i}" for i in range(6)]


def test_stream_with_the_seen_table(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    config = RunConfig("2025-04-01", "2025-04-30", out, seen=str(tmp_path / "seen"))
    for days in (range(3), range(1, 5)):
        rows = [("InfoMoney", f"{_HOST}/mercados/ibovespa-fecha-em-alta-{i}/", _DAYS[i], None, "mercados") for i in days]
        spark.createDataFrame(rows, "source string, url string, published_at timestamp, title string, section string").write.mode("append").parquet(inbox)
        incremental(spark, inbox, str(tmp_path / "state"), _site(spark), config, _SMALL).awaitTermination()
    assert sorted(x.title for x in spark.read.json(out).collect()) == [f"Ibovespa sobe {i}" for i in range(5)]


def test_ordered_files(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(f"w{rnd.randrange(3)}", rnd.randrange(7), rnd.randrange(9), 1, "s", f"u{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "week string, weekday int, turn int, source_priority int, source string, url string")
    pipeline.ordered(df).write.parquet(str(tmp_path / "o"))
    got = r.positions(spark.read.parquet(str(tmp_path / "o"))).collect()
    assert [x.url for x in sorted(got, key=lambda x: x.position)] == [x[-1] for x in sorted(rows)]
    assert sorted(x.position for x in got) == list(range(1, 501))


def test_outputs_of_both_layouts_are_read(spark, tmp_path):
    path = tmp_path / "out"
    path.mkdir()
    (path / "part-0.json").write_text('{"url": "a"}\nbroken\n')
    (path / "week=1").mkdir()
    (path / "week=1" / "part-1.json").write_text('{"url": "b"}\n')
    assert sorted(x.url for x in jsonl.seen_urls(spark, str(path)).collect()) == ["a", "b"]
