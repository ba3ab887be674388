"""Operators over a whole corpus against brute force: joins, passages, neighbours, reputation, pipeline."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siftwell.llm import graph, line_dedup, ngram_join, quality, substring_dedup, url_reputation, vector_search
from siftwell.llm.queries import ORACLE_SQL, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def corpus(seed: int) -> list[tuple]:
    """Random texts with exact copies, near copies, shared passages, nulls and repeats."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(3))
    passage = [word() for _ in range(60)]
    base = [[word() for _ in range(rnd.choice([3, 30, 120]))] for _ in range(20)]
    rows = []
    for i in range(160):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 4])):
            w[rnd.randrange(len(w))] = word()
        if rnd.random() < 0.3:
            w += passage
        if rnd.random() < 0.3:
            w = [word() for _ in range(40)] + w
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(w)))
    return rows + [(200, None), (201, ""), (202, " \n"), (203, "One two"), (204, "one TWO"), (None, rows[3][1]), (None, None), rows[5], rows[5], (205, "And " * 300), (206, "And " * 301)]


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize(("seed", "few"), [(1, 2), (2, 4), (3, 32)])
def test_near_duplicates_equal_all_pairs(spark, seed, few, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 5)
    monkeypatch.setattr(ngram_join, "FEW", few)
    rows = corpus(seed)
    # rows without an id link like others: near copies of two texts that are not linked with each other
    chain = [f"w{i}" for i in range(60)]
    rows += [(300, " ".join(chain)), (None, " ".join(chain[6:] + ["x1", "x2"])), (301, " ".join(chain[12:] + ["x1", "x2", "x3", "x4"]))]
    sets = [(k if k is not None else 1000 + i, shingles(x)) for i, (k, x) in enumerate(rows)]
    parent = {k: k for k, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    out = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    assert find(300) == find(301) and 100 * len(shingles(rows[-3][1]) & shingles(rows[-1][1])) < 75 * len(shingles(rows[-3][1]) | shingles(rows[-1][1]))
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in out if x.doc_id is not None} == {k: (len(s), find(k)) for k, s in sets if k < 1000}
    assert {x.component_id for x in out if x.doc_id is None} == {find(3), None, 300}
    assert ngram_join.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("scattered", [False, True])
def test_what_blocks_send_grows_with_the_text(spark, scattered, monkeypatch):
    """48 texts that share most words and aren't linked: twice the text is about twice the bytes sent."""
    seen, dealt = [], ngram_join._dealt

    def watched(*args):
        out = dealt(*args)
        seen.append(out.selectExpr("coalesce(sum(octet_length(grams)), 0) AS b").first().b)
        return out

    monkeypatch.setattr(ngram_join, "_dealt", watched)
    for n in (1000, 2000):
        rnd = random.Random(n)
        base = [f"w{rnd.random()}" for _ in range(n)]
        rows = []
        for i in range(48):
            mine = list(base)
            # the same fifth of the words is each text's own, or a run of an eighth of every fifth, at a place of its own
            runs = [(k * n // 5 + rnd.randrange(n // 5 - n // 40), n // 40) for k in range(5)] if scattered else [(0, n // 5)]
            for a, k in runs:
                mine[a : a + k] = [f"x{rnd.random()}" for _ in range(k)]
            rows.append((i, " ".join(mine)))
        got = {x.doc_id: x.component_id for x in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == {i: i for i in range(48)}
    assert seen[0] > 0 and seen[1] < 3 * seen[0]
    assert seen[1] <= 16 * 48 * 2000 * 8  # a set goes to few families, whatever its length


def test_one_of_each_group_stays(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(2, a + " x", 1, "p"), (1, a, 2, "q"), (1, a, 2, "q"), (1, a + " y", 3, "r"), (None, a + " z", 4, "s"), (None, b, 5, "t"), (None, b + " x", 6, "u"), (7, None, 7, "v"), (8, "", 8, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, k_id long, k_text string")
    out = ngram_join.first_of_groups(df)
    assert out.columns == df.columns
    got = sorted((str(x.doc_id), x.k_text) for x in out.collect())
    assert [g for g in got if g[0] in "78"] == [("7", "v"), ("8", "w")]
    assert len(got) == 4 and sum(g[0] == "1" and g[1] in "qr" for g in got) == 1 and sum(g[0] == "None" and g[1] in "tu" for g in got) == 1


def test_block_tree_joins_what_all_pairs_join():
    """Sets of very different sizes, in one walk for many probes: the same components as all pairs give."""
    rnd = random.Random(5)
    level = np.zeros(ngram_join.SKETCH, np.uint8)
    level[[3, 77, 1000]] = 4
    for _ in range(40):
        pool = [rnd.getrandbits(64) for _ in range(400)]
        pool[:3] = [3, 77 + (5 << 40), 1000 + (9 << 40)]
        base = [rnd.sample(pool, rnd.choice([3, 20, 90, 200])) for _ in range(6)]
        sets = []
        for _ in range(rnd.choice([5, 150])):
            x = set(rnd.choice(base))
            x.difference_update(rnd.sample(sorted(x), len(x) // rnd.choice([4, 8, 100])))
            x.update(rnd.sample(pool, rnd.choice([0, 1, len(x) // 8])))
            sets.append(ngram_join.ordered(np.unique(np.array(sorted(x), np.uint64)), level))
        n = len(sets)
        every = list(range(n))
        links = ngram_join.tree_links(sets, every, every, [7 * i for i in every], every, level, 75)
        have = [set(x.tolist()) for x in sets]
        true = {(i, j) for i in every for j in range(i) if 100 * len(have[i] & have[j]) >= 75 * len(have[i] | have[j])}
        assert all((max(p), min(p)) in true for p in links) and len(links) < n

        def parts(pairs):
            top = list(range(n))
            for _ in range(n):
                before = list(top)
                for i, j in pairs:
                    top[i] = top[j] = min(top[i], top[j])
                if before == top:
                    return top

        assert parts(links) == parts(true)


def test_prefix_tree_equals_sets():
    rnd = random.Random(3)
    level = np.zeros(ngram_join.SKETCH, np.uint8)
    for _ in range(60):
        pool = np.array([rnd.getrandbits(64) for _ in range(40)], np.uint64)
        pick = lambda: ngram_join.ordered(np.unique(rnd.sample(pool.tolist(), rnd.randint(1, 40))).astype(np.uint64), level)  # noqa: B023, E731
        probe, sets = pick(), [pick() for _ in range(12)]
        have = set(probe.tolist())
        assert ngram_join.linked(probe, sets, 75) == [100 * len(have & set(s.tolist())) >= 75 * len(have | set(s.tolist())) for s in sets]


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (9, 1), (7, 8), (2, 2), (8, 7)], "u long, v long")
    assert {x.node: x.comp for x in graph.components(links).collect()} == {1: 1, 3: 1, 4: 1, 5: 1, 9: 1, 7: 7, 8: 7}


def brute_lines(rows):
    lines = {k: [x.strip(" \t\n\x0b\x0c\r") for x in (t or "").split("\n")] for k, t in rows}
    first = {}
    for k in sorted(lines):
        bare = [x for x in lines[k] if x]
        for i in range(len(bare) - 2):
            first.setdefault(tuple(bare[i : i + 3]), (k, i))
    out = {}
    for k, t in rows:
        bare = [x for x in lines[k] if x]
        gone = {j for i in range(len(bare) - 2) if first[tuple(bare[i : i + 3])] != (k, i) for j in range(i, i + 3)}
        kept, n = [], -1
        for raw, x in zip((t or "").split("\n"), lines[k], strict=True):
            n += bool(x)
            if not (x and n in gone):
                kept.append(raw)
        out[k] = (len(bare), len(gone), "\n".join(kept))
    return out


def test_line_dedup_equals_brute_force(spark):
    rnd = random.Random(4)
    rows = [(i, "\n".join(rnd.choice(["a", "b ", "c", "", "d", " e"]) for _ in range(rnd.randint(0, 14)))) for i in range(60)] + [(90, "x\n" * 6), (91, "")]
    out = line_dedup.dedup_lines(spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, n_lines string")).collect()
    assert {x.doc_id: (x.n_lines, x.n_removed, x.text) for x in out} == brute_lines(rows)


def test_line_dedup_treats_repeated_rows_alike(spark):
    rows = [(1, "p\nq\nr"), (2, "p\nq\nr\ns"), (2, "p\nq\nr\ns"), (3, None), (None, "p\nq\nr")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(x.doc_id), x.text) for x in out if x.text is not None) == [("1", ""), ("2", "s"), ("2", "s"), ("None", "p\nq\nr")]


def brute_spans(rows, size):
    seen = Counter()
    data = [(k, (t or "").encode()) for k, t in rows]
    for _, b in data:
        seen.update(b[i : i + size] for i in range(len(b) - size + 1))
    out = []
    for k, b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((str(k), len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("together", "long"), [(2048, 1 << 20), (3, 1 << 20), (1, 500)])
def test_substring_dedup_equals_brute_force(spark, together, long, monkeypatch):
    """Also where every anchor is cut finer down to single strings, and texts are read in parts."""
    monkeypatch.setattr(substring_dedup, "TOGETHER", together)
    monkeypatch.setattr(substring_dedup, "LONG", long)
    rows = corpus(5)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, kept int")
    out = substring_dedup.remove_repeats(df).collect()
    assert sorted((str(x.doc_id), x.n_bytes, x.n_removed, x.n_spans, hashlib.sha256(x.kept).hexdigest()) for x in out) == brute_spans(rows, substring_dedup.SIZE)


def test_substring_dedup_by_words(spark):
    """Passages of 51 words go, those of 50 stay, whatever the order of rows; columns of the caller stay."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    long, short = " ".join(word() for _ in range(51)), " ".join(word() for _ in range(50))
    rows = [(i, " ".join([word(), word(), p, word(), word()]), -i, "z") for i, p in enumerate([long, short, long, short])]
    df = spark.createDataFrame(rows, "doc_id long, text string, k_id long, k_text string")
    out = {x.doc_id: x for x in substring_dedup.remove_repeats(df, size=200, min_words=51).collect()}
    assert [long in bytes(out[i].kept).decode() for i in range(4)] == [False] * 4 and [out[i].n_removed >= len(long) for i in range(4)] == [True, False, True, False]
    assert [out[i].n_removed for i in (1, 3)] == [0, 0] and [(out[i].k_id, out[i].k_text) for i in range(4)] == [(-i, "z") for i in range(4)]


def test_substring_stage_holds_one_python_worker_a_task(spark):
    """Texts are decoded where they are cut, as ``as_text`` decodes them: a second worker a task stays in memory to the pipeline's end."""
    docs = spark.createDataFrame([(1, "é" * 300 + " " + "b " * 60), (2, "é" * 300 + " " + "b " * 60), (3, "word " * 3), (4, None)], "doc_id long, text string")
    for words in (0, 51):
        a, b = (substring_dedup.remove_repeats(docs, size=201, min_words=words, decoded=x) for x in (True, False))
        assert a.schema["kept"].dataType.simpleString() == "string"
        assert sorted(map(tuple, a.select("doc_id", "n_removed", "kept").collect())) == sorted(map(tuple, b.select("doc_id", "n_removed", substring_dedup.as_text("kept")).collect()))
    plan = corpus_pipeline.suffix_array_dedup(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and plan.count("MapInArrow") == 1


def test_vector_search(spark):
    rng = np.random.default_rng(6)
    v = np.concatenate([rng.standard_normal((1500, 16)) + 3 * rng.integers(0, 4, (1500, 1)), np.ones((300, 16))])
    rows = [(i, x.tolist()) for i, x in enumerate(v.astype(np.float32))]
    bad = [(2000, None), (2100, [0.0] * 16), (2200, [float("nan")] * 16), (2300, [None] * 16), (2400, [float("inf")] * 16), (None, [1.0] * 16), (2500, [1.0])]
    s = vector_search.Settings(tile=256, queries=8)
    out = vector_search.nearest(spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>"), settings=s).collect()
    got = defaultdict(list)
    for x in sorted(out, key=lambda x: (x.query_id, x["rank"])):
        got[x.query_id].append((x.vec_id, x.score))
    x = v.astype(np.float32).astype(np.float64)
    assert sorted(got) == list(range(0, 1800, 100))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(len(x)), d)).tolist() if i != q][:10]
        assert all(d[i] == pytest.approx(score, rel=1e-12, abs=1e-12) for i, score in found) and found == sorted(found, key=lambda p: (p[1], p[0])) and len(found) == 10
        hits += len(set(want) & {i for i, _ in found})
    assert hits >= 0.9 * 180
    assert vector_search.nearest(spark.createDataFrame(bad[:3], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize(("copies", "scale"), [(30, 1.0), (300, 1.0), (300, 1e6), (3000, 1.0)])
def test_vector_scan_keeps_exact_copies(copies, scale):
    """The rows that set the limit are copies of the query, so that limit is rounding alone."""
    rng = np.random.default_rng(copies)
    s, turn = vector_search.Settings(), vector_search.rotation(64, 11)
    for _ in range(100):
        v = scale * rng.standard_normal((copies + 500, 64)).astype(np.float32).astype(float)
        at = rng.permutation(len(v))[: copies + 1]
        v[at] = v[at[0]]
        ids = np.arange(len(v))
        q = int(at[0])
        rows = vector_search.scan(v[q] @ turn, v @ turn, ids, q, s)
        score = vector_search.exact(v[q], v[rows])
        assert rows[np.lexsort((rows, score))][:10].tolist() == sorted(set(at.tolist()) - {q})[:10]


def test_vector_tiles():
    """Every list has its rows' tiles, no tile holds more than asked for, and long lists share none."""
    rng = np.random.default_rng(8)
    centre = rng.standard_normal((50, 6))
    sizes = {c: int(rng.integers(0, 120)) for c in range(49)} | {7: 1050}  # list 49 is empty
    first, count = vector_search.tiles(centre, sizes, 200)
    assert sorted(vector_search.side_by_side(centre)) == list(range(50)) and count[7] == 6 and count[49] == 0
    held = defaultdict(int)
    for c, n in sizes.items():
        if c != 7:
            assert count[c] == (n > 0)
            held[first[c]] += n
    assert max(held.values()) <= 200 and not set(range(first[7], first[7] + 6)) & {t for t, n in held.items() if n}
    assert vector_search.tiles(centre[:1], {}, 200)[1].tolist() == [0]


def test_vector_search_carries_the_limit():
    """With a tenth distance from elsewhere, nothing beyond it comes back, and what is nearer does, ties included."""
    rng = np.random.default_rng(9)
    s, turn = vector_search.Settings(run=100), vector_search.rotation(32, 11)
    v, ids = rng.standard_normal((900, 32)), rng.permutation(900)
    v[5:9] = v[4]
    d = np.sqrt(((v - v[0]) ** 2).sum(1))
    for tenth in (np.inf, np.sort(d)[30], np.sort(d)[4], 0.0):
        near, score = vector_search.search(v[0], (v[0] @ turn, v @ turn), np.arange(900), v, ids, ids[0], s, tenth)
        want = [i for i in np.lexsort((ids, d)) if i != 0 and d[i] <= tenth][:10]
        assert len(set(near.tolist()) & {int(ids[i]) for i in want}) >= 0.9 * len(want) and (score <= tenth).all() and len(near) <= 10
    at4 = vector_search.search(v[4], (v[4] @ turn, v @ turn), np.arange(900), v, ids, ids[4], s, 0.0)
    assert at4[0].tolist() == sorted(ids[5:9].tolist()) and at4[1].tolist() == [0.0] * 4


@pytest.mark.parametrize("rows", [600, 6000])
def test_vector_recall_of_the_production_settings(spark, rows):
    """Directions without any structure, the hardest case: recall of 0.9 and more against brute force."""
    rng = np.random.default_rng(rows)
    v = rng.standard_normal((rows, 64)).astype(np.float32).astype(float)
    v /= np.sqrt((v**2).sum(1, keepdims=True))
    out = vector_search.nearest(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")).collect()
    got = defaultdict(set)
    for x in out:
        got[x.query_id].add(x.vec_id)
    hits = 0
    for q in range(0, rows, 100):
        d = ((v - v[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(got[q] & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert hits >= 0.9 * len(out) and len(out) == rows // 100 * 10


def test_url_rules(spark):
    cases = {
        "https://A.Example.com/en/7x?y": ("a.example.com", "/en/7x", "example.com/en/7", "allow"), "http://b.com/en/1": ("b.com", "/en/1", "com/en/", "block"),
        "x://net/de/8#f": ("net", "/de/8", "net/de/", "block"), "x://example.net/de/8": ("example.net", "/de/8", "example.net/de/8", "block"),
        "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://xcom/en/": ("xcom", "/en/", None, "allow"), "http://h?q://com/en/": ("h", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id long, url string")
    out = url_reputation.judge(pages, spark.createDataFrame([], "doc_id long, toxic int")).orderBy("page_id").collect()
    assert [(x.host, x.path, x.rule, x.verdict) for x in out] == list(cases.values())


def test_url_line_ends_are_characters(spark):
    import duckdb

    hosts = [f"{a}{b}{c}" for a in ("x", "u@y") for b in (".co.uk", ".com", "") for c in ("", "\n", "\r", ".\n", ":8\r1", ":8\n1", "\u0085", ":\u2028")]
    pages = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p) in enumerate((h, p) for h in hosts for p in ("/en/7\n", "/z"))], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 7 < 4)) for i in range(0, 2 * len(hosts), 3)], "doc_id long, toxic int")
    c = duckdb.connect()
    c.register("pages", pages.toArrow())
    c.register("labels", labels.toArrow())
    cursor = c.execute(ORACLE_SQL["op8_url_filter"])
    out = url_reputation.judge(pages, labels)
    order = [[x[0] for x in cursor.description].index(n) for n in out.columns]
    assert Counter(tuple(r) for r in out.collect()) == Counter(tuple(r[i] for i in order) for r in cursor.fetchall())


def test_url_reputation_blocks_bad_hosts(spark):
    hosts = [("bad.site.info", 0.98)] + [(f"h{i}.ok{i}.info", 0.02) for i in range(20)]
    pages, labels, rnd = [], [], random.Random(7)
    for host, share in hosts:
        for _ in range(60):
            pages.append((len(pages), f"http://{host}/x"))
            labels.append((len(labels), int(rnd.random() < share)))
    pages.append((len(pages), "http://new.site.info/"))
    out = url_reputation.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame([*labels, (0, None), (None, 1)], "doc_id long, toxic int"))
    assert {x.host for x in out.where("verdict = 'block'").collect()} >= {"bad.site.info"}
    assert not {h for h, s in hosts if s < 0.5} & {x.host for x in out.where("verdict = 'block'").collect()}


def plain_reputation(pages, labels):
    """The posterior bound of each host, in plain code."""
    two = {f"{a}.{b}" for a in url_reputation.SECOND_LEVEL for b in ("uk", "sg", "br")} | set(url_reputation.SUFFIXES)

    def split(host):
        name = host.split("@")[-1].split(":")[0]
        if name.replace(".", "").isdigit():
            return name, name
        parts = name.split(".")
        k = 2 if ".".join(parts[-2:]) in two else 1
        return ".".join(parts[-k:]), ".".join(parts[-k - 1 :])

    outcome, host_of = defaultdict(list), {i: u.split("://")[1].split("/")[0].lower() for i, u in pages}
    for i, bad in labels:
        if i in host_of:
            outcome[host_of[i]].append(bad)
    every = [x for v in outcome.values() for x in v]
    mean_all = (sum(every) + 0.5) / (len(every) + 1)

    def level(groups, prior):
        wide = [(sum(v), len(v), prior[k]) for k, v in groups.items() if len(v) >= 2]
        q = sum((b - n * m) ** 2 / n for b, n, m in wide)
        fit = (sum(m * (1 - m) * n for b, n, m in wide) - q) / max(q - sum(m * (1 - m) for *_, m in wide), 1e-6)
        strength = 200.0 if len(wide) < 2 else max(2.0, min(200.0, fit))
        return {k: ((sum(v) + prior[k] * strength) / (len(v) + strength), len(v) + strength) for k, v in groups.items()}

    def grouped(key):
        out = defaultdict(list)
        for h, v in outcome.items():
            out[key(h)] += v
        return out

    suffixes = level(grouped(lambda h: split(h)[0]), defaultdict(lambda: mean_all))
    above = {split(h)[1]: suffixes[split(h)[0]][0] for h in outcome}
    domains = level(grouped(lambda h: split(h)[1]), above)
    hosts = level(grouped(lambda h: h), {h: domains[split(h)[1]][0] for h in outcome})
    out = {}
    for h in set(host_of.values()):
        mean, weight = hosts.get(h) or domains.get(split(h)[1]) or suffixes.get(split(h)[0]) or (mean_all, 1.0)
        out[h] = mean - 1.645 * (mean * (1 - mean) / (weight + 1)) ** 0.5
    return out


def test_url_bounds_equal_plain_code(spark):
    rnd = random.Random(15)
    hosts = [f"{a}.{b}{c}" for a in ("www", "m") for b in ("one", "two", "three.x") for c in (".com", ".com.sg", ".co.uk", ".github.io", ".de", ".de:8080")] + ["10.0.0.1", "10.0.0.2:80", "me@h.one.com", "com", "com.sg"]
    rate = {h: rnd.choice([0.0, 0.1, 0.9]) for h in hosts}
    pages = [(i, f"http://{h}/x") for i, h in enumerate(hosts * 7)]
    labels = [(i, int(rnd.random() < rate[u.split("//")[1].split("/")[0]])) for i, u in pages if rnd.random() < 0.6 and "two.com/" not in u]
    out = url_reputation.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    want = plain_reputation(pages, labels)
    assert {x.host: x.reputation_bound for x in out} == {h: pytest.approx(b, abs=2e-9) for h, b in want.items()}


DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    cursor = c.execute(ORACLE_SQL[name])
    df = QUERIES[name](spark, DATA)
    order = [[x[0] for x in cursor.description].index(n) for n in df.columns]
    assert Counter(tuple(r) for r in df.collect()) == Counter(tuple(r[i] for i in order) for r in cursor.fetchall())


def plain_stages(rows):
    """What documents (id, text) are after each of the first four stages, in plain code."""
    made = quality.measure(pa.array([t for _, t in rows], pa.string()))["kept"]  # its measures are tested elsewhere
    rows = [r for r, k in zip(rows, made.tolist(), strict=True) if k]
    yield dict(rows)
    cut = brute_lines(rows)
    rows = [(k, cut[k][2]) for k, _ in rows if WORD.search(cut[k][2])]
    yield dict(rows)
    sets, top = {k: shingles(t) for k, t in rows}, {k: k for k, _ in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            if b < a and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                top[hi] = lo
    rows = [(k, t) for k, t in rows if find(k) == k]
    yield dict(rows)
    size, seen = corpus_pipeline.PASSAGE_BYTES, Counter()
    for _, t in rows:
        seen.update(t.encode()[i : i + size] for i in range(len(t.encode()) - size + 1))
    out = {}
    for k, t in rows:
        data, gone = t.encode(), set()
        for i in range(len(data) - size + 1):
            if seen[data[i : i + size]] > 1:
                gone.update(range(i, i + size))
        runs = substring_dedup.merged([(i, i + 1) for i in sorted(gone)])
        for a, b in reversed(runs):
            if len(re.findall(rb"[^\x20\x09-\x0D]+", data[a:b])) >= corpus_pipeline.PASSAGE_WORDS:
                data = data[:a] + data[b:]
        if WORD.search(left := data.decode(errors="ignore")):
            out[k] = left
    yield out


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    # columns of the caller's that are named like an operator's come back untouched
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in ("kept", "n_words", "n_lines", "n_bytes", "k_id", "k_text")})
    expected = plain_stages([(x.doc_id, x.text) for x in docs.collect()])
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], expected, strict=True):
        after = stage(spark, docs, DATA)
        assert after.columns == docs.columns, name
        rows = after.collect()
        assert {x.doc_id: x.text for x in rows} == want and len(rows) == len(want), name
        assert all(x.kept == f"kept{x.doc_id}" and x.k_text == f"k_text{x.doc_id}" and x.n_lines == f"n_lines{x.doc_id}" and x.n_chars == len(x.text) for x in rows)
        docs = spark.createDataFrame(rows, docs.schema)
    out = corpus_pipeline.run(spark, DATA)
    assert {x[0] for x in out.select("doc_id").distinct().collect()} == {x[0] for x in docs.select("doc_id").collect()}
    assert all("op" + str(n) in {k.split("_")[0] for k in QUERIES} for n in range(1, 11))
