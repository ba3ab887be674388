"""Quality rules, BPE, packing, HTML, chat and suffix arrays against plain code."""

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwell.llm import bpe, chat, html_text, line_dedup, packing, quality, shared, substring_dedup, suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = "doc_id long, text string, n_words string"  # a column that clashes with ours


def texts(seed: int, n: int) -> list:
    rnd = random.Random(seed)
    words = ["a", "Bé", "c#", "dd|", "中", "e\u00a0f", "g"]
    made = ["".join(rnd.choice(words) + rnd.choice("   \n\t") for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    return [*made, None, "", " \n ", made[0], made[0], "And " * 500, "x" * 3000]


# --- quality ---------------------------------------------------------------------


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    covered = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_measures():
    rows = texts(1, 300)
    got = quality.measure(pa.array(rows, pa.string()))
    base = list(zip(*(got[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), strict=True))
    assert base == [brute_quality(x) for x in rows]
    assert got["base_failed"].tolist() == [b[0] < 20 or 100 * b[4] > 30 * b[0] for b in base]
    assert not (got["kept"] & got["base_failed"]).any()


def test_quality_shares_of_duplicate_ngrams():
    rows = texts(2, 200)
    got = quality.measure(pa.array(rows, pa.string()))
    for text, share in zip(rows, got["dup_5gram_share"].tolist(), strict=True):
        words = WORD.findall(text or "")
        grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        inside = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        assert share == pytest.approx(sum(len(words[j]) for j in inside) / max(1, sum(map(len, words))))


def test_quality_keeps_clean_text_and_columns(spark):
    rnd = random.Random(3)
    clean = " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(200))
    rows = [(1, clean, "x"), (2, None, None), (None, "# " * 100, "x"), (3, clean, "x"), (3, clean, "x")]
    out = quality.score(spark.createDataFrame(rows, NAMES))
    assert [(x.doc_id, x.kept) for x in out.collect()] == [(1, True), (2, False), (None, False), (3, True), (3, True)]
    assert out.columns.count("n_words") == 1
    assert quality.score(spark.createDataFrame([], NAMES)).count() == 0


# --- byte-level BPE ----------------------------------------------------------------

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
MULTI, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")


def encoded(codec, rows):
    out = []
    for i, j, raw, offs in shared.text_chunks(pa.array(rows, pa.string())):
        ids, first = codec.encode(raw, offs)
        out += [ids[first[k] : first[k + 1]].tolist() for k in range(j - i)]
    return out


def odd_texts(n: int) -> list[str]:
    rnd = random.Random(6)
    letters = list(" \n\t\r'  ''stremvldaSLL129,.!?é漢あ\u00a0\u2003\u3000\x1c\x85½²Ⅷ😀\u0301\u200d")
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(n)] + ["", "   ", "a" * 5000, " " * 3000, "'re 'll've'd'm'tx", "don't"]


def test_bpe_equals_libraries():
    rows = odd_texts(3000)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.load(MULTI)
    got = encoded(codec, rows)
    assert got == [own.encode_ordinary(x) for x in rows]
    assert [codec.decode(x) for x in got] == [x.encode() for x in rows]
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(JSON)
    lib.encode_special_tokens = True
    assert encoded(bpe.load(JSON), rows) == [x.ids for x in lib.encode_batch(rows, add_special_tokens=False)]


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 20_000, dtype=np.uint64))
    table = bpe.PerfectHash(keys)
    assert sorted(table.entry.tolist()) == list(range(len(keys)))
    assert (table.find(keys) == np.arange(len(keys))).all() and (table.find(keys + np.uint64(1)) == -1).mean() > 0.99
    assert bpe.PerfectHash(np.zeros(0, np.uint64)).find(keys[:3]).tolist() == [-1] * 3


def test_bpe_compares_bytes(monkeypatch):
    """With a hash of very few values every pre-token collides, and the ids are the same."""
    rows = odd_texts(200)
    want = encoded(bpe.load(MULTI), rows)
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b" a": 257, b"  ": 258, b"aa": 259, b"aaaa": 260}
    plain = bpe.Codec(ranks)
    expected = encoded(plain, rows)
    codec = bpe.Codec(ranks)
    monkeypatch.setattr(codec.table, "find", lambda keys: (keys % np.uint64(len(ranks))).astype(np.int64))
    few = shared.SpanHash.of
    monkeypatch.setattr(shared.SpanHash, "of", lambda self, a, b: few(self, a, b) % np.uint64(7))
    assert encoded(codec, rows) == expected
    monkeypatch.undo()
    assert encoded(bpe.load(MULTI), rows) == want


def test_bpe_frames(spark):
    rows = [(1, "héllo wörld", "x"), (2, None, None), (2, "", None), (None, "a b", "x")]
    out = bpe.decode(bpe.encode(spark.createDataFrame(rows, "doc_id long, text string, ids string"), MULTI), MULTI).collect()
    assert [(x.doc_id, bytes(x.decoded).decode()) for x in out] == [(a, b or "") for a, b, _ in rows]
    assert bpe.encode(spark.createDataFrame([], "text string"), MULTI).count() == 0


@pytest.mark.parametrize("together", [1 << 17, 40, 1])
def test_lists_are_decoded_without_an_object_an_id(spark, monkeypatch, together):
    monkeypatch.setattr(bpe, "DECODED", together)
    codec = bpe.load(MULTI)
    rows = [None, "", *odd_texts(300), None, ""]
    ids = [None if x is None else encoded(codec, [x])[0] for x in rows]
    monkeypatch.setattr(bpe.Codec, "decode", None)
    for column, want in ((pa.array(ids, pa.list_(pa.int32())), rows), (pa.array([[1, 2], *ids, [3]], pa.list_(pa.int32())).slice(1, len(ids)), rows), (pa.array([], pa.list_(pa.int32())), [])):
        got = list(codec.decode_lists(column))
        assert [x for part in got for x in part.to_pylist()] == [(x or "").encode() for x in want]
        assert together < 1 << 17 or len(got) <= 1
    with pytest.raises((ValueError, IndexError, pa.ArrowInvalid)):
        list(codec.decode_lists(pa.array([[1, None]], pa.list_(pa.int32()))))


# --- packing -----------------------------------------------------------------------


def test_packing_places_every_id_once(spark):
    rnd = random.Random(7)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) + str(rnd.randint(0, 50)) for _ in range(rnd.choice([0, 3, 200, 2500])))) for i in range(60)] + [(100, None), (None, "x")]
    out = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), JSON).collect()
    enc = packing._encoding(JSON)
    ids = {k: [*enc.encode_ordinary(v or ""), packing.END] for k, v in rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for x in out:
        pieces[x.doc_id].append((x.start, x.length))
        sequences[x.sequence_id].append((x.offset, x.length))
        assert np.frombuffer(x.ids, "<u4").tolist() == ids[x.doc_id][x.start : x.start + x.length] and x.doc_tokens == len(ids[x.doc_id])
    for k, v in ids.items():
        assert [s for s, _ in sorted(pieces[k])] == [0, *np.cumsum([n for _, n in sorted(pieces[k])])[:-1]] and sum(n for _, n in pieces[k]) == len(v)
    for v in sequences.values():
        assert [o for o, _ in sorted(v)] == [0, *np.cumsum([n for _, n in sorted(v)])[:-1]] and sum(n for _, n in v) <= packing.WINDOW
        assert sum(n for _, n in v).bit_count() == 1  # no padding
    digest = packing.digests(packing.pack_documents(spark.createDataFrame(rows[:2], "doc_id long, text string"), JSON)).first()
    x = ids[digest.doc_id][digest.start : digest.start + digest.length]
    assert digest.ids_crc32 == zlib.crc32(np.array(x, "<u4").tobytes())


def test_packing_prefers_lexical_neighbours():
    a, b = np.arange(10, 410, dtype=np.uint32), np.arange(1000, 1400, dtype=np.uint32)
    docs = [a, b, a + 1, b + 1, np.arange(5000, 5100, dtype=np.uint32)] + [np.arange(9000 + 500 * k, 9400 + 500 * k, dtype=np.uint32) for k in range(6)]
    first = next(iter(packing.pack(docs)))
    assert [d for d, _, _ in first][:2] == [0, 2]


def test_packing_finds_neighbours_across_the_input(spark, monkeypatch):
    """Texts of one topic stand far apart; the result does not depend on partitions."""
    monkeypatch.setattr(packing, "SHARD_ITEMS", 64)
    rnd = random.Random(11)
    words = [["".join(rnd.choice("bcdfgklmnprst") + rnd.choice("aeiou") for _ in range(3)) for _ in range(30)] for _ in range(20)]
    rows = [(i, " ".join(rnd.choice(words[i % 20]) for _ in range(20))) for i in range(1000)]
    seen = []
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        sequences = defaultdict(list)
        for x in packing.pack_documents(df, JSON, 256).collect():
            sequences[x.sequence_id].append((x.offset, x.doc_id, x.start, x.length))
        seen.append(sorted(sorted(v) for v in sequences.values()))
        pairs = [(a[1] % 20, b[1] % 20) for v in sequences.values() for a, b in zip(sorted(v), sorted(v)[1:])]
        assert sum(a == b for a, b in pairs) > 0.8 * len(pairs)
    assert seen[0] == seen[1]


def test_packing_ranks_all_neighbours():
    """100 short neighbours fit a window; items that share nothing come first in the input."""
    docs = [np.array(x, np.uint32) for x in ([7, 1], *([1000 + 8 * i + j for j in range(8)] for i in range(150)), *([7, *(5000 + 8 * i + j for j in range(7))] for i in range(100)))]
    first = next(iter(packing.pack(docs)))
    assert sorted(d for d, _, _ in first[1:101]) == list(range(151, 251))


def test_packing_ids_equal_the_tokenizers_library(spark):
    import tokenizers

    rows = ["ab <|endoftext|> cd", "<|endoftext|><|endoftext|>x", "  <|endoftext|>\n\n a", "<|endoftext", *[x for x in texts(13, 30) if x]]
    lib = tokenizers.Tokenizer.from_file(JSON)
    want = {i: [*x.ids, packing.END] for i, x in enumerate(lib.encode_batch(rows, add_special_tokens=False))}
    got = defaultdict(list)
    for x in packing.pack_documents(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), JSON).orderBy("doc_id", "start").collect():
        got[x.doc_id] += np.frombuffer(x.ids, "<u4").tolist()
    assert got == want


def test_packing_counts_over_the_corpus():
    """A term that is rare in the corpus tells, though each item of the shard has it."""
    items = [np.array([5, 6 + i], np.uint32) for i in range(4)]
    df = np.ones(20, np.int64)
    df[5] = 4
    assert packing.Index(items).scores(0)[1] == 0
    assert packing.Index(items, (packing._idf(df, 1000), 2.0)).scores(0)[1] > 0


# --- suffix arrays -----------------------------------------------------------------


@pytest.mark.parametrize("small", [1 << 12, 0])
def test_suffix_array(small, monkeypatch):
    monkeypatch.setattr(suffix_array, "SMALL", small)
    rnd = random.Random(8)
    for _ in range(150):
        x = [rnd.randint(0, rnd.choice([1, 2, 200])) for _ in range(rnd.randint(0, 60))]
        assert suffix_array.suffix_array(np.array(x, np.int64)).tolist() == sorted(range(len(x)), key=lambda i: x[i:])


def test_repeats_equal_a_table_of_strings():
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcd ") for _ in range(3000)).encode()
    parts = [text[a : a + rnd.randint(30, 60)] for a in (rnd.randint(0, 2900) for _ in range(120))] + [b"ab" * 40, b"q" * 90, b"short"]
    places = defaultdict(list)
    for i, p in enumerate(parts):
        for j in range(len(p) - 29):
            places[p[j : j + 30]].append((i, j))
    want = sorted(x for v in places.values() if len(v) > 1 for x in v)
    assert sorted((i, j) for i, at in enumerate(substring_dedup.repeats(parts, 30)) for j in at.tolist()) == want


# --- lines ---------------------------------------------------------------------------


def test_without_lines():
    assert line_dedup.without_lines("a\n\nb\nc\nd", [1], 3) == ("a\n", 3)
    assert line_dedup.without_lines("a\nb\nc", [0], 3) == ("", 3)


# --- pages ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a b"),
        ("<nav><a>Home</a></nav><article><h1>T</h1><p>One <b>bold</b>er, text.<br>More.</p><aside>ad</aside><form>x</form></article><footer>f</footer>", "T One bolder, text. More."),
        ("<nav><ul><li>x<article><p>Body, text here.</article>", "Body, text here."),
        ("<div class='cookie-notice'>We use cookies.</div><div><h2>H</h2><p>Long text, with commas, and so on.</p><p>More of it, here.</p></div><div id=comments><p>Nice, post.</p></div>", "H Long text, with commas, and so on. More of it, here."),
        ("<script>var t='</p>'</script><style>p{}</style><!-- <p>no</p> --><article><p>a &lt;b&gt;&nbsp;&#233;</p></article>", "a <b> é"),
        ("<article><p>cut off in the mid", "cut off in the mid"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


_LONG = "<p>" + "A sentence of the text, with commas, and so on. " * 6 + "</p>"


@pytest.mark.parametrize(("open_", "close"), [("<article>", "</article>"), ("<body>", "</body>")])
def test_ratios_decide_inside_the_held_element(open_, close):
    """Outside an article a short line without punctuation goes, with its heading; lists, tables and headings of text stay."""
    data = "<table>" + "".join(f"<tr><td>cell {i}</td><td>{i}.5</td></tr>" for i in range(12)) + "</table>"
    page = f"{open_}<h1>Title</h1>{_LONG * 3}<h2>Data</h2>{data}<section><h5>More</h5><div>Read on</div></section>{close}"
    text = html_text.main_text(page)
    assert text.startswith("Title A sentence") and "Data cell 0 0.5" in text and text.endswith("cell 11 11.5" if open_ == "<body>" else "cell 11 11.5 More Read on")


@pytest.mark.parametrize("name", ["content no-sidebar", "has-header", "legal-news", "search-result"])
def test_marks_do_not_take_the_main_text(name):
    assert html_text.main_text(f"<body><div class='{name}'>{_LONG * 3}</div><div class='site-footer'>Imprint, terms.</div></body>").startswith("A sentence")


def test_article_keeps_its_header_and_links():
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Source number {i}, with a title.</a></li>" for i in range(4)) + "</ul>"
    page = f"<article><div class='article-header'><h1>Title</h1></div>{_LONG}{links}<div class='share-bar'>Share this, please.</div></article>"
    text = html_text.main_text(page)
    assert text.startswith("Title A sentence") and text.endswith("Source number 3, with a title.")


def test_article_text_stays_whatever_its_names():
    """Words inside an id, a class on a paragraph and long links take nothing from an article."""
    link = "<p>See <a href='/x'>" + "a very long title of another text, " * 8 + "</a> too.</p>"
    page = f"<article><h1>T</h1>{_LONG}<h2 id='related-work'>Related work</h2>{_LONG}<section id='search-methods'>{_LONG}</section><p class='legal'>The law says so, and more.</p>{link}<div class='comments'><p>First, I say!</p></div></article>"
    text = html_text.main_text(page)
    assert all(x in text for x in ("Related work A sentence", "The law says so, and more.", "a very long title")) and text.count("A sentence") == 18 and "I say" not in text


def test_threshold_decides(monkeypatch):
    page = f"<body>{_LONG * 2}<section><div><p>Short, one.</p></div></section></body>"
    seen = set()
    for share in (0.0, 0.5, 3.9):
        monkeypatch.setattr(html_text, "_SHARE", share)
        seen.add(html_text.main_text(page))
    assert len(seen) > 1


@pytest.mark.parametrize("page", ["<div>x" * 170_000, '<a b="x ' * 130_000, "<b><div>x" * 80_000 + "</b>" * 80_000, "<div>" * 90_000 + "<li>x</li>" * 60_000, "<div>" * 50_000 + "<nav><article>x" * 30_000, "<a b='>" * 140_000 + '"', "<" * 1_000_000])
def test_broken_pages_take_linear_time(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 15  # a quadratic reader takes minutes


def test_main_text_of_made_pages():
    """Pages made of parts whose place in the result is known."""
    rnd = random.Random(14)
    words = "alpha beta gamma delta epsilon zeta".split()
    sentence = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(8, 20))).capitalize() + rnd.choice([".", ", too.", "; so it is!"])
    noise = [
        "<nav><ul><li><a href='/'>Home</a><li><a href='/n'>News</a></ul></nav>", "<header><h1>Site</h1><p>Slogan, here.</p></header>", "<aside><p>About us, in short.</p></aside>",
        "<div class='cookie-banner'>We use cookies, as all do.</div>", "<form><label>Mail, please</label><input></form>", "<script>if (a < b) { x = '</p>'; }</script>", "<style>p > a {}</style>", "<!-- <p>gone</p> -->",
    ]
    for _ in range(60):
        expected, body = [], []
        for _ in range(rnd.randint(3, 8)):
            said = [sentence() for _ in range(rnd.randint(2, 5))]
            text = " ".join(said)
            expected.append(text)
            body.append("<p>" + text.replace(",", "<b>,</b>").replace(" ", rnd.choice([" ", "\n  ", "&#32;"])) + rnd.choice(["</p>", ""]))
            if rnd.random() < 0.3:
                body.append(rnd.choice(["<aside>Related, perhaps.</aside>", "<script>1 < 2</script>", "<div class='ad'>Buy, now!</div>"]))
        comments = "<section class='comments'><p>Great, thanks!</p><p>Not so, I think.</p></section>"
        page = "<html><head><title>x</title></head><body>" + "".join(rnd.sample(noise, 4)) + "<article>" + "".join(body) + rnd.choice([comments, ""]) + "</article>" + "".join(rnd.sample(noise, 3)) + comments + "<footer>Imprint, terms.</footer></body></html>"
        assert html_text.main_text(page) == " ".join(expected)


def test_extract_keeps_rows(spark):
    rows = [(1, "<p>a</p>", "old"), (1, None, None), (None, "<p>" + "b " * 50_000, "x")]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()
    assert [(x.page_id, len(x.text)) for x in out] == [(1, 1), (1, 0), (None, 99_999)]


# --- chat ------------------------------------------------------------------------------


def test_escape_round_trip():
    rnd = random.Random(10)
    bits = [*chat.CONTROL, "\\", "<", "[", "/", "s>", " ", "é", "\n", "]", ">"]
    for _ in range(3000):
        x = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12)))
        assert chat.unescape(chat.escape(x)) == x and not any(c in chat.escape(x) for c in chat.CONTROL)


def test_chat_round_trip(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 50)
    rnd = random.Random(11)
    bits = [*chat.CONTROL, "\\", "hi ", "é", "\n"]
    rows = [(rnd.choice([1, 2, 3, None]), rnd.choice([0, 1, 2, None, 7]), rnd.choice(["user", "assistant", "system", None, "[INST]", "a\nb", "a", "\\n\\"]), rnd.choice([None, "".join(rnd.choice(bits) for _ in range(5))])) for _ in range(80)]
    out = chat.read_back(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    want = {}
    for conv, turns in groupby(sorted(rows, key=key), key=lambda r: r[0]):
        turns = list(turns)
        said = "".join(x[3] or "" for x in turns if x[2] == "assistant")
        want[conv] = (len(turns), hashlib.sha256("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    assert {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for x in out} == want


def test_roles_read_back():
    """A newline in a role is not the one that ends it."""
    turns = [("a\nb", "c"), ("a", "b\nc"), ("\\n", "n"), ("x\\", "\n"), ("[ROLE] \n", " [/ROLE]"), ("user", "u"), ("assistant", "")]
    out, ends, body, loss = chat.assemble(pa.array([x for x, _ in turns]), pa.array([x for _, x in turns]))
    assert list(chat.read_turns(out.tobytes().decode())) == turns
    assert ends[-1] == len(out) and loss.tolist() == [0] * 7


def test_chat_of_nothing(spark):
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_decoding_cut_bytes(spark):
    df = spark.createDataFrame([(bytearray("é".encode()[:1] + b"ab"),), (None,)], "kept binary")
    assert [x[0] for x in df.select(substring_dedup.as_text("kept")).collect()] == ["ab", None]


def test_frames_without_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs, JSON).count() == 0
    assert line_dedup.dedup_lines(docs).count() == 0
    assert substring_dedup.remove_repeats(docs).count() == 0
    assert docs.select(F.lit(1)).count() == 0


def test_an_article_is_kept_whole():
    long = "A sentence of the text, with commas, and so on. " * 5
    page = f"""<body><nav>Menu</nav><article><h1>T</h1><div>By Jane</div><ul><li>first</li><li>second</li></ul><p>{long}</p>
    <figure><figcaption>A caption</figcaption></figure><section class="share-prices"><p>Prices fell.</p></section><section class="Legal history"><p>The law is old.</p></section>
    <div class="notice-board"><p>Pinned here.</p></div><div class="search-results-study">We looked.</div><p>Yes.</p><table><tr><td>1</td></tr></table>
    <div class="share-buttons">Tweet</div><div class="notice">Mind the gap, please.</div><div class="ad slot-3">Buy now, it is cheap.</div>
    <div class="comments wide"><p>I say, this is a long comment, with commas, and so on.</p></div><aside>Beside</aside><p>{long}</p><h3>End</h3></article>
    <main><p>x</p></main><div class="related"><article><p>Teaser</p></article></div><footer>Imprint</footer></body>"""
    text = html_text.main_text(page)
    clean = " ".join(long.split())
    assert text == f"T By Jane first second {clean} A caption Prices fell. The law is old. Pinned here. We looked. Yes. 1 {clean} End"
    # without an article the main element is one
    assert html_text.main_text(page.replace("<main><p>x</p></main>", "").replace("article>", "main>")) == text


def test_a_small_article_beside_a_large_one():
    one, other = "A sentence of the text, with commas. " * 200, "Another, shorter article, of one sentence. " * 6
    text = html_text.main_text(f"<body><article><p>{one}</p></article><div><article><p>{other}</p><p>Its end</p></article></div></body>")
    assert text == f"{one}{other}Its end"


def test_long_white_space_is_encoded():
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    plain = Tokenizer.from_file(path)
    for text in (" " * 1_000_000 + "a", "\n" * 1_000_000 + "a", "word" + " \n" * 600_000 + "x", "a b\n\n  c", ""):
        assert packing.token_ids(text, path) == plain.encode(text, add_special_tokens=False).ids


def test_ids_as_an_array():
    path = packing.tokenizer_path()
    for text in ("", "a", " " * 1_000_000 + "a", "x<|endoftext|>y", "é 😀 \x00\n\n"):
        got = packing.token_array(text, path)
        assert isinstance(got, np.ndarray) and got.tolist() == packing.token_ids(text, path)


def test_ids_without_looking_ahead():
    """White space of every kind, before and after added tokens, at the ends and in long runs."""
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    plain = Tokenizer.from_file(path)
    rnd = random.Random(21)
    bits = [*" \n\t\r\x0b\x0c\x1c\x1f\x85\u00a0\u1680\u2003\u2028\u202f\u205f\u3000\u180e\u200b\ufeff", "  ", "\n\n", "a", "ab", "12", "!", "é", "'s", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
        assert packing.token_array(text, path).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
    assert packing._plain(path)[0]._pat_str.count("(?") == 0  # looking ahead takes a third of the time


def test_whole_sequences_share_batches():
    rng = np.random.default_rng(8)
    docs = [rng.integers(0, 50_000, 16 * n).astype("<u2") for n in (1, 3, 2, 700, 1) * 40]
    b = pa.RecordBatch.from_pydict({"doc_id": [None, *range(1, 200)], "doc_tokens": [len(x) + 5 for x in docs], "width": pa.array([2] * 200, pa.int32()), "whole": [x.tobytes() for x in docs]})
    out = list(packing._sequences(iter([b.slice(0, 3), b.slice(3)]), 16, 7))
    assert len(out) < 120  # not one a document
    rows = [r for x in out for r in x.to_pylist()]
    assert [r["sequence_id"] for r in rows] == list(range(7, 7 + len(rows)))
    assert [(r["doc_id"], r["start"], r["length"], r["doc_tokens"], r["offset"]) for r in rows] == [(d or None, s, 16, len(x) + 5, 0) for d, x in enumerate(docs) for s in range(0, len(x), 16)]
    assert b"".join(r["ids"] for r in rows) == np.concatenate(docs).astype("<u4").tobytes()


def test_an_index_without_used_items_scores_the_others_alike():
    rng = np.random.default_rng(9)
    items = [rng.integers(0, 300, rng.integers(1, 60)).astype(np.uint16) for _ in range(200)]
    whole, index, held = packing.Index(items), packing.Index(items), np.ones(200, bool)
    for _ in range(3):
        held &= rng.random(200) < 0.6
        index.keep(held)
        assert all((index.scores(i) == np.where(held, whole.scores(i), 0)).all() for i in range(200))


def test_scores_equal_the_formula():
    rng = np.random.default_rng(3)
    items = [rng.integers(0, 40, rng.integers(1, 60)) for _ in range(50)]
    n, mean = len(items), np.mean([len(x) for x in items])
    df = [sum(t in set(x.tolist()) for x in items) for t in range(40)]
    idf = [max(np.log((n - d + 0.5) / (d + 0.5)), 0) for d in df]
    index = packing.Index(items)
    for i, seed in enumerate(items):
        for j, x in enumerate(items):
            tf = {t: int((x == t).sum()) for t in set(seed.tolist())}
            bm25 = sum(idf[t] * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(x) / mean)) for t, f in tf.items() if f)
            assert abs(index.scores(i)[j] - bm25) < 1e-9


def test_turns_with_long_roles_and_texts_stay_in_order(spark):
    rnd = random.Random(6)
    role = lambda: rnd.choice(["user", "assistant", "r" * 32, "r" * 32 + "a", "r" * 32 + "b", "r" * 33, None])
    rows = [(rnd.choice([1, 2, None]), rnd.choice([0, 1, None]), role(), rnd.choice(["", None, "é" * 32, "é" * 32 + "b", "é" * 32 + "a", "x"])) for _ in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    key = lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    for got in chat.read_back(chat.format_turns(df)).collect():
        mine = sorted((r for r in rows if r[0] == got.conv_id), key=key)
        assert got.n_turns == len(mine)
        assert got.turns_sha256 == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine).encode()).hexdigest()
