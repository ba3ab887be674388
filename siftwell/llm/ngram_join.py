"""Self-join of texts on the Jaccard similarity of their word n-gram sets.

Each text becomes a set of n-gram hashes in one global order: n-grams that few
texts hold come first (by a count sketch over all texts), equal ones by hash.
Two sets of similarity t or more share a member among the first
n - ceil(t n) + 1 of each, so those are indexed, with all rare ones whose hash is
below a cut. Every set indexes what it holds below the cut, so how many of these
it shares bounds its overlap with any other set: that drops sets, then pairs.
Each set is first compared with the pivot it shares most with, and linked sets
are contracted. Sets that are then still apart meet under the members they share:
pair by pair under members that few hold, else in blocks. Members that the same
sets hold, or nearly, are one family, under which a set comes once, however many
of them it has. A block's sets are a prefix tree in the global order, which is walked once for many probes: a path
that sets share is overlapped with the probes once, and what is below is left
when the members that remain cannot reach the bound for any of them. Of a
block's links only those that join what is not joined yet are rows.

Texts with the same set are one class from the start, so copies cost one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import graph, shared

WORDS = 5
PERCENT = 75
#: Counters of the sketch; fixed, so what is broadcast doesn't grow: 1 byte each.
SKETCH = 1 << 20
#: Share of the hashes below the cut; above 1 - t, so that the bound bites.
CUT = 0.35
#: Members that fewer sets hold are joined; that adds at most so many rows for each.
FEW = 32
#: Sets, and members of them, that meet in one task, on either side, about.
BLOCK = 4096
BLOCK_MEMBERS = 1 << 20
#: Entries that a map task holds before it ships them.
FLUSH = 1 << 21
#: Sketch level (log2 of a count against the mean counter) from which an n-gram's
#: entries are dealt to the buckets by their class too.
HEAVY_LEVEL = 6
#: Members of a step down the prefix tree, and probes that walk it together.
STEP, PROBES = 16, 64


# --- sets --------------------------------------------------------------------


def text_sets(column: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text (A-Z lower-cased)."""
    for _, _, raw, offs in shared.text_chunks(column):
        starts, ends, first = shared.word_spans(raw, offs)
        word = shared.SpanHash(raw, shared.LOWER_BYTE).of(starts, ends)
        grams = shared.window_hashes(word, words)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= words:
                yield np.unique(grams[a : b - words + 1])
            elif b > a:
                yield shared.window_hashes(word[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)


def set_id(grams: np.ndarray) -> int:
    """A 64-bit id of a set: that of the sum of its mixed members."""
    total = int(np.add.reduce(shared.mix(grams ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)) + 0x9E3779B97F4A7C15 * len(grams)
    return int(shared.mix(np.array([total & (2**64 - 1)], np.uint64)).view(np.int64)[0])


def levels(counts: np.ndarray) -> np.ndarray:
    """A counter's level: 0 up to eight times the mean, then its log2."""
    ratio = counts / max(float(counts.mean()), 1.0)
    return np.where(ratio < 8, 0, np.floor(np.log2(np.maximum(ratio, 1)))).astype(np.uint8)


def ordered(grams: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The set in the global order: rare members first, ties by hash."""
    at = level[(grams & np.uint64(SKETCH - 1)).astype(np.int64)]
    return grams if not at.any() else grams[np.argsort(at, kind="stable")]


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1 if n else 0


# --- prefix tree -------------------------------------------------------------


def linked(probe: np.ndarray, sets: list[np.ndarray], percent: int) -> list[bool]:
    """Which of ``sets`` have the similarity with ``probe``; all in the global order.

    The sets are walked as a prefix tree in depth-first order: the overlap along
    the path that a set shares with the one before it is kept, and the rest is
    cut off when even a match of all members that remain falls short.
    """
    out = [False] * len(sets)
    n = len(probe)
    have = np.sort(probe)
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    path = np.zeros(0, np.uint64)  # members from the root to where the walk stands
    overlap = np.zeros(1, np.int64)  # overlap with the probe at each depth
    cut = -1  # depth at which the path was given up, else -1
    for i in order:
        s = sets[i]
        m = len(s)
        if not n or not m or 100 * min(n, m) < percent * max(n, m):
            continue
        need = -(-percent * (n + m) // (100 + percent))
        depth = min(len(path), m)
        differ = np.flatnonzero(path[:depth] != s[:depth])
        depth = int(differ[0]) if len(differ) else depth
        if 0 <= cut <= depth and overlap[cut] + min(m - cut, n - overlap[cut]) < need:
            continue  # the subtree was left for a bound that holds for this set too
        done = int(overlap[depth])
        steps, marks = [overlap[: depth + 1]], depth
        cut = -1
        while marks < m:
            part = s[marks : marks + 64]
            at = np.searchsorted(have, part)
            hit = have[np.minimum(at, n - 1)] == part
            run = done + np.cumsum(hit)
            steps.append(run)
            done, marks = int(run[-1]), marks + len(part)
            if done + (m - marks) < need:
                cut = marks
                break
        overlap, path = np.concatenate(steps), s[:marks]
        out[i] = cut < 0 and 100 * done >= percent * (n + m - done)
    return out


def tree_links(sets: list[np.ndarray], probes: list[int], held: list[int], names: list[int], comp: list[int], level: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between ``probes`` and ``held`` (places in ``sets``) that join components.

    Sets are in the global order. A probe meets the held sets that have more
    members than it, or as many and a larger name. Every link between components
    that the links given do not join already is given.
    """
    size = np.array([len(x) for x in sets])
    grams, rank = np.unique(np.concatenate(sets), return_inverse=True)
    place = np.empty(len(grams), np.int64)
    place[np.lexsort((grams, level[(grams & np.uint64(SKETCH - 1)).astype(np.int64)]))] = np.arange(len(grams))
    cut = np.cumsum(size) - size
    ranks = np.split(place[rank], cut[1:])
    # the tree: held sets in the order of a walk, members in steps; what is past a set's end no probe has
    held = sorted(held, key=lambda i: ranks[i].astype(">u4").tobytes())
    steps = -(-size[held] // STEP)
    start = np.cumsum(steps) - steps
    flat = np.full((int(steps.sum()), STEP), len(grams))
    for k, i in enumerate(held):
        flat[start[k] : start[k] + steps[k]].ravel()[: size[i]] = ranks[i]
    common = np.zeros(len(held), np.int64)  # steps that a set shares with the one before it
    for k in range(1, len(held)):
        n = min(steps[k - 1], steps[k])
        same = (flat[start[k - 1] : start[k - 1] + n] == flat[start[k] : start[k] + n]).all(1)
        common[k] = n if same.all() else int(np.argmin(same))
    name, m = np.array([names[i] for i in held]), size[held]

    above: dict[int, int] = {}

    def root(c: int) -> int:
        while above.get(c, c) != c:
            above[c] = above.get(above[c], above[c])
            c = above[c]
        return c

    out: list[tuple[int, int]] = []
    probes = sorted(probes, key=lambda i: size[i])
    has = np.zeros((len(grams) + 1, PROBES), np.uint8)
    at, width = 0, 4  # the first few probes join most of what is alike
    while at < len(probes):
        batch = probes[at : at + width]
        at, width = at + width, min(4 * width, PROBES)
        n = size[batch]
        for k, i in enumerate(batch):
            has[ranks[i], k] = 1
        now = {c: root(c) for c in {comp[i] for i in batch} | {comp[i] for i in held}}
        mine, theirs = np.array([now[comp[i]] for i in batch]), np.array([now[comp[i]] for i in held])
        own = np.array([names[i] for i in batch])
        open_ = (theirs[:, None] != mine) & ((m[:, None] > n) | ((m[:, None] == n) & (name[:, None] > own))) & (100 * n >= percent * m[:, None])
        live = np.flatnonzero(open_.any(1))
        found: list[tuple[int, int]] = []
        if len(live):
            shared_steps = np.minimum.reduceat(common[: live[-1] + 1], np.append(0, live[:-1] + 1))
            node, overlap, depth = np.zeros(len(live), np.int64), np.zeros((1, len(batch)), np.int64), 0
        while len(live):
            new = shared_steps <= depth
            new[0] = True
            first = np.flatnonzero(new)
            overlap = overlap[node[first]] + has[flat[start[live[first]] + depth]][:, :, : len(batch)].sum(1, dtype=np.int64)
            node = np.cumsum(new) - 1
            depth += 1
            left = np.maximum(m[live] - depth * STEP, 0)[:, None]
            can = open_[live] & ((overlap[node] + left) * (100 + percent) >= percent * (n + m[live][:, None]))
            ended = steps[live] <= depth
            for k, j in zip(*np.nonzero(can & ended[:, None]), strict=True):
                found.append((batch[j], held[live[k]]))
            stay = np.flatnonzero(can.any(1) & ~ended)
            if not len(stay):
                break
            shared_steps = np.minimum.reduceat(shared_steps[: stay[-1] + 1], np.append(0, stay[:-1] + 1))
            live, node = live[stay], node[stay]
        for i, j in found:
            a, b = root(comp[i]), root(comp[j])
            if a != b:
                above[max(a, b)] = min(a, b)
                out.append((i, j))
        for k, i in enumerate(batch):
            has[ranks[i], k] = 0
    return out


# --- stages ------------------------------------------------------------------


def _sketch_levels(docs: DataFrame, words: int) -> np.ndarray:
    """The level of every counter of the count sketch over all texts.

    Tasks ship their counters by block; the sum has a fixed size.
    """
    block = 1 << 14

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int64)
        for b in batches:
            for grams in text_sets(b.column(0), words):
                if len(grams):
                    np.add.at(sketch, (grams & np.uint64(SKETCH - 1)).astype(np.int64), 1)
        used = [i for i in range(SKETCH // block) if sketch[i * block : (i + 1) * block].any()]
        packed = [sketch[i * block : (i + 1) * block].astype(np.uint32).tobytes() for i in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(packed, pa.binary())], names=["at", "block"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got = np.frombuffer(x, np.uint32).astype(np.uint64)
                total[i] = total[i] + got if i in total else got
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["at", "block"])

    summed = docs.select("text").mapInArrow(shared.tidy(count), "at int, block binary").repartition("at").mapInArrow(shared.tidy(add), "at int, block binary")
    counts = np.zeros(SKETCH, np.float64)
    for i, x in summed.collect():  # SKETCH counters in all, however large the corpus
        counts[i * block : (i + 1) * block] += np.frombuffer(x, np.uint64)
    return levels(counts)


def below_cut(in_order: np.ndarray, level: np.ndarray) -> int:
    """How many members of an ordered set are rare and below the cut; they come first."""
    low = in_order < np.uint64(int(CUT * 2**64))
    return int((low & (level[(in_order & np.uint64(SKETCH - 1)).astype(np.int64)] == 0)).sum())


def _classes(docs: DataFrame, level, words: int, percent: int) -> DataFrame:
    """(k_id, k_text, doc_id, n, cls, low, need) of each row.

    low: members below the cut. need: how many of them any linked set shares.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, cls, low, need = [], [], [], []
            for grams in text_sets(b.column(3), words):
                size = len(grams)
                n.append(size)
                cls.append(set_id(grams) if size else None)
                low.append(below_cut(ordered(grams, level.value), level.value) if size else 0)
                # an overlap is at least t n; the members above the cut give n - low of it
                need.append(low[-1] - size - (-size * percent // 100) if low[-1] >= prefix_length(size, percent) else 0)
            columns = [*b.columns[:3], *(pa.array(x, pa.int64()) for x in (n, cls, low, need))]
            yield pa.RecordBatch.from_arrays(columns, names=["k_id", "k_text", "doc_id", "n", "cls", "low", "need"])

    keyed = docs.select(*shared.row_key(), "doc_id", "text")
    return keyed.mapInArrow(shared.tidy(run), "k_id long, k_text long, doc_id long, n long, cls long, low long, need long")


def _index(docs: DataFrame, level, buckets: int, words: int, percent: int) -> DataFrame:
    """Indexed members and their classes, packed by bucket.

    A bucket is a range of the members' hashes; the entries of a very common
    member are dealt over all buckets by their class, so that no bucket gets all.
    """
    names = ["bucket", "common", "grams", "classes"]

    def rows(grams: list[np.ndarray], cls: list[int]) -> Iterator[pa.RecordBatch]:
        gram = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        of = np.repeat(np.array(cls, np.int64), [len(g) for g in grams])
        common = level.value[(gram & np.uint64(SKETCH - 1)).astype(np.int64)] >= HEAVY_LEVEL
        gram = shared.mix(gram)
        spread = np.where(common, shared.mix(gram ^ of.view(np.uint64)), gram)
        bucket = ((spread >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64) * 2 + common
        order = np.argsort(bucket, kind="stable")
        gram, of, bucket = gram[order], of[order], bucket[order]
        cut = np.searchsorted(bucket, np.arange(2 * buckets + 1)).tolist()
        full = [i for i in range(2 * buckets) if cut[i + 1] > cut[i]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i // 2 for i in full], pa.int32()), pa.array([i % 2 == 1 for i in full], pa.bool_()), pa.array([gram[cut[i] : cut[i + 1]].tobytes() for i in full], pa.binary()), pa.array([of[cut[i] : cut[i + 1]].tobytes() for i in full], pa.binary())],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, cls, held, seen = [], [], 0, set()
        for b in batches:
            for g in text_sets(b.column(0), words):
                if not len(g):
                    continue
                c = set_id(g)
                if c in seen:  # a copy adds nothing to the index
                    continue
                seen.add(c)
                if len(seen) > 1 << 18:
                    seen.clear()
                g = ordered(g, level.value)
                p = g[: max(prefix_length(len(g), percent), below_cut(g, level.value))]
                grams.append(p)
                cls.append(c)
                held += len(p)
                if held >= FLUSH:
                    yield from rows(grams, cls)
                    grams, cls, held = [], [], 0
        yield from rows(grams, cls)

    return docs.select("text").mapInArrow(shared.tidy(run), "bucket int, common boolean, grams binary, classes binary")


def _postings(packed: DataFrame) -> DataFrame:
    """(gram, cls) of the indexed members that several classes hold, and of all very common ones."""

    def shared_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list[tuple[bytes, bytes]]] = {}
        for b in batches:
            for i, x, g, c in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                held.setdefault((i, x), []).append((g, c))
        while held:
            (_, common), parts = held.popitem()
            gram = np.frombuffer(b"".join(g for g, _ in parts), np.uint64)
            cls = np.frombuffer(b"".join(c for _, c in parts), np.int64)
            keep = np.arange(len(gram)) if common else np.flatnonzero(shared.repeated(shared.mix(gram)))
            order = keep[np.lexsort((cls[keep], gram[keep]))]
            gram, cls = gram[order], cls[order]
            if not len(gram):
                continue
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (cls[1:] != cls[:-1])
            gram, cls = gram[new], cls[new]
            if not common:
                _, where, count = np.unique(gram, return_inverse=True, return_counts=True)
                many = count[where] > 1
                gram, cls = gram[many], cls[many]
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(cls)], names=["gram", "cls"])

    return packed.repartition("bucket").mapInArrow(shared.tidy(shared_members), "gram long, cls long")


def _verify(pairs: DataFrame, texts: DataFrame, level, words: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets have the similarity; each pair is compared once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            groups: dict[int, list[int]] = {}
            for i, u in enumerate(b.column(0).to_pylist()):
                groups.setdefault(u, []).append(i)
            hits = []
            for at in groups.values():
                for k in range(0, len(at), 256):  # sets held at a time
                    part = at[k : k + 256]
                    column = pa.concat_arrays([b.column(2).slice(at[0], 1), b.column(3).take(pa.array(part, pa.int64()))])
                    probe, *sets = [ordered(g, level.value) for g in text_sets(column, words)]
                    hits += [i for i, x in zip(part, linked(probe, sets, percent), strict=True) if x]
            yield b.select([0, 1]).take(pa.array(hits, pa.int64()))

    right = texts.select(F.col("cls").alias("v"), F.col("text").alias("vt"))
    left = texts.select(F.col("cls").alias("u"), F.col("text").alias("ut"))
    both = pairs.select("u", "v").join(right, "v").join(left, "u").select("u", "v", "ut", "vt")
    return both.mapInArrow(shared.tidy(run), "u long, v long")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Each row's doc_id, n_shingles and component_id, its key (k_id, k_text) and an id of its component.

    Similarity is that of the sets of distinct ``words``-word n-grams; a text
    with fewer words has its whole word sequence as its one member; a text
    without words has no member and is its own component. component_id is the
    smallest doc_id that links reach. Null texts count as empty. Rows with a
    null doc_id stay and link like others; their component_id is null only where
    no row that they reach has an id. Repeated rows each get their row. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    shared.small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    level = spark.sparkContext.broadcast(_sketch_levels(docs, words))
    rows = shared.materialize(_classes(docs, level, words, percent), "classes")
    buckets = max(32, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = shared.materialize(_postings(_index(docs, level, buckets, words, percent)), "postings")
    known = rows.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("first"), F.min(F.struct("k_id", "k_text")).alias("place"), F.min("n").alias("n"), F.min("low").alias("low"), F.min("need").alias("need")
    )

    # Sets that share too few of their members below the cut have no partner.
    enough = shared.materialize(
        found.groupBy("cls").agg(F.count("*").alias("k")).join(known, "cls").where("k >= need").select("cls", "place.*", "n", "low"), "enough"
    )
    posts = found.join(enough.select("cls"), "cls")
    held = posts.groupBy("gram").agg(F.min("cls").alias("lo"), F.count("*").alias("m")).where("m > 1")
    posts = shared.materialize(posts.join(held, "gram").select("gram", "cls", "lo", "m"), "posts")
    shared.discard(found)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, sets = [], []
            for i, (want, grams) in enumerate(zip(b.column(0).to_pylist(), text_sets(b.column(1), words), strict=True)):
                if len(grams) and set_id(grams) == want:
                    keep.append(i)
                    sets.append(ordered(grams, level.value).tobytes())
            part = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sets, pa.binary())], names=["cls", "text", "n", "low", "grams"])

    carriers = enough.join(posts.select("cls").distinct(), "cls")
    keyed = docs.select(*shared.row_key(), "text").join(carriers, ["k_id", "k_text"])
    texts = keyed.select("cls", "text", "n", "low").mapInArrow(shared.tidy(load), "cls long, text string, n long, low long, grams binary")
    texts = shared.materialize(texts, "texts")
    if texts.count() > texts.select("cls").distinct().count():  # rows that repeat a doc_id and text
        texts = shared.materialize(texts.dropDuplicates(["cls"]), "texts")
    sizes = texts.select("cls", "n", "low")

    # Each class and the pivot with which it shares most: of each member, the
    # class that shares most in all, and the first.
    central = posts.groupBy("cls").agg(F.sum("m").alias("m")).join(sizes, "cls").select("cls", (F.col("m") / F.greatest("low", F.lit(1))).alias("share"))
    central = shared.materialize(central, "central")
    top = posts.select("gram", "cls").join(central, "cls").groupBy("gram").agg(F.max(F.struct("share", "cls")).getField("cls").alias("top"))
    star = posts.select("gram", "cls", "lo").join(top, "gram").select(F.col("cls").alias("v"), F.explode(F.array("lo", "top")).alias("u")).where("u <> v")
    star = star.groupBy("v", "u").agg(F.count("*").alias("k")).groupBy("v").agg(F.max(F.struct("k", "u")).alias("best"))
    star = star.select(F.least("v", "best.u").alias("u"), F.greatest("v", "best.u").alias("v")).distinct()
    star = _sized(star, sizes).where(f"least(un, vn) * 100 >= greatest(un, vn) * {percent}")
    links = shared.materialize(_verify(star, texts, level, words, percent), "links")
    comp = shared.materialize(graph.components(links), "comp")

    def still_apart() -> DataFrame:
        """Rows of members that several components hold, of sets that may have a partner elsewhere."""
        rows = posts.select("gram", "cls").join(comp, posts.cls == comp.node, "left").select("gram", "cls", F.coalesce("comp", "cls").alias("comp"))
        for _ in range(2):  # a set that shares too few of them with other components has none; then some members are shared no more
            mixed = rows.groupBy("gram").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("gram")
            rows = shared.materialize(rows.join(mixed, "gram"), "apart")
            able = rows.groupBy("cls").agg(F.count("*").alias("k")).join(sizes, "cls").where(f"k >= {_need(percent)}").select("cls")
            rows = rows.join(able, "cls")
        # ids of classes are hashes, so the smallest and the largest holder agree the oftener, the more two members' holders are alike
        family = F.xxhash64(F.min("cls"), F.max("cls"), F.floor(F.log2(F.count("*"))))
        held = rows.groupBy("gram").agg(F.count("*").alias("held"), family.alias("family"))
        return shared.materialize(rows.join(held, "gram").select("gram", "cls", "held", "family", "comp"), "apart")

    apart = still_apart()
    # All that are apart yet: under members that few sets hold, pairs; under
    # common ones, blocks.
    near = _verify(_few(apart, sizes, percent).distinct(), texts, level, words, percent)
    more = shared.materialize(near.union(_blocks(apart, texts, level, percent)).distinct(), "links")
    comp = graph.components(links.union(more)) if not more.isEmpty() else comp

    group = known.select("cls", "first").join(comp, known.cls == comp.node, "left").select("cls", "first", F.coalesce("comp", "cls").alias("comp"))
    low = group.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = group.join(low, "comp").select("cls", "component_id", "comp")
    return rows.join(named, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "k_id", "k_text", "comp"
    )


def _few(apart: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of different components that share a member which under FEW sets hold.

    What they share of such members is counted; they may share all common members
    below the cut, and all above it, that either has.
    """
    small = apart.where(f"held < {FEW}")
    left = small.select("gram", F.col("cls").alias("u"), F.col("comp").alias("uc"))
    right = small.select("gram", F.col("cls").alias("v"), F.col("comp").alias("vc"))
    pairs = left.join(right, "gram").where("u < v and uc <> vc").groupBy("u", "v").agg(F.count("*").alias("k"))
    pairs = _sized(pairs, sizes)
    common = apart.where(f"held >= {FEW}").groupBy("cls").agg(F.count("*").alias("common"))
    for x in ("u", "v"):
        pairs = pairs.join(common.select(F.col("cls").alias(x), F.col("common").alias(f"{x}m")), x, "left").fillna(0, [f"{x}m"])
    return pairs.where(
        f"least(un, vn) * 100 >= greatest(un, vn) * {percent} and (k + least(um, vm) + least(un - ulow, vn - vlow)) * {100 + percent} >= {percent} * (un + vn)"
    ).select("u", "v")


def _dealt(apart: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(family, cls, comp, grams, i, j, probe, holder): what meets in each block (family, i, j).

    Of two sets, the one with fewer members (ties: the smaller id) shares one of
    its rarest members below the cut with the other: as many of them as it may
    lack, and one more. Under each family of members, the sets that have one of
    it among these probe all sets that hold one of it, in blocks. A set is there
    once for a family, not for each of its members, so what is sent grows with
    the text and not with its square.
    """
    order = Window.partitionBy("cls").orderBy("held", "gram")
    need = F.ceil(F.col("n") * (2 * percent) / (100 + percent))
    rows = apart.join(texts.select("cls", "n", "low"), "cls")
    # Its rarest are first those that no set of another component has. A set that
    # is indexed beyond the cut meets under all of its members.
    alone = F.greatest(F.col("low") - F.count("*").over(Window.partitionBy("cls")), F.lit(0))
    beyond = F.col("low") < F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    rows = rows.withColumn("short", beyond | (F.row_number().over(order) + alone <= F.col("n") - need + 1))
    # members that lead somewhere: some set has it among its rarest, and the sizes fit
    rows = rows.where(f"held >= {FEW}")
    asked = rows.where("short").groupBy("gram").agg(F.min("n").alias("n0"), F.max("n").alias("n1"))
    rows = rows.join(asked, "gram").where(f"n >= n0 and {percent} * n <= 100 * n1")
    rows = shared.materialize(rows.groupBy("family", "cls", "comp", "n").agg(F.max("short").alias("short")), "families")
    there = rows.groupBy("family").agg(F.sum("n").alias("members"), F.count("*").alias("sets"), F.max("short").alias("probes"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_MEMBERS), F.ceil(F.col("sets") / BLOCK)).cast("int")
    rows = rows.join(there.where("probes and c0 <> c1").select("family", blocks.alias("blocks")), "family")
    # every probe meets every block of holders; where there is one block, a set is there once
    mine = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)

    def seat(i, j, probe, holder):
        return F.struct(i.alias("i"), j.alias("j"), probe.alias("probe"), holder.alias("holder"))

    yes, no, zero = F.lit(True), F.lit(False), F.lit(0)
    probing = F.transform(F.when(F.col("short"), every).otherwise(F.array().cast("array<int>")), lambda j: seat(mine, j, yes, no))
    holding = F.transform(every, lambda i: seat(i, mine, no, yes))
    seats = F.when(F.col("blocks") == 1, F.array(seat(zero, zero, F.col("short"), yes))).otherwise(F.concat(probing, holding))
    rows = rows.select("family", "cls", "comp", F.explode(seats).alias("seat"))
    return rows.join(texts.select("cls", "grams"), "cls").select("family", "cls", "comp", "grams", "seat.*")


def _blocks(apart: DataFrame, texts: DataFrame, level, percent: int) -> DataFrame:
    """Links (u, v) that join different components, under members that many sets hold."""
    dealt = _dealt(apart, texts, percent).repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "cls")

    def meet(group: list[tuple]) -> list[tuple[int, int]]:
        probes, held = [k for k, r in enumerate(group) if r[6]], [k for k, r in enumerate(group) if r[7]]
        comp = [r[2] for r in group]
        if not probes or not held or len(set(comp)) < 2:
            return []
        cls = [r[1] for r in group]
        sets = [np.frombuffer(r[3], np.uint64) for r in group]
        return [(min(cls[i], cls[j]), max(cls[i], cls[j])) for i, j in tree_links(sets, probes, held, cls, comp, level.value, percent)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for b in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            links: list[tuple[int, int]] = []
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if group and (row[0], row[4], row[5]) != (group[0][0], group[0][4], group[0][5]):
                    links += meet(group)
                    group = []
                group.append(row)
            yield _pairs(links)
        if group:
            yield _pairs(meet(group))

    return dealt.mapInArrow(shared.tidy(run), "u long, v long")


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in range(2)], names=["u", "v"])


def _need(percent: int) -> str:
    """How many members below the cut a set (n, low) shares with any partner, at least."""
    least_overlap = f"ceil(n * {percent} / 100)"
    return f"(CASE WHEN low >= n - {least_overlap} + 1 THEN low - n + {least_overlap} ELSE 0 END)"


def _sized(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    for x in ("u", "v"):
        pairs = pairs.join(sizes.select(F.col("cls").alias(x), F.col("n").alias(f"{x}n"), F.col("low").alias(f"{x}low")), x)
    return pairs


def first_of_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the smallest doc_id.

    Rows that repeat a doc_id and text count as one document. Of texts with one
    id, and of groups without ids, one stays, by a hash of the text; rows with a
    null doc_id go where their group has an id. Texts without words stay.
    """
    found = near_duplicates(docs, words, percent)
    place = F.struct(F.col("doc_id").isNull(), "k_id", "k_text")
    first = found.where("comp is not null").groupBy("comp").agg(F.min(place).alias("p")).select("p.k_id", "p.k_text")
    stay = first.union(found.where("comp is null").select("k_id", "k_text")).distinct().toDF(*shared.RESERVED)
    keyed = docs.select("*", *shared.row_key(names=shared.RESERVED))
    kept = keyed.join(stay, [*shared.RESERVED], "left_semi")
    return kept.dropDuplicates([*shared.RESERVED]).drop(*shared.RESERVED)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(shared.table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
