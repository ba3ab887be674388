"""The relevance rules: ordered chains of conditions that say why a row goes.

A chain is one CASE expression: the first condition that holds gives the
reason, null means that the row stays. Rows need no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.keywords import Keywords, contains_any
from ..plans.vocabulary import DEFAULT, Vocabulary


def relevance_score(core: Column, brazil: Column, focus: Column) -> Column:
    return core + brazil * 2 + focus


def first_reason(*rules: tuple[str, Column]) -> Column:
    """The name of the first rule that holds, else null; an unknown condition doesn't hold."""
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules], F.lit(None).cast("string"))


def _lookup(key: Column, values: dict, default) -> Column:
    """A small map of constants as an expression."""
    out = F.lit(default)
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


class Rules:
    def __init__(self, words: Vocabulary = DEFAULT):
        self.words = words
        for name in ("core", "brazil", "focus", "foreign", "home", "metrics", "periods", "aggregates", "announcements", "generic_titles"):
            setattr(self, name, Keywords(getattr(words, name)))

    # --- single conditions, on normalised text ---

    def denied_path(self, raw_path: Column) -> Column:
        return contains_any(raw_path, [f"/{x}/" for x in self.words.path_deny])

    def denied_section(self, section: Column) -> Column:
        return section.isin(*sorted(self.words.section_deny))

    def editorial_path(self, raw_path: Column) -> Column:
        """Opinion pieces; no chain uses it."""
        return contains_any(raw_path, ["/post/", "/coluna/", "/minhas-financas/"])

    def home_context(self, text: Column) -> Column:
        return self.home.any(text) | (Keywords([self.words.exchange_word]).any(text) & F.contains(text, F.lit(self.words.exchange_sign)))

    def exterior_only(self, text: Column) -> Column:
        return self.foreign.any(text) & ~self.home_context(text)

    def generic_title(self, title: Column) -> Column:
        return self.generic_titles.any(title)

    def company_results(self, title: Column, path: Column) -> Column:
        """One company's results: an announcement, or a metric with a period and no sector."""
        both = F.trim(F.concat_ws(" ", title, path))
        return self.announcements.any(both) | (~self.aggregates.any(title) & self.metrics.any(title) & self.periods.any(title))

    def roundup_path(self, path: Column) -> Column:
        return contains_any(path, self.words.roundup_paths)

    def roundup_record(self, title: Column, path: Column, core: Column, brazil: Column) -> Column:
        return title.isin(*sorted(self.words.live_titles)) | (self.roundup_path(path) & (core + brazil * 2 < 4))

    def strict(self, section: Column) -> Column:
        return section.isin(*sorted(self.words.strict_sections))

    def least_score(self, section: Column) -> Column:
        return _lookup(section, self.words.strict_sections, self.words.least_score)

    def priority(self, source: Column) -> Column:
        return _lookup(source, self.words.source_priority, self.words.last_priority)

    # --- chains ---

    def gross_match(self, source: Column, url: Column) -> Column:
        """Whether section and URL alone let a candidate pass."""
        path, normal = t.raw_path(url), t.normalized_path(url)
        parts = F.transform(t.path_parts(path), t.normalize)

        def listed(by_source: dict[str, frozenset[str]]) -> Column:
            hits = [(source == s) & F.arrays_overlap(parts, F.array(*map(F.lit, sorted(x)))) for s, x in by_source.items()]
            return F.coalesce(reduce(lambda a, b: a | b, hits, F.lit(False)), F.lit(False))

        finance = self.core.any(normal)
        return ~self.denied_path(path) & F.when(listed(self.words.section_deny_by_source) & ~finance, False).otherwise(
            listed(self.words.section_allow_by_source) | finance
        )

    def early_reason(self, candidates: DataFrame) -> DataFrame:
        """Adds ``reject_reason`` to candidates (url, title, section), before any page is read.

        Null titles and sections are allowed; columns already there pass through.
        """
        url = F.col("url")
        surface = F.struct(
            t.normalize(t.join_parts(F.col("title"), t.slug_title(url))).alias("head"), t.normalize(F.col("section")).alias("section"),
            t.raw_path(url).alias("raw"), t.normalized_path(url).alias("path"),
        )

        def judge(x: Column, n: Column) -> Column:
            focus, core, brazil, path = n["focus"], n["core"], n["brazil"], x["path"]
            least = F.when(self.strict(x["section"]), self.words.least_score_strict_early).otherwise(self.words.least_score)
            return first_reason(
                ("section", self.denied_section(x["section"])),
                ("path", self.denied_path(x["raw"])),
                ("company_results", self.company_results(x["head"], path)),
                ("exterior_only", self.exterior_only(F.concat_ws(" ", x["head"], path))),
                ("generic_title", self.generic_title(x["head"])),
                ("no_signal", (focus == 0) & (core == 0)),
                ("roundup", self.roundup_path(path) & (focus + brazil < 2)),
                ("low_score", ~self.roundup_path(path) & (relevance_score(core, brazil, focus) < least)),
            )

        def counted(x: Column) -> Column:
            hits = F.struct(self.focus.count(x["head"]).alias("focus"), self.core.count(x["head"]).alias("core"), self.brazil.count(x["head"]).alias("brazil"))
            return t.bound(hits, lambda n: judge(x, n))

        # bound, so that a filter on the reason doesn't multiply what it is made of
        return candidates.withColumn("reject_reason", t.bound(surface, counted))

    def record_reason(self, records: DataFrame) -> DataFrame:
        """Adds ``reject_reason`` to records (url, title, description, section, tags, core_hits, brazil_hits)."""
        url, tags = F.col("url"), F.array_join(F.col("tags"), " ")
        surface = F.struct(
            t.normalize(F.col("section")).alias("section"), t.normalize(F.col("title")).alias("title"), t.raw_path(url).alias("raw"), t.normalized_path(url).alias("path"),
            t.normalize(t.join_parts(F.col("title"), F.col("description"), tags)).alias("all"), t.normalize(t.join_parts(F.col("title"), tags)).alias("head"),
            F.col("core_hits").alias("core"), F.col("brazil_hits").alias("brazil"),
        )

        def judge(x: Column, n: Column) -> Column:
            core, brazil, focus, section = x["core"], x["brazil"], n["focus"], x["section"]
            return first_reason(
                ("section", self.denied_section(section)),
                ("path", self.denied_path(x["raw"])),
                ("company_results", self.company_results(x["title"], x["path"])),
                ("exterior_only", self.exterior_only(x["all"])),
                ("roundup", self.roundup_record(x["title"], x["path"], core, brazil)),
                ("generic_title", self.generic_title(x["title"])),
                ("no_home_context", ~self.home_context(x["all"])),
                ("no_signal", (focus == 0) & (core == 0)),
                ("strict_section", self.strict(section) & (n["head_focus"] == 0) & (focus < 2)),
                ("low_score", relevance_score(core, brazil, focus) < self.least_score(section)),
            )

        def counted(x: Column) -> Column:
            hits = F.struct(self.focus.count(x["all"]).alias("focus"), self.focus.count(x["head"]).alias("head_focus"))
            return t.bound(hits, lambda n: judge(x, n))

        return records.withColumn("reject_reason", t.bound(surface, counted))

    def signal_counts(self, text: Column) -> dict[str, Column]:
        """core_hits and brazil_hits of a text that isn't normalised yet."""
        hits = self.signals(text)
        return {"core_hits": hits["core"], "brazil_hits": hits["brazil"]}

    def signals(self, text: Column) -> Column:
        """struct(core, brazil): both counts of a text that isn't normalised yet."""
        return t.bound(t.normalize(text), lambda n: F.struct(self.core.count(n).alias("core"), self.brazil.count(n).alias("brazil")))
