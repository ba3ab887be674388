"""Dictionary matching on normalised text.

A keyword matches where no letter or digit touches it. Single words are looked
up among a text's words, all in one set operation. Few keywords with spaces or
symbols are searched, behind a plain substring test. Many are looked up as well:
at each word that begins one, the runs of words of the dictionary's lengths are
held against a hashed set, so a text is gone through once however many there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, java_quote, normalize_value

_WORD = "[a-z0-9]+"
#: Beyond so many phrases, or words, looking them up in a set made once takes less than asking for each.
MANY_PHRASES, MANY_WORDS = 96, 1024


class Keywords:
    def __init__(self, keywords: Iterable[str]):
        every = sorted({normalize_value(k) for k in keywords} - {""})
        self.words = [k for k in every if re.fullmatch(_WORD, k)]
        self.phrases = [k for k in every if not re.fullmatch(_WORD, k)]
        #: Those that are looked up begin and end with a word; how many words they have, and which they begin with.
        runs = [k for k in self.phrases if re.fullmatch(f"{_WORD}.*{_WORD}", k)]
        self.runs = runs if len(runs) > MANY_PHRASES else []
        self.lengths = sorted({len(re.findall(_WORD, k)) for k in self.runs})
        self.first = sorted({re.match(_WORD, k)[0] for k in self.runs})
        looked_up = set(self.runs)
        self.searched = [k for k in self.phrases if k not in looked_up]

    def _words(self, text: Column) -> Column:
        return F.split(text, "[^a-z0-9]+")

    def _found_words(self, text: Column) -> Column:
        """The different words of the dictionary in a text."""
        if len(self.words) <= MANY_WORDS:
            return F.array_intersect(self._words(text), F.array(*map(F.lit, self.words)))
        return F.array_distinct(F.filter(self._words(text), lambda w: w.isin(self.words)))

    def _found_runs(self, text: Column) -> Column:
        """The different looked-up phrases in a text."""

        def look_up(x: Column) -> Column:
            # x: words and what lies between them in turn
            begins = F.filter(F.transform(x, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda s: s["w"].isin(self.first))
            runs = F.transform(begins, lambda s: F.array(*[F.array_join(F.slice(x, s["i"] + 1, 2 * n - 1), "") for n in self.lengths]))
            return F.array_distinct(F.filter(F.flatten(runs), lambda k: k.isin(self.runs)))

        return bound(F.regexp_extract_all(text, F.lit(f"({_WORD}|[^a-z0-9]+)"), F.lit(1)), look_up)

    def _searched(self, text: Column, k: str) -> Column:
        return F.contains(text, F.lit(k)) & text.rlike(f"(?<![a-z0-9]){java_quote(k)}(?![a-z0-9])")

    def any(self, text: Column) -> Column:
        """Whether any keyword is in the (normalised) text."""
        found = F.lit(False)
        if self.words:
            found = F.arrays_overlap(self._words(text), F.array(*map(F.lit, self.words))) if len(self.words) <= MANY_WORDS else F.size(self._found_words(text)) > 0
        if self.runs:
            found = found | (F.size(self._found_runs(text)) > 0)
        for k in self.searched:
            found = found | self._searched(text, k)
        return found

    def count(self, text: Column) -> Column:
        """How many different keywords are in the (normalised) text."""
        total = F.lit(0)
        if self.words:
            total = F.size(self._found_words(text))
        if self.runs:
            total = total + F.size(self._found_runs(text))
        for k in self.searched:
            total = total + self._searched(text, k).cast("int")
        return total


def contains_any(text: Column, markers: Iterable[str]) -> Column:
    """Plain substrings."""
    found = F.lit(False)
    for m in sorted(markers):
        found = found | F.contains(text, F.lit(m))
    return found
