"""Text, URL and date functions as Column expressions that stay in the JVM.

Null texts count as empty where a function says so; nothing here raises on odd
input. The driver-side twins (``*_value``) serve dictionaries and Arrow UDFs.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what counts as white space
_WHITE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# fixed values: words that say nothing about a text's content
_EMPTY_WORDS = ("com", "para", "pela", "pelos", "sobre")


@functools.cache
def _ascii_forms() -> tuple[str, str, dict[str, str]]:
    """Characters with a one-character ASCII decomposition, these, and the longer ones."""
    one, to, more = [], [], {}
    for code in range(0x80, 0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            one.append(chr(code))
            to.append(plain)
        elif plain:
            more[chr(code)] = plain
    return "".join(one), "".join(to), more


def clean_space_value(value: str) -> str:
    return " ".join(value.split())


def normalize_value(value: str | None) -> str:
    plain = unicodedata.normalize("NFKD", value or "").encode("ascii", "ignore").decode()
    return clean_space_value(plain.lower())


def clean_space(c: Column) -> Column:
    """White space, of any kind, becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(c, _WHITE + "+", " "))


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``c``, with ``c`` computed once however often ``f`` uses it."""
    return F.get(F.transform(F.array(c), f), 0)


def normalize(c: Column) -> Column:
    """Compatibility decomposition, ASCII only, lower case, single spaces; null is ''.

    Texts pay for what they hold: ASCII ones for nothing, those with accents for
    one translation, the rare ones with characters that become several (like
    ligatures) for a look-up of each character.
    """
    one, to, more = _ascii_forms()
    other = r"[^\x00-\x7f]"
    # one constant text, which Spark makes a constant map: thousands of single literals take seconds to state
    pairs = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in more.items())), F.lit("\x01"), F.lit("\x02"))

    def spelled(x: Column) -> Column:
        return F.array_join(F.transform(F.split(x, ""), lambda ch: F.when(ch < "\x80", ch).otherwise(F.coalesce(F.try_element_at(pairs, ch), F.lit("")))), "")

    def plain(x: Column) -> Column:
        several = F.length(F.translate(x, "".join(more), "")) < F.length(x)  # much faster than a pattern of so many characters
        return F.when(x.rlike(other), F.when(several, spelled(x)).otherwise(F.regexp_replace(x, other + "+", ""))).otherwise(x)

    def lower(x: Column) -> Column:
        return clean_space(F.lower(F.when(x.rlike(other), bound(F.translate(x, one, to), plain)).otherwise(x)))

    return bound(F.coalesce(c, F.lit("")), lower)


def not_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def join_parts(*parts: Column) -> Column:
    """The parts that are neither null nor empty, with a space between."""
    return F.concat_ws(" ", *[not_empty(p) for p in parts])


# --- URLs ---------------------------------------------------------------------


def url_path(url: Column) -> Column:
    """The path, without parameters of its last part; '' if there is none."""
    url = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[\x00-\x20]+|[\t\r\n]", "")
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")
    return F.regexp_replace(F.regexp_extract(rest, r"^(?://[^/?#]*)?([^?#]*)", 1), ";[^/]*$", "")


def url_origin(url: Column) -> Column:
    """``scheme://host``, or null."""
    return not_empty(F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1))


def percent_decode(c: Column) -> Column:
    """Percent escapes as UTF-8; broken escapes stay, broken UTF-8 becomes U+FFFD."""

    def piece(p: Column) -> Column:
        raw = F.unhex(F.replace(p, F.lit("%"), F.lit("")))
        return F.when(p.rlike("^%[0-9A-Fa-f]{2}"), F.make_valid_utf8(raw.cast("string"))).otherwise(p)

    def decode(x: Column) -> Column:
        pieces = F.regexp_extract_all(x, F.lit(r"((?:%[0-9A-Fa-f]{2})+|[^%]+|%)"), F.lit(1))
        return F.when(F.contains(x, F.lit("%")), F.array_join(F.transform(pieces, piece), "")).otherwise(x)

    return bound(c, decode)


def slug_title(url: Column) -> Column:
    """A title from the last part of the path: no trailing number, hyphens as spaces."""
    last = F.element_at(F.split(F.regexp_replace(url_path(url), "/+$", ""), "/"), -1)
    return clean_space(F.replace(percent_decode(F.regexp_replace(last, r"-\d+$", "")), F.lit("-"), F.lit(" ")))


def raw_path(url: Column) -> Column:
    return F.lower(url_path(url))


def normalized_path(url: Column) -> Column:
    return normalize(percent_decode(raw_path(url)))


def path_parts(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda p: p != "")


def section(url: Column) -> Column:
    """The first part of the path, or null."""
    return F.get(path_parts(url_path(url)), 0)


def url_key(url: Column) -> Column:
    return F.sha1(url)


# --- weeks --------------------------------------------------------------------


def week_key(ts: Column) -> Column:
    """ISO year and week: 2025-W17."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))


def weekday(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def week_start(ts: Column) -> Column:
    return F.to_date(F.date_trunc("week", ts))


def week_end(ts: Column) -> Column:
    return F.date_add(week_start(ts), 6)


def iso_timestamp(ts: Column) -> Column:
    """2025-04-21T10:30:00+00:00, with microseconds only if there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    fine = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(fine)


# --- lists --------------------------------------------------------------------


def split_values(c: Column) -> Column:
    """The values between ``;``, ``,`` and ``|``, cleaned, without empty ones."""
    return F.filter(F.transform(F.split(c, "[;,|]"), clean_space), lambda x: x != "")


def distinct_values(values: Column) -> Column:
    """The first of the values that normalise alike, cleaned, in order."""
    keys = F.transform(values, normalize)
    first = lambda both: F.transform(
        F.filter(F.array_distinct(both["k"]), lambda k: k != ""), lambda k: clean_space(F.element_at(both["v"], F.array_position(both["k"], k).cast("int")))
    )
    return bound(F.struct(keys.alias("k"), values.alias("v")), first)


def content_tokens(c: Column) -> Column:
    """Distinct words of four letters or digits and more."""
    words = F.regexp_extract_all(normalize(c), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) >= 4) & ~w.isin(*_EMPTY_WORDS)))


def sanitize_description(description: Column, title: Column) -> Column:
    """The description if it shares a content token with the title, or the title has none."""
    mine, other = content_tokens(description), content_tokens(title)
    keep = (F.size(mine) > 0) & ((F.size(other) == 0) | F.arrays_overlap(mine, other))
    return F.when(F.coalesce(not_empty(description).isNotNull() & keep, F.lit(False)), description)


def sentiment_text(title: Column, description: Column) -> Column:
    head = F.concat(F.lit("Titulo: "), F.coalesce(title, F.lit("")))
    return F.concat_ws("\n", head, F.concat(F.lit("Resumo: "), not_empty(description)))


def java_quote(text: str) -> str:
    """``text`` for a Java pattern."""
    return re.sub(r"([^A-Za-z0-9 ])", r"\\\1", text)
