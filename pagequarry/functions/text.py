"""Scalar functions on text: columns in, columns out, all inside Catalyst."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Punctuation that does not belong to a value at its ends.
EDGES = " \t\r\n:;,.()[]{}"
NUMBER = r"^[-+]?\d+([.,]\d+)?$"
#: White space and separators: what ``[\s\p{Z}\x0b\x1c-\x1f\x85]`` matches.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def text(c) -> Column:
    """The column as text; null is empty, as missing values are throughout."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def clean(c, strip: str = " ") -> Column:
    """White space collapsed to one space, and the characters of ``strip`` taken from both ends."""
    return F.btrim(F.regexp_replace(text(c), r"\s+", " "), F.lit(strip))


def tidy(c) -> Column:
    """The same as ``clean`` for columns of many rows: the pattern runs only on text with white space to collapse."""
    s = text(c)
    spaced = F.lit(False)
    for x in ("  ", *"\t\n\x0b\f\r"):
        spaced |= F.contains(s, F.lit(x))
    return F.trim(F.when(spaced, F.regexp_replace(s, r"\s+", " ")).otherwise(s))


def blank(c) -> Column:
    """Whether ``clean`` leaves nothing; text is looked at up to its first character that is no white space."""
    return F.ltrim(text(c), F.lit(" \t\n\x0b\f\r")) == ""


def casefold(c) -> Column:
    return F.replace(F.lower(text(c)), F.lit("ß"), F.lit("ss"))


def norm_alnum(c) -> Column:
    """Lower case, letters and digits of ASCII only."""
    return F.regexp_replace(casefold(c), "[^a-z0-9]", "")


def norm_upper(c) -> Column:
    """Upper case, letters and digits of ASCII only."""
    return F.regexp_replace(F.upper(text(c)), "[^A-Z0-9]", "")


def norm_words(c) -> Column:
    """Upper case, with a space for whatever is neither letter nor digit."""
    return F.btrim(F.regexp_replace(F.upper(text(c)), "[^A-Z0-9]+", " "))


def norm_header(c) -> Column:
    """Lower case words of a header; a slash stays."""
    return F.btrim(F.regexp_replace(F.lower(text(c)), "[^a-z0-9/]+", " "))


def norm_label(c) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text(c)), "[^a-z0-9]+", " "))


def scan_text(c) -> Column:
    """Text as tags are sought in it: upper case, plain dashes, no bars or underscores."""
    plain = F.translate(F.upper(text(c)), "–—|_" + SPACES, "--  " + " " * len(SPACES))
    return F.btrim(F.regexp_replace(plain, " {2,}", " "))


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def worded(choices: str) -> str:
    """A pattern for whole words: what is neither letter, digit nor underscore stands on both sides.

    Choices begin with a plain character; a look at these and at up to two more
    comes first, which most places of a text fail.
    """
    plain = [re.match(r"(?:[A-Za-z0-9 /](?![?*{]))+", c)[0] for c in choices.split("|")]
    first = "".join(f"[{''.join(sorted(set(x)))}]" for x in list(zip(*plain, strict=False))[:3])
    return rf"(?={first})(?<![\p{{L}}\p{{N}}_])(?:{choices})(?![\p{{L}}\p{{N}}_])"


def near_matches(s: Column, pattern: str, contexts: dict[str, str], window: int = 220, headed: bool = False) -> Column:
    """Matches of a pattern in order, as structs: ``value``, and for each context whether its pattern occurs near the match.

    Near is the match itself and ``window`` characters on either side. Places of
    matches come from the lengths of matches and of what lies between them. If
    ``headed``, the pattern's group 1 is looked back at and belongs to the match.
    """
    kind = f"array<struct<value: string, {', '.join(f'{n}: boolean' for n in contexts)}>>"

    def step(acc: Column, x: Column) -> Column:
        stop = acc["at"] + F.length(x["gap"]) + F.length(x["hit"])
        value = F.concat(x["head"], x["hit"]) if headed else x["hit"]
        first = F.greatest(stop - F.length(value) - window, F.lit(0))
        flags = bind(F.substring(s, first + 1, stop - first + window), lambda w: F.struct(value.alias("value"), *[w.rlike(c).alias(n) for n, c in contexts.items()]))
        return F.struct(stop.alias("at"), F.array_append(acc["out"], flags).alias("out"))

    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(s, pattern, -1), F.lit(1), F.size(found))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
        heads = [F.regexp_extract_all(s, F.lit(pattern), F.lit(1)).alias("head")] if headed else []
        return F.when(F.size(found) == 0, F.array().cast(kind)).otherwise(F.aggregate(F.arrays_zip(gaps.alias("gap"), found.alias("hit"), *heads), start, step, lambda a: a["out"]))

    return bind(F.regexp_extract_all(s, F.lit(pattern), F.lit(0)), placed)


def number(c) -> Column:
    """A number with a point or a comma; null where the text is none."""
    t = F.btrim(text(c))
    return F.when(t.rlike(NUMBER), F.replace(t, F.lit(","), F.lit(".")).try_cast("double"))


def whole(c) -> Column:
    """An integer, 0 where the text is none."""
    t = F.btrim(text(c))
    return F.when(t.rlike(r"^[-+]?\d+$"), F.coalesce(t.try_cast("int"), F.lit(0))).otherwise(0)


def general(c: Column) -> Column:
    """A number in shortest form of six significant digits."""
    out = F.format_string("%g", c)
    out = F.regexp_replace(out, r"(\.\d*?)0+(e|$)", "$1$2")
    return F.regexp_replace(out, r"\.(e|$)", "$1")


def short_id(prefix: str, *columns: Column) -> Column:
    """A reproducible id: the prefix and 12 hex digits of SHA-1 over the parts."""
    return F.concat(F.lit(prefix), F.upper(F.left(F.sha1(F.concat_ws("|", *columns).cast("binary")), F.lit(12))))


def first_seen(value: Column, order: Column) -> Column:
    """Different values in the order of ``order``, as an aggregate."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.array_distinct(F.transform(pairs, lambda p: p["v"]))


def rank(c: Column, ranks: dict[str, int]) -> Column:
    """The rank of a label, 0 for others."""
    out = F.lit(0)
    for k, v in ranks.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def ratio(c, chars: str) -> Column:
    """The share of a text's characters that are in the character class; 0 for no text."""
    t = text(c)
    return F.when(F.length(t) > 0, F.length(F.regexp_replace(t, f"[^{chars}]", "")) / F.length(t)).otherwise(0.0)


def word_count(c) -> Column:
    return F.size(F.filter(F.split(text(c), r"\s+"), lambda x: x != ""))


def safe_name(c, default: str = "vendor_manual") -> Column:
    out = F.btrim(F.regexp_replace(text(c), "[^A-Za-z0-9_.-]+", "_"), F.lit("_"))
    return F.when(out == "", default).otherwise(out)


def page_text(c) -> Column:
    """``007`` as ``7``; other text as it is."""
    t = clean(c)
    return F.when(t.rlike(r"^\d{1,9}$"), t.try_cast("int").cast("string")).otherwise(t)


def suffix_number(c) -> Column:
    """The integer that a text ends with."""
    return F.regexp_extract(text(c), r"(\d{1,9})$", 1).try_cast("int")


def after_label(c, label: str) -> Column:
    """What follows ``LABEL:`` on a line, cleaned."""
    return clean(F.regexp_extract(text(c), rf"(?i)\b{label}\s*[:#]\s*(.+)$", 1))


def pad3(c: Column) -> Column:
    return F.when(F.length(c) >= 3, c).otherwise(F.lpad(c, 3, "0"))


PAIR = r"\b(\d{3,4})\s*-\s*([A-Z]{1,4})\s*-\s*(\d{3,5})\s*/\s*(\d{3,5})\b"
FULL = r"\b(\d{3,4})\s*-\s*([A-Z]{1,4})\s*-\s*(\d{3,5})\b"


def equipment_tags(c) -> Column:
    """Full tags of a text; a pair such as ``863-ACS-101/102`` gives both; first occurrences in order."""
    t = F.upper(text(c))

    def every(pattern: str, number_group: int) -> Column:
        parts = [F.regexp_extract_all(t, F.lit(pattern), F.lit(g)) for g in (1, 2, number_group)]
        return F.transform(F.arrays_zip(*[p.alias(f"p{i}") for i, p in enumerate(parts)]), lambda x: F.concat_ws("-", x["p0"], x["p1"], pad3(x["p2"])))

    return F.array_distinct(F.concat(every(PAIR, 3), every(PAIR, 4), every(FULL, 3)))
