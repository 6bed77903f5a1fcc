"""Personal data: patterns bootstrapped from what plain rules find.

Plain rules find e-mail addresses, IP addresses, card and telephone numbers. These
seed instances induce lexical patterns: the words beside them, the form in which
they are written, the host of an address. Other strings that may be identifiers
are instances too, as yet of no kind. Patterns and instances are a graph, which
Spark scores in rounds: a pattern's confidence for a kind is the share of that kind
among all different instances that it holds, where those that may be of the kind
weigh less than those that cannot be, and instances that a confident
pattern holds take its kind, which lets further patterns become confident. At the
end each place where such an instance stands is a span besides those of the rules.

Both sides of the graph are told by different instances, so a passage that is
copied a thousand times counts once.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, stage_table

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Different instances of a kind that a pattern needs, and their share of all that it holds.
SUPPORT, CONFIDENCE = 5, 0.9
#: A pattern's instances count as this many more, so that few are no certainty; one that may be of the kind, though no rule says so, as this much.
PRIOR, UNKNOWN = 0.5, 0.25
ROUNDS = 8
#: Longer words are no part of a pattern.
WORD_CHARS = 24

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# what numbers and their separators consist of; a match of the rules below never leaves such an area
_AREA = re.compile(r"[+(0-9][0-9+ ().-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]+")
_AT = re.compile(r"@|[\[({<] ?(?:at|AT) ?[\])}>]| (?:at|AT) (?=[A-Za-z0-9-]{1,63} (?:dot|DOT) )")
_HOST = re.compile(r" ?([A-Za-z0-9-]{1,63})((?:(?:\.| ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?| (?:dot|DOT) )[A-Za-z0-9-]{1,63})*)")
_DOT = re.compile(r"\.| ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?| (?:dot|DOT) ")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in even)) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """As a leftmost search for local part, ``@`` and domain; linear, however long the words."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def _short(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255


def _numbers(text: str, start: int, end: int) -> Iterator[tuple[int, int, int]]:
    for m in _IP.finditer(text, start, end):
        if all(map(_short, m.group().split("."))):
            yield IP, *m.span()
    for m in _CARD.finditer(text, start, end):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield CARD, *m.span()
    for m in _PHONE.finditer(text, start, end):
        if 8 <= sum(map(str.isdigit, m.group())) <= 15:
            yield PHONE, *m.span()


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """``kind, start, end`` of what the rules find, by kind and place, in code points."""
    text = text or ""
    out = [(EMAIL, *s) for s in _emails(text)]
    for area in _AREA.finditer(text):
        out += _numbers(text, *area.span())
    return sorted(out)


def _kinds(digits: list[str]) -> int:
    """Which kinds a number outside of the rules may be, as bits."""
    joined = "".join(digits)
    may = 1 << PHONE if 7 <= len(joined) <= 15 else 0
    if 13 <= len(joined) <= 19 and luhn(joined):
        may |= 1 << CARD
    if len(digits) == 4 and all(map(_short, digits)):
        may |= 1 << IP
    return may


def _form(value: str) -> str:
    return "form " + re.sub("[0-9]", "9", value)


def _word(word: str) -> str:
    return re.sub("[0-9]", "9", word.lower()) if len(word) <= WORD_CHARS else "*"


def _context(text: str, start: int, end: int) -> list[str]:
    """Patterns of the words beside a place; the text's start or end alone is none."""
    before = [_word(w) for w in text[max(0, start - 2 * WORD_CHARS - 4) : start].split()[-2:]]
    after = [_word(w) for w in text[end : end + WORD_CHARS + 2].split()[:1]]
    out = [f"left {before[-1]}"] if before else []
    out += [f"right {after[0]}"] if after else []
    out += [f"around {before[-1] if before else '^'} _ {after[0] if after else '$'}"] if before or after else []
    return out + ([f"left {' '.join(before)}"] if len(before) > 1 else [])


def _key(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass")) - (1 << 63)


def _address(local: str, labels: list[str]) -> tuple[int, list[str]]:
    value = f"{local}@{'.'.join(labels)}".lower()
    return _key(value), [f"host {'.'.join(labels[-2:]).lower()}"] if len(labels) > 1 else []


class _Taken:
    """Spans that other ones may not overlap."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        found = sorted((s, e) for _, s, e in spans)
        self.starts, self.reach = [s for s, _ in found], list(itertools.accumulate((e for _, e in found), max))

    def free(self, start: int, end: int) -> bool:
        i = bisect.bisect_left(self.starts, end)
        return not i or self.reach[i - 1] <= start


def _other_numbers(text: str, start: int, end: int) -> Iterator[tuple[int, int, bool]]:
    """Places in an area that may be numbers of some kind, and whether they are all of it."""

    def lead(k: int) -> int:
        a = groups[k][0]
        return a - (a > start and text[a - 1] in "+(")

    groups = [m.span() for m in _DIGITS.finditer(text, start, end)]
    if not groups:
        return
    whole = (lead(0), groups[-1][1])
    places = {whole} if len(groups) <= 19 else set()
    for i, (a, z) in enumerate(groups):
        if 16 <= z - a <= 19:
            places.add((a, z))
        if text[lead(i)] == "+":
            n = 0
            for k in range(i, len(groups)):
                b, e = groups[k]
                n += e - b
                if n > 15 or k > i and text[lead(k)] == "+":
                    break
                if n >= 8:
                    places.add((lead(i), e))
    for a, z in sorted(places):
        if 7 <= sum(map(str.isdigit, text[a:z])) <= 19 and not (text[a - 1 : a].isalnum() or text[z : z + 1].isalnum()):
            yield a, z, (a, z) == whole


def occurrences(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int, int, list[str]]]]:
    """The rules' spans, and places of instances: ``start, end, kind, kinds, instance, patterns``.

    ``kind`` is -1 and ``kinds`` what it may be, as bits, where no rule matches.
    """
    text, out = text or "", []
    base = [(EMAIL, *s) for s in _emails(text)]
    areas = [m.span() for m in _AREA.finditer(text) if m.end() - m.start() >= 7]
    for a, z in areas:
        base += _numbers(text, a, z)
    for kind, start, end in base:
        value = text[start:end]
        if kind == EMAIL:
            local, _, host = value.partition("@")
            key, found = _address(local, host.split("."))
        else:
            key, found = _key(value if kind == IP else "".join(_DIGITS.findall(value))), [_form(value)]
        out.append((start, end, kind, 0, key, found + _context(text, start, end)))
    taken = _Taken(base)
    for area in areas:
        for start, end, whole in _other_numbers(text, *area):
            if taken.free(start, end):
                digits = _DIGITS.findall(text, start, end)
                found = [_form(text[start:end])] + (_context(text, start, end) if whole else [])
                out.append((start, end, -1, _kinds(digits), _key("".join(digits)), found))
    # other spellings of addresses
    for m in _AT.finditer(text):
        stop = m.start() - (text[m.start() - 1 : m.start()] == " " and m.group()[0] not in " @")
        local, host = _LOCAL.search(text[max(0, stop - 64) : stop]), _HOST.match(text, m.end())
        if local and host:
            start, end = stop - len(local.group()), host.end()
            if taken.free(start, end):
                key, found = _address(local.group(), [host.group(1), *_DOT.split(host.group(2))[1:]])
                out.append((start, end, -1, 1 << EMAIL, key, found + _context(text, start, end)))
    return sorted(base), out


_PLACE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("kinds", pa.int32()), ("instance", pa.int64()), ("patterns", pa.list_(pa.string()))])
_FIELDS = [f.name for f in _PLACE]
_SCANNED = "row long, doc_id long, base array<int>, places array<struct<start:int,end:int,kind:int,kinds:int,instance:long,patterns:array<string>>>"


def scanned(docs: DataFrame) -> DataFrame:
    """``row, doc_id, base, places`` for each row of ``docs``: a number of its own, the rules' spans, and all instances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            base, places = [], []
            for t in b.column(1):
                spans, found = occurrences(t.as_py())
                base.append([x for s in spans for x in s])
                places.append([dict(zip(_FIELDS, p, strict=True)) for p in found])
            ids = pa.array(range(row, row + b.num_rows), pa.int64())
            row += b.num_rows
            yield pa.RecordBatch.from_arrays([ids, b.column(0), pa.array(base, pa.list_(pa.int32())), pa.array(places, pa.list_(_PLACE))], names=["row", "doc_id", "base", "places"])

    return docs.select(F.col("doc_id").cast("long"), "text").transform(mapped, run, _SCANNED)


def _confident(edges: DataFrame, known: DataFrame, support: int, confidence: float) -> DataFrame:
    """``pattern, kind, n, total, confidence`` of the patterns that may tell kinds."""
    marked = edges.join(known, "instance", "left")
    counts = [F.struct(F.count_if(F.col("kind") == k).alias("n"), F.lit(-k).alias("order"), F.count_if(F.col("kind").isNull() & _may(F.col("kinds"), F.lit(k))).alias("open")) for k in range(len(KINDS))]
    found = marked.groupBy("pattern").agg(F.greatest(*counts).alias("best"), F.count("*").alias("total"))
    n, unknown = F.col("best.n"), F.col("best.open")
    share = n / (F.col("total") - (1 - UNKNOWN) * unknown + PRIOR)
    found = found.select("pattern", (-F.col("best.order")).alias("kind"), n.alias("n"), "total", share.alias("confidence"))
    return found.filter((F.col("n") >= support) & (F.col("confidence") >= confidence))


def _may(kinds: Column, kind: Column) -> Column:
    return F.getbit(kinds.cast("long"), kind) == 1


def bootstrapped(found: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Patterns (``pattern, kind, n, total, confidence``) and instances (``instance, kind``) learned from a ``scanned`` table.

    Rounds end when no instance gets a kind any longer, or after ``rounds`` of them.
    An instance that the rules find keeps its kind, the first by the order of
    ``KINDS`` if they find it as several; of the patterns that hold another one, the
    most confident decides among the kinds that it may be.
    """
    places = found.select(F.explode("places").alias("p"))
    edges = places.select("p.instance", "p.kinds", F.explode("p.patterns").alias("pattern"))
    # a pattern of fewer instances can never be confident
    edges = stage_table(edges.groupBy("pattern", "instance").agg(F.bit_or("kinds").alias("kinds")), "edges")
    often = edges.groupBy("pattern").agg(F.count("*").alias("m")).filter(F.col("m") >= support).select("pattern")
    edges = stage_table(edges.join(often, "pattern", "left_semi"), "edges")
    known = stage_table(places.filter("p.kind >= 0").groupBy("p.instance").agg(F.min("p.kind").alias("kind")), "known")
    patterns = stage_table(_confident(edges, known, support, confidence), "patterns")
    for _ in range(rounds):
        open_edges = edges.filter("kinds > 0").join(known, "instance", "left_anti").join(patterns.select("pattern", "kind", "confidence"), "pattern")
        open_edges = open_edges.filter(_may(F.col("kinds"), F.col("kind")))
        # the most confident, and then the first kind
        new = open_edges.groupBy("instance").agg(F.max(F.struct("confidence", (-F.col("kind")).alias("kind"))).alias("best"))
        new = stage_table(new.select("instance", (-F.col("best.kind")).alias("kind")), "known")
        if new.isEmpty():
            break
        known = stage_table(known.unionByName(new), "known")
        patterns = stage_table(_confident(edges, known, support, confidence), "patterns")
    return patterns, known


def find(docs: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, spans`` for each row of ``docs`` (``doc_id, text``).

    ``spans`` are structs of ``kind`` (a name of ``KINDS``), ``start``, ``end``
    (code points, the end is exclusive) and ``base``, whether a rule found it; by
    kind, then place. Learned spans overlap neither those of the rules nor each
    other; of two that would, the longer stays, then the first. Null and empty
    texts have none, repeated rows the same ones each, rows without an id too;
    other columns are ignored; an empty table gives none.
    """
    found = stage_table(scanned(docs), "scanned")
    _, known = bootstrapped(found, support, confidence, rounds)
    open_places = found.select("row", F.explode(F.filter("places", lambda p: p["kind"] < 0)).alias("p")).select("row", "p.start", "p.end", "p.kinds", "p.instance")
    told = open_places.join(known, "instance").filter(_may(F.col("kinds"), F.col("kind")))
    more = stage_table(told.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more")), "more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        for b in batches:
            out = []
            for base, added in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                spans = [(*base[i : i + 3], True) for i in range(0, len(base), 3)]
                out.append([{"kind": KINDS[k], "start": s, "end": e, "base": is_base} for k, s, e, is_base in sorted(spans + _apart(added or []))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, kind)], names=["doc_id", "spans"])

    joined = found.select("row", "doc_id", "base").join(more, "row", "left").select("doc_id", "base", "more")
    return joined.transform(mapped, run, "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean>>")


def _apart(added: list[dict]) -> list[tuple[int, int, int, bool]]:
    """Spans that don't overlap, the longer first."""
    kept: list[tuple[int, int, int, bool]] = []
    starts: list[int] = []
    for size, start, kind in sorted({(p["start"] - p["end"], p["start"], p["kind"]) for p in added}):
        end, i = start - size, bisect.bisect(starts, start)
        if (not i or kept[i - 1][2] <= start) and (i == len(kept) or end <= kept[i][1]):
            starts.insert(i, start)
            kept.insert(i, (kind, start, end, False))
    return kept


def digests(found: DataFrame) -> DataFrame:
    """Counts of the rules' spans by kind, a checksum of these, and all spans as text."""
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    counts = [_count(base, k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
