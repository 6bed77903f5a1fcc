from __future__ import annotations

import hashlib
import re
import time

from pagequarry.llm import pii

# the rules as they are stated, without any care for time
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def plain(text):
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    return sorted(out + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15])


PARTS = ["+1 (269) 555-3296", "4845168114407329", "4845 1681 1440 7329", "1.2.3.4", "300.1.2.3", "010.000.1.255", "a@b.c", "x.y+z@mail.example.com", "@", "a@b", ".", "-", " ", "(", "+", "9", "é", "\n", "0", "1."]
PARTS += ["tel: 020 7946 0958", "a (at) b.c", "joe at host dot com", "(at)", "..", "1-2"]


def test_rules_equal_plain_patterns(rnd):
    for _ in range(5000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 10)))
        want = plain(text)
        base, found = pii.occurrences(text)
        assert pii.base_spans(text) == want == base
        for start, end, kind, *_ in found:
            assert (kind, start, end) in want if kind >= 0 else not any(s < end and start < e for _, s, e in want)


def test_long_runs_take_linear_time():
    began = time.time()
    for part in ("1", "1.", "1 ", "+1", "a@", "(", "a", "+12345678"):
        pii.occurrences(part * 50_000 + "@")
    assert time.time() - began < 30


def card(n):
    digits = f"4{n:014d}"
    return next(digits + str(c) for c in range(10) if luhn(digits + str(c)))


def found(docs, rows, **options):
    return {r["doc_id"]: r for r in pii.find(docs(rows), **options).collect()}


def text_of(text, r):
    return [(s["kind"], text[s["start"] : s["end"]], s["base"]) for s in r["spans"]]


def test_unseen_identifiers_by_form_context_and_host(docs):
    rows = [f"Word{chr(97 + i)} said +1 (2{i:02d}) 555-01{i:02d} today {card(i)} or u{i}@mail{i}.example.org" for i in range(12)]
    rows += [f"reach me under tel: +44 20 79{i:02d} 0958 soon" for i in range(12)]
    # a rule takes both numbers for one and drops it
    rows.append(f"both +1 (299) 555-0199 {card(77)} here")
    rows.append("reach me under tel: 0131 496 0123 soon")
    rows.append("or by post joe.bloggs (at) mail.example (dot) org please")
    rows.append("the years 1990 1991 1992 and order 55501 of 2020, 3 at noon dot matrix")
    got = found(docs, rows)
    at = len(rows)
    assert text_of(rows[at - 4], got[at - 4]) == [("card", card(77), False), ("phone", "+1 (299) 555-0199", False)]
    assert text_of(rows[at - 3], got[at - 3]) == [("phone", "0131 496 0123", False)]
    assert text_of(rows[at - 2], got[at - 2]) == [("email", "joe.bloggs (at) mail.example (dot) org", False)]
    assert got[at - 1]["spans"] == []
    for i, text in enumerate(rows):
        assert [(pii.KINDS.index(s["kind"]), s["start"], s["end"]) for s in got[i]["spans"] if s["base"]] == plain(text)


def test_contexts_that_hold_other_numbers_tell_nothing(docs):
    rows = [f"number {i} is +1 (2{i:02d}) 555-01{i:02d} now" for i in range(6)] + [f"which is 20{i:02d}-555-01{i:02d} now" for i in range(6)]
    assert not [s for r in found(docs, rows).values() for s in r["spans"] if not s["base"]]


def test_rounds_reach_what_learned_instances_show(docs):
    rows = [f"tel: +44 20 79{i:02d} 0958." for i in range(10)]
    # learned by context, and then seen beside other words
    rows += [f"tel: 0131 49{i} 0123 ." for i in range(2)] + [f"Fax<{i}> and zzz 0141 49{i} 0123" for i in range(0)]
    got = found(docs, rows)
    assert [text_of(rows[i], got[i]) for i in (10, 11)] == [[("phone", f"0131 49{i} 0123", False)] for i in range(2)]
    shown = docs(rows + ["elsewhere 0131 490 0123 stands alone"])
    assert [s["base"] for s in {r["doc_id"]: r for r in pii.find(shown).collect()}[12]["spans"]] == [False]


def test_copies_are_one_instance(docs):
    rows = ["only +1 (212) 555-0100 here"] * 40 + ["only 212 555 0199 here"]
    assert not found(docs, rows)[40]["spans"]


def test_digests_and_odd_rows(docs):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "é a@b.c 1.2.3.4", "en", "s", 0), (3, "é a@b.c 1.2.3.4", "en", "s", 0), (None, "a@b.c", "en", "s", 0), (4, "x" * 300_000 + " +1234567890", "en", "s", 0)]
    df = docs(rows).selectExpr("*", "1 as row", "2 as spans", "3 as base", "4 as `a.b`")
    got = sorted((tuple(r) for r in pii.digests(pii.find(df)).collect()), key=repr)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    both = "email:2:7,ip:8:15"
    long = "phone:300001:300012"
    want = [(1, 0, 0, 0, 0, sha(""), ""), (2, 0, 0, 0, 0, sha(""), ""), (3, 1, 1, 0, 0, sha(both), both), (3, 1, 1, 0, 0, sha(both), both), (4, 0, 0, 0, 1, sha(long), long), (None, 1, 0, 0, 0, sha("email:0:5"), "email:0:5")]
    assert got == sorted(want, key=repr)
    assert pii.find(docs(rows).limit(0)).count() == 0


def test_graph_equals_brute_force(docs, rnd):
    words = ["card", "mail", "the", "of"]
    value = lambda: rnd.choice([f"+1 (2{rnd.randrange(100):02d}) 555-01{rnd.randrange(100):02d}", f"0{rnd.randrange(100, 130)} 496 0{rnd.randrange(100, 120)}", card(rnd.randrange(40)), f"4{rnd.randrange(30):015d}"])
    rows = [" x ".join(f"{rnd.choice(words)} {value()} {rnd.choice(words)}" for _ in range(3)) for _ in range(150)]
    rows += [f"tel {f'+1 (3{i:02d}) 555-0188' if i % 5 else f'0{900 + i} 496 0123'} {rnd.choice(words)}" for i in range(60)]
    places = [p for r in rows for p in pii.occurrences(r)[1]]
    edges, known = {}, {}
    for _, _, kind, kinds, key, patterns in places:
        for p in patterns:
            edges[p, key] = edges.get((p, key), 0) | kinds
        if kind >= 0:
            known[key] = min(kind, known.get(key, 9))
    for turn in range(9):
        sure = {}
        for pattern in {p for p, _ in edges}:
            held = [(known.get(k), kinds) for (p, k), kinds in edges.items() if p == pattern]
            n, kind = max((sum(h == k for h, _ in held), -k) for k in range(4))
            spare = sum(h is None and kinds >> -kind & 1 for h, kinds in held)
            share = n / (len(held) - 0.75 * spare + 0.5)
            if n >= 4 and share >= 0.7:
                sure[pattern] = (-kind, n, len(held), share)
        new = {}
        for (p, key), kinds in edges.items():
            if p in sure and key not in known and kinds >> sure[p][0] & 1:
                new[key] = max(new.get(key, (0, -9)), (sure[p][3], -sure[p][0]))
        if not new or turn == 8:
            break
        known |= {k: -v[1] for k, v in new.items()}
    got_patterns, got_known = pii.bootstrapped(pii.scanned(docs(rows)), support=4, confidence=0.7)
    assert {r["instance"]: r["kind"] for r in got_known.collect()} == known
    assert {r["pattern"]: (r["kind"], r["n"], r["total"], r["confidence"]) for r in got_patterns.collect()} == sure
    assert any(p.startswith("left") for p in sure) and len(known) > sum(1 for _ in {p[4] for p in places if p[2] >= 0})
