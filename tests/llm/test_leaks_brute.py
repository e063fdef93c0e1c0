"""Leaks against a brute-force search of every item in every document."""

import random

import pytest
import regex

from linkwright.llm import decontaminate as D


def tokens(text, initials):
    t = regex.sub("[\x01-\x04]", "", text or "")
    t = regex.sub(r"(?<=\p{Nd})[.,](?=\p{Nd})", "\x03", t)
    t = regex.sub(r"(?<=[^.!?:;\s][ \t]{1,3})(\p{Lu}[\p{L}\p{M}'’-]*)", "\x01\\1", t)
    if initials:
        t = regex.sub(r"(?<![\p{L}\p{M}\p{N}\x01-\x03])(?<![\p{L}\p{M}]['’-]{1,2})(\p{Lu}[\p{L}\p{M}'’-]*)", "\x04\\1", t)
    t = regex.sub(r"(?<![\p{L}\p{M}\p{N}\x01-\x03])(\p{Nd}+(?:\x03\p{Nd}+)*)", "\x02\\1", t.lower())
    return [x for x in regex.split(r"[^\p{L}\p{M}\p{N}\x01-\x04]+", t) if x]


def kind(t):
    if t[0] == "\x01":
        return "<name>"
    return "<number>" if t[0] == "\x02" or t in D.NUMBER_WORDS else "<unit>" if t in D.UNITS else None


def slot_kind(t):
    return "<name>" if t[0] == "\x04" else kind(t)


def readings(window):
    """The window with words that may be names as themselves, and as names."""
    plain = tuple(kind(t.lstrip("\x04")) or t.lstrip("\x04") for t in window)
    return {plain, tuple("<name>" if t[0] == "\x04" else p for t, p in zip(window, plain, strict=True))}


def slots_at(it, dt, shift, ats):
    """The item's slots covered by windows at ``ats``, with what stands in their places; unsure names only beside sure ones."""
    pairs = set()
    for k, t in enumerate(it):
        if slot_kind(t) and any(a <= k < a + D.WINDOW for a in ats) and 0 <= shift + k < len(dt) and slot_kind(dt[shift + k]) == slot_kind(t):
            o = dt[shift + k]
            pairs.add((t.replace("\x04", "\x01"), o.replace("\x04", "\x01"), t[0] == o[0] == "\x04"))
    sure = [p for p in pairs if not p[2]]
    return {p[:2] for p in pairs if not p[2] or any(p[0] == s[0] or p[1] == s[1] for s in sure)}


def brute(docs, items, initials):
    out = {}
    for j, item in items:
        it = tokens(item, initials)
        w = min(D.WINDOW, len(it))
        if not it:
            continue
        item_windows = [readings(it[k : k + w]) for k in range(len(it) - w + 1)]
        for i, doc in docs:
            dt = tokens(doc, initials)
            places = {}
            for at in range(len(dt) - w + 1):
                g = readings(dt[at : at + w])
                for k, h in enumerate(item_windows):
                    if g & h:
                        places.setdefault(at - k, set()).add(k)
            if not places:
                continue
            share = len(set().union(*places.values())) / len(item_windows)
            most = max(map(len, places.values()))
            judged = []
            for shift, ats in places.items():
                if len(ats) == most or len(ats) >= D.MIN_SHARE * len(item_windows):
                    pairs = slots_at(it, dt, shift, ats)
                    fine = len({p[0] for p in pairs}) == len(pairs) == len({p[1] for p in pairs})
                    judged.append((fine, len(ats), -shift, len({p[0] for p in pairs})))
            fine, _, _, slots = max(judged)
            out[(i, j)] = (round(share, 9), slots, fine, share >= D.MIN_SHARE and fine)
    return out


@pytest.mark.parametrize("initials", [False, True])
def test_matches_brute_force(spark, initials):
    rng = random.Random(13)
    common = "the cat sat on a mat with three red hats and then it ran".split()
    names, numbers = ["Anna", "Bob", "Zoë", "Ünal"], ["3", "12", "7.5", "1,000"]

    def text(n):
        w = [rng.choice(common) if rng.random() < 0.6 else rng.choice([*names, *numbers, "kg", "miles", "word%d" % rng.randrange(40)]) for _ in range(n)]
        return " ".join(x + (rng.choice([".", ",", "!"]) if rng.random() < 0.1 else "") for x in w)

    def changed(item):
        swap = dict(zip([*names, *numbers], rng.sample([*names, *numbers], 8), strict=True)) if rng.random() < 0.5 else {}
        if rng.random() < 0.3:  # mixed up: no one name or number for another
            return " ".join(rng.choice(names) if x in names else rng.choice(numbers) if x in numbers else x for x in item.split())
        return " ".join(swap.get(x, x) if rng.random() < 0.97 else "changed" for x in item.split())

    items = [(j, text(rng.randint(3, 30))) for j in range(25)]
    docs = [(i, " ".join([text(rng.randint(0, 40)), changed(rng.choice(items)[1]), text(rng.randint(0, 40))])) for i in range(60)]
    got = D.find_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), initials=initials).collect()
    want = brute(docs, items, initials)
    assert {(r.doc_id, r.item_id): (round(r.share, 9), r.slots, r.consistent, r.leaked) for r in got} == want
    assert any(w[3] and w[1] for w in want.values()) and any(not w[2] for w in want.values())


def test_number_words_and_units(spark):
    item = "A farmer sold three litres of milk each day for two weeks and kept the rest at home with him."
    docs = [(1, item.replace("three", "7").replace("two", "nine").replace("litres", "gallons")), (2, item.replace("milk", "wine").replace("rest", "best").replace("farmer", "man"))]
    found = D.find_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"), initials=True).collect()
    assert {r.doc_id: r.leaked for r in found} == {1: True, 2: False} or {r.doc_id for r in found if r.leaked} == {1}
