import hashlib
import re

import pytest

from trawl.llm import pii


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m)


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15)]

TEXTS = ["", None, "a@b.com_x@y.org", "a@b@c.d.e", "x@y", ".@a.b", "é mail: jo.hn+x@ex-ample.co.uk, 日本 10.0.0.1",
         "1.2.3.4.5.6.7.8", "1..2.3.4.5", "256.1.1.1 255.255.255.255 001.002.003.0004 0000.0.0.0 999999999999.1.1.1",
         "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "4111  1111 1111 1111 4111111111111111000",
         "call +1 (743) 555-3824 or +44 20 7946 0958. +1234567", "+1", "+1 2", "+1-23456789012345678", "+1 555 555 1234 +1 555 555 1234)",
         "4111 1111 1111 1111 2", "5500005555555559 1", "😀 a@b.co 😀 +1 (743) 555-3824 10.1.2.3", "a" * 200_000, "1" * 200_000,
         "a@b.c " * 3000, "+" * 50_000, "@" * 50_000, "1.1.1.1 " * 1000, ("x" * 50_000) + "@a.b", "a@" + "b." * 20_000 + "c", "1 " * 50_000]


def _base(text):
    text = text or ""
    return [(k, m.start(), m.end()) for k, p, ok in BASE for m in re.finditer(p, text) if ok(m[0])]


def _listed(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


@pytest.fixture(scope="module")
def found(spark):
    slow = {"a" * 200_000, "1" * 200_000}                      # the plain expressions need a square here
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "z@z.zz"), (3, TEXTS[6]), (3, TEXTS[6])]
    docs = spark.createDataFrame([(d, t, "x", []) for d, t in rows], "doc_id long, text string, row string, base array<int>")
    return rows, slow, pii.find(docs).collect()


def test_base_spans_match_the_plain_expressions(found):
    rows, slow, got = found
    want = sorted(((d, _base(t)) if t not in slow else (d, []) for d, t in rows), key=str)
    have = sorted(((r.doc_id, r) for r in got), key=lambda x: str((x[0], [tuple(s.split(":")) for s in x[1].spans.split(",")])))
    assert len(have) == len(want)
    key = lambda d, n, h, s: (str(d), n, h, s)
    assert sorted(key(d, [sum(k == x for k, *_ in b) for x in pii.KINDS], hashlib.sha256(_listed(b).encode()).hexdigest(), _listed(b))
                  for d, b in want) == \
        sorted(key(r.doc_id, [r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256, r.spans) for _, r in have)


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"please write to me: user{i}@mail.example now") for i in range(40)]
    rows += [(100, "please write to me: user77.mail.example now"), (101, "elsewhere user77.mail.example is named"),
             (102, "clean text with number 12345678 and v2.10.3-rc1"), (103, "of the user88.mail.example")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].n_email == 1 and got[i].n_found == 0 for i in range(40))
    assert {i: r.spans for i, r in got.items() if r.n_found} == {}
    # The same shape as known addresses after the same words: a card that fails its check digit.
    rows = [(i, f"my card number is {c} thanks") for i, c in enumerate(_cards(30))]
    bad = "4111 1111 1111 1112"
    rows += [(50, "my card number is 4111111111111112 thanks"), (51, "later 4111111111111112 again"), (52, "an order 4111111111111113 here"), (53, bad)]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.spans for i, r in got.items() if r.n_found} == {50: "card:18:34", 51: "card:6:22"}
    assert got[50].n_card == 0 and got[50].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_contexts_find_other_shapes_and_several_tokens(spark):
    rows = [(i, f"please call me on +1-555-{100 + i}-{4000 + i} today") for i in range(30)]
    rows += [(50, "please call me on 555-123-4567 today"), (51, "and 555-123-4567, again"), (52, "please call me on (555) 123 9999 today"),
             (53, "now ring 555-123-4567 maybe"), (54, "item 555-000-1111 sold"), (55, "please call me on 12 today")]
    rows += [(60 + i, f"my address is user{i}@mail.example ok") for i in range(30)]
    rows += [(95, "my address is jo at mail dot example ok"), (96, "meet at noon")]
    # Found strings seed the next rounds: a phrase that only they have leads on.
    rows += [(100 + i, f"please call me on 555-77{i}-4567 today") for i in range(6)]
    rows += [(110 + i, f"fax line: 555-77{i}-4567 here") for i in range(6)] + [(120, "fax line: 444 333 2222 here")]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.n_found}
    want = {50: "phone:18:30", 51: "phone:4:16", 52: "phone:18:32", 53: "phone:9:21", 95: "email:14:36", 120: "phone:10:22"}
    want |= {100 + i: "phone:18:30" for i in range(6)} | {110 + i: "phone:10:22" for i in range(6)}
    assert got == want


def test_a_phrase_of_a_third_of_all_mentions(spark, monkeypatch):
    """The join with the qualified patterns, broadcast and not, with one pattern in most rows."""
    rows = [(i, f"call me on +1-555-{100 + i}-{4000 + i} today") for i in range(60)]
    rows += [(100 + i, f"call me on 555-{100 + i % 9}-7777 today") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((r.doc_id, r.spans) for r in pii.find(docs).collect())
    assert all(s for _, s in want)
    monkeypatch.setattr(pii.common, "BROADCAST_BYTES", 0)
    assert sorted((r.doc_id, r.spans) for r in pii.find(docs).collect()) == want


def test_held_out_strings_are_found_again(spark):
    rows = [(i, f"please call me on +1-555-{100 + i}-{4000 + i} today") for i in range(60)]
    rows += [(100 + i, f"my address is user{i}@mail.example ok") for i in range(60)]
    rows += [(200 + i, f"word{i} 4111 1111 1111 1111 word{i} {i}{i}{i}.{i}") for i in range(20)]
    r = pii.held_out(spark.createDataFrame(rows, "doc_id long, text string"), share=0.3).first()
    assert 15 < r.hidden < 60 and r.right == r.found >= 0.9 * r.hidden - 1 and r.added == r.found


def _cards(n):
    out, x = [], 4000000000000000
    while len(out) < n:
        x += 7919
        if luhn(str(x)):
            out.append(str(x))
    return out


def test_empty(spark):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).collect() == []
