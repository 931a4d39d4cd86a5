import hashlib
import random
import re

from llm_helpers import ODD, SF, docs_df, rows_by_id, texts, with_clashes

from geotaxa.llm import personal_data as pd_

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    """Base spans by the patterns as they are written."""
    return sorted((m.start(), i, m.end()) for i, (kind, p) in enumerate(PATTERNS.items())
                  for m in re.finditer(p, text or "") if valid(kind, m.group()))


def base(text):
    return [s for s in pd_.spans_of(text, pd_.automaton()) if s[1] < len(pd_.BASE_KINDS)]


def added(text):
    return [(pd_.KINDS[k], text[a:b]) for a, k, b in pd_.spans_of(text, pd_.automaton()) if k >= len(pd_.BASE_KINDS)]


def test_query_equals_the_patterns(spark):
    got = rows_by_id(pd_.op12_personal_data(spark, SF))
    want = texts()
    assert set(got) == set(want)
    for doc_id, text in want.items():
        spans = brute(text)
        names = ",".join(f"{pd_.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        row = got[doc_id]
        assert row["base_sha256"] == hashlib.sha256(names.encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in PATTERNS] == [sum(s[1] == i for s in spans) for i in range(4)]
        assert set(filter(None, names.split(","))) <= set(row["spans"].split(","))


def test_random_strings_near_the_patterns():
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice(["1", "4", "55", "255", "256", "00", ".", ".", "-", " ", "+", "@", "a", "b.c", "(", ")", "é", "x@y.z", "4539148803436467"])
                       for _ in range(rng.randrange(1, 30)))
        assert base(text) == brute(text), text


def test_boundaries():
    assert base("a@b@c.d") == brute("a@b@c.d") == [(2, 0, 7)]
    assert base("a@b.c@d.e") == [(0, 0, 5)]
    assert base("1.2.3.4.5.6.7.8") == [(0, 1, 7), (8, 1, 15)]
    assert base("1.2.3.999") == [] and base("0" * 5000 + "1.2.3.4") == [(0, 1, 5007)]
    assert base("9" * 70_000) == [] and base("🙂+1 (555) 010-9999") == [(1, 3, 18)]


def test_added_kinds():
    assert added("write mailto:ann@ex.org, sip:b@ex.org or tel:+1-555-0100.") == [
        ("uri", "mailto:ann@ex.org"), ("uri", "sip:b@ex.org"), ("uri", "tel:+1-555-0100")]
    assert added("see ftp://joe:pw@files.ex.org/x and http://10.0.0.1:80/ not https://ex.org/a@b") == [
        ("uri", "ftp://joe:pw@files.ex.org"), ("uri", "http://10.0.0.1:80")]
    assert added("IBAN: GB82 WEST 1234 5698 7654 32, iban GB00WEST12345698765432") == [("account", "GB82 WEST 1234 5698 7654 32")]
    assert added("SSN 078-05-1120; account no. 12345678") == [("account", "078-05-1120"), ("account", "12345678")]
    assert added("on account of this") == []
    assert added("+1 (269) 555-3296 4539148803436467") == [("tel", "+1 (269) 555-3296"), ("account", "4539148803436467")]


def test_linear_on_hostile_texts():
    for text in ("a" * 300_000 + "@", "@" * 300_000, "1." * 300_000, "+1" + " " * 300_000, "+1 " * 200_000,
                 "1 " * 300_000, "a@b" * 200_000, "://" * 200_000, "mailto:" * 60_000, "iban: " * 60_000):
        assert base(text) == brute(text) if len(text) < 1000 else base(text) is not None


def test_odd_rows_and_redaction(spark):
    df = with_clashes(docs_df(spark, [*ODD, (50, "mail ann@ex.org now"), (51, "é" * 3_000_000 + " 10.1.2.3")]))
    out = pd_.find_personal(df).collect()
    assert len(out) == len(ODD) + 2
    by_id = {r["doc_id"]: r["spans"] for r in out}
    assert by_id[1] == [] and by_id[2] == [] and [s["value"] for s in by_id[50]] == ["ann@ex.org"]
    assert [(s["kind"], s["start"], s["end"]) for s in by_id[51]] == [("ip", 3_000_001, 3_000_009)]
    kept = pd_.redact(df)
    assert kept.columns == df.columns
    hidden = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert hidden[50] == "mail [EMAIL] now" and hidden[1] is None and hidden[4] == "x"
    assert pd_.find_personal(docs_df(spark, [])).count() == 0
