"""Personal data by anchor expansion.

One Aho-Corasick automaton runs over each whole text and stops at *anchors*:
at-signs, plus signs, digits, schemes and identifier cues.  A deterministic
parser then expands each anchor to the boundaries of what it stands in and
validates it.  Parsers take each code point a bounded number of times, so a
text costs time in proportion to its length, whatever it holds.

Base kinds, leftmost and non-overlapping per kind (a match that fails its test
is dropped and what it covers is not tried again):

* ``email``  from ``@``: the local part to the left, dotted labels to the right;
* ``ip``     from a digit: four dotted numbers of at most 255;
* ``card``   from a digit: digits with single spaces or dashes between them,
  14 to 19 of them, Luhn sum right;
* ``phone``  from ``+``: 10 to 15 digits.

Kinds the method adds:

* ``uri``     from a scheme: ``mailto:``, ``tel:`` or ``sip:`` with an address
  behind it, ``scheme://`` with user information or an IPv4 host;
* ``account`` from a cue (IBAN, SSN, account, passport and the like): an IBAN
  with the right check digits, a social security number, or a number of 6 to 17
  digits; and a group of digits with the right Luhn sum inside a chain that is
  no card;
* ``tel``     from ``+``: the fewest whole groups with 10 to 15 digits at the
  start of a match that is too long for a phone.

Places are code points, the end exclusive.  Defined cases: null and empty texts
have no spans; every row gives one row, whatever its doc_id; further columns
are ignored by ``find_personal`` and kept by ``redact``; an empty table gives no
rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotaxa.llm.text import Local, read_documents

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "uri", "account", "tel"]
RANK = {kind: i for i, kind in enumerate(KINDS)}
# Words before an identifier, and the schemes of addresses.
CUES = ["iban", "ssn", "social security", "account", "acct", "passport", "konto", "kontonummer",
        "compte", "cuenta", "pasaporte", "passeport", "reisepass", "driver license", "tax id"]
ADDRESS_SCHEMES = ["mailto:", "tel:", "sip:"]
_SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long,value:string>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGITS = re.compile(r"[0-9]++")
_IP = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_GROUP = re.compile(r"[ ().-]{0,3}([0-9]++)")
_DIAL = re.compile(r"\+?[0-9][().0-9-]*[0-9]")
_AUTHORITY = re.compile(r"[^\s/?#<>\"'@]*+(@?)([A-Za-z0-9.-]*+)(?::[0-9]++)?")
_LABEL = re.compile(r"(?:[ ]?(?:number|no|nr|num|id)\b\.?)?[ :#=]{1,3}", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}+")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9]){5,16}(?![0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def iban_ok(value: str) -> bool:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _byte(number: str) -> bool:
    short = number.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for c in "0123456789":
        found.add_word(c, "digit")
    found.add_word("@", "at")
    found.add_word("+", "plus")
    found.add_word("://", "scheme")
    for s in ADDRESS_SCHEMES:
        found.add_word(s, "address")
    for cue in CUES:
        for form in {cue, cue.capitalize(), cue.title(), cue.upper()}:
            found.add_word(form, "cue")
    found.make_automaton()
    return found


class Parser:
    """The local parsers over one text; each gets the last code point of its anchor."""

    def __init__(self, text: str):
        self.text = text
        self.spans: list[tuple[int, int, int]] = []  # start, rank of the kind, end
        self.mail_end = self.ip_end = self.card_end = self.uri_end = self.account_end = 0

    def add(self, kind: str, start: int, end: int) -> None:
        self.spans.append((start, RANK[kind], end))

    def at(self, i: int) -> None:
        text = self.text
        domain = _DOMAIN.match(text, i + 1)
        if not domain:
            return
        start = i
        while start > self.mail_end and text[start - 1] in _LOCAL:
            start -= 1
        if start < i:
            self.mail_end = domain.end()
            self.add("email", start, domain.end())

    def digit(self, i: int) -> None:
        if i >= self.ip_end:
            found = _IP.match(self.text, i)
            # Without four numbers from here, none starts inside this one either.
            self.ip_end = found.end() if found else _DIGITS.match(self.text, i).end()
            if found and all(_byte(x) for x in found.groups()):
                self.add("ip", i, found.end())
        if i >= self.card_end:
            found = _CARD.match(self.text, i)
            self.card_end = found.end() if found else i + 1
            if not found or found.end() - i < 14:
                return
            digits = found.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                self.add("card", i, found.end())
            else:
                self.inside(i, found.end())

    def inside(self, start: int, end: int) -> None:
        """Groups of 14 to 19 digits, or of four times four, in a longer chain."""
        groups = [(m.start(), m.end()) for m in _DIGITS.finditer(self.text, start, end)]
        at = 0
        while at < len(groups):
            lo, hi = groups[at]
            four = groups[at:at + 4]
            if 14 <= hi - lo <= 19 and luhn(self.text[lo:hi]):
                self.add("account", lo, hi)
            elif len(four) == 4 and all(b - a == 4 for a, b in four) and luhn("".join(self.text[a:b] for a, b in four)):
                self.add("account", lo, four[-1][1])
                at += 3
            at += 1

    def plus(self, i: int) -> None:
        found = _PHONE.match(self.text, i)
        if not found:
            return
        n = sum(c.isdigit() for c in found.group())
        if 10 <= n <= 15:
            self.add("phone", i, found.end())
        elif n > 15:
            at, total = i + 1, 0
            while total < 10 and (group := _GROUP.match(self.text, at, found.end())):
                total, at = total + len(group.group(1)), group.end()
            if 10 <= total <= 15:
                self.add("tel", i, at)

    def address(self, i: int) -> None:
        start = i
        while start > 0 and self.text[start - 1].isalpha():
            start -= 1
        if self.text[start:i + 1] not in ADDRESS_SCHEMES or start < self.uri_end:
            return
        found = _DIAL.match(self.text, i + 1) if self.text.startswith("tel:", start) else _EMAIL.match(self.text, i + 1)
        if found and (found.re is _EMAIL or 7 <= sum(c.isdigit() for c in found.group()) <= 15):
            self.uri_end = found.end()
            self.add("uri", start, found.end())

    def scheme(self, i: int) -> None:
        start = i - 2
        while start > self.uri_end and self.text[start - 1].isascii() and self.text[start - 1].isalpha():
            start -= 1
        host = _AUTHORITY.match(self.text, i + 1)
        address = _IP.fullmatch(host.group(2) or self.text[i + 1:host.end()].split(":")[0])
        named = host.group(1) and "." in host.group(2)
        if start < i - 2 and (named or (address and all(_byte(x) for x in address.groups()))):
            self.uri_end = host.end()
            self.add("uri", start, host.end())

    def cue(self, i: int) -> None:
        label = _LABEL.match(self.text, i + 1)
        if not label or label.end() < self.account_end:
            return
        at = label.end()
        found = _IBAN.match(self.text, at)
        if found:
            end = found.end()
            value = found.group().replace(" ", "")
            if not iban_ok(value):
                found = None
        else:
            found = _SSN.match(self.text, at) or _NUMBER.match(self.text, at)
            end = found.end() if found else at
        if found:
            self.account_end = end
            self.add("account", at, end)


def spans_of(text: str, anchors: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of all spans of a text, sorted."""
    parser = Parser(text)
    parse = {"at": parser.at, "digit": parser.digit, "plus": parser.plus,
             "address": parser.address, "scheme": parser.scheme, "cue": parser.cue}
    done = 0  # digits before this place belong to chains that are settled
    for end, kind in anchors.iter(text):
        if kind != "digit":
            parse[kind](end)
        elif end >= done:
            parser.digit(end)
            done = min(parser.ip_end, parser.card_end)
    return sorted(set(parser.spans))


_anchors = Local()


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if _anchors.value is None:
        _anchors.value = automaton()
    for batch in batches:
        rows = []
        for cell in batch.column("text"):
            text = cell.as_py() or ""
            rows.append([{"kind": KINDS[rank], "start": start, "end": end, "value": text[start:end]}
                         for start, rank, end in spans_of(text, _anchors.value)])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, _SPANS)], ["doc_id", "spans"])


def find_personal(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of (kind, start,
    end, value) by start, then kind in the order of ``KINDS``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_find, _SCHEMA)


def _hide(texts: Iterator) -> Iterator:
    import pandas as pd

    if _anchors.value is None:
        _anchors.value = automaton()
    for column in texts:
        out = []
        for text in column:
            if text is None:
                out.append(None)
                continue
            parts, at = [], 0
            for start, rank, end in spans_of(text, _anchors.value):
                if end <= at:
                    continue
                if start >= at:
                    parts += [text[at:start], f"[{KINDS[rank].upper()}]"]
                at = end  # an overlapping span lengthens what the mark stands for
            out.append("".join(parts) + text[at:])
        yield pd.Series(out, dtype=object)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by the mark of its kind."""
    from collections.abc import Iterator as Batches

    import pandas as pd

    def hide(texts: Batches[pd.Series]) -> Batches[pd.Series]:
        return _hide(texts)

    hide.__annotations__ = {"texts": Batches[pd.Series], "return": Batches[pd.Series]}
    return docs.withColumn("text", F.pandas_udf(hide, "string")("text"))


def op12_personal_data(spark, sf_dir: str) -> DataFrame:
    found = find_personal(read_documents(spark, sf_dir, "doc_id", "text"))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    base = F.filter("spans", lambda s: s["kind"].isin(BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
