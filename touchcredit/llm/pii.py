r"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits,
``://`` and identifier cues.  A deterministic local parser expands each anchor
to the boundaries of its span and validates it; nothing else of the text is
scanned again.

Kinds, in the order of the output:

* ``email``, ``ip``, ``card``, ``phone``: leftmost, non-overlapping per kind;
  a match that fails its check (address part over 255, 13 to 19 digits and the
  Luhn sum, 9 to 15 digits) is dropped and its characters are not tried again.
* ``account``: the identifier after a cue such as ``IBAN``, ``SSN`` or
  ``account number`` in any case, or after an opening bracket or quote there; IBANs must pass their checksum, SSNs their shape, other
  identifiers have 6 to 20 digits.
* ``login``: user name and password before the host of a URL.

Defined cases: NULL text counts as empty (no spans, checksum of the empty
string); texts of any length are scanned whole, in linear time; repeated rows
and NULL ids give a row each; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship, strings

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "account", "login")
CUES = ("iban", "ssn", "social security number", "account number", "account no", "acct", "passport number",
        "passport no", "routing number", "sort code")

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE_BODY = re.compile(r"[ ().0-9-]+")
_AFTER_CUE = re.compile(r"""(?: (?:is|no\.?|number))?(?:[\s:#=.]{1,4}[(\[{<"'“‘„«]{0,2}|[(\[{<"'“‘„«]{1,2})""", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])")
_ACCOUNT = re.compile(r"[A-Za-z]{0,3}[0-9](?:[ -]?[0-9]){5,19}(?![0-9])")
_LOGIN = re.compile(r"[^\s/@:]+:[^\s/@]+@")


@functools.lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("scheme", 3))
    for cue in CUES:
        a.add_word(cue, ("cue", len(cue)))
    a.make_automaton()
    return a


def _folded(text: str) -> str:
    """The text with A-Z in lower case and every offset as it was."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _iban_end(text: str, m: re.Match) -> int | None:
    """End of the longest prefix of the match that passes the checksum."""
    for end in range(m.end(), m.start() + 14, -1):
        code = text[m.start():end].replace(" ", "")
        if text[end - 1] != " " and not text[end:end + 1].isalnum() and 15 <= len(code) <= 34:
            if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
                return end
    return None


def _account(text: str, at: int) -> tuple[int, int] | None:
    m = _AFTER_CUE.match(text, at)
    if not m:
        return None
    start = m.end()
    if (iban := _IBAN.match(text, start)) and (end := _iban_end(text, iban)):
        return start, end
    if found := _SSN.match(text, start) or _ACCOUNT.match(text, start):
        return found.span()
    return None


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by kind as listed, then start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    email_from = ip_from = card_from = phone_from = 0
    for last, (anchor, length) in _anchors().iter(_folded(text)):
        i = last - length + 1
        if anchor == "digit":
            if i >= card_from:
                m = _CARD.match(text, i)
                card_from = m.end() if m else i + 1
                if m and 13 <= m.end() - i:
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and _luhn(digits):
                        found["card"].append(m.span())
            if i >= ip_from:
                run = _DIGITS.match(text, i).end()
                ip_from = run  # no other start within this run can match either
                if text[run:run + 1] == "." and (m := _IP.match(text, i)):
                    ip_from = m.end()
                    parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
                    if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                        found["ip"].append(m.span())
        elif anchor == "at":
            start = i
            while start > email_from and text[start - 1] in _LOCAL:
                start -= 1
            if start < i and (m := _DOMAIN.match(text, i + 1)):
                found["email"].append((start, m.end()))
                email_from = m.end()
            else:
                email_from = max(email_from, i + 1)
        elif anchor == "plus":
            if i >= phone_from and "0" <= text[i + 1:i + 2] <= "9" and (m := _PHONE_BODY.match(text, i + 2)):
                body = m.group().rstrip(" ().-")
                if len(body) >= 2:  # digit, at least one character, digit
                    phone_from = i + 2 + len(body)
                    if 9 <= 1 + sum("0" <= c <= "9" for c in body) <= 15:
                        found["phone"].append((i, phone_from))
        elif anchor == "cue":
            if not text[i - 1:i].isalpha() and (span := _account(text, last + 1)):
                found["account"].append(span)
        elif m := _LOGIN.match(text, last + 1):
            found["login"].append((m.start(), m.end() - 1))
    return [(k, s, e) for k in KINDS for s, e in sorted(set(found[k]))]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "n_account long, n_login long")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts per kind, digest of the base spans, all spans."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [find_spans(t) for t in strings(b.column(1))]
            base = [joined([s for s in r if s[0] in BASE]) for r in rows]
            counts = {k: pa.array([sum(s[0] == k for s in r) for r in rows], pa.int64()) for k in KINDS}
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), *(counts[k] for k in BASE),
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string()),
                 pa.array(map(joined, rows), pa.string()), counts["account"], counts["login"]],
                [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(id_col, text_col).mapInArrow(run, SCHEMA)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by ``<kind>``; overlapping spans become one mark."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{kind}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])
