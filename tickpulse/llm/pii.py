"""Operator 4: personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, URL schemes and identifier
cues. From each anchor a deterministic parser walks outwards to the boundaries of an e-mail address, IPv4
address, card or phone number, URL or account and validates it, in time linear in the text. The four base
kinds are, exactly, the leftmost non-overlapping matches of the patterns in ``BASE`` that pass their test.

Added kinds: ``url`` (scheme and the run after it), ``iban`` (country code and mod-97 check), ``account``
(8 to 18 digits, with hyphens or single spaces between groups, after a cue word of any case). Spans are code points, end exclusive.

Null text counts as empty: no spans. Rows stay as they are (repeated rows and null ids too). Other columns
are not read; ``redact`` keeps them all.
"""

from __future__ import annotations

import hashlib
from itertools import product

import ahocorasick
from pyspark.sql import DataFrame, functions as F

from .common import columns_of, map_texts

#: The base patterns, in the order of the kinds.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*BASE, "url", "iban", "account"]
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "HTTP://", "HTTPS://")
CUES = ("iban", "account", "acct", "konto", "cuenta", "compte")

DIGITS = frozenset("0123456789")
LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
LOCAL = LABEL | frozenset("._%+")
PHONE = DIGITS | frozenset(" ().-")
GROUP = DIGITS | frozenset("-")
URL_STOP = frozenset(" \t\r\n\f\v<>\"'`{}|\\^")
UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for d in DIGITS:
        a.add_word(d, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    for s in SCHEMES:
        a.add_word(s, ("scheme", len(s)))
    for c in CUES:
        for cased in product(*((x, x.upper()) for x in c)):
            a.add_word("".join(cased), ("cue", len(c)))
    a.make_automaton()
    return a


ANCHORS = _automaton()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def iban_ok(s: str) -> bool:
    return 15 <= len(s) <= 34 and s.isalnum() and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _run(text: str, at: int, chars: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in chars:
        at += 1
    return at


def _group(text: str, at: int) -> int:
    """End of the digits and hyphens from ``at``, without hyphens at the end."""
    end = _run(text, at, GROUP)
    while end > at and text[end - 1] == "-":
        end -= 1
    return end


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = _run(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels, stop = 0, end
    while stop < len(text) and text[stop] == ".":
        more = _run(text, stop + 1, LABEL)
        if more == stop + 1:
            break
        labels, stop = labels + 1, more
    return (start, stop) if labels else None


def _iban(text: str, at: int) -> tuple[int, int] | None:
    """From a country code at ``at``: the longest prefix, spaces between groups allowed, that checks."""
    if text[at] not in UPPER or text[at + 1:at + 2] not in UPPER or not text[at + 1:at + 2]:
        return None
    kept, i, ends = "", at, []
    while i < len(text) and len(kept) < 34:
        c = text[i]
        if c in UPPER or c in DIGITS:
            kept += c
            if len(kept) >= 15 and (i + 1 == len(text) or not (text[i + 1] in LABEL)):
                ends.append((kept, i + 1))
        elif c != " " or not kept or text[i - 1] == " ":
            break
        i += 1
    return next(((at, end) for s, end in reversed(ends) if s[2:4].isdigit() and iban_ok(s)), None)


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), by kind as in ``KINDS``, then start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    mail_end = phone_end = digit_end = url_end = account_end = cue_end = 0
    n = len(text)
    for last, (what, size) in ANCHORS.iter(text):
        at = last - size + 1
        if what == "digit":
            if at < digit_end:
                continue
            # every digit of this stretch of digits, single separators and dots is handled here at once
            end = at
            while True:
                end = _run(text, end, DIGITS)
                if end + 1 < n and text[end] in " -." and text[end + 1] in DIGITS:
                    end += 1
                else:
                    break
            digit_end = end
            _numbers(text, at, end, found)
            if at >= 2 and at >= account_end and text[at - 1] in UPPER and text[at - 2] in UPPER \
                    and (at == 2 or text[at - 3] not in LABEL):
                span = _iban(text, at - 2)
                if span:
                    found["iban"].append(span)
                    account_end = span[1]
        elif what == "at":
            span = _email(text, at, mail_end)
            if span:
                found["email"].append(span)
                mail_end = span[1]
        elif what == "plus":
            if at < phone_end or at + 1 >= n or text[at + 1] not in DIGITS:
                continue
            end = _run(text, at + 2, PHONE)
            while end > at + 2 and text[end - 1] not in DIGITS:
                end -= 1
            if end - (at + 2) >= 2:
                phone_end = end
                if 8 <= sum(c in DIGITS for c in text[at:end]) <= 15:
                    found["phone"].append((at, end))
        elif what == "scheme":
            if at < url_end or at and text[at - 1] in LABEL:
                continue
            end = last + 1
            while end < n and text[end] not in URL_STOP:
                end += 1
            while end > last + 1 and text[end - 1] in ".,;:!?)]":
                end -= 1
            if end > last + 1:
                found["url"].append((at, end))
                url_end = end
        else:
            start = max(last + 1, cue_end)  # what an earlier cue has passed over isn't read again
            while start < n and text[start] in " :#.=NOUMBERnoumber°":
                start += 1
            cue_end = start
            end = _group(text, start)
            digits = sum(c in DIGITS for c in text[start:end])
            while 0 < digits < 18 and text[end:end + 1] == " " and text[end + 1:end + 2] in DIGITS:
                stop = _group(text, end + 1)
                digits += sum(c in DIGITS for c in text[end:stop])
                if digits > 18:
                    digits -= sum(c in DIGITS for c in text[end:stop])
                    break
                end = stop
            if start >= account_end and 8 <= digits <= 18:
                found["account"].append((start, end))
                account_end = end
    return [(k, s, e) for k in KINDS for s, e in sorted(found[k])]


def _numbers(text: str, start: int, stop: int, found: dict) -> None:
    """Cards and IPv4 addresses in text[start:stop], a stretch of digits, single spaces, hyphens and dots."""
    at = start
    while at < stop:  # cards: digits with single spaces or hyphens
        end = at
        while end < stop and text[end] != ".":
            end += 1
        if end - at > 1:
            digits = text[at:end].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found["card"].append((at, end))
        at = end + 1
    at = start
    while at < stop:  # addresses: four parts at a time of a dotted chain
        end = at
        while end < stop and text[end] not in " -":
            end += 1
        parts, p = text[at:end].split("."), at
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                found["ip"].append((p, p + size))
            p += size + 1
        at = end + 1


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, counts of the base kinds, base_sha256, spans."""

    def report(texts):
        rows = []
        for text in texts:
            spans = find(text) if text else []
            kinds = [s[0] for s in spans]
            own = joined([s for s in spans if s[0] in BASE])
            rows.append((*map(kinds.count, BASE), hashlib.sha256(own.encode()).hexdigest(), joined(spans)))
        return columns_of(rows, len(BASE) + 2)

    return map_texts(df, [F.col(id_col).cast("long").alias("doc_id")], text_col, lambda: report,
                     {f"n_{k}": "long" for k in BASE} | {"base_sha256": "string", "spans": "string"})


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named
    after the one that starts first (the longer of two that start together)."""
    out, at = [], 0
    spans = sorted(find(text), key=lambda s: (s[1], -s[2]))
    i = 0
    while i < len(spans):
        kind, start, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with personal data replaced in ``text_col``; a null text stays null."""
    others = [f"`{c}`" for c in df.columns if c != text_col]
    out = map_texts(df, others, text_col, lambda: lambda texts: [[t and redacted(t) for t in texts]], {text_col: "string"})
    return out.select(*[f"`{c}`" for c in df.columns])
