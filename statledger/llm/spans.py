"""Fixed span patterns over one text, and the digest columns made from spans.

Offsets are code points, ends exclusive. Every pattern is scanned in time linear in the text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds in the order in which spans with one start are listed.
PII_KINDS = ("email", "ip", "card", "phone", "id")
SECRET_KINDS = ("assign", "access", "hex", "other")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ASSIGN = re.compile(
    r"(?:(?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
# Key formats that the three base kinds do not cover.
_OTHER = re.compile(
    r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{20,}"
    r"|sk-[A-Za-z0-9_-]{24,}|AIza[A-Za-z0-9_-]{30,}"
    r"|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})"
    r"|-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"
)


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            found.append((start, host.end()))
        done = host.end() if host else at + 1
        at = text.find("@", done)
    return found


def pii_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base kinds, in order."""
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def secret_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind number, end, secret)`` of the base kinds and other key formats, in order."""
    found = []
    for m in _ASSIGN.finditer(text):
        if len(m[1]) >= 8:
            found.append((m.start(), 0, m.end(), m[1]))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    found += [(m.start(), 3, m.end(), m[0]) for m in _OTHER.finditer(text)]
    return sorted(found)


def span_text(spans: Column, kinds: tuple[str, ...]) -> Column:
    """Spans as ``kind:start:end``, comma-joined, from an array of (start, kind, end)."""
    names = F.array(*[F.lit(k) for k in kinds])
    parts = F.transform(
        F.sort_array(spans),
        lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.array_join(parts, ",")


def count_kind(spans: Column, number: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")
