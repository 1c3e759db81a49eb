"""Personal data by the plain patterns, text by text."""

import hashlib
import re

KINDS = ("email", "ip", "card", "phone")
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits])):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    found = [
        (m.start(), k, m.end()) for k, kind in enumerate(KINDS) for m in re.finditer(PLAIN[kind], text or "")
        if valid(kind, m.group())
    ]
    return sorted(found)


def row(text):
    spans = base(text)
    joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
    return (*(sum(s[1] == k for s in spans) for k in range(4)), hashlib.sha256(joined.encode()).hexdigest())
