"""Brute-force base spans of the PII and secret contracts, with Python's own matcher."""
import hashlib
import re

PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
SECRET = {"assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def keep(kind, m):
    digits = re.sub("[^0-9]", "", m[0])
    return {"ip": lambda: all(int(p) <= 255 for p in m[0].split(".")), "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
            "phone": lambda: 10 <= len(digits) <= 15, "assign": lambda: len(m[1]) >= 6, "access": lambda: len(m[0]) >= 20,
            "hex": lambda: len(m[0]) >= 24, "email": lambda: True}[kind]()


def base(text, kinds):
    found = [(m.start(), rank, kind, m.end()) for rank, (kind, p) in enumerate(kinds.items()) for m in re.finditer(p, text or "", re.ASCII) if keep(kind, m)]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def digest(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()
