r"""Personal data: patterns propose, checksums confirm, context words adjust.

Each pattern proposes spans. A validator confirms or drops each (Luhn for cards, mod 97 for account and French insurance
numbers, mod 23 for Spanish identity numbers, ISO 7064 for German tax numbers, ranges that are given out for others); a
confirmed span starts from its kind's score, and words within a few dozen characters before and after it raise or lower
that score. The fixed kinds (email, ip, card, phone) always stay, with their score; what the method adds has to reach
`threshold`.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "card_short", "nir", "dni", "tax_id", "ssn", "ipv6", "phone_local")
KINDS = (*BASE, *ADDED)

#: email: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, searched from each @ so that long runs cost no more than their length
LOCAL_PART = string.ascii_letters + string.digits + "._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: ip: [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), as every four parts of a run of numbers with dots
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3,}")
NUMBER = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Forms of identifiers that carry a check, and the letters of the Spanish one in the order of its remainder.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
CARD_SHORT = re.compile(r"(?<![0-9A-Za-z.+-])[0-9](?:[\x20-]?[0-9]){12,14}(?![0-9A-Za-z-])")
NIR = re.compile(r"(?<![0-9A-Za-z])[12]\x20?[0-9]{2}\x20?[0-9]{2}\x20?[0-9]{2}\x20?[0-9]{3}\x20?[0-9]{3}\x20?[0-9]{2}(?![0-9A-Za-z])")
DNI = re.compile(r"(?<![0-9A-Za-z])(?:[XYZ]-?[0-9]{7}|[0-9]{8})-?[A-Z](?![0-9A-Za-z])")
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
TAX_ID = re.compile(r"(?<![0-9A-Za-z.+-])[1-9][0-9](?:\x20?[0-9]{3}){3}(?![0-9A-Za-z-])")
SSN = re.compile(r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
IPV6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
LOCAL = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9A-Za-z-])")

_SAMPLE = re.compile(r"\b(example|sample|dummy|fake|test)")
_NUMBERED = re.compile(r"\b(part|serial|order|invoice|isbn|version|ref|model)")
_HOST = re.compile(r"\b(ip|host|address|server|client|login|gateway)")
_PHONE = re.compile(r"\b(phone|tel|call|mobile|cell|fax|contact|telefon|teléfono|téléphone)")
_CARD = re.compile(r"\b(card|visa|mastercard|amex|payment|credit|debit|karte|tarjeta|carte)")
#: Of each kind: its score once confirmed, words that raise it, words that lower it.
CONTEXT = {
    "email": (0.8, re.compile(r"\b(mail|email|contact|write|reply)"), _SAMPLE),
    "ip": (0.6, _HOST, re.compile(r"\b(version|release|section|build|chapter)")),
    "card": (0.8, _CARD, _NUMBERED),
    "phone": (0.7, _PHONE, _NUMBERED),
    "iban": (0.8, re.compile(r"\b(iban|bank|account|konto|cuenta|compte|transfer)"), _SAMPLE),
    "card_short": (0.5, _CARD, _NUMBERED),
    "nir": (0.7, re.compile(r"\b(nir|insee|sécurité sociale|sociale)"), _NUMBERED),
    "dni": (0.7, re.compile(r"\b(dni|nie|nif|identidad)"), _NUMBERED),
    "tax_id": (0.4, re.compile(r"\b(steuer|tax|idnr|tin)"), _NUMBERED),
    "ssn": (0.5, re.compile(r"\b(ssn|social security|taxpayer|tax id)"), _NUMBERED),
    "ipv6": (0.7, _HOST, re.compile(r"\b(example|time|duration)")),
    "phone_local": (0.4, _PHONE, _NUMBERED),
}
RAISE, LOWER, REACH = 0.35, 0.3, 48


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The check of an account number: moved by four, letters as 10 to 35, the remainder is 1."""
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def digits_of(code: str) -> str:
    return "".join(c for c in code if "0" <= c <= "9")


def short_card(code: str) -> bool:
    """13 to 15 digits that pass Luhn and begin as such cards do."""
    digits = digits_of(code)
    return luhn(digits) and (digits[:2] in ("34", "37") if len(digits) == 15 else digits[:2] in ("30", "36", "38") if len(digits) == 14 else digits[0] == "4")


def nir_key(code: str) -> bool:
    """The last two digits are 97 minus the rest modulo 97."""
    digits = digits_of(code)
    return 97 - int(digits[:-2]) % 97 == int(digits[-2:])


def dni_letter(code: str) -> bool:
    """The letter is that of the number modulo 23; a leading X, Y or Z counts as 0, 1 or 2."""
    code = code.replace("-", "")
    return DNI_LETTERS[int(str("XYZ".find(code[0])) + code[1:-1] if code[0] in "XYZ" else code[:-1]) % 23] == code[-1]


def iso7064(code: str) -> bool:
    """The check digit modulo 11, 10 of a German tax number."""
    digits = digits_of(code)
    product = 10
    for c in digits[:-1]:
        total = (int(c) + product) % 10 or 10
        product = 2 * total % 11
    return (11 - product) % 10 == int(digits[-1])


def issued(code: str) -> bool:
    """Neither area, group nor serial number of a social security number is one that is never given out."""
    area, group, serial = code.split("-")
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


def global_address(code: str) -> bool:
    """Some group has a letter, else it may be a row of times; not all groups are alike."""
    groups = code.split(":")
    return any(c.isalpha() for c in code) and len(set(groups)) > 1


def dialled(code: str) -> bool:
    """Area code and exchange of a North American number begin with 2 to 9, and are not service codes."""
    digits = digits_of(code)
    return digits[0] in "23456789" and digits[3] in "23456789" and digits[1:3] != "11" and digits[4:6] != "11"


#: Patterns of the added kinds with the check that confirms a match, in the order in which they take text.
CHECKED = (
    ("iban", IBAN, mod97),
    ("card_short", CARD_SHORT, short_card),
    ("nir", NIR, nir_key),
    ("dni", DNI, dni_letter),
    ("tax_id", TAX_ID, iso7064),
    ("ssn", SSN, issued),
    ("ipv6", IPV6, global_address),
    ("phone_local", LOCAL, dialled),
)


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        own = len(before) - len(before.rstrip(LOCAL_PART))
        m = DOMAIN.match(text, at + 1) if own else None
        if m:
            yield at - own, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in DOTTED.finditer(text):
        parts = list(NUMBER.finditer(text, run.start(), run.end()))
        for k in range(0, len(parts) - 3, 4):
            four = [p.group().lstrip("0") or "0" for p in parts[k : k + 4]]
            if all(len(p) <= 3 and int(p) <= 255 for p in four):
                yield parts[k].start(), parts[k + 3].end()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed kinds, by kind and start, non-overlapping per kind; failing matches drop out."""
    found = [(a, b, "email") for a, b in emails(text)]
    if DIGIT.search(text):
        found += [(a, b, "ip") for a, b in addresses(text)]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    return found


def confidence(text: str, start: int, end: int, kind: str) -> float:
    """The kind's score, adjusted by the words around the span."""
    value, more, less = CONTEXT[kind]
    around = f"{text[max(0, start - REACH) : start]} {text[end : end + REACH]}".lower()
    return value + RAISE * bool(more.search(around)) - LOWER * bool(less.search(around))


def added_spans(text: str, taken: list[tuple[int, int, str]], threshold: float) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the further kinds that score enough and do not overlap what is taken, by kind and start."""
    if not DIGIT.search(text):
        return []
    found, used = [], None
    for kind, pattern, check in CHECKED:
        for m in pattern.finditer(text):
            if not check(m.group()) or confidence(text, m.start(), m.end(), kind) < threshold:
                continue
            if used is None:  # a mark for each character that is taken
                used = bytearray(len(text))
                for a, b, _ in taken:
                    used[a:b] = b"\1" * (b - a)
            if used.find(1, m.start(), m.end()) < 0:
                found.append((m.start(), m.end(), kind))
                used[m.start() : m.end()] = b"\1" * (m.end() - m.start())
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first gives the kind."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


NAMES = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "scores", "redacted")
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, scores string, redacted string"


def finder(threshold: float, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                more = added_spans(text, base, threshold)
                spans = base + more
                n = Counter(s[2] for s in base)
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                scores = ",".join(f"{confidence(text, *s):.2f}" for s in spans)
                rows.append((*(n[k] for k in BASE), digest, joined(spans), len(more), scores, redacted(text, spans) if with_text else None))
            columns = list(zip(*rows, strict=True)) or [()] * 9
            kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
            arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))]
            last = None if with_text else -1
            yield pa.RecordBatch.from_arrays(arrays[:last], names=NAMES[:last])

    return run


def find(docs: DataFrame, threshold: float = 0.7, with_text: bool = False) -> DataFrame:
    """One row per row of `docs` (doc_id, text): see SCHEMA; `redacted` only if asked for.

    Spans are code points, end exclusive, kind:start:end joined by commas, by kind as listed in KINDS, then by start.
    scores: the confidence of each span in the same order, after its context; base spans stay whatever theirs. A null text
    counts as empty, repeated rows are searched like any other, a row without id keeps its null, further columns are
    ignored. Nothing is shuffled.
    """
    schema = SCHEMA if with_text else SCHEMA.rpartition(",")[0]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(finder(threshold, with_text), schema)
