r"""Secret scan by assignment-aware lexing.

Beside three fixed patterns (assign, access, hex; see BASE) a lexer reads a text as source or configuration: a name, an
assignment sign, a value. Values are string literals, bare words, names of earlier values, and literals or names joined
by `+`; what a name stands for is carried along, in the order of the text, so that `a = "AKIA"` and `key = a + "..."`
are seen together. A value is scored by what its name says (a sensitive word in it, a harmless one), by its length, its
alphabet and its entropy; placeholders score nothing. From `threshold` on it is reported, as the kind `literal` with the
span of the literal that it was written as, and once for each literal that it was put together from. Constants are kept
as references, so that chains of them take time and memory in proportion to the text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "literal")

ASSIGN = re.compile(
    r"""(?P<name>[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?(?P<value>[A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{16}")

#: What can stand before a sign, and after it. A bare value may hold signs of its own, a name may not.
STRING = r"""(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
BEFORE = re.compile(STRING + r"|(?P<word>[A-Za-z_$][A-Za-z0-9_$.-]*)|(?P<sign>:=|=>|=(?!=)|:(?!:))|(?P<end>[;,{}()|])|(?P<other>\S)")
AFTER = re.compile(STRING + r"|(?P<bare>[A-Za-z0-9/_.=$-][A-Za-z0-9+/_.=$-]*)|(?P<plus>\+)|(?P<end>[;,{}()|])|(?P<other>\S)")
SIGN = re.compile(r"[=:]")
SENSITIVE = re.compile(r"pass(?:word|wd|phrase)?$|passw|pwd|secret|token|api.?key|access.?key|private.?key|credential|auth|signature|salt|bearer|cookie|session", re.I)
HARMLESS = re.compile(r"public|url|uri|path|file|name$|count|length|limit|type|size|max|min|version|label|hash$|digest|checksum|commit|colou?r", re.I)
#: Characters at either end of a value that are kept beside the numbers of all its characters: longer than any fixed placeholder.
ENDS = 16
#: Bits that a number of characters keeps at least.
EXACT = 128
PLACEHOLDER = re.compile(r"x{4,}|\*{3,}|example|sample|changeme|placeholder|your.?|dummy|test|todo|none|null|true|false|<.*>|\$\{.*\}|%\(.*\)s", re.I)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping per kind; failing matches drop out."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end("value") - m.start("value") >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if LONG_HEX.search(text):
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= 16]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def entropy(counts: Counter[str] | str) -> float:
    """Bits per character, of a text or of the numbers of its characters."""
    counts = Counter(counts)
    n = sum(counts.values())
    return -sum(c / n * math.log2(c / n) for c in counts.values() if c / n) if n else 0.0


def shifted(counts: Counter[str], bits: int) -> Counter[str]:
    """The numbers without their last bits, each at least one."""
    return Counter({c: max(n >> bits, 1) for c, n in counts.items()}) if bits else counts


class Value:
    """What a name stands for: how often it has each character, its ends, and the literals or earlier values it is put together from.

    Values refer to their parts and hold no copies of them, so a chain of constants costs no more than its text. Scored is the
    whole value: all that a score asks of a long one follows from its characters and ends.
    """

    __slots__ = ("counts", "head", "parts", "shift", "size", "span", "tail")

    def __init__(self, text: str, span: tuple[int, int] | None = None) -> None:
        self.size, self.head, self.tail, self.counts = len(text), text[:ENDS], text[-ENDS:], Counter(text)
        self.span, self.parts, self.shift = span, (), 0

    @classmethod
    def of(cls, parts: list[Value]) -> Value:
        if len(parts) == 1:
            return parts[0]
        one = cls("")
        one.parts = tuple(parts)
        one.shift = max(part.shift for part in parts)
        for part in parts:
            one.head = (one.head + part.head)[:ENDS]
            one.tail = (one.tail + part.tail)[-ENDS:]
            one.size += part.size >> one.shift - part.shift
            one.counts.update(shifted(part.counts, one.shift - part.shift))
        if one.size >> 2 * EXACT:  # constants doubled hundreds of times: such numbers keep their first bits
            one.shift += EXACT
            one.size, one.counts = one.size >> EXACT, shifted(one.counts, EXACT)
        return one

    def placeholder(self) -> bool:
        """Is the whole value one? What is longer than its ends can only be of one character or stand in brackets."""
        text = self.head if self.size <= ENDS else self.head[0] * 4 if len(set(map(str.lower, self.counts))) == 1 else f"{self.head}\0{self.tail}"
        return bool(PLACEHOLDER.fullmatch(text))


def score(name: str, value: str | Value) -> float:
    """0 to 1: how likely the value of a name is a secret."""
    value = Value(value) if isinstance(value, str) else value
    if value.size < 8 or any(map(str.isspace, value.counts)) or value.placeholder():
        return 0.0
    total = 0.0
    if SENSITIVE.search(name):
        total += 0.5
    if HARMLESS.search(name):
        total -= 0.3
    kinds = sum(any(map(re.compile(k).match, value.counts)) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    total += 0.1 * (kinds - 1)
    total += 0.1 * (value.size >= 16) + 0.1 * (value.size >= 32)
    bits = entropy(value.counts)
    total += 0.2 * (bits >= 3.0) + 0.1 * (bits >= 4.0)
    return max(0.0, min(1.0, total))


def sign_lines(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of the lines that hold an assignment sign."""
    at = 0
    while m := SIGN.search(text, at):
        start, end = text.rfind("\n", 0, m.start()) + 1, text.find("\n", m.start())
        at = len(text) if end < 0 else end
        yield start, at


def written(values: list[Value]) -> set[tuple[int, int]]:
    """The spans of all literals in the values; each value is visited once."""
    spans, seen, open_ = set(), set(), list(values)
    while open_:
        value = open_.pop()
        if id(value) not in seen:
            seen.add(id(value))
            if value.span:
                spans.add(value.span)
            open_ += value.parts
    return spans


def literals(text: str) -> Iterator[tuple[str, Value]]:
    """(name, value) of each assignment, in order; known names are replaced.

    A statement ends at a line end, a comma, a semicolon or a bracket. A value without a string, a digit or a known
    name in it is prose and gives nothing.
    """
    known: dict[str, Value] = {}
    for line, stop in sign_lines(text):
        name, target, parts, open_, at = "", None, [], True, line
        while True:
            m = (BEFORE if target is None else AFTER).search(text, at, stop)
            kind, own = (m.lastgroup, m.group()) if m else ("end", "")
            if kind == "end":
                if target and parts:
                    known[target] = Value.of(parts)
                    yield target, known[target]
                name, target, parts, open_ = "", None, [], True
                if m is None:
                    break
            elif target is None:
                if kind == "sign":
                    target = name
                elif kind in ("word", "string"):
                    name = own.strip("\"'`")
                elif own not in "]?":
                    name = ""
            elif kind == "bare" and own == "=" and not parts:
                open_ = True  # a type stood between the name and its value
            elif kind == "plus":
                open_ = bool(parts)
            elif open_:  # a value ends where no plus follows
                open_ = False
                if kind == "string":
                    parts.append(Value(own[1:-1], (m.start() + 1, m.end() - 1)))
                elif kind == "bare":
                    for part in re.finditer(r"[^+]+", own) if any(x in known for x in own.split("+")) else [re.match(r".*", own)]:
                        if part.group() in known:
                            parts.append(known[part.group()])
                        elif re.search("[0-9]", part.group()):
                            parts.append(Value(part.group(), (m.start() + part.start(), m.start() + part.end())))
            at = m.end()


def secret_spans(text: str, threshold: float = 0.6) -> list[tuple[int, int, str]]:
    """All (start, end, kind), by start and kind: the fixed patterns and the literals that score enough."""
    found = set(base_spans(text))
    if SIGN.search(text):
        secret = [value for name, value in literals(text) if score(name, value) >= threshold]
        found.update((a, b, "literal") for a, b in written(secret) if b > a)
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long, masked string"


def scanner(threshold: float, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                spans = secret_spans(text, threshold)
                base = [s for s in spans if s[2] != "literal"]
                n = Counter(s[2] for s in spans)
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((n["assign"], n["access"], n["hex"], digest, joined(spans), n["literal"], masked(text, spans) if with_text else None))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
            arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))]
            names = [field.split()[0] for field in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays(arrays[: None if with_text else -1], names=names[: None if with_text else -1])

    return run


def masked(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """The text with every span replaced by a mark; of an assignment only its value; overlapping spans become one."""
    own = []
    for start, end, kind in spans:
        if kind == "assign" and (m := ASSIGN.match(text, start)):
            start = m.start("value")
        own.append((start, end))
    out, at = [], 0
    for start, end in sorted(own):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, threshold: float = 0.6, with_text: bool = False) -> DataFrame:
    """One row per row of `docs` (doc_id, text): see SCHEMA; `masked` (the text without its secrets) only if asked for.

    Spans are code points, end exclusive. A null text counts as empty, repeated rows are scanned like any other, a row
    without id keeps its null, further columns are ignored. Nothing is shuffled.
    """
    schema = SCHEMA if with_text else SCHEMA.rpartition(",")[0]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scanner(threshold, with_text), schema)


def masker(text_column: int, size_column: int | None, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if text is None else masked(text, secret_spans(text, threshold)) for text in batch.column(text_column).to_pylist()]
            columns = list(batch.columns)
            columns[text_column] = pa.array(texts, pa.string())
            if size_column is not None:
                columns[size_column] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(columns[size_column].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def mask(docs: DataFrame, threshold: float = 0.6) -> DataFrame:
    """`docs` with every secret in `text` replaced by a mark, and n_chars (if there) counted anew. A null text stays null."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    return docs.mapInArrow(masker(docs.columns.index("text"), size, threshold), docs.schema)
