r"""Line-first cleaning.

Every line of a text is judged on its own: does it look like a sentence (punctuation), like a menu (navigation), like a
notice that pages carry around (boilerplate), like symbols or shouting, or does it repeat an earlier line. Lines that fail
are removed, and a document that loses too large a part of its words is rejected. Counts over the whole text (see BASE)
reject documents before that. A word is a run of other than white space (space, tab to carriage return).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballast.llm.common import WordHasher, strings

SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Fixed phrases of notices that sites put on many pages.
BOILERPLATE = re.compile(
    r"all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|(?:we|site|website) uses? cookies|accept (?:all )?cookies"
    r"|enable javascript|javascript is (?:disabled|required)|click here|read more|sign (?:in|up)|log ?in|subscribe|newsletter|share (?:this|on)"
    r"|follow us|back to top|skip to (?:main )?content|add to cart|lorem ipsum|powered by|copyright ©|© ?[12][0-9]{3}",
    re.I,
)
SEPARATOR = re.compile(r"[|»›•·>]|::")


@dataclass(frozen=True)
class Rules:
    """Limits of the line rules, and the share of words that a kept document may lose."""

    prose_words: int = 12  # a line of this many words has to have sentence punctuation
    boilerplate_words: int = 30  # a notice is no longer than this
    menu_share: float = 0.2  # separators per word, from three on
    symbol_share: float = 0.3  # symbols per word
    upper_share: float = 0.7  # of the letters, in lines of five words or more
    stutter_share: float = 0.5  # of words equal to the one before, in lines of five words or more
    lost_share: float = 0.4


def line_fault(line: str, rules: Rules) -> str:
    """Why a line goes, or nothing. `line` has a word in it."""
    words = line.count(" ") + 1
    symbols = sum(map(line.count, SYMBOLS))
    if symbols or "·" in line or "•" in line or "»" in line or "›" in line or "::" in line:
        separators = len(SEPARATOR.findall(line))
        if separators >= 3 and separators >= rules.menu_share * words:
            return "navigation"
        if symbols > rules.symbol_share * words and symbols >= 3:
            return "symbols"
    if words <= rules.boilerplate_words and BOILERPLATE.search(line):
        return "boilerplate"
    if words >= 5:
        upper = len(re.findall(r"[A-Z]", line))
        if upper > 5 and upper > rules.upper_share * sum(map(str.isalpha, line)):
            return "shouting"
        run = line.split()
        if sum(map(eq, run, run[1:])) > rules.stutter_share * len(run):
            return "stutter"
    if words >= rules.prose_words and not any(mark in line for mark in ".!?;:。！？…،؛।"):
        return "punctuation"
    return ""


def clean(text: str, rules: Rules) -> tuple[list[str], int, int]:
    """The lines that stay, how many with a word there are, how many of those go. Empty lines stay where they are."""
    seen, kept, n, gone = set(), [], 0, 0
    for line in text.split("\n"):
        if not line.strip(SPACE):
            kept.append(line)
            continue
        n += 1
        fault = "repeated" if line in seen else line_fault(line, rules)
        seen.add(line)
        if fault:
            gone += 1
        else:
            kept.append(line)
    return kept, n, gone


def repeated_words(h: np.ndarray) -> int:
    """How many words lie in windows of WINDOW words that the text holds twice or more."""
    n = len(h) - WINDOW + 1
    if n < 2:
        return 0
    odd = np.uint64(0x9E3779B97F4A7C15)
    run = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            run = run * odd + h[k : k + n]
    ordered = np.sort(run)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.searchsorted(twice, run)
    hit = twice[np.minimum(at, len(twice) - 1)] == run
    edge = np.zeros(len(h) + 1, np.int64)
    edge[:n] += hit
    edge[WINDOW : WINDOW + n] -= hit
    return int((np.cumsum(edge)[:-1] > 0).sum())


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, n_lines long, n_lines_gone long, lost_words long, cleaned string"
)


def judge(rules: Rules, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, symbol = WordHasher(), np.zeros(256, np.int64)
        symbol[[ord(c) for c in SYMBOLS]] = 1
        inside = np.ones(256, np.int64)  # of a byte: does it begin a code point of a word
        inside[0x80:0xC0] = 0
        inside[[ord(c) for c in SPACE]] = 0
        for batch in batches:
            texts, rows = batch.column(1), []
            raw, at = strings(texts)
            for i, j, owner, h in hasher.many(raw, at):
                first = np.searchsorted(owner, np.arange(i, j + 1))
                for k in range(i, j):
                    own = raw[at[k] : at[k + 1]]
                    text = texts[k].as_py() or ""
                    mine = h[first[k - i] : first[k - i + 1]]
                    n, repeats = len(mine), repeated_words(mine)
                    full = [line for line in text.split("\n") if line.strip(SPACE)]
                    failed = n < 20 or 100 * repeats > 30 * n
                    kept, lines, gone = clean(text, rules)
                    cleaned = "\n".join(kept)
                    lost = n - (len(WORD.findall(cleaned)) if gone else n)
                    keep = not failed and lost <= rules.lost_share * n
                    rows.append((n, int(inside[own].sum()), int(symbol[own].sum()), len(full) - len(set(full)), repeats, failed, keep, lines, gone, lost, cleaned if with_text else None))
            columns = list(zip(*rows, strict=True)) or [()] * 11
            kinds = (*[pa.int64()] * 5, pa.bool_(), pa.bool_(), *[pa.int64()] * 3, pa.string())
            names = [field.split()[0] for field in SCHEMA.split(",")]
            last = None if with_text else -1
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))][:last], names=names[:last])

    return run


def line_first(docs: DataFrame, rules: Rules | None = None, with_text: bool = False) -> DataFrame:
    """One row per row of `docs` (doc_id, text): see SCHEMA; `cleaned` (the lines that stay) only if asked for.

    base_failed: fewer than 20 words, or more than 30 % of the words in repeated windows. kept: not that, and the lines
    that went held at most `lost_share` of the words. A null text counts as empty and so fails. Repeated rows are judged
    like any other, a row without id keeps its null. Nothing is shuffled.
    """
    schema = SCHEMA if with_text else SCHEMA.rpartition(",")[0]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(judge(rules or Rules(), with_text), schema)
