"""Packing documents into sequences of a fixed number of tokens by minimum bin slack.

Documents become token ids with an end mark; only those longer than a sequence are cut. What packing needs of the corpus
is how many pieces of each length there are: at most `capacity` numbers, however many rows. From them a plan is made on
the driver: the largest length left opens a bin, a subset-sum search over the lengths left (a bitset as a whole number,
one bit per sum) finds the fullest combination that fits beside it, and that combination is used as often as the counts
allow before the next is searched. Each use exhausts a length, so there are no more combinations than a few per length.

The pieces of a length are numbered over all tasks (a count per task and length, then running totals), and the number
picks the place in the plan. No task sees more than its own pieces.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballast.llm.common import stored

CAPACITY = 2048
END = 0
#: Words whose ids a task keeps at hand.
CACHE = 600_000
BREAKS = re.compile(r"(\n+)")


def little_endian(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class TokenBytes:
    """Token ids of texts as little-endian 32-bit numbers, cut by the byte-level BPE of a `tokenizers` file.

    That tokenizer looks at a text in pieces that never run over a single space or a line end between other characters.
    So the ids of a line whose only white space is single spaces are those of its words, one after the other, and words
    are looked up first. `ranks` names the same vocabulary for tiktoken, which is faster on single words; without it,
    or where a special token's string or other white space occurs, the tokenizer itself does the work.
    """

    def __init__(self, tokenizer: str, ranks: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer)
        self.special = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        self.encode = self._slow
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
            quick = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
            self.encode = lambda text: little_endian(quick.encode_ordinary(text))
        outer = self

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                if len(self) > CACHE:
                    self.clear()
                ids = self[word] = outer.encode(word[1:] if word[:1] == "\n" else f" {word}")
                return ids

        self.words, self.breaks = Words(), {}

    def _slow(self, text: str) -> bytes:
        return little_endian(self.whole.encode(text, add_special_tokens=False).ids)

    def _gap(self, n: int, last: bool) -> bytes:
        """Ids of n line ends, before a text's end or between lines."""
        if (n, last) not in self.breaks:
            if len(self.breaks) > 1000:
                self.breaks.clear()
            self.breaks[n, last] = self._slow("\n" * n) if last else (self._slow("\n" * (n - 1)) if n > 1 else b"") + self._slow("\n")
        return self.breaks[n, last]

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self.special):
            return self._slow(text)
        out, parts = [], BREAKS.split(text)
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self._gap(len(part), k == len(parts) - 2 and not parts[-1]))
            elif part:
                words = part.split(" ")
                if words == part.split():
                    words[0] = f"\n{words[0]}"  # the first has no space before it
                    out.extend(map(self.words.__getitem__, words))
                elif part != part.strip():
                    return self._slow(text)
                else:
                    out.append(self._slow(part))
        return b"".join(out)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long"


def piecer(tokenizer: str, ranks: str | None, capacity: int, with_ids: bool):
    """Function for mapInArrow over (doc_id, text): see PIECES. nth counts the task's pieces of that length from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, seen, task = TokenBytes(tokenizer, ranks), Counter(), TaskContext.get().partitionId()
        end = little_endian([END])
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tokens(text.as_py() or "") + end
                n, at = len(ids) // 4, 0
                while at < n:
                    to = n - (n - at - 1) // capacity * capacity  # what is left over goes into the first piece
                    own = ids[4 * at : 4 * to]
                    rows.append((doc, (at + capacity - 1) // capacity, at, to - at, zlib.crc32(own), task, seen[to - at], own))
                    seen[to - at] += 1
                    at = to
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.binary())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids"]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays if with_ids else arrays[:-1], names=names if with_ids else names[:-1])

    return run


def fullest(counts: dict[int, int], room: int) -> Counter:
    """A multiset of lengths within their counts whose sum comes closest to `room` from below; larger lengths first."""
    reach, trail = 1, []
    limit = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, step = min(counts[length], room // length), 1
        while left:
            take = min(step, left)
            trail.append((length, take, reach))
            reach |= (reach << (length * take)) & limit
            left, step = left - take, step * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(trail):
        if not before >> total & 1:
            chosen[length] += take
            total -= length * take
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Counter, int]]:
    """Combinations of lengths and how often each is used; together they use up the histogram."""
    left, uses = {k: n for k, n in histogram.items() if n}, []
    while left:
        top = max(left)
        left[top] -= 1
        bin_ = fullest({k: n for k, n in left.items() if n}, capacity - top)
        left[top] += 1
        bin_[top] += 1
        times = min(left[k] // n for k, n in bin_.items())
        uses.append((bin_, times))
        for k, n in bin_.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return uses


def places(uses: list[tuple[Counter, int]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length its runs of numbers: first number, pieces per bin, first bin, first offset in the bin."""
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    given, bins = Counter(), 0
    for bin_, times in uses:
        offset = 0
        for length, n in sorted(bin_.items(), reverse=True):
            table.setdefault(length, []).append((given[length], n, bins, offset))
            given[length] += n * times
            offset += n * length
        bins += times
    return table


def placer(table: dict[int, list[tuple[int, int, int, int]]], length_column: int, number_column: int):
    """Function for mapInArrow: the rows with sequence_id and offset behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = {length: np.array(rows, np.int64).T for length, rows in table.items()}
        for batch in batches:
            lengths, numbers = batch.column(length_column).to_numpy(), batch.column(number_column).to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                first, per, bins, at = runs[int(length)]
                k = np.searchsorted(first, numbers[own], "right") - 1
                nth = numbers[own] - first[k]
                sequence[own] = bins[k] + nth // per[k]
                offset[own] = at[k] + nth % per[k] * length
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], names=[*batch.schema.names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece of the rows of `docs` (doc_id, text).

    doc_id, piece (from 0), start (ids of its document before it), length, ids_crc32 (of the little-endian unsigned
    32-bit ids), sequence_id, offset (its place in the sequence), and with `with_ids` the ids as such bytes. Each
    document ends with the id 0; a null or empty text is only that. A longer document is cut into pieces of `capacity`
    ids, the first holding what is left over. Repeated rows and rows without id are packed like any other.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = PIECES + ", ids binary" if with_ids else PIECES
    pieces = stored(docs.mapInArrow(piecer(tokenizer, ranks, capacity, with_ids), schema), "pieces")
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    # at most `capacity` rows
    histogram = {row["length"]: row["n"] for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # a length has a row per task here
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = [c for c in pieces.columns if c not in ("task", "nth", "length")]
    numbered = pieces.join(base, ["task", "length"]).select("length", (F.col("base") + F.col("nth")).alias("number"), *own)
    out = numbered.mapInArrow(placer(places(plan(histogram, capacity)), 0, 1), f"length long, number long, {', '.join(f'{n} {t}' for n, t in numbered.dtypes[2:])}, sequence_id long, offset long")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))
