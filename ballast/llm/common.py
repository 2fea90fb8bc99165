"""Helpers shared by the operators: the shared folder, functions for Python workers, words and their hashes."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Workers get the functions of this package by value: they need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__.rpartition(".")[0]])

#: Bytes of text that vectorised code looks at in one go. It bounds memory, not the text: longer texts are cut at white space.
STEP = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; in local mode without one, a temporary folder that is then set as such."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="ballast-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: later steps neither repeat the work nor lose it with an executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins (one more: where the last ends); null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def is_space(raw: np.ndarray) -> np.ndarray:
    """White space is space and the controls from tab to carriage return."""
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of all words of many texts at once.

    A word's hash is the polynomial of its bytes in an odd base modulo 2**64, taken as a difference of prefix sums and
    divided by the base's power at its start, then mixed. Words are cut at white space.
    """

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, fold_case: bool = False) -> None:
        code = mixed(np.arange(1, 257, dtype=np.uint64))
        if fold_case:
            code[65:91] = code[97:123]
        self.code, self.power, self.inverse = code, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, STEP + 1)
            for name, base in (("power", self.BASE), ("inverse", pow(self.BASE, -1, 1 << 64))):
                run = np.full(n, base, np.uint64)
                run[0] = 1
                setattr(self, name, np.multiply.accumulate(run))

    def _part(self, raw: np.ndarray, border: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of each word; no word runs over a border."""
        word = ~is_space(raw)
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        if border is not None and len(border):
            first[border] = word[border]
            last[border - 1] = word[border - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        if not len(start):
            return start, np.zeros(0, np.uint64)
        self._powers(len(raw) + 1)
        with np.errstate(over="ignore"):
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.code[raw] * self.power[: len(raw)], dtype=np.uint64)))
            h = (total[end] - total[start]) * self.inverse[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return start, mixed(h)

    def words(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word of one text starts (in bytes), and its hash; at most STEP bytes at a time where white space allows."""
        if len(raw) <= STEP:
            return self._part(raw)
        starts, hashes, at = [], [], 0
        while at < len(raw):
            end, reach = min(at + STEP, len(raw)), STEP
            while end < len(raw):
                space = np.flatnonzero(is_space(raw[end - reach : end]))
                if len(space):
                    end = end - reach + int(space[-1]) + 1
                    break
                end = min(end + reach, len(raw))
            start, h = self._part(raw[at:end])
            starts.append(start + at)
            hashes.append(h)
            at = end
        return np.concatenate(starts), np.concatenate(hashes)

    def many(self, raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For runs [i, j) of texts of about STEP bytes: the text number and the hash of each word, in order."""
        i, n = 0, len(at) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(at, at[i] + STEP, "right")) - 1)
            if j == i + 1:
                start, h = self.words(raw[at[i] : at[j]])
                yield i, j, np.full(len(h), i), h
            else:
                border = np.unique(at[i + 1 : j] - at[i])
                start, h = self._part(raw[at[i] : at[j]], border[(border > 0) & (border < at[j] - at[i])])
                yield i, j, np.searchsorted(at, start + at[i], "right") - 1, h
            i = j
