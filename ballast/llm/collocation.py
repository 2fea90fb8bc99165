"""Phrase collocations from sorted count streams.

Texts are tokenised into blocks: per language a block's own words with their counts, and the text as places in that list.
The word counts of all blocks give each word that occurs often enough a number; a block learns the numbers of its own
words by a join on the word. Then each block turns into two count streams, sorted in prefix order: its distinct pairs and
its distinct triples of numbers. Streams are dealt into parts by key and a task merges the sorted streams of its part, so
counts are exact, and a key that holds a third of all rows is one entry of each stream.

What remains, the phrases that occur often enough, is joined by merging sorted streams: in prefix order for the counts of
first parts and for extensions to the right, in suffix order for those of the rest and for extensions to the left. The
joins ask for sort-merge, so both sides are read in lockstep and no table of counts is held in memory.

A word below the limit cannot be part of a phrase that reaches it, nor can a part of a phrase be rarer than the phrase:
leaving rarer words and phrases out loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballast.llm.common import stored, strings

UNKNOWN = "und"
LEAST, TOP = 10, 2000
#: A longer candidate that has at least this percentage of a phrase's count replaces it.
COVERED = 50
#: Bytes of text after which a block of a language is closed; bytes of all open blocks of a task.
BLOCK, OPEN = 4 << 20, 12 << 20
#: Words of the corpus per part that streams are merged in.
PART = 1_000_000
#: Rows of a batch that are looked at in one go.
ROWS = 1024
#: Pieces that a language's candidates are dealt to where they meet its border.
SALTS = 64
#: Parts in which words are numbered.
NUMBERED = 1024

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = True
_BREAK[0x0A:0x0E] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

BLOCKS = "block long, lang string, words array<binary>, counts array<long>, places binary, ends binary"


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and for each whether it ends its piece."""
    raw, at = strings(texts)
    raw = _LOWER[raw]
    inside = ~_GAP[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    # no word runs over the border of two texts
    border = np.unique(at[1:-1])
    border = border[(border > 0) & (border < len(raw))]
    first[border] = inside[border]
    last[border - 1] = inside[border - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    del first, last
    offsets = np.concatenate(([0], np.cumsum(end - start)))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
    # a piece ends where a break or the end of a text lies between a word and the next
    breaks = np.flatnonzero(_BREAK[raw])
    ends = np.ones(len(start), bool)
    ends[:-1] = np.searchsorted(breaks, start[1:]) != np.searchsorted(breaks, end[:-1])
    if len(border) and len(start):  # the last word before each border
        ends[np.maximum(np.searchsorted(start, border) - 1, 0)[np.searchsorted(start, border) > 0]] = True
    return words, ends


def _tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of (lang, text) rows; see BLOCKS. A block's number is made of its task's and its place in the task."""
    task, made = TaskContext.get().partitionId(), 0
    held: dict[str, list[pa.Array]] = {}
    size: dict[str, int] = {}

    def block(lang: str) -> pa.RecordBatch:
        nonlocal made
        words, ends = zip(*(_words(texts) for texts in held.pop(lang)), strict=True)
        size.pop(lang)
        coded = pa.chunked_array(words).combine_chunks().dictionary_encode()
        places = coded.indices.to_numpy().astype(np.uint32)
        own = coded.dictionary.cast(pa.binary())
        counts = np.bincount(places, minlength=len(own))
        columns = [pa.array([(task << 32) + made]), pa.array([lang]), pa.ListArray.from_arrays([0, len(own)], own), pa.ListArray.from_arrays([0, len(own)], pa.array(counts))]
        columns += [pa.array([places.tobytes()], pa.binary()), pa.array([np.packbits(np.concatenate(ends)).tobytes()], pa.binary())]
        made += 1
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in BLOCKS.split(", ")])

    for batch in (whole.slice(k, ROWS) for whole in batches for k in range(0, whole.num_rows, ROWS)):
        coded = batch.column(0).fill_null(UNKNOWN).dictionary_encode()
        for k, lang in enumerate(coded.dictionary.to_pylist()):
            texts = batch.column(1).filter(pa.array(coded.indices.to_numpy() == k)).fill_null("").cast(pa.large_string())
            lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1])
            at = 0
            while at < len(texts):
                room = BLOCK - size.get(lang, 0)
                upto = at + max(1, int(np.searchsorted(np.cumsum(lengths[at:]), room, "right")))
                held.setdefault(lang, []).append(texts.slice(at, upto - at))
                size[lang] = size.get(lang, 0) + int(lengths[at:upto].sum())
                at = upto
                if size[lang] >= BLOCK or at < len(texts):
                    yield block(lang)
                elif sum(size.values()) > OPEN:
                    yield block(max(sorted(size), key=size.get))
    for lang in sorted(held):
        yield block(lang)


def tokenised(docs: DataFrame) -> DataFrame:
    """The blocks of all documents (lang, text), written once."""
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(_tokenised, BLOCKS), "blocks")


def numbered(blocks: DataFrame, least: int) -> DataFrame:
    """(number, lang, word, f): the words that occur at least `least` times, numbered from 1 without gaps."""
    each = blocks.select("lang", F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("n")).alias("all"))
    each = each.select("lang", F.explode("all").alias("one")).select("lang", "one.word", "one.n")
    often = each.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    often = stored(often.withColumn("part", F.pmod(F.xxhash64("lang", "word"), F.lit(NUMBERED)).cast("int")), "words")
    sizes = {r["part"]: r["n"] for r in often.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before = np.concatenate(([0], np.cumsum([sizes.get(k, 0) for k in range(NUMBERED)])))
    if before[-1] >= 1 << 32:
        raise ValueError("more words than 32-bit numbers")
    start = F.array(*[F.lit(int(x)) for x in before[:-1]])[F.col("part")]
    place = F.expr("row_number() OVER (PARTITION BY part ORDER BY lang, word)")
    return stored(often.select((start + place).cast("long").alias("number"), "lang", "word", "f"), "numbers")


STREAM = "size int, part int, pairs binary, thirds binary, counts binary"


def _planes(x: np.ndarray) -> bytes:
    """The bytes of all numbers, byte by byte of the number: for small gaps most of it is zero and shrinks in the shuffle."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _numbers(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _runs(key: np.ndarray) -> np.ndarray:
    """Where each run of equal neighbours starts."""
    return np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)


def _streams(parts: int):
    """Function for mapInArrow over (places, ends, at, numbers): a block's count streams of pairs and triples by part; see STREAM."""

    def dealt(size: int, pair: np.ndarray, third: np.ndarray | None, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        spread = pair * np.uint64(0x9E3779B97F4A7C15)
        if third is not None:
            spread = (spread ^ third) * np.uint64(0xC2B2AE3D27D4EB4F)
        part = ((spread >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        pair, count, edge = pair[order], count[order], np.searchsorted(part[order], np.arange(parts + 1))
        third = None if third is None else third[order]
        for k in np.flatnonzero(np.diff(edge)):
            a, b = edge[k], edge[k + 1]
            gaps = np.diff(pair[a:b], prepend=np.uint64(0))
            blobs = [_planes(gaps), b"" if third is None else _planes(third[a:b].astype(np.uint32)), _planes(count[a:b].astype(np.uint32))]
            yield pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([k], pa.int32()), *(pa.array([x], pa.binary()) for x in blobs)], names=[c.split()[0] for c in STREAM.split(", ")])

    def of_block(places: bytes, ends: bytes, at: np.ndarray, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
        places = np.frombuffer(places, np.uint32)
        n = len(places)
        number = np.zeros(int(places.max(initial=0)) + 1, np.uint64)
        number[at] = numbers
        word = number[places]
        # a word that is too rare is none, and nothing runs over the end of a piece
        joined = np.unpackbits(np.frombuffer(ends, np.uint8), count=n)[:-1] == 0
        joined &= (word[:-1] > 0) & (word[1:] > 0)
        where = np.flatnonzero(joined)
        if not len(where):
            return
        key = (word[where] << np.uint64(32)) | word[where + 1]
        order = np.argsort(key)
        start = _runs(key[order])
        pair = key[order][start]
        yield from dealt(2, pair, None, np.diff(start, append=len(key)))
        # triples: two joined pairs in a row; the pair's place in the sorted pairs and the third word order them by prefix
        rank = np.zeros(n - 1, np.uint64)
        rank[where[order]] = np.repeat(np.arange(len(start), dtype=np.uint64), np.diff(start, append=len(key)))
        where = np.flatnonzero(joined[:-1] & joined[1:])
        key = np.sort((rank[where] << np.uint64(32)) | word[where + 2])
        start = _runs(key)
        if len(start):
            yield from dealt(3, pair[key[start] >> np.uint64(32)], key[start] & np.uint64(0xFFFFFFFF), np.diff(start, append=len(key)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                places, ends = row[0].as_buffer(), row[1].as_buffer()
                at, numbers = (row[k].values.to_numpy(zero_copy_only=False).astype(kind) for k, kind in ((2, np.int64), (3, np.uint64)))
                yield from of_block(places, ends, at, numbers)

    return run


def _merger(least: int):
    """Function for applyInPandas over the streams of a part: its phrases that occur often enough."""

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        triples = key[0] == 3
        pair = np.concatenate([np.cumsum(_numbers(x, np.uint64), dtype=np.uint64) for x in rows["pairs"]])
        count = np.concatenate([_numbers(x, np.uint32) for x in rows["counts"]]).astype(np.int64)
        third = np.concatenate([_numbers(x, np.uint32) for x in rows["thirds"]]) if triples else np.zeros(len(pair), np.uint32)
        order = np.lexsort((third, pair)) if triples else np.argsort(pair, kind="stable")
        pair, third, count = pair[order], third[order], count[order]
        start = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (third[1:] != third[:-1]))))
        f = np.add.reduceat(count, start)
        keep = start[f >= least]
        return pd.DataFrame({"w1": (pair[keep] >> np.uint64(32)).astype(np.int64), "w2": (pair[keep] & np.uint64(0xFFFFFFFF)).astype(np.int64), "w3": third[keep].astype(np.int64), "f": f[f >= least]})

    return merge


def phrases(blocks: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """(w1, w2, w3, f): pairs (w3 is 0) and triples of word numbers that occur at least `least` times in pieces."""
    total = blocks.agg(F.sum(F.length("places"))).first()[0] or 0
    parts = max(1, -(-int(total) // (4 * PART)))
    each = blocks.select("block", "lang", F.posexplode("words").alias("at", "word"))
    own = each.join(words.select("lang", "word", "number").hint("merge"), ["lang", "word"])
    own = own.groupBy("block").agg(F.collect_list(F.struct("at", "number")).alias("own"))
    rows = blocks.select("block", "places", "ends").join(own.hint("merge"), "block")
    rows = rows.select("places", "ends", F.col("own.at").alias("at"), F.col("own.number").alias("numbers"))
    streams = rows.mapInArrow(_streams(parts), STREAM)
    return stored(streams.groupBy("size", "part").applyInPandas(_merger(least), "w1 long, w2 long, w3 long, f long"), "phrases")


def scored(words: DataFrame, found: DataFrame) -> DataFrame:
    """(w1, w2, w3, lang, a, l, r, score) of the candidates that no longer one covers, each by its lowest-scoring cut."""
    one = words.select("number", "lang", "f").hint("merge")
    pairs = found.where("w3 = 0").select("w1", "w2", "f").hint("merge")
    triples = found.where("w3 > 0")
    exact = "CAST(1000000 * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) AS DECIMAL(38,0)) DIV (CAST({l} AS DECIMAL(18,0)) * CAST({r} AS DECIMAL(18,0)))"

    def of_word(rows: DataFrame, column: str, name: str, *more: str) -> DataFrame:
        return rows.join(one.select(F.col("number").alias(column), F.col("f").alias(name), *more), column)

    # extensions: the most frequent triple that begins or ends with a pair
    right = triples.groupBy("w1", "w2").agg(F.max("f").alias("longer"))
    left = triples.groupBy(F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("f").alias("longer"))
    longer = right.union(left).groupBy("w1", "w2").agg(F.max("longer").alias("longer"))
    two = pairs.withColumnRenamed("f", "a").join(longer.hint("merge"), ["w1", "w2"], "left")
    two = two.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * COVERED))
    two = of_word(of_word(two, "w1", "l", "lang"), "w2", "r").select("w1", "w2", F.lit(0).cast("long").alias("w3"), "lang", "a", "l", "r", F.expr(exact.format(l="l", r="r")).alias("score"))
    three = triples.withColumnRenamed("f", "a")
    three = three.join(pairs.withColumnRenamed("f", "l2"), ["w1", "w2"])  # prefix order
    three = three.join(pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("r1")), ["w2", "w3"])  # suffix order
    three = of_word(of_word(three, "w1", "l1", "lang"), "w3", "r2")
    three = three.withColumns({"s1": F.expr(exact.format(l="l1", r="r1")), "s2": F.expr(exact.format(l="l2", r="r2"))})
    first = F.col("s1") <= F.col("s2")
    cut = {c: F.when(first, F.col(a)).otherwise(F.col(b)).alias(c) for c, a, b in (("l", "l1", "l2"), ("r", "r1", "r2"), ("score", "s1", "s2"))}
    return two.union(three.select("w1", "w2", "w3", "lang", "a", cut["l"], cut["r"], cut["score"]))


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The `top` best-scored phrases of each language of `docs` (lang, text): lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and split at .,;:!? and line breaks into pieces, those at spaces and tabs into words. A
    null text is empty, a null lang is `und`. n counts the words of the language, a the phrase (2 or 3 words, `least` times
    or more within pieces, overlaps included); l and r count the two parts of the cut whose score, floor(10^6*a*a/(l*r)), is
    lowest, of equals the first. A pair is left out if a triple that contains it and occurs `least` times or more has at
    least COVERED percent of its count. Rank: by score and a falling, then by phrase in byte order. Repeated rows count each
    time; languages without such phrases have no rows. Counts below 10^15 keep the arithmetic exact.
    """
    blocks = tokenised(docs)
    words = numbered(blocks, least)
    found = stored(scored(words, phrases(blocks, words, least)), "candidates")
    # the score and count at the border; what ties with it stays until the phrases are spelt
    place = F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC)")
    first = found.select("lang", "score", "a").withColumn("rank", place).where(F.col("rank") <= top)
    border = first.groupBy("lang").agg(F.min(F.struct("score", "a")).alias("border"))
    border = border.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(SALTS)).cast("int")
    best = found.withColumn("salt", salt).join(border, ["lang", "salt"]).where(F.struct("score", "a") >= F.col("border")).drop("border", "salt")
    spelt = words.select("number", "word")
    for k in (1, 2):
        best = best.join(spelt.select(F.col("number").alias(f"w{k}"), F.col("word").alias(f"s{k}")), f"w{k}")
    best = best.join(spelt.select(F.col("number").alias("w3"), F.col("word").alias("s3")), "w3", "left")
    best = best.withColumn("phrase", F.concat_ws(" ", *[F.col(f"s{k}").cast("string") for k in (1, 2, 3)]))
    place = F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)")
    best = best.withColumn("rank", place.cast("long")).where(F.col("rank") <= top)
    n = blocks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n"))
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
