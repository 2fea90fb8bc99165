"""Document quality by votes of the nearest labelled documents in a latent-semantic space.

Terms of a text are its hashed pairs of bytes and two of repetition: words that equal the word before, and words met up to
`NEAR` places before. Counts are damped by a square root, weighted by inverse document frequency and projected on the
leading right singular vectors of the labelled sample's term matrix. The sample's vectors go to every task; each task
multiplies them with its documents a block at a time, exactly, and the neighbours of each document vote with their labels,
weighted by a power of their cosine.

The sample is bounded by `sample` documents and drawn by a hash of the id, so what is fitted, collected and broadcast does
not grow with the corpus: (sample x DIMS) + (TERMS x DIMS) numbers. Everything else covers all documents and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballast.llm.common import STEP, WordHasher, mixed, strings
from ballast.llm.langid import held_out

#: Buckets of byte pairs; dimensions kept; labelled documents the space is fitted on and that vote.
BUCKETS, DIMS, SAMPLE = 1024, 48, 4000
#: Voters of a document, and the power of a voter's cosine that is its weight.
VOTERS, POWER = 15, 8
#: Words back that count as near; weight of the terms of repetition.
NEAR, REPEATS = 16, 2.0
TERMS = BUCKETS + 2
LIKELY = 0.3
SEED = 13


class Counter:
    """Term counts of many texts at once."""

    def __init__(self) -> None:
        self.bucket = (mixed(np.arange(1, 1 << 16 | 1, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)
        self.hasher = WordHasher()

    def _pairs(self, raw: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
        """Adds the byte pairs of the texts raw[at[i]:at[i + 1]]; none runs over a border."""
        i, n = 0, len(at) - 1
        while i < n:
            j = min(max(i + 1, int(np.searchsorted(at, at[i] + STEP, "right")) - 1), i + 1024)
            # a text longer than a step comes in pieces that share a byte
            for lo in range(int(at[i]), int(at[j]), STEP):
                part = raw[lo : min(lo + STEP + 1, int(at[j]))].astype(np.int64)
                if len(part) < 2:
                    continue
                code = self.bucket[part[:-1] << 8 | part[1:]]
                if j == i + 1:
                    out[i, :BUCKETS] += np.bincount(code, minlength=BUCKETS)
                    continue
                own = np.repeat(np.arange(j - i), np.diff(at[i : j + 1]))[lo - at[i] :][: len(part)]
                same = own[:-1] == own[1:]
                out[i:j, :BUCKETS] += np.bincount((own[:-1] * BUCKETS + code)[same], minlength=(j - i) * BUCKETS).reshape(j - i, BUCKETS)
            i = j

    def _repeats(self, raw: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
        n = len(at) - 1
        for _, _, text, word in self.hasher.many(raw, at):
            if len(word) < 2:
                continue
            again = np.zeros(len(word), bool)
            again[1:] = (word[1:] == word[:-1]) & (text[1:] == text[:-1])
            near = np.zeros(len(word), bool)
            for back in range(2, min(NEAR, len(word) - 1) + 1):
                near[back:] |= (word[back:] == word[:-back]) & (text[back:] == text[:-back])
            out[:, BUCKETS] += np.bincount(text[again], minlength=n)
            out[:, BUCKETS + 1] += np.bincount(text[near & ~again], minlength=n)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """A row per text, a column per term."""
        raw, at = strings(texts)
        out = np.zeros((len(at) - 1, TERMS), np.float32)
        self._pairs(raw, at, out)
        self._repeats(raw, at, out)
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class Space:
    """The latent-semantic space of a labelled sample, and its vectors."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray) -> None:
        self.labels = labels.astype(np.float32)
        n = len(counts)
        self.weight = (np.log((1 + n) / (1 + (counts > 0).sum(axis=0))) + 0.1).astype(np.float32)
        self.weight[BUCKETS:] = REPEATS
        x = self._weighed(counts)
        _, vectors = np.linalg.eigh(x.T.astype(np.float64) @ x)
        self.turn = np.ascontiguousarray(vectors[:, ::-1][:, :DIMS], np.float32)
        self.points = _unit(x @ self.turn)

    def _weighed(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.sqrt(counts) * self.weight)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the voters of each row; the sample's mean where no voter has a cosine above 0."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cosine = _unit(self._weighed(counts) @ self.turn) @ self.points.T
        k = min(VOTERS, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** POWER
        total = weight.sum(axis=1)
        vote = (weight * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.where(total > 0, vote, self.labels.mean())


def labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, quality, text) of at most `sample` documents with a label that are not held out, drawn by a hash of the id.

    Only quality 0 and 1 count; of an id with several labels the mean is taken, of one with several texts the first by order.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("quality"))
    drawn = known.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # at most `sample` rows are broadcast
    return texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id").agg(F.first("quality").alias("quality"), F.min("text").alias("text"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = Counter()
    for batch in batches:
        rows = [x.tobytes() for x in counter.counts(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["doc_id", "quality", "counts"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Space:
    """The space of the labelled sample; at most `sample` rows of TERMS counts come to the driver."""
    rows = labelled(docs, labels, sample).mapInArrow(_counted, "doc_id long, quality double, counts binary").orderBy("doc_id").collect()
    counts = np.frombuffer(b"".join(r["counts"] for r in rows), np.float32).reshape(-1, TERMS)
    return Space(counts, np.array([r["quality"] for r in rows]))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, held_out, score, predicted.

    A null text is empty. An empty text, and any whose cosine with all voters is 0 or less, gets the mean label of the
    sample; without any label every score is 0.5. Of equal cosines at the last voter's place, some vote and some don't.
    """
    space = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, own = Counter(), space.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = np.round(np.clip(own.scores(counter.counts(part.column(2))), 0, 1), 6)
                columns = [part.column(0), part.column(1), pa.array(found), pa.array((found >= LIKELY).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
