"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point; so has the gap between words. A run of three
letters is bound into one vector: the first letter's vector turned by two places, times the second's turned by one,
times the third's. A text's vector is the sum of its runs' vectors, a language's prototype the sum over its texts.
A text gets the language whose prototype has the largest cosine with it.

Sums of vectors are linear in the counts of runs, so a task counts the runs of about a megabyte of text and multiplies
the counts with the matrix of run vectors once. Training sends one vector per language and task through the shuffle;
prototypes are (languages x DIMS) numbers, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIMS = 1024
#: More different values of lang than this are taken as a mistake in the data, since prototypes go to every task.
MAX_LANGUAGES = 1000
UNKNOWN = "und"
#: Characters per step of vectorised work; longer texts are counted piece by piece.
PIECE = 1 << 19
SEED = 31


class RunVectors:
    """Counts letter runs of texts and turns counts into vectors."""

    def __init__(self, dims: int) -> None:
        self.dims, self.letters = dims, {}
        self.is_letter = np.zeros(1 << 16, bool)
        self.is_letter[[i for i in range(1 << 16) if chr(i).isalpha()]] = True

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) > 20_000:
                self.letters.clear()
            bits = np.random.default_rng((SEED, code)).integers(0, 2, self.dims, np.int8)
            self.letters[code] = 2 * bits - 1
        return self.letters[code]

    def matrix(self, runs: list[np.ndarray]) -> np.ndarray:
        """One row per run, given the three codes of each."""
        known = np.unique(np.concatenate(runs)) if len(runs[0]) else np.zeros(0, np.int64)
        table = np.array([self.letter(int(c)) for c in known], np.int8).reshape(len(known), self.dims)
        a, b, c = (np.searchsorted(known, codes) for codes in runs)
        return (np.roll(table, 2, 1)[a] * np.roll(table, 1, 1)[b] * table[c]).astype(np.float32)

    def pieces(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For runs of texts of about PIECE characters: text number and the code (0: a gap) of each letter or gap."""
        row, size, held = [], 0, []
        for k, text in enumerate(texts):
            text = (text or "").lower()
            # a piece begins with the two characters before it, so that no run is lost at the cut
            for at in range(0, max(len(text), 1), PIECE):
                part = text[max(at - 2, 0) : at + PIECE] if at else f" {text[:PIECE]}"
                held.append(part if at + PIECE < len(text) else f"{part} ")
                row.append(k)
                size += len(held[-1])
                if size >= PIECE:
                    yield self._codes(row, held)
                    row, size, held = [], 0, []
        if held:
            yield self._codes(row, held)

    def _codes(self, row: list[int], held: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        part = np.repeat(np.arange(len(held)), [len(x) for x in held])
        is_letter = self.is_letter[np.minimum(codes, (1 << 16) - 1)]
        for i in np.flatnonzero(codes >= 1 << 16):
            is_letter[i] = chr(codes[i]).isalpha()
        first = np.concatenate(([True], part[1:] != part[:-1]))
        keep = is_letter | first | np.concatenate(([False], is_letter[:-1]))
        return np.array(row)[part[keep]], np.where(is_letter, codes, 0)[keep], part[keep]

    def counts(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
        """Text numbers, their counts (a row each, a column per run), and the runs' codes. A long text may come again."""
        for row, codes, part in self.pieces(texts):
            alphabet, letter = np.unique(codes, return_inverse=True)
            n = len(alphabet)
            ok = part[:-2] == part[2:]
            # a run has at least one letter
            ok &= (codes[:-2] > 0) | (codes[1:-1] > 0) | (codes[2:] > 0)
            run = ((letter[:-2] * n + letter[1:-1]) * n + letter[2:])[ok]
            own = row[:-2][ok]
            texts_here = np.unique(row)
            if n**3 <= 1 << 22:
                seen = np.zeros(n**3, bool)
                seen[run] = True
                runs, at = np.flatnonzero(seen), np.cumsum(seen) - 1
                column = at[run]
            else:
                runs, column = np.unique(run, return_inverse=True)
            codes_of = [alphabet[runs // (n * n)], alphabet[runs // n % n], alphabet[runs % n]]
            # few texts at a time, so that the table of counts stays small
            step = max(1, (1 << 22) // max(len(runs), 1))
            index = np.searchsorted(texts_here, own)
            for i in range(0, len(texts_here), step):
                some = (index >= i) & (index < i + step)
                m = min(step, len(texts_here) - i)
                table = np.bincount((index[some] - i) * len(runs) + column[some], minlength=m * len(runs)) if len(runs) else np.zeros(0)
                yield texts_here[i : i + m], table.reshape(m, len(runs)).astype(np.float32), codes_of


def trainer(dims: int):
    """Function for mapInArrow over (lang, text): for each language of the task the sum of its texts' vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, total = RunVectors(dims), {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            known = sorted(set(langs))
            own = np.searchsorted(known, langs)
            for texts, table, runs in maker.counts(batch.column(1).to_pylist()):
                if not table.shape[1]:
                    continue
                by = np.zeros((len(known), table.shape[1]), np.float32)
                np.add.at(by, own[texts], table)
                for k, vector in zip(known, by @ maker.matrix(runs), strict=True):
                    total[k] = total.get(k, 0) + np.rint(vector).astype(np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))], names=["lang", "vector"])

    return run


def train(docs: DataFrame, dims: int = DIMS) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their prototypes of length one, from all rows of `docs` (lang, text) with both."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sums = rows.mapInArrow(trainer(dims), "lang string, vector array<long>")
    sums = sums.select("lang", F.posexplode("vector").alias("dim", "value")).groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    found = sums.limit(MAX_LANGUAGES * dims + 1).toPandas()
    if len(found) > MAX_LANGUAGES * dims:
        raise ValueError(f"lang has more than {MAX_LANGUAGES} values")
    langs = sorted(found["lang"].unique())
    table = np.zeros((len(langs), dims))
    table[np.searchsorted(langs, found["lang"].to_numpy()) if langs else [], found["dim"].to_numpy()] = found["value"].to_numpy()
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return langs, np.divide(table, norm, out=np.zeros_like(table), where=norm > 0)


def predictor(langs: list[str], prototypes: np.ndarray, text_column: int, kept: list[int]):
    """Function for mapInArrow: the kept columns with lang_pred and score behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = RunVectors(prototypes.shape[1])
        for batch in batches:
            texts = batch.column(text_column).to_pylist()
            best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            long: dict[int, np.ndarray] = {}
            for rows, table, runs in maker.counts(texts) if langs else ():
                if not table.shape[1]:
                    continue
                vectors = table @ maker.matrix(runs)
                for k in [k for k in np.flatnonzero(table.any(axis=1)) if len(texts[rows[k]]) > PIECE]:
                    vectors[k] += long.get(rows[k], 0)
                    long[rows[k]] = vectors[k].copy()
                cosine = vectors @ prototypes.T.astype(np.float32) / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
                at = cosine.argmax(axis=1)
                for k in np.flatnonzero(table.any(axis=1)):
                    best[rows[k]] = langs[at[k]]
                    score[rows[k]] = round(min(max(float(cosine[k, at[k]]), 0.0), 1.0), 6)
            own = [batch.column(i) for i in kept]
            yield pa.RecordBatch.from_arrays([*own, pa.array(best, pa.string()), pa.array(score)], names=[*(batch.schema.names[i] for i in kept), "lang_pred", "score"])

    return run


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray, keep_text: bool = True) -> DataFrame:
    """`docs` with lang_pred and score (the cosine, below 0 counts as 0); UNKNOWN and 0 for a text that is null or has no letters.

    Columns of these names in `docs` are replaced. The languages are tried in sorted order, the first of equals wins.
    """
    docs = docs.drop("lang_pred", "score")
    kept = [i for i, name in enumerate(docs.columns) if keep_text or name != "text"]
    schema = T.StructType([docs.schema.fields[i] for i in kept]).add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(predictor(langs, prototypes, docs.columns.index("text"), kept), schema)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text is divisible by 5. Without id: false."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, dims: int = DIMS) -> DataFrame:
    """One row per row of `docs` (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Trains on the documents that have an id, are not held out and have a lang; lang is no input of a prediction. With
    nothing to learn from, every document is UNKNOWN.
    """
    langs, prototypes = train(docs.where(F.col("doc_id").isNotNull() & ~held_out()), dims)
    return predict(docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text")), langs, prototypes, keep_text=False)
