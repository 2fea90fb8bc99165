"""Near-duplicate documents by one-permutation MinHash.

A document is the set of its distinct word shingles. Documents with equal sets form a class and are handled as one. For
each class one pass over the sorted 64-bit shingle hashes gives a signature: the top bits of a hash name its bin, the
smallest hash of a bin is its value. An empty bin takes the value of the first filled bin in a random order of its own
(optimal densification), so that two sets agree in a bin with a probability equal to their similarity. `rows`
neighbouring bins make a band and equal bands make a bucket.

A bucket proposes a star, not all its pairs: one edge from each member to a centre. Edges are confirmed on full shingle
sets and joined to components. Buckets whose members are then in one component are settled. The others go on, one of
those that have the same members, cut into blocks of bounded size; a task compares the full sets of two blocks at a time
and returns only links that join components. So no pair that shares a bucket is lost, and none is written out to be
compared. At the defaults a pair of similarity 0.8 shares none of its 64 buckets with a probability of 1e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballast.llm.common import WordHasher, mixed, stored, strings

BINS, ROWS = 512, 8
#: Members of a block and their shingles, at most about so many; columns of a step of the comparison of two blocks.
BLOCK, BLOCK_SHINGLES, COLUMNS = 512, 1 << 18, 4096
SKETCH = "doc_id long, d1 long, d2 long, n_shingles long, bands array<long>"
SEED = 20


def shingle_sets(hasher: WordHasher, column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes, sorted. Fewer words than `size`: all of them are one shingle."""
    raw, at = strings(column)
    mark = mixed(np.arange(11, 11 + size, dtype=np.uint64)) | np.uint64(1)
    for i, j, text, h in hasher.many(raw, at):
        first = np.searchsorted(text, np.arange(i, j + 1))
        n = len(h) - size + 1
        with np.errstate(over="ignore"):
            run = sum((h[k : k + n] * mark[k] for k in range(size)), np.zeros(max(n, 0), np.uint64)) if n > 0 else np.zeros(0, np.uint64)
            run = mixed(run)
            for k in range(j - i):
                a, b = first[k], first[k + 1]
                if b - a >= size:
                    yield np.unique(run[a : b - size + 1])
                elif b > a:
                    yield mixed(np.array([sum(int(x) * int(m) for x, m in zip(h[a:b], mark, strict=False)) % (1 << 64) + 1], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)


def sketcher(size: int, bins: int, rows: int):
    """Function for mapInArrow over (doc_id, text): see SKETCH."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(fold_case=True)
        order = np.argsort(np.random.default_rng(SEED).random((bins, bins)), axis=1).argsort(axis=1).astype(np.int16)
        shift = np.uint64(64 - bins.bit_length() + 1)
        mark = mixed(np.arange(101, 101 + rows, dtype=np.uint64)) | np.uint64(1)
        band = mixed(np.arange(1001, 1001 + bins // rows, dtype=np.uint64))
        for batch in batches:
            sizes, first, second, bands = [], [], [], []
            for s in shingle_sets(hasher, batch.column(1), size):
                sizes.append(len(s))
                if not len(s):
                    first.append(None), second.append(None), bands.append(None)
                    continue
                at = (s >> shift).astype(np.int64)
                head = np.concatenate(([True], at[1:] != at[:-1]))
                filled, value = at[head], np.zeros(bins, np.uint64)
                value[filled] = s[head]
                if len(filled) < bins:
                    empty = np.ones(bins, bool)
                    empty[filled] = False
                    empty = np.flatnonzero(empty)
                    value[empty] = s[head][order[np.ix_(empty, filled)].argmin(axis=1)]
                with np.errstate(over="ignore"):
                    keys = mixed((value.reshape(-1, rows) * mark).sum(axis=1, dtype=np.uint64) ^ band)
                    first.append(int(mixed(s).sum(dtype=np.uint64).view(np.int64)))
                    second.append(int(mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                bands.append(keys.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "d1", "d2", "n_shingles", "bands"],
            )

    return run


def confirmer(size: int, percent: int):
    """Function for mapInArrow over (a, b, text_a, text_b), like `a` together where possible: the pairs that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(fold_case=True)
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            texts_a = batch.column(2).dictionary_encode()
            left, ids = list(shingle_sets(hasher, texts_a.dictionary, size)), texts_a.indices.to_numpy(zero_copy_only=False)
            for k, b in enumerate(shingle_sets(hasher, batch.column(3), size)):
                a = left[ids[k]]
                at = np.searchsorted(a, b)
                both = int((a[np.minimum(at, len(a) - 1)] == b).sum()) if len(a) and len(b) else 0
                keep[k] = both > 0 and 100 * both >= percent * (len(a) + len(b) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["a", "b"])

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough. `texts`: (node, text) of every node."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(confirmer(size, percent), "a long, b long")


def block_linker(size: int, percent: int):
    """Function for mapInArrow over (key, i, j, block, component, node, text), sorted by key, i and j: links (a, b).

    The rows of one (key, i, j) are the members of blocks i and j of a bucket. Returned are links between different
    components, of those only as many as join what is not joined yet.
    """

    def links_of(hasher: WordHasher, rows: list[tuple]) -> Iterator[tuple[int, int]]:
        block, component, node, texts = zip(*rows, strict=True)
        sets = list(shingle_sets(hasher, pa.array(texts, pa.string()), size))
        n = np.array([len(x) for x in sets])
        known, at, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), n)
        common = df > 1
        column = (np.cumsum(common) - 1)[at][common[at]]
        row, both = row[common[at]], np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for start in range(0, int(common.sum()), COLUMNS):
            lo, hi = np.searchsorted(column, (start, start + COLUMNS))
            part = np.zeros((len(sets), COLUMNS), np.float32)
            part[row[lo:hi], column[lo:hi] - start] = 1
            both += part @ part.T
        alike = (both > 0) & (100 * both >= percent * (n[:, None] + n[None, :] - both))
        root = {c: c for c in component}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        for x, y in zip(*np.nonzero(np.triu(alike, 1)), strict=True):
            a, b = find(component[x]), find(component[y])
            if a != b:
                root[max(a, b)] = min(a, b)
                yield min(node[x], node[y]), max(node[x], node[y])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, rows, last, found = WordHasher(fold_case=True), [], None, []
        for batch in batches:
            *keys, block, component, node = (batch.column(i).to_pylist() for i in range(6))
            for k, group in enumerate(zip(*keys, strict=True)):
                if group != last:
                    found += links_of(hasher, rows) if len(rows) > 1 else []
                    rows, last = [], group
                rows.append((block[k], component[k], node[k], batch.column(6)[k].as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*found, strict=True) if found else ((), ()))], names=["a", "b"])
            found = []
        found = list(links_of(hasher, rows)) if len(rows) > 1 else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    return run


def block_links(shared: DataFrame, root: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between different components that share a bucket. `shared`: (key, node, n) of the buckets."""
    member = shared.join(root, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
    part = member.groupBy("key", "component").agg(
        F.count("*").alias("m"), F.sum("n").alias("total"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who")
    )
    # the largest component of a bucket needs no comparison with itself: its members meet only those of the others
    bucket = part.groupBy("key").agg(
        F.max(F.struct("m", "total", "component")).alias("p"),
        F.sum("m").alias("m"), F.sum("total").alias("total"), F.sum("who").alias("who"), F.count("*").alias("parts"),
    )
    # of the buckets with the same members, one
    bucket = bucket.where("parts > 1").groupBy("who", "m").agg(F.min(F.struct("key", "p", "total")).alias("b"))

    def blocks(m, total):
        return F.greatest(F.ceil(m / BLOCK), F.ceil(total / BLOCK_SHINGLES)).cast("int")

    large = F.col("b.p")
    bucket = bucket.select(
        "b.key", large["component"].alias("largest"), blocks(large["m"], large["total"]).alias("passive"),
        blocks(F.col("m") - large["m"], F.col("b.total") - large["total"]).alias("active"),
    )
    rows = member.join(bucket, "key")
    at = F.xxhash64("node", "key")
    is_large = F.col("component") == F.col("largest")
    rows = rows.withColumn("block", F.when(is_large, F.col("active") + F.pmod(at, "passive")).otherwise(F.pmod(at, "active")).cast("int"))
    last = F.when(is_large, F.col("active")).otherwise(F.col("active") + F.col("passive")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "component", "node")
    rows = rows.join(texts, "node").select("key", "i", "j", "block", "component", "node", "text")
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(block_linker(size, percent), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component): for each node of the links (a, b) the smallest node that it reaches.

    Alternates two steps until nothing changes: every node sends its smallest neighbour to its larger neighbours, then
    to its smaller ones. Each edge stays one edge, so no node gathers a list. The number of rounds grows with the
    logarithm of the longest path; each round's edges are written to the shared folder.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = stored(small.where("u > v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    root = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return root.union(root.select(F.col("component").alias("node"), "component").distinct())


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bins: int = BINS, rows: int = ROWS) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Words are runs of other than white space with A-Z lower-cased; `size` of them make a shingle. Documents link if
    100 * intersection >= percent * union. component_id is the smallest doc_id reached over links; kept: it is the
    document's own. A null or empty text has no shingles and links with nothing. Repeated rows come out as often as
    they came in; rows that share a doc_id count as one document. Without doc_id: component_id is null, kept false.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = stored(docs.mapInArrow(sketcher(size, bins, rows), SKETCH), "sketch")
    own = sketch.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = own.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("node"), F.min_by("bands", "doc_id").alias("bands"))
    classes = stored(classes, "classes")
    buckets = classes.select(F.posexplode("bands").alias("band", "key"), "node", F.col("n_shingles").alias("n"))
    buckets = buckets.select(F.xxhash64("band", "key").alias("key"), "node", "n")
    # another random member of the bucket is its centre in every band, so that a group's members meet many centres
    centre = buckets.groupBy("key").agg(F.count("*").alias("members"), F.min(F.struct(F.xxhash64("node", "key").alias("h"), "node", "n")).alias("c"))
    shared = stored(buckets.join(centre.where("members > 1").select("key", F.col("c.node").alias("a"), F.col("c.n").alias("m")), "key"), "buckets")
    alike = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    stars = shared.where(f"node <> a AND {alike}").select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("node"), "text")
    stars = stored(stars, "stars")
    links = stored(confirmed(stars, texts, size, percent), "confirmed")
    root = components(links)
    more = stored(block_links(shared, root, texts, size, percent), "joined")
    if not more.isEmpty():
        root = components(links.union(more))
    same = classes.select("d1", "d2", "n_shingles", "node").join(root, "node", "left")
    same = same.select("d1", "d2", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    alone = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        sketch.drop("bands")
        .join(same, ["d1", "d2", "n_shingles"], "left")
        .select("doc_id", "n_shingles", alone.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(False)))
    )
