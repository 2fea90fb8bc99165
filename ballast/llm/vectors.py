"""Near-duplicate vectors by search in robust-pruned flat graphs on overlapping cluster shards.

Vectors of one label are dealt to shards around centres that are fitted on a bounded sample. A vector is at home with its
nearest centre and a guest with every centre whose border to the home's, the plane halfway between the two, is at most
`overlap` degrees away. By default that is the angle of a link: a partner beyond the border is no nearer than the border
itself, so all partners of a vector are in its home shard, however many shards there are. Each shard builds a flat graph over its members: for each the nearest ones, pruned so that a neighbour
is dropped if a kept one is clearly nearer to it. The lists that a vector gets in its shards are united. Then each shard
searches the partners of its home vectors: a greedy beam search from the medoid, then range expansion from there and from
the vector's own list, which follows every vector found within the limit. Every pair is verified by its cosine in double
precision. A shard too large for a task is compared exactly, a block of vectors against a block at a time.

Tasks return a count per vector and edges that span what is linked, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballast.llm.common import stored
from ballast.llm.neardup import components

#: Rows per shard aimed at, and beyond which a shard is compared in blocks instead; rows of such a block.
SHARD, SHARD_MOST, BLOCK = 2000, 10_000, 2000
#: Rows that centres are fitted on, and centres of a label at most: both bound what every task is sent.
SAMPLE, CENTRES = 50_000, 512
#: Neighbours considered and kept per vector, how much nearer is clearly nearer, beam of the greedy search.
CANDIDATES, DEGREE, ALPHA, BEAM = 64, 24, 1.2, 8
SEED = 5
#: Rows of a block of the recall audit.
AUDIT = 20_000


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that can link: uid, vec_id, label, v (of length one), weight. Equal vectors of a label are one row."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.array_max(F.transform("v", F.abs))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND size(v) > 0").where(finite).where(largest > 0)
    # scaled by the largest component first, so that squares neither overflow nor vanish
    rows = rows.withColumn("v", F.transform("v", lambda x: x / largest))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows = rows.withColumn("v", F.transform("v", lambda x: x / norm)).withColumn("uid", F.xxhash64("label", "v"))
    return rows


def centres(points: DataFrame, sample: int, shard: int) -> dict[str, np.ndarray]:
    """Centres of each label (and length of vector), by spherical k-means over a sample of at most `sample` rows."""
    counts = points.groupBy("group").agg(F.count("*").alias("n"))
    total = points.count()
    share = min(1.0, sample / max(total, 1))
    picked = points.where(F.pmod(F.xxhash64("uid", F.lit(SEED)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("group", "v").limit(2 * sample).toPandas()
    # labels with more than one shard only: at most total / shard of them
    sizes = {r["group"]: r["n"] for r in counts.where(F.col("n") > shard).collect()}
    out = {}
    for group, rows in picked.groupby("group"):
        k = min(-(-sizes.get(group, 0) // shard), CENTRES, len(rows))
        if k < 2:
            continue
        x = np.stack(rows["v"].to_numpy())
        rng = np.random.default_rng(SEED)
        c = x[rng.choice(len(x), k, replace=False)]
        for _ in range(8):
            near = (x @ c.T).argmax(axis=1)
            total_ = np.zeros_like(c)
            np.add.at(total_, near, x)
            norm = np.linalg.norm(total_, axis=1, keepdims=True)
            c = np.where(norm > 0, total_ / np.maximum(norm, 1e-12), c)
        out[group] = c
    return out


MEMBER = "shard string, home boolean, uid long, vec_id long, weight long, v array<double>"


def dealer(by_group: dict[str, np.ndarray], overlap: float):
    """Function for mapInPandas over points: a row for each shard of each vector; see MEMBER."""
    reach = float(np.sin(np.radians(overlap)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group, rows in batch.groupby("group"):
                c = by_group.get(group)
                if c is None:
                    yield rows.assign(shard=f"{group}/0", home=True)[["shard", "home", "uid", "vec_id", "weight", "v"]]
                    continue
                cosine = np.stack(rows["v"].to_numpy()) @ c.T
                near = cosine.argmax(axis=1)
                # sine of the angle to the border with each centre; an angle of 90 degrees or more leaves none out
                behind = cosine.max(axis=1, keepdims=True) - cosine
                apart = np.linalg.norm(c[near][:, None, :] - c[None, :, :], axis=2)
                guest = (behind <= reach * apart + 1e-9) if overlap < 90 else np.ones_like(cosine, bool)
                guest[np.arange(len(near)), near] = True
                who, where = np.nonzero(guest)
                yield rows.iloc[who].assign(shard=[f"{group}/{k}" for k in where], home=near[who] == where)[["shard", "home", "uid", "vec_id", "weight", "v"]]

    return run


def pruned(x: np.ndarray) -> np.ndarray:
    """Adjacency of a flat graph over the rows of x: up to DEGREE neighbours each, -1 where there are fewer."""
    n = len(x)
    m = min(CANDIDATES, n - 1)
    out = np.full((n, DEGREE), -1, np.int32)
    if m < 1:
        return out
    f = x.astype(np.float32)
    for lo in range(0, n, 256):
        own = np.arange(lo, min(lo + 256, n))
        sims = f[own] @ f.T
        sims[np.arange(len(own)), own] = -2
        near = np.argpartition(-sims, m - 1, axis=1)[:, :m]
        s = np.take_along_axis(sims, near, 1)
        order = np.argsort(-s, axis=1, kind="stable")
        near, s = np.take_along_axis(near, order, 1), np.take_along_axis(s, order, 1)
        gap = np.sqrt(np.maximum(2 - 2 * s, 0))  # distance to the vector itself
        between = np.sqrt(np.maximum(2 - 2 * np.einsum("bcd,bed->bce", f[near], f[near]), 0))
        alive = np.ones(near.shape, bool)
        rows = np.arange(len(own))
        for k in range(DEGREE):
            first = alive.argmax(axis=1)
            ok = alive[rows, first]
            out[own[ok], k] = near[rows[ok], first[ok]]
            alive[rows, first] = False
            alive &= ~((ALPHA * between[rows, first] <= gap) & ok[:, None])
            if not alive.any():
                break
    return out


def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The adjacency lists of a shard: (uid, near)."""
    uid = rows["uid"].to_numpy()
    table = pruned(np.stack(rows["v"].to_numpy()))
    return pd.DataFrame({"uid": uid, "near": [uid[t[t >= 0]] for t in table]})


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For the nodes 0 to n - 1 the smallest node reached over the links (a, b)."""
    low = np.arange(n)
    while len(a):
        before = low.copy()
        np.minimum.at(low, a, before[b])
        np.minimum.at(low, b, before[a])
        low = low[low]
        if (low == before).all():
            break
    return low


FOUND = "uid long, links long, a long, b long"


def found_rows(uid: np.ndarray, vec: np.ndarray, links: np.ndarray, query: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    low = spanning(a, b, len(uid))
    moved = np.flatnonzero(low != np.arange(len(uid)))
    # nullable integers before the two are put together: as floats, ids would lose digits
    counts = pd.DataFrame({"uid": uid[query], "links": links[query]}, dtype="Int64")
    edges = pd.DataFrame({"a": np.minimum(vec[moved], vec[low[moved]]), "b": np.maximum(vec[moved], vec[low[moved]])}, dtype="Int64")
    return pd.concat([counts, edges])[["uid", "links", "a", "b"]]


def searcher(limit: float, beam: int):
    """Function for applyInPandas over a shard's (home, uid, vec_id, weight, v, near): see FOUND."""

    def search(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid").reset_index(drop=True)
        uid, vec, weight, home = (rows[c].to_numpy() for c in ("uid", "vec_id", "weight", "home"))
        x, n = np.stack(rows["v"].to_numpy()), len(rows)
        # united lists, as far as they stay in the shard
        size = rows["near"].str.len().fillna(0).astype(int).to_numpy()
        flat = np.concatenate([np.asarray(v, np.int64) for v in rows["near"] if v is not None] or [np.zeros(0, np.int64)])
        at = np.minimum(np.searchsorted(uid, flat), n - 1)
        own, there = np.repeat(np.arange(n), size), uid[at] == flat
        own, at = own[there], at[there]
        degree = np.bincount(own, minlength=n)
        adjacent = np.full((n, max(degree.max(initial=0), 1)), -1, np.int32)
        adjacent[own, np.arange(len(own)) - np.repeat(np.cumsum(degree) - degree, degree)] = at
        # both directions of each edge, for the expansion: a vector that no list names can be reached from its own
        code = np.unique(np.concatenate((own.astype(np.int64) * n + at, at.astype(np.int64) * n + own)))
        ends, first = code % n, np.searchsorted(code, np.arange(n + 1, dtype=np.int64) * n)
        medoid = int((x @ x.mean(axis=0)).argmax())
        queries = np.flatnonzero(home)
        links, left, right = np.zeros(n, np.int64), [], []
        for lo in range(0, len(queries), 256):
            q = queries[lo : lo + 256]
            seen = np.zeros((len(q), n), bool)
            row = np.arange(len(q))
            # greedy: a beam of the nearest so far, the best one not yet opened is opened next
            pool, score, opened = np.full((len(q), beam), medoid), np.full((len(q), beam), -2.0), np.ones((len(q), beam), bool)
            score[:, 0], opened[:, 0] = x[q] @ x[medoid], False
            seen[:, medoid] = True
            hits = [(row[score[:, 0] >= limit], np.full(int((score[:, 0] >= limit).sum()), medoid))]
            while not opened.all():
                best = np.where(opened, -3.0, score).argmax(axis=1)
                live = ~opened[row, best]
                opened[row, best] = True
                near = np.where(live[:, None], adjacent[pool[row, best]], -1)
                fresh = (near >= 0) & ~seen[row[:, None], near]
                r, c = np.nonzero(fresh)
                to = near[r, c]
                seen[r, to] = True
                new = np.full(near.shape, -2.0)
                new[r, c] = np.einsum("ij,ij->i", x[q[r]], x[to])
                within = new[r, c] >= limit
                hits.append((r[within], to[within]))
                pool, score = np.concatenate((pool, near), 1), np.concatenate((score, new), 1)
                opened = np.concatenate((opened, ~fresh), 1)
                keep = np.argsort(-score, axis=1, kind="stable")[:, :beam]
                pool, score, opened = (np.take_along_axis(z, keep, 1) for z in (pool, score, opened))
            # range expansion: from the vector itself and all that is within the limit, until nothing new is
            r, to = (np.concatenate(z) for z in zip(*hits, strict=True))
            r, to = np.concatenate((r, row)), np.concatenate((to, q))
            kept_r, kept_to = [r], [to]
            while len(r):
                size = first[to + 1] - first[to]
                r2 = np.repeat(r, size)
                to2 = ends[np.repeat(first[to] - np.cumsum(size) + size, size) + np.arange(size.sum())]
                code = np.unique((r2.astype(np.int64) * n + to2)[~seen[r2, to2]])
                r2, to2 = code // n, code % n
                seen[r2, to2] = True
                within = np.einsum("ij,ij->i", x[q[r2]], x[to2]) >= limit
                r, to = r2[within], to2[within]
                kept_r.append(r)
                kept_to.append(to)
            code = np.unique(np.concatenate(kept_r).astype(np.int64) * n + np.concatenate(kept_to))
            a, b = q[code // n], code % n
            a, b = a[a != b], b[a != b]
            np.add.at(links, a, weight[b])
            left.append(a)
            right.append(b)
        none = np.zeros(0, np.int64)
        return found_rows(uid, vec, links, queries, np.concatenate([*left, none]), np.concatenate([*right, none]))

    return search


def comparer(limit: float):
    """Function for applyInPandas over two blocks of a large shard (query, uid, vec_id, weight, v): see FOUND."""

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        query, other = rows[rows["query"]], rows[~rows["query"]]
        if not len(query) or not len(other):
            return pd.DataFrame({c: pd.array([], "Int64") for c in ("uid", "links", "a", "b")})
        both = pd.concat([query, other])
        x, y, weight = np.stack(query["v"].to_numpy()), np.stack(other["v"].to_numpy()), other["weight"].to_numpy()
        links, left, right = np.zeros(len(both), np.int64), [], []
        for lo in range(0, len(x), 512):
            a, b = np.nonzero((x[lo : lo + 512] @ y.T >= limit) & (query["uid"].to_numpy()[lo : lo + 512, None] != other["uid"].to_numpy()[None, :]))
            np.add.at(links, a + lo, weight[b])
            left.append(a + lo)
            right.append(b + len(x))
        return found_rows(both["uid"].to_numpy(), both["vec_id"].to_numpy(), links, np.arange(len(x)), np.concatenate(left), np.concatenate(right))

    return compare


def found_links(points: DataFrame, limit: float, overlap: float, shard: int, shard_most: int) -> DataFrame:
    """For points (uid, vec_id, group, weight, v) the counts and spanning edges of all shards; see FOUND."""
    member = stored(points.mapInPandas(dealer(centres(points, SAMPLE, shard), overlap), MEMBER), "members")
    sizes = member.groupBy("shard").agg(F.count("*").alias("m"))
    member = member.join(sizes, "shard")
    fit = member.where(F.col("m") <= shard_most).drop("m")
    lists = fit.select("shard", "uid", "v").groupBy("shard").applyInPandas(build, "uid long, near array<long>")
    united = lists.groupBy("uid").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    united = stored(united, "graph")
    found = fit.join(united, "uid", "left").select("shard", "home", "uid", "vec_id", "weight", "v", "near").groupBy("shard").applyInPandas(searcher(limit, BEAM), FOUND)
    # shards too large for a task: every block of home vectors meets every block of members
    large = member.where(F.col("m") > shard_most).withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    large = large.withColumn("own", F.pmod(F.xxhash64("uid", "shard"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    query = large.where("home").select("shard", F.col("own").alias("i"), F.col("other").alias("j"), F.lit(True).alias("query"), "uid", "vec_id", "weight", "v")
    other = large.select("shard", F.col("other").alias("i"), F.col("own").alias("j"), F.lit(False).alias("query"), "uid", "vec_id", "weight", "v")
    exact = query.unionByName(other).groupBy("shard", "i", "j").applyInPandas(comparer(limit), FOUND)
    return found.unionByName(exact)


def near_vectors(vectors: DataFrame, limit: float = 0.98, overlap: float | None = None, shard: int = SHARD, shard_most: int = SHARD_MOST) -> DataFrame:
    """One row per row of `vectors` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors of one label and length link if their cosine is at least `limit`. Without label, or if the embedding is null,
    empty, zero or has a null or non-finite component, a row links with nothing. n_links counts rows linked directly,
    repeated rows each; component_id is the smallest vec_id reached, the row's own included; kept: it is its own. Without
    vec_id: no links, component_id is null, kept false. Further columns are ignored. `overlap` (degrees) is the angle of a
    link unless given; a smaller one makes shards smaller and can miss links.
    """
    overlap = float(np.degrees(np.arccos(limit))) if overlap is None else overlap
    rows = usable(vectors)
    points = rows.groupBy("uid").agg(F.min("vec_id").alias("vec_id"), F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("weight"))
    points = points.select("uid", "vec_id", F.concat_ws("/", "label", F.size("v").cast("string")).alias("group"), "weight", "v")
    points = stored(points, "points")
    found = stored(found_links(points, limit, overlap, shard, shard_most), "found")
    count = found.where("uid IS NOT NULL").groupBy("uid").agg(F.sum("links").alias("links"))
    root = components(found.where("a IS NOT NULL").select("a", "b"))
    classes = points.select("uid", "weight", F.col("vec_id").alias("node")).join(count, "uid", "left").join(root, "node", "left")
    classes = classes.select("uid", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    linked = rows.select("uid", "vec_id").join(classes, "uid").select("vec_id", "n_links", "component_id")
    everyone = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    # rows that cannot link come from the difference of the numbers of rows by id
    n_all = everyone.groupBy("vec_id").agg(F.count("*").alias("n"))
    n_used = rows.groupBy("vec_id").agg(F.count("*").alias("used"))
    alone = n_all.join(n_used, n_all["vec_id"].eqNullSafe(n_used["vec_id"]), "left").select(n_all["vec_id"], (F.col("n") - F.coalesce("used", F.lit(0))).alias("left"))
    alone = alone.where("left > 0").select("vec_id", F.explode(F.sequence(F.lit(1), F.col("left").cast("int"))).alias("_")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def audited_recall(vectors: DataFrame, result: DataFrame, limit: float = 0.98, every: int = 100) -> DataFrame:
    """One row: queries, links (exact) and found. Queries are the rows whose vec_id is divisible by `every`, against all rows.

    Queries meet all rows of their label in blocks of about AUDIT rows; only counts come back.
    """
    rows = usable(vectors)
    sizes = rows.groupBy("label").agg(F.ceil(F.count("*") / AUDIT).cast("int").alias("blocks"))
    rows = rows.join(sizes, "label").withColumn("block", F.pmod(F.xxhash64("uid", "vec_id"), "blocks").cast("int"))
    query = rows.where(F.col("vec_id") % every == 0).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def count(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"vec_id": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
        x, y = left["own"].to_numpy(), right["v"].to_numpy()
        n = np.zeros(len(x), np.int64)
        for size in {len(v) for v in x}:  # vectors of another length don't link
            own, other = [k for k, v in enumerate(x) if len(v) == size], [v for v in y if len(v) == size]
            if other:
                z = np.stack(other)
                for lo in range(0, len(own), 256):
                    n[own[lo : lo + 256]] = (np.stack(x[own[lo : lo + 256]]) @ z.T >= limit).sum(axis=1)
        return pd.DataFrame({"vec_id": left["vec_id"].to_numpy(), "n": n})

    query = query.select("vec_id", F.col("v").alias("own"), F.col("label").alias("own_label"), F.col("block").alias("own_block"))
    others = rows.select("v", "label", "block").groupBy("label", "block")
    exact = query.groupBy("own_label", "own_block").cogroup(others).applyInPandas(count, "vec_id long, n long")
    exact = exact.groupBy("vec_id").agg((F.sum("n") - 1).alias("links"))
    return exact.join(result.select("vec_id", "n_links"), "vec_id").agg(F.count("*").alias("queries"), F.sum("links").alias("links"), F.sum(F.least("links", "n_links")).alias("found"))


def with_recall(vectors: DataFrame, result: DataFrame, limit: float = 0.98) -> DataFrame:
    """`result` with the audited share of links found as `recall` in every row; 1 where the audit knows no link."""
    audit = audited_recall(vectors, result, limit).first()
    return result.withColumn("recall", F.lit(audit["found"] / audit["links"] if audit["links"] else 1.0))
