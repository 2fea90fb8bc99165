"""Operators that look across rows: near-duplicates, vectors, mixing, packing, and the pipeline."""

from __future__ import annotations

import os
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from ballast.llm import mixing, neardup, packing, queries, vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
FILES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
SF = "/root/testdata/sf0.001"


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text: str, size: int) -> frozenset:
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(table, monkeypatch, size):
    monkeypatch.setattr(neardup, "BLOCK", 7)
    monkeypatch.setattr(neardup, "COLUMNS", 50)
    random.seed(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(random.choice([0, 1, 2, 4, 8, 12, 16])):
            w[random.randrange(120)] = f"x{random.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(200, None), (201, ""), (202, "One"), (203, "one"), (204, "a b c d"), (205, "A b\tc  d"), (206, "z " * 60_000), (207, "z " * 60_001)]
    rows += [(202, "One"), (None, "one")]
    out = neardup.near_duplicates(table([(a, b, None, None, None) for a, b in rows], DOCS), size=size).collect()
    assert len(out) == len(rows)
    sets = {i: shingles(t, size) for i, t in rows if i is not None}
    links = [(a, b) for a in sets for b in sets if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = union(links, sets)
    for r in out:
        if r["doc_id"] is None:
            assert r["component_id"] is None and not r["kept"]
        else:
            assert (r["component_id"], r["n_shingles"], r["kept"]) == (want[r["doc_id"]], len(sets[r["doc_id"]]), want[r["doc_id"]] == r["doc_id"])
    assert neardup.near_duplicates(table([], DOCS)).count() == 0


def test_components_of_a_path(spark):
    links = spark.range(60).selectExpr("60 - id AS a", "59 - id AS b")
    assert {tuple(r) for r in neardup.components(links).collect()} == {(i, 0) for i in range(61)}


def vector_rows(n: int) -> list[tuple]:
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8), int(rng.integers(0, 2))) for i in range(n)]
    rows += [(n + i, rows[i % 9][1] + rng.normal(size=8) * 0.08, rows[i % 9][2]) for i in range(n)]
    return [(i, [float(x) for x in v], label) for i, v, label in rows]


@pytest.mark.parametrize(("shard", "most"), [(2000, 10_000), (60, 10_000), (60, 50)])
def test_near_vectors(table, monkeypatch, shard, most):
    monkeypatch.setattr(vectors, "BLOCK", 40)
    rows = vector_rows(150)
    rows += [(900, None, 0), (901, [0.0] * 8, 0), (902, [None] + [1.0] * 7, 0), (903, [float("nan")] * 8, 0), (904, rows[0][1], None), (905, [], 0), (None, rows[0][1], 0)]
    rows += [rows[0], (906, [x * 1e200 for x in rows[0][1]], rows[0][2])]
    schema = "vec_id long, embedding array<double>, label int, kept string, n_links string"
    data = table([(*r, "x", "y") for r in rows], schema)
    result = vectors.near_vectors(data, overlap=180.0, shard=shard, shard_most=most)
    out = result.collect()
    good = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    x = np.array([np.array(r[1]) / max(map(abs, r[1])) for r in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in good])
    link = (x @ x.T >= 0.98) & (label[:, None] == label[None, :]) & ~np.eye(len(good), dtype=bool)
    want = union([(good[a][0], good[b][0]) for a, b in zip(*np.nonzero(link), strict=True)], {r[0] for r in good})
    links = Counter((r[0], int(n)) for r, n in zip(good, link.sum(axis=1), strict=True))
    links.update((r[0], 0) for r in rows if not any(r is g for g in good))
    assert Counter((r["vec_id"], r["n_links"]) for r in out) == links
    assert all(r["component_id"] == want.get(r["vec_id"], r["vec_id"]) for r in out)
    assert all(r["kept"] == (r["vec_id"] is not None and r["component_id"] == r["vec_id"]) for r in out)
    audit = vectors.audited_recall(table([(*r, "x", "y") for r in rows[:-2]], schema), vectors.near_vectors(table([(*r, "x", "y") for r in rows[:-2]], schema), shard=shard), every=10).first()
    assert audit["links"] > 0 and audit["found"] >= 0.9 * audit["links"]
    if shard == 2000:
        assert vectors.near_vectors(table([], schema)).count() == 0


def test_mixing_against_sql(spark, table):
    random.seed(7)
    rows = [(i % 390 if i % 17 else None, " ".join("w" * random.randint(0, 40)), random.choice(["en", "fr", "de", None]), random.choice(["src0", "src1", "src5", "src6", "odd", None]), 0) for i in range(400)]
    rows += [(500, None, "en", "src0", 0), (501, "", "xx", "src9", 0)]
    docs = table([(*r, "c") for r in rows], DOCS + ", domain string")
    got = mixing.mix(docs, queries.domain(), queries.WEIGHTS, queries.EPOCHS, queries.FRACTION, seed=queries.SEED)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = con.sql(queries.SQL["op7_mixing"])
    columns = ["doc_id", "domain", "lang", "source", "n_tokens", "uses"]
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(want.select(*columns).fetchall())
    assert mixing.mix(table([], DOCS), queries.domain(), queries.WEIGHTS).count() == 0


def test_mixing_shortage_goes_to_siblings_first(table):
    # a/x/s1 cannot give its half of a's budget: s2 makes up for it, b gets no more than its own half
    rows = [(i, "w " * 10, "x", "s1", 0) for i in range(2)] + [(10 + i, "w " * 10, "x", "s2", 0) for i in range(50)] + [(100 + i, "w " * 10, "x", "t1", 0) for i in range(50)]
    from pyspark.sql import functions as F

    out = mixing.mix(table(rows, DOCS), F.substring("source", 1, 1), {}, epochs=1, tokens=600)
    used = Counter()
    for r in out.collect():
        used[r["source"]] += r["uses"] * r["n_tokens"]
    assert used == {"s1": 20, "s2": 280, "t1": 300}
    twice = mixing.mix(table(rows[:2], DOCS), F.lit("d"), {}, epochs=2, tokens=1000).collect()
    assert [r["uses"] for r in twice] == [2, 2]


def test_token_ids():
    from tokenizers import Tokenizer

    whole, own = Tokenizer.from_file(FILES[0]), packing.TokenBytes(*FILES)
    odd = ["", "\n", "\n\n\n", "a\n\nb\n", "  a b", "a  b", "a \n b", "x\n\n", " x", "é b c", "<|endoftext|> a", "a <|endoftext|>b", "it's don't\ncan't", "\ta\tb", "a\r\nb", "a\x1cb c", "\xa0a b", "a b c", "a\n\n\n  b", "日本 語 12345", "a.b c!d", "ends \n"]
    random.seed(8)
    odd += ["".join(random.choices("ab1.' \n\t\xa0é", k=random.randint(1, 30))) for _ in range(2000)]
    for text in odd:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert own(text) == np.array(ids, "<u4").tobytes(), text
        assert packing.TokenBytes._slow(own, text) == own(text)


def test_packing(table):
    random.seed(9)
    rows = [(i, " ".join(random.choices(["ab", "cd.", "\n", "xyz"], k=random.choice([0, 3, 50, 400, 6000])))) for i in range(120)]
    rows += [(500, None), (500, None), (None, "no id"), (501, "word " * 9000)]
    docs = table([(a, b, None, None, None) for a, b in rows], DOCS)
    out = packing.pack(docs, *FILES, with_ids=True).collect()
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(FILES[0])
    want = Counter()
    for doc, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids), 2048), len(ids)] if len(ids) > 2048 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            own = np.array(ids[a:b], "<u4").tobytes()
            want[doc, k, a, b - a, zlib.crc32(own), own] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in out) == want
    bins: dict = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in out)
    assert len(bins) <= -(-total // 2048) + 2
    assert packing.pack(table([], DOCS), *FILES).count() == 0


def test_plan_uses_the_histogram_up():
    random.seed(10)
    for _ in range(20):
        counts = Counter(random.randint(1, 60) for _ in range(random.randint(1, 400)))
        uses = packing.plan(dict(counts), 64)
        used = Counter()
        for bin_, times in uses:
            assert sum(k * n for k, n in bin_.items()) <= 64
            for k, n in bin_.items():
                used[k] += n * times
        assert used == counts
    assert packing.fullest({5: 2, 3: 1}, 11) == Counter({5: 2}) and packing.fullest({}, 9) == Counter()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    kept = corpus_pipeline.language(spark, docs, SF)
    assert kept.columns == columns
    letters = {i for i, r in rows.items() if any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in kept.collect()} <= letters and kept.count() >= 0.98 * len(letters)
    single = corpus_pipeline.near_duplicates(spark, docs, SF)
    sets = {i: shingles(r["text"], 5) for i, r in rows.items()}
    links = [(a, b) for a in sets for b in sets if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = union(links, sets)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({*want.values()}) and single.columns == columns
    clean = {r["doc_id"]: r for r in corpus_pipeline.secrets(spark, docs, SF).collect()}
    assert clean.keys() == rows.keys() and any("[SECRET]" in r["text"] for r in clean.values())
    assert all(r["n_chars"] == len(r["text"]) for r in clean.values())
    mix = corpus_pipeline.mixed(spark, docs, SF)
    uses = {r["doc_id"]: r["uses"] for r in mixing.mix(docs, queries.domain(), queries.WEIGHTS, queries.EPOCHS, 1.0, seed=queries.SEED).collect()}
    assert Counter(r["doc_id"] for r in mix.collect()) == +Counter(uses) and mix.columns == columns


def test_pipeline_edges(spark, table, tmp_path):
    empty = table([], DOCS)
    odd = table([(None, None, None, None, None), (1, "", None, None, 0), (1, "Some words here.", "en", None, 9), (1, "Some words here.", "en", None, 9), (None, "Some words there too.", "en", "src1", 2)], DOCS)
    for data in (empty, odd):
        docs = data
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()


def test_pipeline_keeps_columns_with_names_of_its_own(spark, table):
    """All stages but the last return the columns of documents with their values, whatever they are called."""
    names = ["score", "lang_pred", "uses", "epoch", "row", "kept", "_row", "n_tokens"]
    schema = DOCS + "".join(f", {n} string" for n in names)
    rows = [(i, f"the cat number {i} sat on the mat with {i * 7} others and looked at it.", "en", "src1", 50, *[f"{n}{i}" for n in names]) for i in range(1, 9)]
    docs = table(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        got = docs.collect()
        assert got and all(r[n] == f"{n}{r['doc_id']}" for r in got for n in names)


def test_pipeline_rows_without_id_go_once_each(spark, table):
    docs = table([(None, "Same words here.", "en", "s", 9)] * 3 + [(None, "Other words here.", "en", "s", 9), (1, "Same words here.", "en", "s", 9)], DOCS)
    got = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == [(1, "Same words here."), (None, "Other words here."), (None, "Same words here.")]


def test_whole_pipeline_runs(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 50


def test_shared_folder_is_asked_for_on_a_cluster():
    from ballast.llm import common

    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(Session())
    assert os.path.exists(SF)
