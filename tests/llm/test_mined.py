"""Whitening, collocations and the neighbour vote against plain computations."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ballast.llm import collocation, neighbour_vote, queries, vectors, whitening
from tests.conftest import SF

VECTORS = "vec_id long, embedding array<double>, label int, n string, component string"


def whitened(rows):
    """By rows of whole numbers: deviations, and per component the share and all projections, from the dense covariance."""
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for v in x]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums, strict=True)] for v in x])
    cov = centred.T @ centred / n
    e, q = np.linalg.eigh(cov)
    return deviation, e[::-1], centred @ q[:, ::-1], float(np.trace(cov))


def check_whitening(got, ids, rows):
    deviation, e, projected, trace = whitened(rows)
    k = min(8, int((e > 1e-18 * e[0]).sum()))
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert len(got) == len(ids) * k == len(by)
    table = np.array([[by[i, c + 1]["whitened"] for c in range(k)] for i in ids])
    assert np.allclose(table.T @ table / len(ids), np.eye(k), atol=1e-9)
    want = projected[:, :k] / np.sqrt(e[:k])
    sign = np.sign((table * want).sum(axis=0))
    gaps = np.abs(np.subtract.outer(e, e))[:k] + np.eye(len(e))[:k] * e[0]
    alone = gaps.min(axis=1) > 1e-6 * e[0]  # components of equal variance may turn among themselves
    assert np.allclose(table[:, alone], (want * sign)[:, alone], atol=1e-7)
    for i, row in zip(ids, deviation, strict=True):
        for c in range(k):
            r = by[i, c + 1]
            assert (r["n"], r["deviation"]) == (len(ids), row if row < 1 << 63 else None)
            assert r["explained"] == pytest.approx(e[c] / trace, rel=1e-9) and r["identity_error"] < 1e-8


@pytest.mark.parametrize("case", ["plain", "few dimensions", "low rank", "equal variances", "large"])
def test_whitening(table, monkeypatch, case):
    monkeypatch.setattr(whitening, "BLOCK", 64)
    rng = np.random.default_rng(3)
    rows = {
        "plain": rng.normal(size=(40, 12)) * np.arange(1, 13),
        "few dimensions": rng.normal(size=(20, 3)),
        "low rank": rng.normal(size=(30, 2)) @ rng.integers(-3, 4, (2, 9)),
        "equal variances": np.vstack([np.eye(6), -np.eye(6)]) * 4,
        "large": rng.normal(size=(12, 9)) * 1e9,
    }[case]
    data = [(i, [float(c) for c in v], 0, "x", "y") for i, v in enumerate(rows)]
    check_whitening(whitening.whiten(table(data, VECTORS)).collect(), range(len(rows)), rows)


def test_whitening_edges(table):
    odd = [(900, None), (901, []), (902, [None, 1.0, 2.0]), (903, [float("nan")] * 3), (904, [float("inf"), 0.0, 0.0]), (905, [1e300] * 3), (906, [1.0, 2.0])]
    rows = [(i, [float(i % 5), float(i % 3), float(i)]) for i in range(9)] + [(3, [3.0, 0.0, 3.0])]
    made = [(a, b, None, None, None) for a, b in rows + odd]
    got = whitening.whiten(table(made, VECTORS)).collect()
    assert len(got) == 30 and {r["vec_id"] for r in got} == set(range(9)) and {r["n"] for r in got} == {10}
    assert whitening.whiten(table([], VECTORS)).count() == 0
    assert whitening.whiten(table([(1, [1.0, 2.0], 0, "", "")] * 3, VECTORS)).count() == 0  # no variance
    assert whitening.whiten(table([(a, b, None, None, None) for a, b in odd[:6]], VECTORS)).count() == 0
    none = whitening.whiten(table([(None, [0.0, 1.0], 0, "", ""), (1, [1.0, 0.0], 0, "", "")], VECTORS)).collect()
    assert {r["vec_id"] for r in none} == {None, 1}


def test_whitening_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = {r["vec_id"]: r["embedding"] for r in docs.collect()}
    check_whitening(queries.op11_whitening(spark, SF).collect(), list(rows), list(rows.values()))


DOCS = "doc_id long, text string, lang string, source string, rank long, phrase string"


def mined(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = {(lang, part) for (lang, p), a in found.items() if len(p) == 3 for part in (p[:2], p[1:]) if 100 * a >= 50 * f[lang, part]}
    out = defaultdict(list)
    for (lang, p), a in found.items():
        if (lang, p) not in gone:
            score, k = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, lo, r, n[lang], -s) for lang in out for i, (s, a, p, lo, r) in enumerate(sorted(out[lang])[:top]))


def corpus(seed, n=120):
    rnd = random.Random(seed)
    words = ["a", "B", "b", "é", "É", "x y", "the", "of", "New", "York", "new", "york", "ab", "a-b", " ", "ß"]
    joins = [" "] * 9 + ["  ", "\t", ". ", ",", "\n", "\r\n", "! ", "\x0b", ";"]
    text = lambda: "".join(x for _ in range(rnd.randrange(60)) for x in (rnd.choice(words), rnd.choice(joins)))
    rows = [(rnd.choice(["en", "fr", None, ""]), text()) for _ in range(n)]
    rows += [("en", None), ("en", ""), (None, None), ("en", " . "), ("en", "a a a a a a a a a a a a"), ("en", "one two three " * 4000)]
    return rows + [("de", "same row of words here")] * 12


@pytest.mark.parametrize(("block", "part", "top"), [(1 << 24, 1 << 22, 2000), (300, 500, 7)])
def test_collocation(table, monkeypatch, block, part, top):
    monkeypatch.setattr(collocation, "BLOCK", block)
    monkeypatch.setattr(collocation, "OPEN", 2 * block)
    monkeypatch.setattr(collocation, "PART", part)
    rows = corpus(1)
    data = table([(i, text, lang, "s", 1, "p") for i, (lang, text) in enumerate(rows)], DOCS)
    got = sorted(tuple(r) for r in collocation.mine(data, 10, top).collect())
    assert got == mined(rows, 10, top) and len({r[0] for r in got}) >= 4


def test_collocation_sql_and_edges(table):
    assert collocation.mine(table([], DOCS)).count() == 0
    assert collocation.mine(table([(1, "too few", "en", "s", 1, "p"), (None, None, None, None, None, None)], DOCS)).count() == 0
    rows = [(lang, None if text is None else text.replace(" ", "")) for lang, text in corpus(2, 60)]
    con = duckdb.connect()
    docs = pa.table({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]})  # noqa: F841
    assert sorted(con.execute(queries.collocation_sql("docs")).fetchall()) == mined(rows, 10, 2000)


def test_words_end_pieces_at_breaks_and_texts():
    words, ends = collocation._words(pa.array(["Ab c.", "", "d", "e,f g"], pa.large_string()))
    assert [w.decode() for w in words.to_pylist()] == ["ab", "c", "d", "e", "f", "g"]
    assert ends.tolist() == [False, True, True, True, False, True]
    assert len(collocation._words(pa.array([" .", ""], pa.large_string()))[0]) == 0


LABELS = "doc_id long, quality int, toxic int"


def labelled_docs(n=400):
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 8))) for _ in range(300)]
    good = lambda: " ".join(rnd.choices(words, k=rnd.randint(20, 60))).capitalize() + "."
    bad = [
        lambda: " ".join(f"{w}$$$" for w in rnd.choices(words, k=30)),
        lambda: " ".join(rnd.choices(words, k=30)).upper() + "!!",
        lambda: " ".join(w for w in rnd.choices(words, k=4) for _ in range(12)),
    ]
    rows = [(i, rnd.choice(bad)() if i % 5 == 0 else good(), int(i % 5 != 0)) for i in range(n)]
    return rows


def test_neighbour_vote_held_out(table):
    rows = labelled_docs()
    docs = table([(i, text, "en", "s", 1, "p") for i, text, _ in rows], DOCS)
    labels = table([(i, q, 0) for i, _, q in rows if i % 3] + [(1, None, 0), (2, 7, 0), (None, 1, 0), (10**6, 1, 0)], LABELS)
    got = {r["doc_id"]: r for r in neighbour_vote.score(docs, labels).collect()}
    held = [(i, q) for i, _, q in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    assert sum(got[i]["predicted"] == q for i, q in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    # labels of held-out documents teach nothing
    turned = table([(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 0) for i, _, q in rows if i % 3], LABELS)
    again = {r["doc_id"]: r["score"] for r in neighbour_vote.score(docs, turned).collect()}
    assert again == {i: r["score"] for i, r in got.items()}


def test_neighbour_vote_edges(table):
    rows = [(1, None, "en", "s", 1, "p"), (2, "", "en", "s", 1, "p"), (None, "no id", "en", "s", 1, "p"), (3, "x" * 3_000_000, "en", "s", 1, "p"), (4, "same", "en", "s", 1, "p"), (4, "same", "en", "s", 1, "p")]
    nothing = neighbour_vote.score(table(rows, DOCS), table([], LABELS)).collect()
    assert len(nothing) == 6 and {r["score"] for r in nothing} == {0.5}
    some = neighbour_vote.score(table(rows, DOCS), table([(1, 0, 0), (3, 1, 0), (4, 1, 0), (4, 0, 0)], LABELS)).collect()
    assert len(some) == 6 and all(0 <= r["score"] <= 1 for r in some)
    assert neighbour_vote.score(table([], DOCS), table([(1, 1, 0)], LABELS)).count() == 0


def test_votes_equal_brute_force():
    rows = labelled_docs(120)
    counter = neighbour_vote.Counter()
    counts = counter.counts(pa.array([text for _, text, _ in rows]))
    space = neighbour_vote.Space(counts[:80], np.array([q for _, _, q in rows[:80]]))
    unit = lambda x: x / np.linalg.norm(x)
    for row, score in zip(counts[80:], space.scores(counts[80:]), strict=True):
        own = unit(unit(np.sqrt(row) * space.weight) @ space.turn)
        best = sorted(((float(own @ p), float(q)) for p, q in zip(space.points, space.labels, strict=True)), reverse=True)[: neighbour_vote.VOTERS]
        weight = [max(c, 0) ** neighbour_vote.POWER for c, _ in best]
        assert score == pytest.approx(sum(w * q for w, (_, q) in zip(weight, best, strict=True)) / sum(weight), abs=1e-3)


def test_counts_do_not_depend_on_steps(monkeypatch):
    texts = pa.array(["ab ab cd ab", None, "", "é é", "word " * 200, "a"])
    whole = neighbour_vote.Counter().counts(texts)
    monkeypatch.setattr(neighbour_vote, "STEP", 16)
    assert (neighbour_vote.Counter().counts(texts) == whole).all()
    assert whole[0, neighbour_vote.BUCKETS :].tolist() == [1, 1] and whole[4, neighbour_vote.BUCKETS] == 199
    assert whole[0, : neighbour_vote.BUCKETS].sum() == 10 and not whole[1:3].any()


@pytest.mark.parametrize("size", [3, 8])
def test_near_vectors_over_many_shards_at_the_defaults(table, size):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, size))
    if size > 3:
        x = x[rng.integers(0, 60, 6000)] + rng.normal(size=x.shape) * 0.1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    data = table([(i, [float(c) for c in v], 0, "", "") for i, v in enumerate(x)], VECTORS)
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(data, 0.98, shard=500).collect()}
    want = (x @ x.T >= 0.98).sum(axis=1) - 1
    assert [got[i] for i in range(6000)] == want.tolist()
    result = vectors.near_vectors(data, 0.98, shard=500)
    assert vectors.with_recall(data, result).first()["recall"] == 1.0
