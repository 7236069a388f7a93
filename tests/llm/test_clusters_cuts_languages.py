"""Operators 11 to 13 against brute force, and on odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest

from conftest import FOLDER
from factloom.llm import centroid_clusters, fill_in_middle, language_codes

VECTORS = "vec_id long, embedding array<float>, cluster string, distance string"


def lloyd(rows, k, rounds, dims):
    """Plain Lloyd on whole numbers: assignment with distances, and centroids."""
    kept = [
        (i, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)
    ]
    order = sorted(
        kept,
        key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
        if r[0] is not None
        else (True, "", r[1]),
    )
    centroids = [list(v) for _, v in order[:k]]
    for step in range(rounds + 1):
        found = []
        for i, v in kept:
            d = [sum((x - y) ** 2 for x, y in zip(v, c)) for c in centroids]
            found.append((i, d.index(min(d)), min(d)))
        if step == rounds:
            return found, centroids
        for c in range(len(centroids)):
            mine = [v for (_, v), (_, at, _) in zip(kept, found) if at == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("chunk", [3, 65_536])
def test_clusters_of_odd_vectors(spark, chunk):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.5, 0.0, 0.3, 2.0]) for _ in range(8)]) for i in range(60)]
    rows += [(7, rows[0][1]), (7, rows[0][1]), (None, rows[3][1]), (None, rows[4][1])]
    rows += [(100, None), (101, []), (102, [1.0] * 7), (103, [float("nan")] * 8)]
    rows += [(104, [float("inf")] * 8), (105, [None] * 8), (106, [-0.001] * 8)]
    frame = spark.createDataFrame([r + ("clash", "clash") for r in rows], VECTORS)
    found, final = centroid_clusters.cluster(frame.repartition(3), k=5, rounds=3, dims=8, chunk=chunk)
    expected, centroids = lloyd(rows, 5, 3, 8)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)
    places = {r["cluster"]: r for r in final.collect()}
    assert [places[c]["values"] for c in range(5)] == centroids
    for c in range(5):
        mine = [d for _, at, d in expected if at == c]
        assert (places[c]["n"], places[c]["inertia"]) == (len(mine), sum(mine))


def test_clusters_of_few_and_no_vectors(spark):
    frame = spark.createDataFrame([(1, [0.5] * 4, "", ""), (2, [9e30] * 4, "", "")], VECTORS)
    found, final = centroid_clusters.cluster(frame, dims=4)
    assert {r["vec_id"] for r in found.collect()} == {1, 2} and final.count() == 2
    # Components end at 2^27; distances stay exact.
    assert all(r["distance"] == 0 for r in found.collect())
    for part in centroid_clusters.cluster(frame.limit(0), dims=4):
        assert part.count() == 0


def test_books_lose_nothing():
    rng = np.random.default_rng(1)
    chunk = rng.integers(-3, 3, (500, 12)).astype(np.int32)
    chunk[:, 6:] = chunk[:, :1]  # repeated dimensions merge into wider blocks
    blocks = centroid_clusters.encoded(chunk)
    assert (np.hstack([book[codes] for book, codes in blocks]) == chunk).all()
    assert max(book.shape[1] for book, _ in blocks) >= 4


# --- fill in middle -------------------------------------------------------------
def units(text):
    return re.findall(r"[^\n]*\n|[^\n]+", text)


def test_boundaries_of_every_container():
    rng = random.Random(2)
    texts = ["", "a", "\n", "a\nb", "a\n\nb\n", "ü\n" * 10, "\n" * 200_000]
    texts += ["".join(rng.choice("a\n") for _ in range(150_000)) + "end"]
    texts += ["x" * 65_535 + "\n" + "y" * 65_536 + "\nz", "x" * 65_536 + "\n", "\U0001f600" * 70_000]
    for text in texts:
        ends = fill_in_middle.line_ends(text)
        expected, at = [], 0
        for unit in units(text):
            at += len(unit)
            expected.append(at)
        assert len(ends) == len(expected)
        picks = range(1, len(expected) + 1)
        for k in picks if len(expected) < 2000 else rng.sample(list(picks), 500):
            assert ends.select(k) == expected[k - 1]
    forms = {c[0] for t in texts for c in fill_in_middle.line_ends(t).containers}
    assert forms == {"array", "bitmap", "run"}


def test_fill_in_middle_of_odd_texts(spark):
    texts = [None, "", "one", "a\nb\nc", "a <P> b\nc", "ü\n\U0001f600\nz\n", "<S", "P>\n<", "x\n" * 70_000]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "a\nb", "c", 2), (3, "a\nb\nc", "c", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, form string, n long")
    out = fill_in_middle.transformed(frame).withColumn(
        "back", fill_in_middle.restored_text(fill_in_middle.F.col("output"), fill_in_middle.F.col("form"))
    )
    found = out.collect()
    assert len(found) == len(rows) and {r["_n" if "_n" in out.columns else "__n"] for r in found} == {1, 2, 3}
    for r in found:
        text = r["text"]
        digest = hashlib.sha256(f"7:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()
        h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
        u = units(text)
        low, high = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
        p, m, s = "".join(u[:low]), "".join(u[low:high]), "".join(u[high:])
        form = "plain" if not text or "<P>" in text else "spm" if h[3] % 100 < 50 else "psm"
        expected = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        assert (r["n"], r["form"], r["output"], r["back"]) == (len(u), form, expected, text)
        assert (r["prefix"], r["middle"]) == ((None, None) if form == "plain" else (p, m))
    assert fill_in_middle.transformed(frame.limit(0)).count() == 0
    assert {r["form"] for r in fill_in_middle.transformed(frame, percent=0).collect()} == {"plain"}


# --- languages ------------------------------------------------------------------
def test_codewords_stand_apart():
    for n in (2, 3, 4, 7, 8, 9, 40):
        words = language_codes.codewords(n).astype(int)
        apart = [(words[a] != words[b]).sum() for a in range(n) for b in range(a)]
        assert min(apart) * 2 >= words.shape[1] and len({tuple(w) for w in words}) == n
        assert all(set(column) == {1, -1} for column in words.T if n < 8)


def test_held_out_accuracy(spark):
    rows = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet")
    found = {(r["doc_id"], r["held_out"]): r for r in language_codes.identified(rows).collect()}
    right = total = 0
    for r in rows.collect():
        mine = found[r["doc_id"], language_codes.fold(r["doc_id"]) == 0]
        assert 0 <= mine["score"] <= 1
        if mine["held_out"] and r["lang"] is not None:
            total, right = total + 1, right + (mine["lang_pred"] == r["lang"])
    assert total > 100 and right / total >= 0.99


def test_margins_by_brute_force(spark):
    rows = [(1, "aa bb", "x"), (2, "aa", "x"), (3, "cc dd", "y"), (4, "ee", "z"), (5, "q", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_codes.train(frame)
    assert model.languages == ["x", "y", "z"]
    counts = {l: np.full(language_codes.BUCKETS, language_codes.SMOOTHING) for l in "xyz"}
    grams = lambda t: [t[i : i + n] for n in range(1, 5) for i in range(len(t) - n + 1)]
    for _, text, lang in rows[:4]:
        for gram in grams(f" {text} "):
            counts[lang][language_codes.buckets(gram)[-1]] += 1
    chance = {l: c / c.sum() for l, c in counts.items()}
    seen = [language_codes.buckets(g)[-1] for g in grams(" aa ee ")]
    shrink = language_codes.EVIDENCE / (language_codes.EVIDENCE + len(seen))
    for bit, word in enumerate(model.words.T):
        side = {s: np.mean([chance[l] for l, w in zip("xyz", word) if w == s], axis=0) for s in (1, -1)}
        expected = sum(np.log(side[1][b] / side[-1][b]) for b in seen) * shrink
        assert model.margins("AA, 12 ee!")[bit] == pytest.approx(expected, rel=1e-4)


def test_odd_texts_have_a_language(spark):
    rows = [(1, None, "x", "c"), (1, "", "x", "c"), (2, "123 ½ !?", "x", "c"), (None, "aa", "x", "c")]
    rows += [(i, "aa bb " * 3, "x", "c") for i in range(10, 20)] + [(30, "cc dd", "y", "c")] * 2
    rows += [(40, "aa bb cc dd", None, "c"), (41, "aa " * 300_000, None, "c"), (6, "aa bb cc dd", None, "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    found = language_codes.identified(frame).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["held_out"] == (language_codes.fold(r["doc_id"]) == 0)
        if r["doc_id"] in (1, 2):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] == 41:
            assert r["lang_pred"] == "x" and r["score"] > 0.9
    mixed = [r for r in found if r["doc_id"] in (6, 40)]
    assert {r["second"] for r in mixed} | {r["lang_pred"] for r in mixed} <= {"x", "y"}
    assert language_codes.identified(frame.limit(0)).count() == 0
    untold = frame.withColumn("lang", language_codes.F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_codes.identified(untold).collect()} == {"und"}
