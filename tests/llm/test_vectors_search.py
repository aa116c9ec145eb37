"""Whitening, near copies among embeddings and ranked lexical search, against brute force."""

import collections
import math
import re

import numpy as np
import pytest

from xylemflow.llm import embedding_dedup, lexical_search, whitening

VECTORS = "vec_id long, embedding array<double>, label int, row_nr int, class_id int, digest string, x int, dim int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, 0, 1, "d", 2, 3) for i, v, label in rows], VECTORS)


def near_by_force(rows, cosine=0.93):
    def usable(v, label):
        return label is not None and v is not None and len(v) and None not in v and all(map(math.isfinite, v)) and any(v)

    n = len(rows)
    links = [[] for _ in range(n)]
    for a in range(n):
        for b in range(n):
            (_, v, x), (_, w, y) = rows[a], rows[b]
            if a != b and usable(v, x) and usable(w, y) and x == y and len(v) == len(w):
                if math.fsum(p * q for p, q in zip(v, w)) / math.sqrt(math.fsum(p * p for p in v) * math.fsum(q * q for q in w)) >= cosine:
                    links[a].append(b)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        ids = [rows[b][0] for b in seen if rows[b][0] is not None]
        component = min(ids) if ids else None
        out.append((rows[a][0], len(links[a]), component, rows[a][0] == component))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


def test_near_embeddings(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 24))
    rows = [(i, rng.standard_normal(24).tolist(), i % 3) for i in range(0, 60)]
    # Chains and clusters of distinct near copies, copies, and a scaled copy.
    rows += [(100 + i, (centres[i % 6] + 0.3 * rng.standard_normal(24)).tolist(), i % 2) for i in range(150)]
    rows += [(400 + i, centres[0].tolist(), 0) for i in range(40)] + [(441, (2.5 * centres[0]).tolist(), 0), (442, centres[0].tolist(), 1)]
    rows += [(500, None, 0), (501, [], 0), (502, [0.0] * 24, 0), (503, [None] + [1.0] * 23, 0), (504, [float("nan")] * 24, 0)]
    rows += [(505, [float("inf")] * 24, 0), (506, centres[0].tolist(), None), (507, centres[0][:7].tolist(), 0), (None, centres[1].tolist(), 1)]
    rows += [(508, [1e200] * 24, 2), (509, [1e200] * 24, 2), (509, [2e-200] * 24, 2), (5, centres[2].tolist(), 0), (5, centres[2].tolist(), 0)]
    safe = [r for r in rows if r[0] not in (508, 509)]
    got = [tuple(r) for r in embedding_dedup.near_copies(vectors_of(spark, rows)).collect()]
    assert ordered(r for r in got if r[0] not in (508, 509)) == ordered(near_by_force(safe))
    assert ordered(r for r in got if r[0] in (508, 509)) == [(508, 2, 508, True), (509, 2, 508, False), (509, 2, 508, False)]


def test_near_embeddings_in_small_blocks(spark, monkeypatch):
    """One hot group over many blocks gives the same links as whole buckets."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + 0.27 * rng.standard_normal(16)).tolist() if i % 3 == 0 else rng.standard_normal(16).tolist(), 1) for i in range(300)]
    got = [tuple(r) for r in embedding_dedup.near_copies(vectors_of(spark, rows)).collect()]
    want = near_by_force(rows)
    found, real = sum(r[1] for r in got), sum(r[1] for r in want)
    assert real * 0.99 <= found <= real
    assert all(a[1] <= b[1] for a, b in zip(ordered(got), ordered(want)))


def test_near_embeddings_of_nothing(spark):
    assert embedding_dedup.near_copies(vectors_of(spark, [])).count() == 0
    assert [tuple(r) for r in embedding_dedup.near_copies(vectors_of(spark, [(3, None, None)])).collect()] == [(3, 0, 3, True)]


def test_plan_keeps_the_chance_of_a_miss():
    for n in (1, 10**3, 10**6, 10**9):
        bits, tables = embedding_dedup.plan(n)
        together = (1 - math.acos(0.93) / math.pi) ** bits
        assert (1 - together) ** tables <= 0.001


def test_whitening(spark):
    rng = np.random.default_rng(7)
    spread = rng.standard_normal((20, 20)) * np.linspace(3, 0.1, 20)
    good = (rng.standard_normal((500, 20)) @ spread + 5).tolist()
    rows = [(i, v, 1) for i, v in enumerate(good)] + [(3, good[3], 1), (None, good[4], 1)]
    rows += [(900, None, 1), (901, [], 1), (902, [None] * 20, 1), (903, [float("nan")] + [0.0] * 19, 1), (904, [1.0] * 19, 1)]
    got = whitening.whiten(vectors_of(spark, rows)).toPandas()
    kept = np.array([v for _, v, _ in rows[:502]])
    x = np.floor(64 * kept).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    y = x - total / n
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == n * 20 and (got["n"] == n).all()
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9
    want = {(i, c): (float(w), int(d)) for i, ws, d in zip(range(500), (y @ vectors / np.sqrt(values))[:500], ((n * x - total) ** 2).sum(axis=1)) for c, w in enumerate(ws, 1)}
    signs = {}
    for row in got[got["vec_id"].notna() & (got["vec_id"] != 3)].itertuples():
        w, d = want[int(row.vec_id), row.component]
        assert row.deviation == d
        assert abs(row.explained - values[row.component - 1] / np.trace(v)) < 1e-9
        sign = signs.setdefault(row.component, np.sign(w * row.whitened))
        assert abs(row.whitened * sign - w) < 1e-8
    assert (got[got["vec_id"] == 3].groupby("component").whitened.nunique() == 1).all()


def test_whitening_of_little(spark):
    assert whitening.whiten(vectors_of(spark, [])).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).count() == 0
    flat = whitening.whiten(vectors_of(spark, [(i, [float(i % 5), 7.0, float(i % 5)], 0) for i in range(50)]))
    assert flat.select("component").distinct().count() == 1
    huge = whitening.whiten(vectors_of(spark, [(1, [1e300, 0.0], 0), (2, [0.0, 1.0], 0)]))
    assert huge.where("deviation IS NULL").count() == huge.count() > 0


@pytest.mark.parametrize("n", [1, 2, 9, 70])
def test_contours_find_the_spectrum(n):
    a = np.random.default_rng(n).standard_normal((n, n))
    a = a @ a.T
    values = np.linalg.eigvalsh(a)[::-1]
    intervals = whitening.spectrum_intervals(a, 32, 1e-13 * values[0])
    found = []
    for low, high, count in intervals:
        inside, vectors = whitening.feast(a, low, high, count)
        assert len(inside) == count and np.abs(a @ vectors - vectors * inside).max() < 1e-11 * values[0]
        found += sorted(inside, reverse=True)
    assert np.allclose(found[:32], values[:32], rtol=1e-9)


def test_inertia_keeps_clusters_together():
    a = np.diag([5.0] * 12 + [3.0] * 40 + [1.0] * 3)
    assert [count for _, _, count in whitening.spectrum_intervals(a, 32, 1e-12)] == [12, 40]


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    lower = {c: c + 32 for c in range(65, 91)}
    return TERM.findall((text or "").translate(lower))


def search_by_force(docs, items, k=10):
    held = [(i, collections.Counter(terms_of(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_all, l_all = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, counts in held:
            score, m = 0, 25 + 75 * sum(counts.values()) * n_all // l_all
            for t in terms_of(text):
                if counts[t]:
                    score += math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return out


WORDS = "the Cat sat ON mat-ürgency x1 x1y 中文 🙂smile ABC_def a a' b".split()


@pytest.mark.parametrize("cells, blocks", [(lexical_search.CELLS, lexical_search.BLOCK_POSTINGS), (64, 5)])
def test_search(spark, monkeypatch, cells, blocks):
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    monkeypatch.setattr(lexical_search, "EXPANDED", cells)
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", blocks)
    rng = np.random.default_rng(3)
    text = lambda n: " ".join(rng.choice(WORDS, n))
    docs = [(i, text(rng.integers(1, 30))) for i in range(80)]
    docs += [(90 + i, "same words here the the") for i in range(15)] + [(90, "same words"), (None, "same words here the the")]
    docs += [(200, None), (201, ""), (202, "--- ,,, \x00"), (203, "the " * 5000), (204, "Ünïcode space"), (205, "x1\x7fx1y")]
    items = [(i, text(6)) for i in range(9)] + [(9, "same the THE words"), (10, None), (11, ""), (12, "unheardof"), (9, "x1 x1 smile 中文"), (None, "cat")]
    frame = lambda rows, name: spark.createDataFrame([(i, t, 7, 8, 9) for i, t in rows], f"{name} long, text string, doc_row int, rank int, item int")
    got = [tuple(r) for r in lexical_search.search(frame(docs, "doc_id"), frame(items, "item_id")).collect()]
    assert ordered(got) == ordered(search_by_force(docs, items))


def test_search_of_nothing(spark):
    nothing = spark.createDataFrame([], "doc_id long, item_id long, text string")
    some = spark.createDataFrame([(1, 1, "a b")], "doc_id long, item_id long, text string")
    assert lexical_search.search(nothing, some).count() == lexical_search.search(some, nothing).count() == 0


def test_scores_beyond_exact_doubles():
    """Sums in two halves agree with integers where doubles would not be exact."""

    class Held:
        value = (np.array([27_000]), np.array([0, 1]), np.array([0]), np.array([10**7]), 1, False)

    import pyarrow as pa

    from xylemflow.llm.hashing import binary_column

    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([0]), pa.array([977]), binary_column(np.array([0], np.int32), np.array([0, 1])), binary_column(np.array([977]), np.array([0, 1]))],
        names=["doc_id", "doc_row", "n", "terms", "times"],
    )
    (out,) = lexical_search._scores(iter([batch]), Held, 5, 10_007, 10)
    m = 25 + 75 * 977 * 5 // 10_007
    assert out.column(3).to_pylist() == [10**7 * 27_000 * (977 * 10**9 // (977_000 + 8 * m))]
