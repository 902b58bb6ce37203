"""Norm-bucketed search, hard negatives and source divergence against brute force and their SQL."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle_check import compare, duck

from songpulse.llm import divergence, hard_negatives, norm_search, queries, vector_blocks
from songpulse.llm.oracle import ORACLE

VECTORS = "vec_id long, embedding array<double>, label int, rank int, score long, v string"


@pytest.mark.parametrize("name", ["op11_top_products", "op12_hard_negatives", "op13_source_divergence"])
def test_queries_equal_their_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    problems, n = compare(queries.QUERIES[name](spark, sf), duck(sf), ORACLE[name])
    assert not problems and n


def whole(x):
    if math.isinf(256 * x):
        return vector_blocks.MOST if x > 0 else -(2**63)
    return min(2**63 - 1, max(-(2**63), math.floor(256 * x)))


def taking_part(rows, labelled=False):
    kept = {}
    for vec_id, v, label, *_ in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v) or labelled and label is None:
            continue
        kept[vec_id] = min(kept.get(vec_id, ([whole(x) for x in v], label)), ([whole(x) for x in v], label))
    return kept


def product(a, b):
    return min(vector_blocks.MOST, max(vector_blocks.LEAST, sum(x * y for x, y in zip(a, b, strict=True))))


def top(rows, every, k):
    kept, out = taking_part(rows), set()
    for q, (v, _) in kept.items():
        if q % every == 0:
            scores = sorted((-product(v, w), i) for i, (w, _) in kept.items() if i != q and len(w) == len(v))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    return out


def mined(rows, every, k=5):
    kept, out = taking_part(rows, labelled=True), set()
    for a, (v, label) in kept.items():
        if a % every:
            continue
        scores = sorted((-product(v, w), i, other) for i, (w, other) in kept.items() if i != a and len(w) == len(v))
        for p, positive, _ in [s for s in scores if s[2] == label][:k]:
            fine = [(s, i) for s, i, other in scores if other != label and 80 * -p <= 100 * -s <= 100 * -p][:k]
            out |= {(a, positive, n + 1, i, -p, -s) for n, (s, i) in enumerate(fine)}
    return out


def random_rows(seed, n, dims, spread):
    """Vectors around a few directions, of several lengths, with copies; labels of uneven sizes."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, dims))
    v = centres[rng.integers(0, 4, n)] + spread * rng.standard_normal((n, dims))
    v *= rng.choice([0.05, 0.5, 1, 1, 3], (n, 1))
    v[rng.random(n) < 0.3] = v[0]
    return [(i, [float(x) for x in row], int(label), 1, 1, "x") for i, (row, label) in enumerate(zip(v, rng.choice([0, 0, 0, 1, 2], n), strict=True))]


ODD = [
    (None, [1.0, 2.0], 1, 0, 0, ""), (20, None, 1, 0, 0, ""), (30, [1.0, None], 1, 0, 0, ""), (40, [math.nan, 1.0], 1, 0, 0, ""),
    (50, [math.inf, 1.0], 0, 0, 0, ""), (60, [0.0, 0.0], 0, 0, 0, ""), (70, [0.001, -0.001], None, 0, 0, ""), (80, [1.0], 0, 0, 0, ""),
    (90, [], 0, 0, 0, ""), (100, [1e200, 1.0], 0, 0, 0, ""), (110, [-1e200, 1e-200], 1, 0, 0, ""), (120, [3.0, 1.0], 0, 0, 0, ""),
    (120, [3.0, 1.0], 0, 0, 0, ""), (120, [2.0, 5.0], 1, 0, 0, ""), (-10, [2.0, 2.0], 1, 0, 0, ""), (-20, [2.0, 2.0], 0, 0, 0, ""),
    (130, [1e6, 1e6], 0, 0, 0, ""), (140, [1e6, -1e6], 1, 0, 0, ""), (95, [], 1, 0, 0, ""), (96, [2.5, 2.0], 0, 0, 0, ""),
]


def found_top(spark, rows, every, k, **options):
    df = spark.createDataFrame(rows, VECTORS)
    return [tuple(r) for r in norm_search.top_products(df, df.where(f"vec_id % {every} = 0"), k, **options).collect()]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_top_products_over_many_blocks(spark, spread):
    rows = random_rows(3, 900, 6, spread)
    got = found_top(spark, rows, 30, 5, block_cells=6 * 40)
    assert len(got) == len(set(got)) and set(got) == top(rows, 30, 5)


def test_coordinates_leave_all_that_reach_the_cosine():
    rng = np.random.default_rng(5)
    v = (rng.standard_normal((4, 8))[rng.integers(0, 4, 2000)] + 0.3 * rng.standard_normal((2000, 8)) * 1).__mul__(300).astype(np.int64)
    bucket = norm_search.Bucket(np.arange(2000), v)
    fewer = 0
    for q in v[:40]:
        direction = q / np.linalg.norm(q)
        for cosine in (0.8, 0.9, 0.99, 1.0):
            near = set(np.flatnonzero(bucket.directions @ direction >= cosine).tolist())
            left = set(bucket.by_coordinates(direction, cosine).tolist())
            assert near <= left
            fewer += len(left) < 1000
    assert fewer > 100


def test_odd_vectors(spark):
    got = found_top(spark, ODD, 10, 3, block_cells=8)
    assert sorted(got) == sorted(top(ODD, 10, 3))
    df = spark.createDataFrame(ODD, VECTORS)
    got = [tuple(r) for r in hard_negatives.mine(df, df.where("vec_id % 10 = 0"), block_cells=8).collect()]
    assert sorted(got) == sorted(mined(ODD, 10))


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_hard_negatives_over_many_blocks(spark, spread):
    rows = random_rows(7, 900, 20, spread)
    df = spark.createDataFrame(rows, VECTORS)
    got = [tuple(r) for r in hard_negatives.mine(df, df.where("vec_id % 60 = 0"), block_cells=20 * 50).collect()]
    want = mined(rows, 60)
    assert len(got) == len(set(got)) and set(got) == want and want


def test_scan_leaves_rows_early():
    rng = np.random.default_rng(1)
    v = rng.integers(-60, 60, (3000, 64))
    v[:20] = v[0] + rng.integers(-2, 2, (20, 64))
    seen = []
    columns = hard_negatives.Columns(v)

    def alive(rows, lower, upper):
        seen.append(len(rows))
        return upper >= hard_negatives._kth(lower, 5)

    rows, scores = columns.scan(v[0], np.ones(3000, bool), alive)
    assert seen[-1] < 1500 and set(np.argsort(-(v @ v[0]))[:5]) <= set(rows.tolist())


def test_vector_searches_of_empty_tables(spark):
    df = spark.createDataFrame([], VECTORS)
    assert norm_search.top_products(df, df).collect() == [] and hard_negatives.mine(df, df).collect() == []


# ---- divergence ------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, term string, n long, kept string, item string"


def audited(rows, min_docs):
    words = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, found in words:
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = set()
    for (lang, source), own in counts.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        total = Counter()
        for c in groups.values():
            total.update(c)
        price = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[u] for u in kept) + 2 * len(kept)) for t in kept}
        gap = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = price(own), price(total)
        parts = {
            "pair": [(-sum(gap(p[t], r[t]) for t in kept), s) for s, r in ((s, price(c)) for s, c in groups.items() if s != source)],
            "term": [(-gap(p[t], q[t]), t) for t in kept if own[t] and p[t] > q[t]],
        }
        for part, items in parts.items():
            ranked = sorted(items, key=lambda x: (x[0], x[1].encode()))
            out |= {(lang, source, part, item, -v, n + 1) for n, (v, item) in enumerate(ranked) if part == "pair" or n < 10}
    return out


def corpus(seed):
    rng = np.random.default_rng(seed)
    names = ["the", "The", "straße", "漢字", "É", "é", "x1y", "zz"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(4)]
    sources = [f"s{i}" for i in range(9)] + [None, "", "S"]
    rows = []
    for _ in range(400):
        s = int(min(rng.geometric(0.3) - 1, 11))
        text = " ".join(rng.choice(names[s % 5 :], rng.integers(0, 30)).tolist())
        rows.append((text, [None, "", "en", "de"][min(int(rng.geometric(0.5)) - 1, 3)], sources[s]))
    return rows + [(None, "fr", "a"), ("", "fr", "b"), ("only once", "fr", None), (None, None, "lone"), ("!!! 123", "en", "no-terms")]


@pytest.mark.parametrize("tiles", [1, 3, 64])
def test_audit_equals_brute_force(spark, tiles):
    rows = corpus(tiles)
    df = spark.createDataFrame([(i, *r, "t", 1, "k", "i") for i, r in enumerate(rows)], DOCS)
    got = [tuple(r) for r in divergence.audit(df, min_docs=4, block_terms=7, tile_groups=tiles).collect()]
    assert len(got) == len(set(got)) and set(got) == audited(rows, 4)


def test_audit_of_an_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).collect() == []


def test_long_text_is_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE_BYTES", 5)
    text = "Alpha beta,GAMMA straße 漢字x " * 50
    got = [t.decode() for piece in divergence.terms(text.encode()) for t in piece]
    assert got == re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def test_quadtree_pairs_equal_dense_sums():
    rng = np.random.default_rng(2)
    for n_rows, n_columns, share in ((1, 1, 1.0), (5, 40, 0.05), (30, 17, 0.4), (6, 90, 0.0)):
        dense = np.where(rng.random((n_rows, n_columns)) < share, rng.integers(1, 2**40, (n_rows, n_columns)), 0)
        totals = dense.sum(1)
        rows, columns = np.nonzero(dense)
        pairs = np.array([(a, b) for a in range(n_rows) for b in range(a + 1, n_rows)], np.int64).reshape(-1, 2)
        got = divergence.pair_sums(rows, columns, dense[rows, columns], totals, n_columns, n_columns, pairs)
        for (a, b), value in zip(pairs.tolist(), got.tolist(), strict=True):
            p, q = ([1 + 10**9 * (int(c) + 2) // (int(totals[r]) + 2 * n_columns) for c in dense[r]] for r in (a, b))
            assert value == sum((x - y) ** 2 // (x + y) for x, y in zip(p, q, strict=True))


def test_zero_quadrants_are_priced_once():
    """Two rows that share a run of zero columns cost no visit per column."""
    tree = divergence.Quadtree(np.array([0, 1]), np.array([0, 1]), 1 << 12)
    visits = sum(len(pair) for pair, *_ in tree.walk(np.array([[0, 1]]), 1 << 12))
    assert visits < 40
