"""Near-duplicates and components against brute force; copies, chains, edge cases."""

import random
import re

import numpy as np
import pytest

from songpulse.llm import minhash, shingles
from songpulse.llm.components import components, forest_roots


def brute(rows, k, threshold=80):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed):
    rnd = random.Random(seed)
    text = lambda n: [f"w{rnd.randrange(500)}" for _ in range(n)]
    rows, passage = [], text(40)
    for i in range(60):
        base = text(rnd.randrange(30, 120))
        if i % 4 == 0:
            base = base[:30] + passage
        rows.append(" ".join(base))
        for _ in range(rnd.choice([0, 0, 1, 6])):  # a chain of edits: neighbours link, the ends need not
            base = list(base)
            for _ in range(rnd.randrange(4)):
                base[rnd.randrange(len(base))] = f"x{rnd.randrange(99)}"
            rows.append(" ".join(base))
    rows += [rows[0]] * 150 + [rows[1].upper(), "a b", "A\tb", "a", "", None, "  \n", "a b c d", "é É", "é é"]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k", [4, 5])
def test_classes_match_brute_force(spark, k):
    rows = corpus(k)
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n int, key int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.classes(docs, shingle_words=k).collect()}
    assert got == brute(rows, k)


def test_hot_buckets_in_parts(spark, monkeypatch):
    """Classes of a hot group that mostly share bands but stay apart; every part meets every other one."""
    monkeypatch.setattr(minhash, "PART_ROWS", 4)
    rnd = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(120):
        changed = [f"x{rnd.randrange(9)}" if rnd.random() < 0.04 else w for w in passage]
        rows.append((i, " ".join(changed)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = docs.selectExpr("1L key", "doc_id id", "doc_id label", "120L size")
    fine = docs.selectExpr("doc_id id", "50L n", "array(1L) bands", *(f"0L {f}" for f in minhash._FINE))
    pairs = [tuple(sorted(r)) for r in minhash._thinned_across(left, fine, 80).collect()]
    assert sorted(pairs) == [(a, b) for a in range(120) for b in range(a + 1, 120)]
    for k in (2, 4):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.classes(docs, shingle_words=k).collect()}
        assert got == brute(rows, k)


def test_repeated_null_and_empty_rows(spark):
    schema = "doc_id long, text string, component_id string"
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "a b c d e f", "x"), (2, None, "x"), (3, "", "x"), (None, None, "x")], schema)
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in minhash.classes(docs).collect())
    assert got == [("1", "1"), ("1", "1"), ("2", "2"), ("3", "3"), ("None", "1"), ("None", "None")]
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "None"]
    assert minhash.classes(docs.limit(0)).count() == 0 and minhash.deduplicate(docs.limit(0)).count() == 0


def test_circulant_signature_estimates_similarity():
    rnd = np.random.default_rng(1)
    pool = rnd.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2500]), np.unique(pool[500:])
    sig = minhash.signature([a, b], 512)
    assert abs((sig[0:, 0] == sig[0:, 1]).mean() - 2000 / 3000) < 0.08
    assert len(set(sig[:, 0].tolist())) > 500


def test_long_text_is_one_set():
    words = " ".join(f"w{i}" for i in range(100_000))
    assert len(shingles.shingle_set(words, 4)) == 99_997
    assert list(shingles.shingle_set("A b", 4)) == list(shingles.shingle_set(" a\vB\n", 4))


def test_components_of_chains_stars_and_cycles(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(1000, 1400)]
    links = [*chain, *star, (1, 2), (2, 1), (3, 1), (5, 5), (None, 4)]
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(1000, 1400)]} | {1: 1, 2: 1, 3: 1}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_roots(spark):
    chain = [(i, i + 1) for i in range(50)]
    links = spark.createDataFrame([*chain, (7, 100), (100, 200)], "a long, b long")
    assert {r["id"]: r["label"] for r in forest_roots(links).collect()} == dict.fromkeys([*range(1, 51), 100, 200], 0)
    assert forest_roots(links.limit(0)).count() == 0


def test_documents_without_ids_are_linked(spark):
    """Near copies without a doc_id are one class; two named documents joined only through one are in one class."""
    words = [f"w{i}" for i in range(60)]
    text = lambda *changed: " ".join(f"x{i}" if i in changed else w for i, w in enumerate(words))
    # 2 and 3 are too far apart, the row without a name is near to both.
    rows = [(3, text(0)), (None, text()), (2, text(59)), (None, "q r s t u v"), (None, "Q r s t u v"), (9, "a b c d e f g")]
    rows += [(None, "n " + text(30) + " only these"), (None, "n " + text(30) + " only those")]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, _row string")
    got = minhash.classes(docs, threshold=88).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == sorted(
        [("3", "2"), ("None", "2"), ("2", "2"), ("None", "None"), ("None", "None"), ("9", "9"), ("None", "None"), ("None", "None")]
    )
    kept = minhash.deduplicate(docs, threshold=88)
    assert kept.columns == docs.columns
    left = sorted(str(r["doc_id"]) for r in kept.collect())
    assert left == ["2", "9", "None", "None"]


def test_one_id_with_two_texts_is_one_document(spark):
    """Each text is compared; the document keeps one row."""
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(1, words), (2, "z " * 3 + "other text here and there"), (2, words + " end"), (3, "z " * 3 + "other text here and there")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in minhash.classes(docs, threshold=80).collect()}
    assert {c for i, c in got if i in (1, 3)} <= {1, 2, 3} and (1, 1) in got
    assert sorted(r["doc_id"] for r in minhash.deduplicate(docs).collect()).count(2) <= 1


def test_long_words_are_not_remembered():
    from songpulse.llm import shingles

    shingles._HASHES.clear()
    many = " ".join(f"{i}{'x' * 10_000}" for i in range(500))
    once = shingles.word_hashes(many)
    assert (once == shingles.word_hashes(many)).all() and len(set(once.tolist())) == 500 and len(shingles._HASHES) == 0
    shingles.word_hashes("short words stay")
    assert len(shingles._HASHES) == 3
