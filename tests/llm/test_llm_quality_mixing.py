"""Rule ledger and source mix: hand rows, edge cases, brute force, skew."""

import math
import re
from collections import Counter

import pytest

from songpulse.llm import mixing, quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_upper": len(re.findall("[A-Z]", text or "")), "n_exclaims": (text or "").count("!"),
    }


TEXTS = [
    None, "", " \t\n ", "one", "a b c d e f g h " * 4, "x " * 100_000, "line\nline\n \nline\nend", "é#*$ %&|<> 漢字\x0bz\x0cq\rr",
    " ".join(f"w{i}" for i in range(30)), "A B C d! e! f!", " ".join(f"w{i % 11}" for i in range(40)),
]


def test_measures_match_brute_force(spark):
    rows = spark.createDataFrame([(i, t, "en", "s", 0, 9) for i, t in enumerate(TEXTS)], f"{DOCS}, n_words int")
    found = {r["doc_id"]: r.asDict() for r in quality.ledger(rows).collect()}
    for i, text in enumerate(TEXTS):
        assert {k: found[i][k] for k in quality.MEASURES} == measures(text), text and text[:40]


def test_bits_policies_and_ablation(spark):
    clean = " ".join(f"word{i}" for i in range(40))
    rows = spark.createDataFrame([(1, clean), (2, "short"), (3, clean.upper()), (None, None), (2, "short")], "doc_id long, text string")
    led = quality.ledger(rows).cache()
    kept = {(r["doc_id"], r["kept"]) for r in quality.apply_policy(led, "v2").collect()}
    assert kept == {(1, True), (2, False), (3, False), (None, False)}
    assert {r["doc_id"] for r in quality.apply_policy(led, "base").where("kept").collect()} == {1, 3}
    off = {r["rule"]: r for r in quality.ablation(led).collect()}
    assert off["few_words"]["n_failed"] == 3 and off["upper_case"]["n_failed_alone"] == 1
    assert off["upper_case"]["n_kept_without"] == 2 and off["symbols"]["n_kept_without"] == 1
    assert quality.select_passing(rows).collect() == [(1, clean)]


def test_scripts_without_spaces(spark):
    han = " ".join(f"{chr(0x4E00 + i)}" + "漢字かな交じり文は空白なしで書かれる長い文章である" for i in range(25))
    thai = " ".join(f"ภาษาไทยเขียนติดกันโดยไม่เว้นวรรคระหว่างคำ{i}" for i in range(25))
    latin = " ".join(f"averyveryverylongwordwithoutend{i}" for i in range(25))
    mostly_latin = " ".join(f"averyveryverylongwordwithoutend漢字{i}" for i in range(25))
    rows = spark.createDataFrame(list(enumerate([han, thai, latin, mostly_latin, "漢" * 500, han + "#" * 25])), "doc_id long, text string")
    assert {r["doc_id"] for r in quality.select_passing(rows).collect()} == {0, 1}
    led = quality.ledger(rows)
    kept = lambda version: {r["doc_id"] for r in quality.apply_policy(led, version).where("kept").collect()}
    assert kept("v3") == {0, 1} and kept("v2") == set() and kept("base") == {0, 1, 2, 3, 5}
    off = {r["rule"]: r["n_failed"] for r in quality.ablation(led).collect()}
    assert off["word_length_spaced"] == 2 and off["few_words"] == 1


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], DOCS)
    assert quality.ledger(empty).count() == 0 and mixing.mix(empty).count() == 0
    assert quality.select_passing(empty).columns == empty.columns and mixing.take(empty).columns == empty.columns
    odd = spark.createDataFrame([(1, "a b", "s", 5, 6, 7)], "doc_id long, text string, source string, size int, taken int, _v int")
    assert mixing.mix(odd).first().asDict()["size"] == 2
    assert mixing.take(odd).first().asDict()["_v"] == 7


def fill(sizes, weights, total):
    """Resharing the excess over and over."""
    target, capped = dict.fromkeys(sizes, 0.0), set()
    while True:
        left = total - sum(2 * sizes[s] for s in capped)
        w = sum(weights[s] for s in sizes if s not in capped)
        target = {s: 2.0 * sizes[s] if s in capped else left * weights[s] / w for s in sizes}
        over = {s for s in sizes if s not in capped and target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("bucket_docs", [3, 10_000])
def test_mix_targets_and_budgets(spark, bucket_docs):
    # Source "hot" has a third of all rows; one size-0 source, a NULL source and NULL texts.
    rows = [(i, "w " * (1 + i % 7), "hot" if i % 3 == 0 else f"s{i % 4}") for i in range(900)]
    rows += [(2000 + i, None, "empty") for i in range(5)] + [(3000 + i, "a b", None) for i in range(9)] + [(None, "n n", "s1")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [r.asDict() for r in mixing.mix(docs, ["doc_id", "source"], bucket_docs=bucket_docs).collect()]
    assert len(out) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 2 * r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = fill(dict(sizes), {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    for r in out:
        assert math.isclose(r["target"], want[r["source"]]) and r["source_size"] == sizes[r["source"]]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 4, s
    again = [r.asDict() for r in mixing.mix(docs.repartition(5), ["doc_id", "source"], bucket_docs=bucket_docs).collect()]
    key = lambda r: tuple(map(str, r.values()))
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_take_repeats_whole_rows(spark):
    docs = spark.createDataFrame([(i, "w " * 5, f"s{i % 3}", i) for i in range(300)], "doc_id long, text string, source string, copies int")
    copies = Counter(r["doc_id"] for r in mixing.take(docs).collect())
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    assert copies == {k: v for k, v in plan.items() if v}
    assert set(mixing.take(docs).where("copies != doc_id").collect()) == set()


def test_heavier_documents_come_first_more_often(spark):
    good, bad = "plain words only here", "1 2 3 4"
    docs = spark.createDataFrame([(i, good if i % 2 else bad, "a") for i in range(4000)] + [(9000, "z " * 8000, "b")], "doc_id long, text string, source string")
    rows = mixing.mix(docs, ["doc_id"]).where("doc_id < 9000 and copies > 0").groupBy("doc_id").max("copies").collect()
    full = Counter(r["doc_id"] % 2 for r in rows if r["max(copies)"] == max(x["max(copies)"] for x in rows))
    assert full[1] > full[0]


def test_a_document_without_words_is_taken_twice_at_most(spark):
    rows = [(1, "a b c", "en", "s", 5), (2, "", "en", "s", 0), (3, None, "en", "s", 0), (4, "w " * 500, "en", "t", 9), (5, "w " * 500, "en", "u", 9)]
    docs = spark.createDataFrame(rows, DOCS)
    mixed = {r["doc_id"]: r for r in mixing.mix(docs, ["doc_id"]).collect()}
    assert all(r["copies"] <= mixing.MAX_EPOCHS for r in mixed.values()) and mixed[1]["copies"] == 2
    taken = [r["doc_id"] for r in mixing.take(docs).collect()]
    assert max(taken.count(i) for i in (1, 2, 3)) == 2


def test_every_policy_is_a_mask(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate([*TEXTS, "漢字仮名" * 30 + " " + "文章" * 40])], DOCS)
    led = quality.ledger(docs)
    for version, mask in quality.POLICIES.items():
        got = {(r["doc_id"], r["kept"]) for r in quality.apply_policy(led, version).collect()}
        assert got == {(r["doc_id"], r["fail_bits"] & mask == 0) for r in led.collect()}
    kept = {r["doc_id"] for r in quality.apply_policy(led).collect() if r["kept"]}
    assert kept == {r["doc_id"] for r in quality.select_passing(docs).collect()}
