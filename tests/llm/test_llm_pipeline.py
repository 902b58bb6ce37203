"""The pipeline against a plain version of its stages, and the registered queries against SQL."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from oracle_check import compare, duck
from test_llm_minhash import brute
from test_llm_quality_mixing import fill, measures

import __spark_entry__
import corpus_pipeline
from songpulse.llm import bpe, pii, quality
from songpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def passes(text):
    m = measures(text)
    return not any(eval(r.fails.replace(" or ", " or "), {}, m) for r in quality.RULES)  # noqa: S307


def mixed(docs):
    """doc_id -> copies, by sorting every source whole."""
    words = lambda t: len(t.encode().split())
    sizes, members = Counter(), defaultdict(list)
    for i, text, source in docs:
        sizes[source] += words(text)
        u = (int(hashlib.md5(f"{i}:mix-1".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        plain = sum(not c.isascii() or c.isalpha() for c in text)
        members[source].append((-(u ** (1 / (1 + plain / len(text)))), i, words(text)))
    target = fill(dict(sizes), {s: (5, 2, 1)[n % 3] for n, s in enumerate(sorted(sizes))}, 1.5 * sum(sizes.values()))
    copies = {}
    for source, rows in members.items():
        epochs, at = int(target[source] // sizes[source]), 0
        for _, i, size in sorted(rows):
            copies[i] = epochs + (2 * at + size <= 2 * (target[source] - epochs * sizes[source]))
            at += size
    return copies


def test_pipeline_matches_plain_stages(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    good = [r for r in rows if passes(r["text"])]
    classes = brute([(r["doc_id"], r["text"]) for r in good], 5)
    single = [r for r in good if classes[r["doc_id"]][1] == r["doc_id"]]
    clean = [(r["doc_id"], pii.replaced(r["text"], {k: f"[{k.upper()}]" for k in pii.KINDS}), r["source"]) for r in single]
    copies = mixed(clean)
    ranks = bpe.load_ranks(public_tokenizers.path(corpus_pipeline.RANKS))
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, text, source in clean:
        ids = encoder.encode_ordinary(text)
        want[(i, source, len(ids), np.array(ids, "<u4").tobytes(), text)] += copies[i]
    got = Counter((r["doc_id"], r["source"], r["n_tokens"], bytes(r["ids"]), r["text"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert 0 < len(single) < len(good) < len(rows)
    assert got == +want


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, 1), (1, "a b", "en", None, 3, 2), (None, "c", None, "s", 1, 3)],
                                 "doc_id long, text string, lang string, source string, n_chars long, size int")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, SF)
        assert out.columns == docs.columns, name
        out.count()
        assert step(spark, docs.limit(0), SF).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 3


def test_entry_has_the_eleven_queries():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


@pytest.mark.parametrize("name", sorted(set(__spark_entry__.oracle_sql()) & set(QUERIES)))
def test_query_matches_sql(spark, name):
    problems, n = compare(QUERIES[name](spark, SF), duck(SF), __spark_entry__.oracle_sql()[name])
    assert not problems and n
