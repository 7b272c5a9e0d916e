import math
from collections import Counter, defaultdict

import pytest
from compare import connect, differences
from reference import SYMBOL_WORD, words_of

from wardledger.llm import lexical_search
from wardledger.llm.lexical_search import ORACLE_SQL, Terms, search

ITEMS = "item_id bigint, text string, doc_id int, score double, row string"


def expected(docs, items, k=10):
    """Every item against every document."""
    counts = [(i, Counter(words_of(t, SYMBOL_WORD))) for i, t in docs]
    n, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    held = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            m = 25 + (75 * sum(c.values()) * n) // max(1, total)
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in words_of(text, SYMBOL_WORD)
                if t in c
            )
            if s > 0:
                scores.append((-s, doc is None, doc))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, i + 1, doc, -s) for i, (s, _, doc) in enumerate(scores[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.collect()]


def test_sql(documents, benchmark, folder):
    columns, extra, missing, n = differences(search(documents, benchmark), connect(folder), ORACLE_SQL)
    assert not columns and not extra and not missing and n > 0


def test_odd_rows(spark, odd):
    items = [(1, "One, one TWO"), (2, None), (3, ""), (4, "...!"), (5, "wort3 ünd5 日本語 テキスト"), (5, "beta alpha7 alpha9"),
             (None, "beta"), (7, "nowhere"), (8, "123 \x00 a b"), (9, "One, one TWO")]
    table = spark.createDataFrame([(*i, 1, 0.5, "x") for i in items], ITEMS)
    assert rows(search(odd, table)) == expected(pairs(odd, "doc_id"), items)
    assert rows(search(odd.repartition(7), table.repartition(3), k=2)) == expected(pairs(odd, "doc_id"), items, 2)


@pytest.mark.parametrize(("postings", "long"), [(150, 40), (60, 16)])
def test_blocks_and_cut_items(documents, benchmark, monkeypatch, postings, long):
    """Small bounds: many blocks, and items whose parts are scored apart and added up."""
    monkeypatch.setattr(lexical_search, "LONG", long)
    items = benchmark.limit(6)
    assert rows(search(documents, items, postings=postings)) == expected(pairs(documents, "doc_id"), pairs(items, "item_id"))


def test_equal_scores_go_by_id(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(40, 0, -1)] + [(99, "other")], "doc_id bigint, text string").repartition(5)
    found = search(docs, spark.createDataFrame([(1, "same here"), (2, "words words")], "item_id bigint, text string"))
    by_item = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        by_item[r["item_id"]].append(r["doc_id"])
    # Every document but one holds the words, so their weight is small but above 0.
    assert dict(by_item) == {1: list(range(1, 11)), 2: list(range(1, 11))}


def test_terms_of_equal_hash_are_told_apart(monkeypatch, spark):
    import numpy as np
    import pyarrow as pa

    from wardledger.llm import kernels

    flat = lambda data, start, end: (end - start).astype(np.uint64) % np.uint64(3)
    monkeypatch.setattr(lexical_search, "hash_spans", flat)
    monkeypatch.setattr(kernels, "hash_spans", flat)
    terms = ["a", "bc", "de", "abcd", "xyz", "fg"]
    texts = next(kernels.slices(pa.array(["de x fg abcd none xyz a bc efgh"])))
    words = kernels.Words(texts, kernels.byte_table("symbol"))
    assert Terms(terms).find(words).tolist() == [2, -1, 5, 3, -1, 4, 0, 1, -1]


def test_no_rows(nothing, documents, benchmark):
    assert search(nothing, benchmark).count() == 0
    empty = search(documents, benchmark.limit(0))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]
    assert search(documents.where("false"), benchmark.limit(0)).count() == 0
