from collections import defaultdict

import pytest
from compare import connect, differences
from reference import words_of

from wardledger.llm.mixing import ORACLE_SQL, mix, mixed_rows


def targets(sizes, weights=(5, 2, 1), share=1.5):
    """Resharing by rounds."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    return out


def check(docs):
    rows = mix(docs).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    for source, value in targets(sizes).items():
        assert target[source] == pytest.approx(value) and abs(taken[source] - value) <= 0.5
    return rows


def test_sql(documents, folder):
    columns, extra, missing, rows = differences(mix(documents), connect(folder), ORACLE_SQL)
    assert not columns and not extra and not missing and rows == documents.count()


def test_budgets(documents):
    assert sorted(check(documents)) == sorted(check(documents))


def test_odd_rows(odd):
    rows = check(odd)
    assert sorted(r["size"] for r in rows) == sorted(len(words_of(r["text"])) for r in odd.collect())


def test_a_limited_source_and_one_without_words(spark):
    rows = [(1, "one", "a"), (2, "x " * 500, "b"), (3, "y " * 300, "c"), (4, None, "d")]
    check(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))


def test_rows_stay_whole(documents):
    taken = {r["doc_id"]: -(-r["taken"] // r["size"]) if r["size"] else 0 for r in mix(documents).collect()}
    found = defaultdict(int)
    for r in mixed_rows(documents).collect():
        found[r["doc_id"]] += 1
    assert {k: v for k, v in taken.items() if v} == found
    assert mixed_rows(documents).columns == documents.columns


def test_no_rows(nothing):
    assert mix(nothing).count() == 0 and mixed_rows(nothing).count() == 0
