import hashlib

import pytest
from compare import connect, differences
from reference import LOWER

from wardledger.llm.exact_dedup import ORACLE_SQL, exact_dedup


def expected(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(out, key=str)


def test_sql(documents, folder):
    columns, extra, missing, rows = differences(exact_dedup(documents), connect(folder), ORACLE_SQL)
    assert not columns and not extra and not missing and rows == documents.count()


@pytest.mark.parametrize("bits", [64, 17])
def test_odd_rows(odd, bits):
    found = sorted((tuple(r) for r in exact_dedup(odd, hash_bits=bits, capacity=2).collect()), key=str)
    assert found == expected([(r["doc_id"], r["text"]) for r in odd.collect()])


def test_collisions_are_told_apart_by_bytes(spark):
    # 300 texts on a few hash values: every chain is long.
    docs = spark.createDataFrame([(i, f"text {i % 150}") for i in range(300)], "doc_id bigint, text string")
    found = sorted((tuple(r) for r in exact_dedup(docs, hash_bits=4, max_depth=4, capacity=1).collect()), key=str)
    assert found == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_no_rows(nothing):
    assert exact_dedup(nothing).count() == 0
