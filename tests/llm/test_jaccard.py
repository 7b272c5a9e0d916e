import random

import pytest
from reference import components as plain
from reference import shingles

from wardledger.llm import jaccard, shared
from wardledger.llm.components import components
from wardledger.llm.jaccard import Rule, bands, jaccard_components


def check(docs, rule):
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    found = {r["doc_id"]: r for r in jaccard_components(docs, rule=rule).collect() if r["doc_id"] is not None}
    expected = plain(texts, rule.words, rule.num, rule.den)
    assert {i: r["component_id"] for i, r in found.items()} == expected
    assert {i: r["n_shingles"] for i, r in found.items()} == {i: len(shingles(t, rule.words)) for i, t in texts.items()}


@pytest.mark.parametrize("rule", [Rule(), Rule(words=5, num=80, den=100)])
def test_documents(documents, rule):
    check(documents, rule)


def test_near_copies_of_every_size(spark):
    # Sets around each other's limit, of 3 to 300 words, with chains and hot groups.
    r = random.Random(3)
    rows = []
    for size in (3, 4, 6, 9, 10, 13, 20, 27, 40, 66, 100, 180, 300):
        for group in range(3):
            base = [f"w{r.randrange(10_000)}" for _ in range(size)]
            for _ in range(8):
                copy = list(base)
                for _ in range(r.randrange(0, 1 + size // 30)):
                    copy[r.randrange(len(copy))] = f"w{r.randrange(10_000)}"
                cut = r.randrange(0, 1 + size // 8)
                rows.append((len(rows), " ".join(copy[: size - cut])))
                base = copy if r.random() < 0.3 else base
    r.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), Rule())


def test_a_bucket_of_unlinked_members_is_compared_in_full(spark):
    # All share half of their words; only some pairs are similar.
    r = random.Random(5)
    common = [f"c{i}" for i in range(60)]
    rows = []
    for i in range(60):
        own = [f"o{i // 2}x{k}" for k in range(60)]
        if i % 2:
            own[r.randrange(60)] = "changed"
        rows.append((i, " ".join(common + own)))
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), Rule())


def test_odd_rows(odd):
    found = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(odd).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (8, 117, 7), (9, 118, 7), (None, 117, 7), (None, 0, None)} <= found
    assert jaccard_components(odd).count() == odd.count()


def test_no_rows(nothing):
    assert jaccard_components(nothing).count() == 0


def test_bands_leave_no_gap():
    rule = Rule()
    first, d, cells = bands(rule, 5000)
    assert first[0] == 1 and (d[1:] >= d[:-1]).all() and (cells > d).all()
    for size in range(1, 5000):
        at = first.searchsorted(size, "right") - 1
        assert d[at] >= rule.differ(size)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40) if i != 20] + [(9, 3), (3, 3), (70, 60), (None, 1), (100, 99), (99, 100)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {i: 0 if i <= 20 else 21 for i in range(41)} | {60: 60, 70: 60, 99: 99, 100: 99}


def test_near_copies_cost_a_pair_each_and_leave_no_tables(spark, monkeypatch, tmp_path):
    r = random.Random(7)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(80):
        copy = list(base)
        copy[r.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    compared, linked = [], jaccard.linked

    def counted(pairs, sets, rule):
        compared.append(pairs.count())
        return linked(pairs, sets, rule)

    monkeypatch.setattr(jaccard, "linked", counted)
    monkeypatch.setattr(shared, "shared_path", lambda spark, name: f"file://{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}-{r.random()}")
    found = jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"), rule=Rule(words=5, num=80, den=100))
    left = {p.name.split("-")[0] + "-" + p.name.split("-")[1] for p in tmp_path.iterdir() if p.name.startswith("jaccard")}
    assert left == {"jaccard-nodes"}
    texts = dict(rows)
    assert {x["doc_id"]: x["component_id"] for x in found.collect()} == plain(texts, 5, 80, 100)
    assert sum(compared) < 1.5 * len(rows)
