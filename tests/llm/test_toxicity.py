import math
import re
from collections import Counter

import numpy as np
from reference import crc

from wardledger.llm.toxicity import BLOCK, FLOOR, NEAREST, NEIGHBOURS, BlockMaxIndex, fit, score_toxicity


def sparse(v):
    row, word = np.nonzero(v)
    return np.searchsorted(row, np.arange(len(v) + 1)), word.astype(np.int32), v[row, word]


def test_nearest_are_exact():
    r = np.random.default_rng(1)
    for examples, words in ((700, 40), (5, 4), (64, 3)):
        v = np.where(r.random((examples, words)) < r.choice([0.05, 0.3], words), r.random((examples, words)), 0)
        v = np.concatenate([v, v[: examples // 4]])  # ties
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        index = BlockMaxIndex(*sparse(v), words)
        for q in v[:40]:
            if q.any():
                cosine = np.round(v @ q, 9)
                own = np.flatnonzero(q), q[q > 0]
                near, found = index.nearest(*own, 15, index.common(np.array([0, own[0].size]), *own)[0])
                least = max(np.sort(cosine)[-min(15, len(v))], 1e-9)
                order = np.lexsort((np.arange(len(v)), -cosine))[: (cosine >= least).sum()]
                assert (near == order).all() and np.allclose(found, cosine[order])
    assert BLOCK < 700


def brute_force(docs, toxic):
    """Scores by the definitions over whole texts, word by word."""
    bag = {i: Counter(re.findall(r"[^\W\d_]+", (t or "").lower())) for i, t in docs.items()}
    frequency = Counter(w for b in bag.values() for w in b)
    train = {i: y for i, y in toxic.items() if crc(i) % 5 != 0}
    bad, n = sum(train.values()), len(train)
    value = {}
    for w in {w for i in train for w in bag[i]}:
        a = sum(w in bag[i] for i, y in train.items() if y)
        b = sum(w in bag[i] for i, y in train.items() if not y)
        spread = (a + b) * (n - a - b) * bad * (n - bad)
        phi = max(0, abs(a * (n - bad - b) - b * (bad - a)) - n / 2) ** 2 / spread if spread else 0
        value[w] = math.log((len(docs) + 1) / (frequency[w] + 0.5)) * (FLOOR + phi)
    unit = {}
    for i, b in bag.items():
        v = {w: (1 + math.log(c)) * value[w] for w, c in b.items() if w in value}
        size = math.sqrt(sum(x * x for x in v.values()))
        unit[i] = {w: x / size for w, x in v.items()}
    scores = {}
    for i, v in unit.items():
        cosine = {j: round(sum(x * unit[j].get(w, 0) for w, x in v.items()), 9) for j in train}
        cosine = {j: c for j, c in cosine.items() if c > 0}
        least = sorted(cosine.values())[-min(NEIGHBOURS, len(cosine))] if cosine else 0
        vote = {j: 1 / (1 + NEAREST - min(c, 1)) for j, c in cosine.items() if c >= least}
        scores[i] = sum(x * train[j] for j, x in vote.items()) / sum(vote.values()) if vote else bad / n
    return scores


def test_scores_equal_brute_force(spark, documents, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    known = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["doc_id"] in texts}
    expected = brute_force(texts, known)
    found = {r["doc_id"]: r["score"] for r in score_toxicity(documents.repartition(5), labels).collect()}
    assert found.keys() == expected.keys() and len(known) > 20
    assert max(abs(found[i] - expected[i]) for i in found) < 1e-6


def test_copied_example_of_rare_words(spark):
    """A text like one labelled example and no other takes its label, whatever its words."""
    rows = [(i, f"only{chr(97 + i % 26)}{'x' * (i // 26)} common words here", int(i == 7)) for i in range(200) if crc(i) % 5]
    assert any(i == 7 for i, _, _ in rows)
    copy = next(i for i in range(1000, 1100) if crc(i) % 5 == 0)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(copy, rows[[i for i, _, _ in rows].index(7)][1])], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    score = {r["doc_id"]: r["score"] for r in score_toxicity(docs, labels).collect()}
    assert score[7] > 0.9 and score[copy] > 0.9 and sum(s >= 0.5 for s in score.values()) == 2


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "word " * (3000 if i == 3 else 10)) for i in range(50)], "doc_id bigint, text string")
    docs = docs.unionAll(docs)  # repeated rows give one example
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS toxic")
    held = sum(crc(i) % 5 == 0 for i in range(50))
    assert fit(docs, labels).labels.size == 50 - held
    assert fit(docs, labels, sample=10).labels.size == 10
    model = fit(docs, labels, sample_chars=1000 * 200)  # a text of 15 000 characters is too long
    assert 3 not in model.ids and model.labels.size == 50 - held - 1
    assert 0 < fit(docs, labels, sample_chars=50 * 200).labels.size <= 50 - held
    assert fit(docs, labels, sample_chars=0).labels.size == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = score_toxicity(docs, labels).collect()
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"]]
    hit = [r["predicted"] for r in held if toxic[r["doc_id"]] == 1]
    wrong = [r["predicted"] for r in held if toxic[r["doc_id"]] == 0]
    assert sum(hit) / len(hit) > 0.8 and sum(wrong) / len(wrong) < 0.02


def test_labels_of_held_out_rows_are_not_used(spark, documents, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    turned = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = ({(r["doc_id"], r["score"]) for r in score_toxicity(documents, x).collect()} for x in (labels, turned))
    assert a == b


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(4, 1), (4, 0), (7, 0), (8, None), (None, 1), (99, 1), (9, 0), (1, 0)], "doc_id bigint, toxic int")
    rows = score_toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert score_toxicity(nothing, labels).count() == 0
    assert {r["score"] for r in score_toxicity(odd, labels.limit(0)).collect()} == {0.0}
