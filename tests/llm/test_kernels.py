import numpy as np
import pyarrow as pa

from wardledger.llm.jaccard import jaccard_components
from wardledger.llm.kernels import Words, byte_table, hash_spans, slices


def spans(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    size = np.array([len(t.encode()) for t in texts], np.int64)
    end = np.cumsum(size)
    return hash_spans(data, end - size, end)


def opposites(log2):
    parity = [bin(i).count("1") & 1 for i in range(1 << log2)]
    return "".join("ab"[p] for p in parity), "".join("ba"[p] for p in parity)


def test_a_hash_is_of_the_bytes_alone():
    texts = ["", "a", "ab", "abcdefg", "abcdefgh", "abcdefghi", "x" * 100, "é" * 33]
    alone = [int(spans([t])[0]) for t in texts]
    assert spans(texts).tolist() == alone and spans(texts[::-1]).tolist() == alone[::-1]
    assert len(set(alone)) == len(texts)
    # Trailing zero bytes and the order of blocks count.
    assert len(set(spans(["a", "a\0", "a\0\0", "a" * 8 + "b" * 8, "b" * 8 + "a" * 8, "a" * 16]).tolist())) == 6


def test_regular_texts_have_their_own_hashes():
    texts = [t for log2 in range(10, 14) for t in opposites(log2)]
    assert len(set(spans(texts).tolist())) == len(texts)


def test_words_hash_alike_wherever_they_stand():
    texts = next(slices(pa.array(["one two  three", "three one", "", "two"])))
    words = Words(texts, byte_table("space"))
    assert words.hash[[0, 1, 2]].tolist() == words.hash[[4, 5, 3]].tolist()


def test_opposite_texts_are_not_linked(spark):
    texts = [t for log2 in range(10, 14) for t in opposites(log2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs).collect()}
    assert found == {i: i for i in range(len(texts))}
