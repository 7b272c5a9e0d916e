import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from wardledger.llm.alignment import TOKENIZER_A, TOKENIZER_B, Pair, _memo, align, align_documents, overlaps
from wardledger.llm.kernels import slices
from wardledger.llm.packing import tokenizer_path

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"]
ODD = ["a", " a  b ", "\nLas", "x\ty", "I'm\nok.  Yes , no", "a\x00b \x00", "a▁b", "one ▁two", "<s>a</s> <|endoftext|>", "é.À! ×. é .́",
       "a   b c　d 　e", "日本 語\nです 。", "😀 👩‍👩‍👧 x", "....... !!! ?;:,.", "   ", "\n\n\n", "don't.stop,me:now;ok!x?y", "\u0085\nq  r", "12 345,6.78",
       "foo \nbar", "foo\n bar", "ﷺ ½\nÅ", "tab\t\tend\t", "ABC.def\n.x\n. y"]


@pytest.fixture(scope="module")
def pair():
    return Pair(tokenizer_path(TOKENIZER_A), tokenizer_path(TOKENIZER_B))


def tokens(pair, text):
    """Ids and ends of both sides, of the whole text at once."""
    if not text:
        return [], [], [], []
    a = pair.a.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(pair.bytes_a[i] for i in a) != raw or b"".join(pair.bytes_b[i] for i in b) != raw:
        return [], [], [], []
    ends = [np.cumsum([len(t[i]) for i in ids]).tolist() for ids, t in ((a, pair.bytes_a), (b, pair.bytes_b))]
    return a, b, *ends


def expected(pair, rows):
    out, links = [], []
    for doc, text in rows:
        a, b, ends_a, ends_b = tokens(pair, text)
        both = sorted(set(ends_a) & set(ends_b))
        of_a, of_b = dict(zip(ends_a, a, strict=True)), dict(zip(ends_b, b, strict=True))
        links.append([(of_a[e], of_b[e]) for e in both])
        spans = [list(zip([0, *e], e, strict=False)) for e in (ends_a, ends_b)]
        overlap = sum(max(x, u) < min(y, v) for x, y in spans[0] for u, v in spans[1]) if len(text or "") < 3000 else None
        groups = ";".join(
            ",".join(str(i) for i, e in zip(a, ends_a, strict=True) if x < e <= y) + "|" + ",".join(str(i) for i, e in zip(b, ends_b, strict=True) if x < e <= y)
            for x, y in zip([0, *both], both, strict=False)
        ) if len(text or "") < 3000 else None
        sha = groups and hashlib.sha256(groups.encode()).hexdigest()
        out.append([doc, len(a), len(b), len(both), len(both), None, None, sha, overlap])
    counts = Counter(p for x in links for p in x)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for row, own in zip(out, links, strict=True):
        row[5], row[6] = sum(counts[p] == most[p[1]] for p in own), sum(counts[p] for p in own)
        row[7] = row[7] if own or row[7] is None else ""
    return out


def check(pair, df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    found = [[r[c] for c in COLUMNS] for r in align_documents(df).collect()]
    want = expected(pair, rows)
    order = lambda x: str(x[:7])
    for f, w in zip(sorted(found, key=order), sorted(want, key=order), strict=True):
        assert f == [x if y is None else y for x, y in zip(f, w, strict=True)]
    return found


def test_units_give_the_tokens_of_the_whole_text(pair, texts):
    memo = _memo(tokenizer_path(TOKENIZER_A), tokenizer_path(TOKENIZER_B))
    for group in (ODD, list(texts.values()), [o + "\n" + p for o in ODD for p in ODD]):
        spaced = [" " + t for t in group]
        for part in slices(pa.array(spaced, pa.string()), 1 << 14):
            lanes = [np.split(ids, np.cumsum(count)[:-1]) for ids, count in memo.encode(part)]
            for i in range(len(part)):
                text = group[part.first + i]
                a, b, *_ = tokens(pair, text)
                if a:
                    assert (lanes[0][i].tolist(), lanes[1][i].tolist()) == (a, b), text
                else:
                    assert (lanes[0][i] < 0).any() or (lanes[1][i] < 0).any(), text
        spaced.clear()


def test_overlaps_by_hand():
    doc = np.zeros(3, int)
    found = overlaps(doc, np.array([2, 5, 9]), np.array([2, 3, 4]), doc[:2], np.array([5, 9]), np.array([5, 4]))
    assert sorted(zip(found["a"], found["b"], strict=True)) == [(0, 0), (1, 0), (2, 1)]
    found = overlaps(doc[:2], np.array([3, 9]), np.array([3, 6]), doc, np.array([1, 6, 9]), np.array([1, 5, 3]))
    assert sorted(zip(found["a"], found["b"], strict=True)) == [(0, 0), (0, 1), (1, 1), (1, 2)]


def test_documents(pair, documents):
    found = check(pair, documents)
    assert sum(r[3] for r in found) > 1000


def test_odd_texts(spark, pair):
    df = spark.createDataFrame([(i % 9, t) for i, t in enumerate(ODD * 2)], "doc_id bigint, text string")
    check(pair, df.repartition(5))


def test_odd_rows(pair, odd, nothing):
    check(pair, odd)
    assert align_documents(nothing).count() == 0


def test_alignment_holds_the_tokens(pair, documents, texts):
    for r in align(documents.limit(25)).collect():
        a, b, ends_a, ends_b = tokens(pair, texts[r["doc_id"]])
        assert np.frombuffer(r["a_ids"], "<u2").tolist() == a and np.frombuffer(r["b_ids"], "<u2").tolist() == b
        assert [e for e, flag in zip(ends_a, r["a_ends"], strict=True) if flag] == sorted(set(ends_a) & set(ends_b))
        assert [e for e, flag in zip(ends_b, r["b_ends"], strict=True) if flag] == sorted(set(ends_a) & set(ends_b))
