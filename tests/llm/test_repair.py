import zlib

import numpy as np
import pyarrow as pa
import pytest

from wardledger.llm import kernels, repair
from wardledger.llm.kernels import slices
from wardledger.llm.repair import END, PieceEncoder, compress, encode_documents, make_block, read_shards, tokenizer_path, write_shards


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(tokenizer_path())


def direct(encoder, texts):
    return [e.ids + [END] for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def by_pieces(encoder, texts):
    out = []
    for part in slices(pa.array(texts, pa.string()), 1 << 16):
        ids, count = encoder.encode(part)
        out += [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
    return out


def test_pieces_give_the_ids_of_the_whole_text(encoder, texts):
    odd = ["", "  a  b \n c", " x", "x ", "a  b", "   b c", "é è  à  z　 q", " \t x  y ", "I'm  we'll 'x  12 34", "  b   c", "x  y   z",
           "\x1c a \x1d b", "end <|endoftext|> x", None, "日本 語 です 。", "a\n\n b \n", "à à ô", "z \x85 \x85q"]
    for group in (odd, list(texts.values()), odd[::-1]):
        assert by_pieces(encoder, group) == direct(encoder, group)


def expand(seq, rules, first):
    rules = {first + i: r for i, r in enumerate(rules.tolist())}
    out, todo = [], seq.tolist()[::-1]
    while todo:
        s = todo.pop()
        if s in rules:
            todo += rules[s][::-1]
        else:
            out.append(s)
    return out


def test_grammar():
    r = np.random.default_rng(2)
    for ids in (r.integers(0, 5, 4000), np.zeros(1000, int), np.array([1]), np.array([], int), np.tile([1, 2, 3, 1, 2], 500)):
        seq, rules = compress(ids.astype(np.uint16), 10)
        assert expand(seq, rules, 10) == ids.tolist()
    assert len(compress(np.tile([1, 2, 3, 4], 1000).astype(np.uint16), 10)[0]) < 300


def test_random_access():
    r = np.random.default_rng(4)
    count = r.integers(1, 900, 60)
    ids = r.integers(0, 12, count.sum()).astype(np.uint16)
    block = make_block(ids, count, 12)
    parts = np.split(ids, np.cumsum(count)[:-1])
    assert all((block.document(i) == parts[i]).all() for i in range(60))
    assert (block.all_ids() == ids).all() and block.seq.size < ids.size


def check(docs, encoder):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    start, expected = 0, []
    for (i, _), ids in zip(rows, direct(encoder, [t for _, t in rows]), strict=True):
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = [tuple(r) for r in encode_documents(docs).orderBy("start").collect()]
    assert found == expected


def test_documents(documents, encoder):
    check(documents, encoder)


def test_odd_rows(odd, nothing, encoder):
    check(odd, encoder)
    assert encode_documents(nothing).count() == 0


def test_ids_come_back(documents, encoder, texts):
    rows = read_shards(write_shards(documents.limit(20)), with_ids=True).collect()
    assert [r["ids"] for r in rows] == direct(encoder, [texts[r["doc_id"]] for r in rows])


def test_regular_texts_are_told_apart(spark, encoder):
    """Letters by the parity of the bits of their place, and their opposites: no two positions agree."""
    texts = []
    for log2 in range(10, 14):
        parity = [bin(i).count("1") & 1 for i in range(1 << log2)]
        texts += ["".join("ab"[p] for p in parity), "".join("ba"[p] for p in parity)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    found = {r["doc_id"]: r["ids_crc32"] for r in encode_documents(docs).collect()}
    assert found == {i: zlib.crc32(np.array(ids, "<u4").tobytes()) for i, ids in enumerate(direct(encoder, texts))}
    assert len(set(found.values())) == len(texts)


def test_pieces_of_one_hash_are_told_apart(monkeypatch, texts):
    from wardledger.llm import repair

    monkeypatch.setattr(repair, "hash_spans", lambda data, start, end: (end - start).astype(np.uint64) % np.uint64(50))
    group = list(texts.values())[:12]
    encoder = PieceEncoder(tokenizer_path())
    assert by_pieces(encoder, group) == direct(encoder, group) and by_pieces(encoder, group[::-1]) == direct(encoder, group[::-1])


def test_pieces_have_the_ids_of_their_own(encoder):
    words = [" of", " the", " Straße", " ", "  ", " \t", "\n", "x", "", " naïve ", "  y", "　", " <|endoftext|>", " a" * 3, " " + "long" * 12_000]
    pieces = [words[i * i % len(words)].encode() for i in range(400)] + [f" w{i}".encode() for i in range(20_000)]
    for some in (pieces, [b"", b"x"], [b" of"], [b"x"], []):
        ids, count = encoder._encode_pieces(some)
        assert ids.dtype == np.uint16 and count.sum() == ids.size
        direct = [encoder.tokenizer.encode(p.decode(), add_special_tokens=False).ids for p in some]
        assert [x.tolist() for x in np.split(ids, np.cumsum(count))[:-1]] == direct


def test_remembered_pieces_are_compared_in_blocks_of_eight_bytes(monkeypatch):
    """A piece of up to eight bytes is one comparison, not one a byte."""
    compared = []
    monkeypatch.setattr(repair, "span_blocks", lambda *a: compared.append(kernels.span_blocks(*a)) or compared[-1])
    encoder = repair.PieceEncoder(tokenizer_path())
    text = np.frombuffer(" seven77 sevens7 a".encode() * 50, np.uint8)
    texts = kernels.Texts(text, np.array([0, text.size]), 0)
    first, second = encoder.encode(texts)[0], encoder.encode(texts)[0]
    assert (first == second).all() and [c[0].size for c in compared] == [0, 0, 150, 150]
