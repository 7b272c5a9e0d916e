import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wardledger.llm.kernels import slices
from wardledger.llm.packing import CAPACITY, END, Plan, _memo, best_plan, configurations, id_type, pack, pack_documents, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def direct(tokenizer, texts):
    return [e.ids + [END] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_units_give_the_ids_of_the_whole_text(tokenizer, texts):
    odd = ["", " a  b \n c", "x\n\ny", "I'm 'S we'LL", "é é\ńx", "ΑΣ\nΣ ΟΔΟΣ. İ", "x<|endoftext|>y < |endoftext|> <|startoftext|>\n<|endoftext|>",
           "a  b  c  d  e\n　f", "日本 語\nです 。", "\x00 \x00\n\x01", "12 345\n6 #? !?", "ﬁ ½\nÅ ﷺ", "a " * 50,
           "É. éÀ!x ×.× ÷. a.\u0301b ﬁ.x a..b 3.14 x<|ENDOFTEXT|>. <|END.x a|>b"]
    memo = _memo(tokenizer_path())
    for group in (odd, list(texts.values()), odd[::-1], [o + " tail" for o in odd]):
        found = []
        for part in slices(pa.array(group, pa.string()), 1 << 14):
            ((ids, count),) = memo.encode(part)
            found += [[*x.tolist(), END] for x in np.split(ids, np.cumsum(count)[:-1])]
        assert found == direct(tokenizer, group)


def test_a_full_memo_changes_nothing(tokenizer, texts):
    memo = _memo(tokenizer_path())
    memo.limit = 500
    group = list(texts.values())[:60]
    found = []
    for part in slices(pa.array(group, pa.string()), 1 << 13):
        ((ids, count),) = memo.encode(part)
        found += [[*x.tolist(), END] for x in np.split(ids, np.cumsum(count)[:-1])]
    assert found == direct(tokenizer, group) and len(memo.number) <= 500


def laid_out(plan, counts):
    """Sequences with ``(offset, length)`` of their pieces; every position of every length is used once."""
    used, bins = defaultdict(list), defaultdict(list)
    for length, first, n, sequence, per, offset in plan.runs:
        for i in range(n):
            used[length].append(first + i)
            bins[sequence + i // per].append((offset + i % per * length, length))
    assert {k: sorted(v) for k, v in used.items()} == {k: list(range(n)) for k, n in counts.items() if n}
    for pieces in bins.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= plan.capacity
    assert set(bins) == set(range(plan.sequences))
    return bins


def first_fit(counts, capacity):
    rooms = []
    for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        fits = [r for r in range(len(rooms)) if rooms[r] >= length]
        if fits:
            rooms[min(fits, key=lambda r: rooms[r])] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    r = np.random.default_rng(seed)
    capacity = [100, 64, 100, 200, 97, 30][seed]
    sizes = [r.integers(1, capacity + 1, 400), r.integers(capacity // 3, capacity // 2, 300), np.minimum(capacity, r.lognormal(3, 1, 700).astype(int) + 1),
             np.repeat([71, 66, 130, 1], [90, 80, 70, 200]), np.full(50, 49), r.integers(1, 4, 500)][seed]
    counts = dict(Counter(sizes.tolist()))
    for large, groups in ((4, 8), (2, 3), (8, 40)):
        laid_out(Plan(counts, capacity, large, groups), counts)
    best = best_plan(counts, capacity)
    laid_out(best, counts)
    assert best.sequences <= first_fit(counts, capacity)


def test_configurations_reach_the_optimum():
    """Two thirds and a third, a half and a half: no mixture of single sizes is as good."""
    sizes, demand = np.array([66, 50, 34]), np.array([30, 20, 30])
    found = configurations(sizes, demand, 100)
    assert sum(n for _, n in found) == pytest.approx(40)
    assert (sum(c * n for c, n in found) >= demand - 1e-6).all()


def check(df, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    expected = []
    for (doc, _), ids in zip(rows, direct(tokenizer, [t for _, t in rows]), strict=True):
        for piece, start in enumerate(range(0, len(ids), CAPACITY)):
            part = np.array(ids[start : start + CAPACITY], "<u4")
            expected.append((doc, piece, start, part.size, zlib.crc32(part.tobytes())))
    found = pack_documents(df).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == sorted(expected, key=str)
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *(n for _, n in pieces)])[:-1].tolist()
        assert sum(n for _, n in pieces) <= CAPACITY
    assert len(bins) <= first_fit(Counter(e[3] for e in expected), CAPACITY)


def test_documents(documents, tokenizer):
    check(documents, tokenizer)
    check(documents.repartition(9), tokenizer)


def test_odd_rows(odd, nothing, tokenizer):
    check(odd, tokenizer)
    assert pack_documents(nothing).count() == 0 and pack(nothing).count() == 0


def test_sequences_hold_the_ids(documents, tokenizer, texts):
    ids = dict(zip(texts, direct(tokenizer, list(texts.values())), strict=True))
    for r in pack(documents).collect():
        held = np.frombuffer(r["ids"], id_type()).tolist()
        for p in r["pieces"]:
            assert held[p["offset"] : p["offset"] + p["length"]] == ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
