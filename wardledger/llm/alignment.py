"""Alignment of the tokens of two tokenizers over the same bytes.

Both encode a space and the text, so their tokens are two cuttings of the same bytes. In
every batch, ``pandas.merge_asof`` by document finds for each token start the token of the
other side that covers it; both directions together are all overlapping pairs. Where the
two tokens of a pair end together a group of tokens ends on both sides: that pair is a
link.

One token of a link is a suffix of the other. So there are at most as many different
linked pairs of ids as the entries of both vocabularies have bytes, whatever the corpus:
their corpus-wide counts are added up before one small shuffle and sent to every task.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import slices
from .packing import tokenizer_path
from .shared import shared_path
from .units import UnitMemo, worker_memo

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
TOKENS = 1 << 20  # tokens of one side that are looked at together, one document at least
BAD = -1  # stands for a unit whose tokens do not give its bytes
WIDTH = 1 << 16  # above every id
SPACE_MARK = "▁"


def byte_alphabet() -> dict[str, int]:
    """Characters of byte-level vocabularies: printable bytes stand for themselves, the others follow 255 in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers with the bytes of their entries."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # in a text they are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes_a[number] = bytes(alphabet[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)
        ]

    def encode_a(self, units: list[str]) -> list[list[int]]:
        found = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        return self._checked(units, found, self.bytes_a)

    def encode_b(self, units: list[str]) -> list[list[int]]:
        """The tokenizer puts a space in front: it takes the place of the unit's, or is cut off with a line feed after it."""
        spaced = [u.startswith(" ") for u in units]
        found = self.b.encode([u[1:] if s else "\n" + u for u, s in zip(units, spaced, strict=True)], num_threads=1)
        return self._checked(units, [ids if s else ids[2:] for ids, s in zip(found, spaced, strict=True)], self.bytes_b)

    @staticmethod
    def _checked(units: list[str], found: list[list[int]], table: list[bytes]) -> list[list[int]]:
        get = table.__getitem__
        return [ids if b"".join(map(get, ids)) == u.encode() else [BAD] for u, ids in zip(units, found, strict=True)]


def _memo(path_a: str, path_b: str) -> UnitMemo:
    pair = Pair(path_a, path_b)
    memo = UnitMemo([pair.encode_a, pair.encode_b], limit=500_000)
    memo.sizes = [np.array([len(x) for x in table], np.int64) for table in (pair.bytes_a, pair.bytes_b)]
    return memo


def overlaps(doc_a: np.ndarray, end_a: np.ndarray, size_a: np.ndarray, doc_b: np.ndarray, end_b: np.ndarray, size_b: np.ndarray) -> pd.DataFrame:
    """All overlapping pairs of tokens: ``doc``, ``a``, ``b`` (their numbers), ``a_end``, ``b_end``.

    Positions run on through the documents of the batch, in which both sides have equally many bytes.
    """
    a = pd.DataFrame({"doc": doc_a, "start": end_a - size_a, "a": np.arange(end_a.size), "a_start": end_a - size_a, "a_end": end_a})
    b = pd.DataFrame({"doc": doc_b, "start": end_b - size_b, "b": np.arange(end_b.size), "b_end": end_b})
    over_a = pd.merge_asof(a, b, on="start", by="doc")
    over_b = pd.merge_asof(b, a, on="start", by="doc")
    # Tokens that begin together are found from both sides and kept once.
    return pd.concat([over_a[["doc", "a", "b", "a_end", "b_end"]], over_b.loc[over_b["start"] > over_b["a_start"], ["doc", "a", "b", "a_end", "b_end"]]])


def _binary(values: np.ndarray, count: np.ndarray) -> pa.Array:
    bounds = (values.itemsize * np.concatenate([[0], np.cumsum(count)])).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), count.size, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


ALIGNED = "doc_id bigint, n_overlaps bigint, a_ids binary, b_ids binary, a_ends binary, b_ends binary"


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B
) -> DataFrame:
    """Stored tokens and groups of ``docs``, a row each: ``doc_id``, ``n_overlaps``, ``a_ids``, ``b_ids``, ``a_ends``, ``b_ends``.

    Ids are little-endian unsigned 16-bit numbers; an end is a byte for each token, 1 where
    it is the last of its group. A null or empty text, or one whose tokens do not give back
    its bytes, has no tokens. Rows of equal or null ids are documents of their own. Other
    columns are not looked at; an empty table gives no rows.
    """
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = worker_memo((tokenizer_a, tokenizer_b), lambda: _memo(tokenizer_path(tokenizer_a), tokenizer_path(tokenizer_b)))
        for batch in batches:
            for texts in slices(batch.column(1)):
                sides = []
                for ids, count in memo.encode(texts):
                    sides.append((ids, count, np.repeat(np.arange(len(texts)), count)))
                good = np.ones(len(texts), bool)
                for ids, _, doc in sides:
                    good[doc[ids == BAD]] = False
                (ids_a, doc_a, end_a, size_a), (ids_b, doc_b, end_b, size_b) = (
                    (ids[kept], doc[kept], np.cumsum(size[ids[kept]]), size[ids[kept]])
                    for (ids, _, doc), size in zip(sides, memo.sizes, strict=True)
                    for kept in [good[doc]]
                )
                pairs = overlaps(doc_a, end_a, size_a, doc_b, end_b, size_b)
                links = pairs[pairs["a_end"] == pairs["b_end"]]
                last_a, last_b = np.zeros(ids_a.size, np.uint8), np.zeros(ids_b.size, np.uint8)
                last_a[links["a"].to_numpy(np.int64)] = 1
                last_b[links["b"].to_numpy(np.int64)] = 1
                n_a, n_b = (np.where(good, count, 0) for _, count, _ in sides)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(texts)),
                        pa.array(np.bincount(pairs["doc"].to_numpy(np.int64), minlength=len(texts))),
                        _binary(ids_a.astype("<u2"), n_a),
                        _binary(ids_b.astype("<u2"), n_b),
                        _binary(last_a, n_a),
                        _binary(last_b, n_b),
                    ],
                    names=["doc_id", "n_overlaps", "a_ids", "b_ids", "a_ends", "b_ends"],
                )

    text = F.col(text_col).cast("string")
    spaced = F.when(F.length(text) > 0, F.concat(F.lit(" "), text)).otherwise("")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), spaced.alias("text"))
    path = shared_path(spark, "alignments")
    rows.mapInArrow(encode, ALIGNED).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(ALIGNED).parquet(path)


def _column(batch: pa.RecordBatch, name: str, kind: str, first: int, last: int) -> np.ndarray:
    """The numbers in rows ``first`` to ``last`` of a binary column, one after the other."""
    column = batch.column(name)
    if not last - first:
        return np.zeros(0, kind)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset + first : column.offset + last + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind) if data is not None and at[-1] > at[0] else np.zeros(0, kind)


class Part:
    """Some rows of an alignment: ids, flags and the number of tokens, by side."""

    def __init__(self, batch: pa.RecordBatch, first: int, last: int) -> None:
        self.first, self.last = first, last
        self.a, self.b = (_column(batch, f"{side}_ids", "<u2", first, last).astype(np.int64) for side in "ab")
        self.end_a, self.end_b = (_column(batch, f"{side}_ends", "u1", first, last) > 0 for side in "ab")
        self.n_a, self.n_b = (_sizes(batch, f"{side}_ends")[first:last] for side in "ab")

    def links(self) -> np.ndarray:
        """Both ids of each link as one number, in order."""
        return self.a[self.end_a] * WIDTH + self.b[self.end_b]

    def groups(self) -> np.ndarray:
        """Number of groups of each row."""
        doc = np.repeat(np.arange(self.n_a.size), self.n_a)
        return np.bincount(doc[self.end_a], minlength=self.n_a.size)


def _sizes(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return pc.binary_length(batch.column(name)).to_numpy().astype(np.int64)


def parts(batch: pa.RecordBatch) -> Iterator[Part]:
    total = np.concatenate([[0], np.cumsum(_sizes(batch, "a_ends") + _sizes(batch, "b_ends"))])
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(total, total[first] + 2 * TOKENS, "right")) - 1
        last = min(batch.num_rows, max(first + 1, last))
        yield Part(batch, first, last)
        first = last


def link_counts(aligned: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs of ids in order, how many links hold each, and whether that is the most for its B id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for part in parts(batch):
                found, n = np.unique(part.links(), return_counts=True)
                keys, back = np.unique(np.concatenate([keys, found]), return_inverse=True)
                total = np.zeros(keys.size, np.int64)
                np.add.at(total, back, np.concatenate([sums, n]))
                sums = total
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["pair", "n"])

    counted = aligned.select("a_ids", "b_ids", "a_ends", "b_ends").mapInArrow(count, "pair bigint, n bigint")
    table = counted.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # bounded by the vocabularies
    keys, sums = (table.column(c).to_numpy().astype(np.int64) for c in ("pair", "n"))
    order = np.argsort(keys)
    keys, sums = keys[order], sums[order]
    most = np.zeros(WIDTH, np.int64)
    np.maximum.at(most, keys % WIDTH, sums)
    return keys, sums, sums == most[keys % WIDTH]


def group_texts(part: Part) -> tuple[pa.Buffer | None, np.ndarray]:
    """Groups as text, ``a1,a2|b1;a3|b2,b3``, of all rows in one buffer, and where each row's begins."""
    group_a = np.cumsum(part.end_a) - part.end_a
    group_b = np.cumsum(part.end_b) - part.end_b
    ends_a, ends_b = np.flatnonzero(part.end_a) + 1, np.flatnonzero(part.end_b) + 1
    # In the text the A ids of a group come before its B ids.
    at_a = np.arange(part.a.size) + np.concatenate([[0], ends_b])[group_a]
    at_b = np.arange(part.b.size) + ends_a[group_b]
    # Each id with what follows it: "," within a side, "|" and ";" at its end, nothing at the end of the row.
    mark_a, mark_b = np.where(part.end_a, 1, 0), np.where(part.end_b, 2, 0)
    last = np.cumsum(part.n_b)[part.n_b > 0] - 1
    mark_b[last] = 3
    token = np.empty(part.a.size + part.b.size, np.int64)
    token[at_a], token[at_b] = part.a * 4 + mark_a, part.b * 4 + mark_b
    texts = _id_texts().take(pa.array(token))
    of = np.concatenate([[0], np.cumsum(part.n_a + part.n_b)])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: token.size + 1] if token.size else np.zeros(1, np.int64)
    return texts.buffers()[2], offsets[of]


_TEXTS: list[pa.Array] = []


def _id_texts() -> pa.Array:
    if not _TEXTS:
        _TEXTS.append(pa.array([f"{i}{mark}" for i in range(WIDTH) for mark in (",", "|", ";", "")], pa.large_string()))
    return _TEXTS[0]


def summarize(aligned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of tokens, groups and links of each row, its links by their corpus-wide counts, and a hash of its groups."""
    sent = aligned.sparkSession.sparkContext.broadcast(link_counts(aligned))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, best = sent.value
        for batch in batches:
            for part in parts(batch):
                at = np.searchsorted(keys, part.links())
                of = np.concatenate([[0], np.cumsum(part.groups())])
                count_sum = np.concatenate([[0], np.cumsum(sums[at])])[of]
                n_best = np.concatenate([[0], np.cumsum(best[at])])[of]
                buffer, where = group_texts(part)
                raw = memoryview(buffer) if buffer is not None else memoryview(b"")
                sha = [hashlib.sha256(raw[x:y]).hexdigest() if y > x else "" for x, y in zip(where[:-1].tolist(), where[1:].tolist(), strict=True)]
                numbers = [part.n_a, part.n_b, np.diff(of), np.diff(of), np.diff(n_best), np.diff(count_sum)]
                rows = batch.slice(part.first, part.last - part.first)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *[pa.array(n.astype(np.int64)) for n in numbers], pa.array(sha, pa.string()), rows.column("n_overlaps")],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"],
                )

    schema = (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
        "groups_sha256 string, n_overlaps bigint"
    )
    return aligned.mapInArrow(digest, schema).withColumnRenamed("doc_id", id_col)


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Aligns ``docs`` and summarizes each row: see ``align`` and ``summarize``."""
    return summarize(align(docs, id_col, text_col), id_col)
