"""Token ids in grammar-compressed shard files.

Tasks hold ranges of document ids and write a file each: blocks of ids, an end id
after every document. A block is compressed by Re-Pair: in each round the most
frequent neighbouring pairs get a new symbol (a rule) where they stand. Stored are
the rules, how many ids each expands to, the compressed block, the position of every
``SAMPLE``-th symbol and a table of the documents; so a document is decoded from the
symbols that cover it, without the rest of its block.

Texts are cut where the tokenizer never joins (before a single space between other
characters) and each distinct piece is encoded once a worker, which gives the ids of
the whole text at a part of the time. Pieces are found by hash and compared by bytes.
"""

from __future__ import annotations

import json
import os
import struct
import sys
import types
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kernels import HashIndex, Texts, Words, gather, hash_spans, slices, span_blocks
from .shared import shared_path, stored
from .warc import _folder

TOKENIZER = "byte_bpe_50k.json"
END = 0
SYMBOLS = 1 << 16  # symbols fit in 16 bits
SHARD_BYTES = 16 << 20
BLOCK_TOKENS = 4_000_000
ENCODED_AT_ONCE = 2 << 20  # bytes
ROUNDS, RULES_A_ROUND, LEAST_COUNT = 10, 2048, 8
SAMPLE = 1024
MAGIC = b"REPAIR1\n"
MEMO = 800_000  # pieces that a worker remembers
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_BLANK = _SPACE | np.isin(np.arange(256), list(b"\xc2\xe1\xe2\xe3"))  # or the first byte of other white space


class PieceEncoder:
    """Ids of texts by way of their distinct pieces."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # in a text they are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token)  # byte-level: a character stands for a byte
        self.index = HashIndex(18)
        self.ids, self.start, self.count = np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bytes, self.begin, self.size = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and how many each has. Pieces that may follow each other are one text."""
        size = np.array([len(p) for p in pieces], np.int64)
        data, at = np.frombuffer(b"".join(pieces), np.uint8), np.flatnonzero(size > 1)
        first, last = (np.cumsum(size) - size)[at], np.cumsum(size)[at] - 1
        follows = np.zeros(size.size, bool)
        follows[at] = (data[first] == 0x20) & ~_BLANK[data[first + 1]] & ~_SPACE[data[last]]
        joined, alone = np.flatnonzero(follows), np.flatnonzero(~follows)
        order = np.concatenate([joined, alone])
        # Numbers of the texts: about 32 KB of pieces that may follow each other, each other piece by itself.
        text = np.concatenate([(np.cumsum(size[joined]) - size[joined]) >> 15, -1 - np.arange(alone.size)])
        begins = np.flatnonzero(np.diff(text, prepend=text[:1] + 1))
        in_order, until = [pieces[i] for i in order.tolist()], np.append(begins, order.size)[1:]
        texts = [b"".join(in_order[a:b]).decode() for a, b in zip(begins.tolist(), until.tolist(), strict=True)]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        by_text = [np.array(e.ids, np.uint16) for e in encoded]
        ids, held = np.concatenate([np.zeros(0, np.uint16), *by_text]), np.array([x.size for x in by_text], np.int64)
        # A piece ends with the id that reaches its last byte.
        ends, stop = np.cumsum(self.bytes_of[ids]), np.cumsum(held)
        before, passed = np.append(0, ends)[stop - held], np.append(0, np.cumsum(size[order]))
        of = np.repeat(np.arange(begins.size), until - begins)
        cut = np.minimum(np.searchsorted(ends, before[of] + passed[1:] - passed[begins][of], "left") + 1, stop[of])
        begin = np.append(0, cut[:-1])
        begin[begins] = stop - held
        start, count = np.empty_like(size), np.empty_like(size)
        start[order], count[order] = begin, cut - begin
        return gather(ids, start, count), count

    def _known(self, key: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each piece that is remembered, -1 for the others."""
        number = self.index.find(key).astype(np.int64)
        at = np.flatnonzero(number >= 0)
        size = end[at] - start[at]
        fits = size == self.size[number[at]]
        number[at[~fits]] = -1
        at, size = at[fits], size[fits]
        span, _, own = span_blocks(data, start[at], end[at])
        begin = self.begin[number[at]]
        number[at[span[own != span_blocks(self.bytes, begin, begin + size)[2]]]] = -1
        return number

    def _numbers(self, key: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, before: bytes) -> tuple:
        """Number of each piece, and all ids with the place and count of each number's."""
        number = self._known(key, data, start, end)
        new = np.flatnonzero(number < 0)
        if not new.size:
            return number, self.ids, self.start, self.count
        place: dict[bytes, int] = {}
        raw, spans = data.tobytes(), zip(start[new].tolist(), end[new].tolist(), strict=True)
        back = np.array([place.setdefault(raw[a:b], len(place)) for a, b in spans], np.int64)
        pieces = list(place)
        ids, count = self._encode_pieces([before + p for p in pieces] if before else pieces)
        number[new] = self.count.size + back
        own_start = np.concatenate([self.start, self.ids.size + np.cumsum(count) - count])
        own, own_count = np.concatenate([self.ids, ids]), np.concatenate([self.count, count])
        keys = np.zeros(len(pieces), key.dtype)
        keys[back] = key[new]
        distinct = np.unique(keys).size == keys.size and (self.index.find(keys) < 0).all()
        if distinct and self.index.keys.size + keys.size <= MEMO:  # pieces of one hash are encoded again each time
            self.index.add(keys)
            self.ids, self.start, self.count = own, own_start, own_count
            size = np.array([len(p) for p in pieces], np.int64)
            self.begin = np.concatenate([self.begin, self.bytes.size + np.cumsum(size) - size])
            self.bytes, self.size = np.concatenate([self.bytes, np.frombuffer(b"".join(pieces), np.uint8)]), np.concatenate([self.size, size])
        return number, own, own_start, own_count

    def encode_words(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, each encoded by itself after a space, and their number by word."""
        number, own, start, count = self._numbers(words.hash, words.data, words.start, words.end, b" ")
        return gather(own, start[number], count[number]), count[number]

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with ``END`` after each, and their number by text."""
        data, n = texts.data, texts.data.size
        space = _SPACE[data]
        begins = np.zeros(n + 1, bool)
        begins[1 : n - 1] = (data[1:-1] == 0x20) & ~space[:-2] & ~space[2:] if n > 2 else False
        begins[texts.offsets[:-1]] = True
        start = np.flatnonzero(begins[:n])
        end = np.append(start[1:], n)
        number, own, own_start, own_count = self._numbers(hash_spans(data, start, end), data, start, end, b"")
        # An end mark is one more piece after each text.
        at = np.searchsorted(start, texts.offsets[1:])
        number = np.insert(number.astype(np.int64), at, own_count.size)
        own_start, own_count = np.append(own_start, own.size), np.append(own_count, 1)
        own = np.append(own, np.uint16(END))
        each = own_count[number]
        flat = gather(own, own_start[number], each)
        total = np.concatenate([[0], np.cumsum(each)])
        last = at + np.arange(1, at.size + 1)
        return flat, np.diff(np.concatenate([[0], total[last]]))


def worker_encoder(path: str, use: str = "pieces") -> PieceEncoder:
    """The encoder of this Python worker for one use; it lives as long as the worker does."""
    cache = sys.modules.setdefault("_repair_worker_cache", types.ModuleType("_repair_worker_cache"))
    if getattr(cache, "key", None) != (path, use):
        cache.encoder, cache.key = PieceEncoder(path), (path, use)
    return cache.encoder


def compress(ids: np.ndarray, first_symbol: int) -> tuple[np.ndarray, np.ndarray]:
    """Compressed sequence and rules; rule ``i`` is the pair that symbol ``first_symbol + i`` stands for."""
    seq = ids.astype(np.uint16)
    rules = np.zeros((0, 2), np.uint16)
    buckets = 1 << 20
    for _ in range(ROUNDS):
        room = min(RULES_A_ROUND, SYMBOLS - first_symbol - len(rules))
        if room <= 0 or seq.size < 2:
            break
        key = (seq[:-1].astype(np.uint32) << np.uint32(16)) | seq[1:]
        bucket = ((key * np.uint32(0x9E3779B1)) >> np.uint32(12)).astype(np.int64)
        held = np.bincount(bucket, minlength=buckets)
        best = np.argpartition(-held, room)[:room]
        best = best[held[best] >= LEAST_COUNT]
        if not best.size:
            break
        best = best[np.argsort(-held[best], kind="stable")]
        rank, chosen = np.zeros(buckets, np.int32), np.zeros(buckets, bool)
        rank[best], chosen[best] = np.arange(best.size, dtype=np.int32), True
        at = np.flatnonzero(chosen.take(bucket))
        own = rank[bucket[at]]
        pair = np.zeros(best.size, np.uint32)
        pair[own[::-1]] = key[at[::-1]]  # a bucket stands for the pair seen first in it
        same = key[at] == pair[own]
        at, own = at[same], own[same]
        # Of overlapping pairs the more frequent wins; in a run of one pair, every other.
        beside = at[1:] == at[:-1] + 1
        place = np.arange(at.size)
        fresh = np.ones(at.size, bool)
        fresh[1:] = ~beside | (own[1:] != own[:-1])
        in_run = place - np.maximum.accumulate(np.where(fresh, place, 0))
        wins = in_run % 2 == 0
        wins[1:] &= ~(beside & (own[:-1] < own[1:]))
        wins[:-1] &= ~(beside & (own[1:] < own[:-1]))
        at, own = at[wins], own[wins]
        used = np.bincount(own, minlength=best.size) >= 2
        at, own = at[used[own]], own[used[own]]
        if not at.size:
            break
        symbol = np.cumsum(used) - 1 + first_symbol + len(rules)
        rules = np.concatenate([rules, np.stack([pair[used] >> np.uint32(16), pair[used] & np.uint32(0xFFFF)], 1).astype(np.uint16)])
        seq = seq.copy()
        seq[at] = symbol[own]
        keep = np.ones(seq.size, bool)
        keep[at + 1] = False
        seq = seq[keep]
    return seq, rules


class Block:
    """A compressed block; ``ids`` decodes ranges of it."""

    def __init__(self, first_symbol: int, rules: np.ndarray, lengths: np.ndarray, seq: np.ndarray, samples: np.ndarray, docs: np.ndarray) -> None:
        self.first_symbol, self.rules, self.lengths = first_symbol, rules, lengths
        self.seq, self.samples, self.docs = seq, samples, docs  # docs: start in the block, number of ids
        self.size = np.concatenate([np.ones(first_symbol, np.int64), lengths])
        self._flat: tuple[np.ndarray, np.ndarray] | None = None

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        if self._flat is None:
            n = self.first_symbol
            start = np.concatenate([np.arange(n), n + np.cumsum(self.lengths) - self.lengths])
            flat = np.empty(n + int(self.lengths.sum()), np.uint32)
            flat[:n] = np.arange(n)
            for i, (a, b) in enumerate(self.rules.tolist()):
                at, x, y = int(start[n + i]), int(self.size[a]), int(self.size[b])
                flat[at : at + x] = flat[start[a] : start[a] + x]
                flat[at + x : at + x + y] = flat[start[b] : start[b] + y]
            self._flat = flat, start
        return self._flat

    def all_ids(self) -> np.ndarray:
        flat, start = self._expansions()
        return gather(flat, start[self.seq], self.size[self.seq])

    def ids(self, first: int, count: int) -> np.ndarray:
        """``count`` ids from position ``first``: only the symbols that cover them are expanded."""
        at = int(np.searchsorted(self.samples, first, "right")) - 1
        begin, position = at * SAMPLE, int(self.samples[at])
        out: list[np.ndarray] = []
        flat, start = self._expansions()
        while begin < self.seq.size and position < first + count:
            part = self.seq[begin : begin + SAMPLE]
            out.append(gather(flat, start[part], self.size[part]))
            begin, position = begin + SAMPLE, position + out[-1].size
        found = np.concatenate([np.zeros(0, np.uint32), *out])
        skip = first - int(self.samples[at])
        return found[skip : skip + count]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.docs[i, 0]), int(self.docs[i, 1]))

    def to_bytes(self, doc_ids: list[int | None]) -> bytes:
        parts = [self.rules.astype("<u2"), self.lengths.astype("<u4"), self.seq.astype("<u2"), self.samples.astype("<u8"), self.docs.astype("<u8")]
        body = [p.tobytes() for p in parts] + [json.dumps(doc_ids).encode()]
        return struct.pack("<7Q", self.first_symbol, *map(len, body)) + b"".join(body)

    @classmethod
    def read(cls, stream) -> tuple[Block, list[int | None]] | None:  # noqa: ANN001
        head = stream.read(56)
        if not head:
            return None
        first_symbol, *sizes = struct.unpack("<7Q", head)
        body = [stream.read(n) for n in sizes]
        if [len(b) for b in body] != sizes:
            raise ValueError("a shard file is cut short")
        kinds = ("<u2", "<u4", "<u2", "<u8", "<u8")
        rules, lengths, seq, samples, docs = (np.frombuffer(b, k) for b, k in zip(body[:5], kinds, strict=True))
        block = cls(first_symbol, rules.reshape(-1, 2), lengths.astype(np.int64), seq, samples.astype(np.int64), docs.reshape(-1, 2).astype(np.int64))
        return block, json.loads(body[5])


def make_block(ids: np.ndarray, counts: np.ndarray, first_symbol: int) -> Block:
    seq, rules = compress(ids, first_symbol)
    size = [1] * first_symbol
    for a, b in rules.tolist():
        size.append(size[a] + size[b])
    lengths = np.array(size[first_symbol:], np.int64)
    ends = np.cumsum(np.array(size, np.int64)[seq])
    samples = np.concatenate([[0], ends[SAMPLE - 1 :: SAMPLE]]).astype(np.int64)
    return Block(first_symbol, rules, lengths, seq, samples, np.stack([np.cumsum(counts) - counts, counts], 1))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def write_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """Shard files of ``docs`` in ascending id order; returns ``file``, ``part``, ``docs``, ``tokens``.

    A null text is empty. Rows of equal ids are all written, ordered by text; null ids
    come first. Other columns are not looked at; an empty table gives no files.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = rows.repartitionByRange(max(1, -(-size // SHARD_BYTES)), "id").sortWithinPartitions("id", "text")
    target = shared_path(spark, "token-shards")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path(tokenizer))
        first_symbol = encoder.bytes_of.size
        files, root = _folder(target)
        files.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.repair"
        held: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        names: list[int | None] = []
        waiting = docs_done = tokens = 0
        out = None

        def flush() -> None:
            nonlocal out, waiting, docs_done, tokens
            if out is None:
                out = files.open_output_stream(f"{root}/{name}", compression=None)
                out.write(MAGIC)
            block = make_block(np.concatenate(held), np.concatenate(counts), first_symbol)
            out.write(block.to_bytes(names))
            docs_done, tokens = docs_done + len(names), tokens + waiting
            held.clear(), counts.clear(), names.clear()
            waiting = 0

        for batch in batches:
            for texts in slices(batch.column(1), ENCODED_AT_ONCE):
                ids, count = encoder.encode(texts)
                held.append(ids)
                counts.append(count)
                names.extend(batch.column(0).slice(texts.first, len(texts)).to_pylist())
                waiting += ids.size
                if waiting >= BLOCK_TOKENS:
                    flush()
        if names:
            flush()
        if out is not None:
            out.close()
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({"file": [f"{target}/{name}"], "part": [part], "docs": [docs_done], "tokens": [tokens]})

    return stored(ordered.mapInArrow(write, "file string, part bigint, docs bigint, tokens bigint"), "token-manifest")


def read_shards(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` (and ``ids``) of every document in the files."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one small row a file
    placed = manifest.select("file", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("first"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, path = _folder(uri)
                with files.open_input_stream(path, compression=None) as stream:
                    if stream.read(len(MAGIC)) != MAGIC:
                        raise ValueError(f"no shard file: {uri}")
                    while found := Block.read(stream):
                        block, doc_ids = found
                        ids = np.ascontiguousarray(block.all_ids(), "<u4")
                        raw = memoryview(ids).cast("B")
                        crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in block.docs.tolist()]
                        columns = [
                            pa.array(doc_ids, pa.int64()),
                            pa.array(block.docs[:, 0] + first),
                            pa.array(block.docs[:, 1]),
                            pa.array(crc, pa.int64()),
                        ]
                        if with_ids:
                            offsets = np.append(block.docs[:, 0], ids.size).astype(np.int32)
                            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))))
                        first += ids.size
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    spread = placed.repartition(max(1, manifest.count()))  # a task for each file
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return spread.mapInArrow(read, schema)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes ``docs`` and reads the files back: one row per row, see ``read_shards``."""
    return read_shards(write_shards(docs, id_col, text_col)).withColumnRenamed("doc_id", id_col)
