"""Best-fit packing of documents into token sequences by linear grouping.

Pieces of equal length can stand for each other, so the plan is made from the number of
pieces of each length (at most ``CAPACITY`` rows, however many documents there are):

1. Large lengths are sorted, cut into groups of about equal cardinality and rounded up to
   the greatest of their group.
2. The best mixture of configurations (how many of each group share a sequence) for these
   few sizes is a linear programme, solved by column generation; its counts are rounded
   down.
3. The actual lengths take the places of the rounded ones, greatest first.
4. What is left, mostly small pieces, goes by falling length into the sequence with the
   least room that holds it.

The plan is a list of runs: so many pieces of one length go to sequences from a number
on, a fixed number to each, at an offset. It holds no documents. Every piece has a
position among those of its length (a count within its task and the counts of the tasks
before), so its place follows from the plan alone.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kernels import runs, slices
from .shared import shared_path, stored
from .units import UnitMemo, worker_memo

TOKENIZER = "word_bpe_49k.json"
END = 1
CAPACITY = 4096
# What is tried: a large piece takes more than this part of a sequence, and the number of groups.
TRIALS = ((4, 8), (4, 16), (6, 16), (3, 8), (2, 8), (8, 64))
SLICE_BYTES = 4 << 20
POSITIONS = 1 << 44  # above any number of pieces of one length
TINY = 1e-9


def _best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int, most: int) -> np.ndarray:
    """How many of each size make the configuration of the greatest worth, of at most ``most`` pieces."""
    value = np.zeros(capacity + 1)
    chosen = np.full((most, capacity + 1), -1, np.int64)
    for step in range(most):
        better = value.copy()
        for g, (size, w) in enumerate(zip(sizes.tolist(), worth.tolist(), strict=True)):
            if w <= TINY:
                continue
            with_it = value[: capacity + 1 - size] + w
            won = with_it > better[size:] + TINY
            better[size:][won] = with_it[won]
            chosen[step, size:][won] = g
        if (better <= value + TINY).all():
            break
        value = better
    counts, room = np.zeros(sizes.size, np.int64), capacity
    for step in range(most - 1, -1, -1):
        g = chosen[step, room]
        if g >= 0:
            counts[g] += 1
            room -= int(sizes[g])
    return counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often each is used, so that all ``demand`` is met by the fewest sequences."""
    k = sizes.size
    basis = np.diag(capacity // sizes).astype(float)  # a column is a configuration
    cost = np.ones(k)
    for _ in range(40 * k):
        used = np.linalg.solve(basis, demand.astype(float))
        worth = np.linalg.solve(basis.T, cost)
        if worth.min() < -TINY:
            column, price = np.zeros(k), 0.0  # more than the demand of one size
            column[int(worth.argmin())] = -1.0
        else:
            column, price = _best_configuration(sizes, worth, capacity, capacity // int(sizes.min())).astype(float), 1.0
            if worth @ column <= 1 + 1e-7:
                break
        rate = np.linalg.solve(basis, column)
        if not (rate > TINY).any():
            break
        steps = np.where(rate > TINY, used / np.where(rate > TINY, rate, 1), np.inf)
        out = int(steps.argmin())
        basis[:, out], cost[out] = column, price
    used = np.linalg.solve(basis, demand.astype(float))
    return [(basis[:, j].astype(np.int64), float(used[j])) for j in range(k) if cost[j] == 1 and used[j] > TINY]


class Plan:
    """Runs for the pieces of each length: ``(length, first, n, sequence, per, offset)``.

    ``n`` pieces from position ``first`` go to the sequences from ``sequence`` on, ``per``
    to each, the first of them at ``offset``.
    """

    def __init__(self, counts: dict[int, int], capacity: int, large: int, groups: int) -> None:
        self.capacity, self.sequences = capacity, 0
        self.left, self.at = dict(counts), dict.fromkeys(counts, 0)
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: first sequence, how many
        self.some = np.zeros(capacity + 1, bool)
        self._large([n for n in counts if n * large > capacity and counts[n]], groups)
        for length in sorted(counts, reverse=True):
            self._best_fit(length)

    def _place(self, length: int, n: int, sequence: int, per: int, offset: int) -> None:
        self.runs.append((length, self.at[length], n, sequence, per, offset))
        self.at[length] += n
        self.left[length] -= n

    def _keep(self, room: int, sequence: int, n: int) -> None:
        if room:
            self.open[room].append((sequence, n))
            self.some[room] = True

    def _large(self, lengths: list[int], groups: int) -> None:
        lengths = sorted(lengths, reverse=True)
        if not lengths:
            return
        count = np.array([self.left[n] for n in lengths], np.int64)
        earlier = np.cumsum(count) - count
        group = earlier * groups // int(count.sum())
        named, group = np.unique(group, return_inverse=True)
        members = [[n for n, g in zip(lengths, group.tolist(), strict=True) if g == i] for i in range(named.size)]
        sizes = np.array([m[0] for m in members], np.int64)
        demand = np.bincount(group, count).astype(np.int64)
        for configuration, often in configurations(sizes, demand, self.capacity):
            self._substitute([g for g, n in enumerate(configuration.tolist()) for _ in range(n)], int(often + 1e-6), members)

    def _substitute(self, slots: list[int], often: int, members: list[list[int]]) -> None:
        """``often`` sequences with actual pieces in the places of their groups."""
        parts = [(self.sequences, often, 0)]  # first sequence, how many, tokens used
        self.sequences += often
        for g in slots:
            filled = []
            for sequence, n, used in parts:
                while n:
                    length = next((x for x in members[g] if self.left[x]), None)
                    if length is None:
                        filled.append((sequence, n, used))
                        break
                    k = min(n, self.left[length])
                    self._place(length, k, sequence, 1, used)
                    filled.append((sequence, k, used + length))
                    sequence, n = sequence + k, n - k
            parts = filled
        for sequence, n, used in parts:
            self._keep(self.capacity - used, sequence, n)

    def _best_fit(self, length: int) -> None:
        while self.left[length]:
            fits = np.flatnonzero(self.some[length:])
            if not fits.size:
                bins = -(-self.left[length] // (self.capacity // length))
                self._keep(self.capacity, self.sequences, bins)
                self.sequences += bins
                continue
            room = length + int(fits[0])
            sequence, n = self.open[room].pop()
            self.some[room] = bool(self.open[room])
            per = room // length
            whole = min(n, self.left[length] // per)
            if whole:
                self._place(length, whole * per, sequence, per, self.capacity - room)
                self._keep(room - per * length, sequence, whole)
                sequence, n = sequence + whole, n - whole
            if n and self.left[length]:
                rest = min(self.left[length], per)
                self._place(length, rest, sequence, rest, self.capacity - room)
                self._keep(room - rest * length, sequence, 1)
                sequence, n = sequence + 1, n - 1
            if n:
                self._keep(room, sequence, n)


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan of the fewest sequences among ``TRIALS``, or the first that no plan can beat."""
    least = -(-sum(length * n for length, n in counts.items()) // capacity)
    best: Plan | None = None
    for large, groups in TRIALS:
        plan = Plan(counts, capacity, large, groups)
        best = plan if best is None or plan.sequences < best.sequences else best
        if best.sequences == least:
            break
    return best


def _memo(path: str) -> UnitMemo:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return UnitMemo([lambda units: [e.ids for e in tokenizer.encode_batch_fast(units, add_special_tokens=False)]], lower=True)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def id_type(tokenizer: str = TOKENIZER) -> str:
    """Little-endian type of the ids: 16 bits where the vocabulary allows it, else 32."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer_path(tokenizer)).get_vocab_size() <= 1 << 16 else "<u4"


def encode_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, end: int = END, capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``doc_id``, ``piece``, ``start``, ``length``, ``part``, ``nth``, ``ids``.

    ``ids`` holds numbers of ``id_type``. ``nth`` counts the earlier pieces of the same
    length of the same task (``part``).
    """
    kind = np.dtype(id_type(tokenizer))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = worker_memo((tokenizer,), lambda: _memo(tokenizer_path(tokenizer)))
        seen = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for texts in slices(batch.column(1), SLICE_BYTES):
                ((ids, count),) = memo.encode(texts)
                out = np.full(ids.size + len(texts), end, kind)
                out[np.arange(ids.size) + np.repeat(np.arange(len(texts)), count)] = ids
                size = count + 1
                text, piece = runs(-(-size // capacity))
                start = piece * capacity
                length = np.minimum(capacity, size[text] - start)
                order = np.argsort(length, kind="stable")
                held = np.bincount(length, minlength=capacity + 1)
                nth = np.empty(length.size, np.int64)
                nth[order] = runs(held)[1]
                nth += seen[length]
                seen += held
                bounds = (kind.itemsize * np.concatenate([[0], np.cumsum(length)])).astype(np.int64)
                raw = pa.Array.from_buffers(pa.large_binary(), length.size, [None, pa.py_buffer(bounds), pa.py_buffer(out)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(text + texts.first)),
                        pa.array(piece, pa.int32()),
                        pa.array(start),
                        pa.array(length),
                        pa.array(np.full(length.size, part)),
                        pa.array(nth),
                        raw,
                    ],
                    names=["doc_id", "piece", "start", "length", "part", "nth", "ids"],
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, part bigint, nth bigint, ids binary"
    return rows.mapInArrow(encode, schema)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with the ``sequence_id`` and ``offset`` that the plan gives each."""
    spark = pieces.sparkSession
    held = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "packing-counts")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    counts = held.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    plan = best_plan({r["length"]: r["n"] for r in counts}, capacity) if counts else None
    # Runs: a few for each length and configuration, a number that the capacity bounds.
    table = np.array(sorted(plan.runs) if plan else [], np.int64).reshape(-1, 6)
    sent = spark.sparkContext.broadcast(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, _, sequence, per, offset = sent.value.T
        keys = length * POSITIONS + first
        for batch in batches:
            size, position = batch.column("length").to_numpy(), batch.column("position").to_numpy()
            run = np.searchsorted(keys, size * POSITIONS + position, "right") - 1
            nth = position - first[run]
            columns = [*batch.columns[:-1], pa.array(sequence[run] + nth // per[run]), pa.array(offset[run] + nth % per[run] * size)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])

    kept = ["doc_id", "piece", "start", "length", "ids"]
    placed = pieces.join(before, ["part", "length"]).select(*kept, (F.col("before") + F.col("nth")).alias("position"))
    return placed.mapInArrow(
        place, "doc_id bigint, piece int, start bigint, length bigint, ids binary, sequence_id bigint, offset bigint"
    )


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, end: int = END, capacity: int = CAPACITY
) -> DataFrame:
    """Sequences of ``docs``: ``sequence_id``, ``ids`` (numbers of ``id_type``) and ``pieces`` in their order.

    Every document, and of a longer one every piece of ``capacity`` ids, lies whole in one
    sequence. A null or empty text is the end id alone. Rows of equal or null ids are
    documents of their own. Other columns are not looked at; an empty table gives no
    sequences. A sequence holds at most ``capacity`` pieces, so no group is unbounded.
    """
    spark = docs.sparkSession
    pieces = encode_pieces(docs, id_col, text_col, tokenizer, end, capacity)
    path = shared_path(spark, "packing-pieces")
    pieces.write.option("compression", "zstd").parquet(path)
    placed = place_pieces(spark.read.schema(pieces.schema).parquet(path), capacity)
    one = F.struct("offset", "doc_id", "piece", "start", "length", "ids")
    grouped = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(one)).alias("held"))
    return grouped.select(
        "sequence_id",
        F.expr("aggregate(held, X'', (a, p) -> concat(a, p.ids))").alias("ids"),
        F.expr("transform(held, p -> struct(p.doc_id, p.piece, p.start, p.length, p.offset))").alias("pieces"),
    )


def pieces_of(sequences: DataFrame, id_col: str = "doc_id", tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece of the sequences, with the checksum of its ids (as 32-bit numbers) as they lie there."""
    kind = id_type(tokenizer)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(2)
            piece, count = held.flatten(), np.diff(held.offsets.to_numpy())
            begin, length = piece.field("offset").to_numpy(), piece.field("length").to_numpy()
            crc = np.empty(begin.size, np.int64)
            at = 0
            for ids, n in zip(batch.column(1), count.tolist(), strict=True):
                raw = memoryview(np.frombuffer(ids.as_buffer(), kind).astype("<u4")).cast("B")
                for i in range(at, at + n):
                    crc[i] = zlib.crc32(raw[4 * begin[i] : 4 * (begin[i] + length[i])])
                at += n
            columns = [piece.field(c) for c in ("doc_id", "piece", "start", "length")]
            sequence = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), count)))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(crc), sequence, piece.field("offset")],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return sequences.select("sequence_id", "ids", "pieces").mapInArrow(digest, schema).withColumnRenamed("doc_id", id_col)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs ``docs`` into sequences and lists their pieces: see ``pack``."""
    return pieces_of(pack(docs, id_col, text_col), id_col)
