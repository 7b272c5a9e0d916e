"""N-gram Jaccard join by parity sketches, exact.

Two shingle sets with similarity at least t, the smaller of size a, differ in at most
d = floor(a * (1 - t) / t) shingles. A sketch XORs each shingle's hash into one of m
64-bit cells; one differing shingle changes one cell, so the number of differing
cells (the sketches' Hamming distance by cell) is at most d, and of m = 1.5 d cells
m - d are equal. Cells are the join keys.

* Sets of about equal size share a band, which fixes d and m. A set also enters the
  lower bands whose sets it may be similar to.
* A set needs m - d equal cells, less those it has empty. A cell that no other set has
  is a difference from all: a set with fewer other cells than it needs has no partner
  and goes. Of the rest, all but as many as are needed less one are keys (in the
  order of their values), so two similar sets still have one in common.
* A set with too few filled cells for this promise joins by all its cells and by its
  d + 1 least shingle hashes, which two such sets share.
* Equal sets are one node, so copies cost nothing after the first scan.
* Keys are counted first (combined before the shuffle), then rows of repeated keys
  form buckets. Each set first meets one other, the least of all its keys, so a group
  of copies costs a pair a set however many keys they share. Then a bucket is not expanded into pairs: its members are compared with a
  few of them (``HEADS``), links are merged into components, the compared ones leave
  the bucket, and buckets that still hold several components go on with more heads. In the end every
  pair of different components that share a key has been compared.
* Shingles that no other set of the buckets has differ from all: a pair whose own
  shingles are too many already is not compared. Heads are those with the fewest.
* Links are verified on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .kernels import U64, Texts, Words, byte_table, grams, mix64, runs, slices
from .shared import bit_filter, forget, in_filter, stored

# Heads of each bucket by round, at most so many of a component and in all; the last goes for all later rounds.
HEADS = ((2, 2), (1, 128), (2, 256), (8, 512), (32, 512), (512, 512))
SORTED_KEYS = 2_000_000
BAND_RATIO = 1.25
KEY_BITS = 25


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words are linked when ``den * both >= num * either``."""

    words: int = 4
    num: int = 85
    den: int = 100

    def differ(self, smaller: int) -> int:
        """Most shingles in which a similar set may differ from one of this size."""
        return smaller * self.den // self.num - smaller

    def least_partner(self, size: int) -> int:
        return -(-size * self.num // self.den)


_BANDS: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def bands(rule: Rule, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First size, d and number of cells of each band up to the size ``largest``."""
    if (rule.num, rule.den, largest) in _BANDS:
        return _BANDS[rule.num, rule.den, largest]
    first, d, cells = [], [], []
    low = 1
    while low <= largest:
        high = max(low, int(low * BAND_RATIO))
        most = rule.differ(high)
        m = most + 1
        if most:
            m = ceil(1.5 * most) + 2
        first.append(low)
        d.append(most)
        cells.append(m)
        low = high + 1
    return _BANDS.setdefault((rule.num, rule.den, largest), (np.array(first), np.array(d), np.array(cells)))


class Sets:
    """Distinct shingle hashes of some texts: ``hash`` sorted within each text, ``of``, ``size``, ``node``."""

    def __init__(self, texts: Texts, rule: Rule) -> None:
        words = Words(texts, byte_table("space"))
        h, same = grams(words, rule.words)
        at = np.flatnonzero(same)
        h, text = h[at], words.text[at]
        for n in range(1, rule.words):  # a shorter text is one shingle
            short = np.flatnonzero(words.count == n)
            if short.size:
                g, _ = grams(words, n)
                h, text = np.concatenate([h, g[words.of[short]]]), np.concatenate([text, short])
        order = np.lexsort((h, text))
        h, text = h[order], text[order]
        new = np.ones(h.size, bool)
        new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        self.hash, self.text = h[new], text[new]
        self.of = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.size = np.diff(self.of)
        self.node = self._total(mix64(self.hash)) ^ mix64(self._total(mix64(self.hash ^ U64(0x2545F4914F6CDD1D))) + self.size.astype(U64))

    def _total(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
        return total[self.of[1:]] - total[self.of[:-1]]

    def keys(self, which: np.ndarray, rule: Rule, bits: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Cells of the texts numbered ``which`` and the text of each; with ``bits``, the bitmap
        of cells that several sets have, their join keys."""
        size = self.size[which]
        first, d, cells = bands(rule, 1 << max(10, int(self.size.max(initial=1)).bit_length()))
        high = np.searchsorted(first, size, "right") - 1
        low = np.searchsorted(first, -(-size * rule.num // rule.den), "right") - 1
        group, inside = runs(high - low + 1)
        who, band = which[group], low[group] + inside
        keep = d[band] > 0  # without difference, similar sets are equal ones
        who, band = who[keep], band[keep]
        n = self.size[who]
        entry, at = runs(n)
        h = self.hash[self.of[who][entry] + at]
        m = cells[band]
        base = np.cumsum(m) - m
        cell = base[entry] + (((h >> U64(32)) * m[entry].astype(U64)) >> U64(32)).astype(np.int64)
        total = int(m.sum())
        sketch, filled = np.zeros(total, U64), np.zeros(total, bool)
        np.bitwise_xor.at(sketch, cell, h)
        filled[cell] = True
        owner, part = runs(m)
        tag = mix64(band[owner].astype(U64) * U64(1 << 32) + part.astype(U64) + U64(1))
        keys, owner = mix64(sketch ^ tag)[filled], owner[filled]
        need = np.bincount(owner, minlength=m.size) - d[band]  # m - d, less the empty cells
        if bits is not None:
            some = in_filter(bits, keys)
            keys, owner = keys[some], owner[some]
            order = np.lexsort((keys, owner))
            keys, owner = keys[order], owner[order]
            held = np.bincount(owner, minlength=m.size)
            _, at = runs(held)
            some = at < (held - np.maximum(need, 1) + 1)[owner]
            keys, owner = keys[some], owner[some]
        text = who[owner]
        lacking = np.flatnonzero(need < 1)
        if lacking.size:
            g, k = runs(np.minimum(d[band[lacking]] + 1, n[lacking]))
            least = self.hash[self.of[who[lacking]][g] + k]
            tag = mix64(band[lacking][g].astype(U64) + U64(0xB5297A4D << 32))
            keys, text = np.concatenate([keys, mix64(least ^ tag)]), np.concatenate([text, who[lacking][g]])
        return keys, text


def _first_of_each(node: np.ndarray, seen: set[int]) -> np.ndarray:
    """Rows of nodes that are new to this task."""
    out = []
    for i, n in enumerate(node.tolist()):
        if n not in seen:
            seen.add(n)
            out.append(i)
    return np.array(out, np.int64)


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def sketch_keys(rows: DataFrame, rule: Rule, bits: np.ndarray) -> DataFrame:
    """``key`` and ``node`` of the sets in ``rows.text``, only keys that ``bits`` may hold."""
    sent = rows.sparkSession.sparkContext.broadcast(bits)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # one number a text of the task
        for batch in batches:
            for texts in slices(batch.column(0)):
                sets = Sets(texts, rule)
                new = _first_of_each(sets.node, seen)
                keys, text = sets.keys(new[sets.size[new] > 0], rule, sent.value)
                yield pa.RecordBatch.from_arrays([_long(keys), _long(sets.node[text])], names=["key", "node"])

    return rows.select("text").mapInArrow(scan, "key bigint, node bigint")


def repeated_keys(rows: DataFrame, rule: Rule) -> DataFrame:
    """Keys (``key``) that several of the sets in ``rows.text`` have.

    Nearly all keys are of one set only, so a hash table of them is no use ahead of the
    shuffle. They are sorted some millions at a time, which makes one row of the keys that
    many sets have.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # one number a text of the task
        held: list[np.ndarray] = []
        waiting = 0

        def counted() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate([np.zeros(0, U64), *held]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([_long(keys), pa.array(n > 1)], names=["key", "several"])

        for batch in batches:
            for texts in slices(batch.column(0)):
                sets = Sets(texts, rule)
                new = _first_of_each(sets.node, seen)
                held.append(sets.keys(new[sets.size[new] > 0], rule)[0])
                waiting += held[-1].size
                if waiting >= SORTED_KEYS:
                    waiting = 0
                    yield counted()
        yield counted()

    keys = rows.select("text").mapInArrow(scan, "key bigint, several boolean").repartition("key")
    found = keys.groupBy("key").agg(F.count("*").alias("n"), F.max("several").alias("several"))
    return found.where("n > 1 OR several").select("key")


def shingle_nodes(rows: DataFrame, rule: Rule) -> DataFrame:
    """``row``, ``id``, ``n_shingles`` and ``node`` (equal for equal sets) of ``rows``."""
    id_type = rows.schema["id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(1)):
                sets = Sets(texts, rule)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(texts.first, len(texts)), pa.array(sets.size.astype(np.int64)), _long(sets.node)],
                    names=["id", "n_shingles", "node"],
                )

    return rows.select("id", "text").mapInArrow(scan, f"id {id_type}, n_shingles bigint, node bigint")


def shingle_sets(rows: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """``node`` and ``shingles`` for the ids in ``wanted``; a few others may be among them."""
    hashed = F.xxhash64("id").alias("key")
    sent = rows.sparkSession.sparkContext.broadcast(bit_filter(wanted.select(hashed), "key"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = np.flatnonzero(in_filter(sent.value, batch.column(0).to_numpy().view(np.uint64)))
            for texts in slices(batch.column(1).take(pa.array(some))):
                sets = Sets(texts, rule)
                offsets = pa.array(sets.of.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [_long(sets.node), pa.ListArray.from_arrays(offsets, _long(sets.hash))], names=["node", "shingles"]
                )

    return rows.select(hashed, "text").mapInArrow(scan, "node bigint, shingles array<bigint>")


def linked(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The rows of ``pairs`` (nodes ``a``, ``b``) whose sets are similar."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    either = F.size("sa") + F.size("sb") - both
    size_a, size_b = F.size("sa"), F.size("sb")
    close = F.least(size_a, size_b) * rule.den >= F.greatest(size_a, size_b) * rule.num
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(close).where(both * rule.den >= either * rule.num).select("a", "b")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``.

    A text's set is its distinct shingles of ``rule.words`` words (runs of other than
    space and 0x09-0x0D, A-Z lower-cased); with fewer words all of them are one
    shingle; without words or text the set is empty and linked with nothing.
    ``component_id`` is the least id that links reach, the own id at least. Shingles
    are compared as 64-bit hashes. Repeated rows are equal texts. A null id is never
    the least; a set that only null ids have is linked with equal ones at most. An
    empty table gives no rows. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    nodes = stored(shingle_nodes(rows, rule), "jaccard-nodes")
    repeated = stored(repeated_keys(rows, rule), "jaccard-keys")
    members = stored(sketch_keys(rows, rule, bit_filter(repeated, "key", KEY_BITS)).distinct(), "jaccard-rows")
    buckets = _several(members.withColumn("component", F.col("node")))
    forget(repeated, members)
    # One id for each node that shares a key; later rounds compare others than the first.
    ids = nodes.where("n_shingles > 0").groupBy("node").agg(F.min("id").alias("id"))
    wanted = ids.join(buckets.select("node").distinct(), "node", "left_semi")
    sets = stored(shingle_sets(rows, wanted, rule), "jaccard-sets")

    buckets = _bounded(buckets, sets, rule)
    links = tried = nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    known = components(links)
    done: list[DataFrame] = [sets]
    turn = -1
    while not buckets.isEmpty():
        if turn < 0:
            found, rest = _least_pairs(buckets, rule), buckets
        else:
            heads = _heads(buckets, *HEADS[min(turn, len(HEADS) - 1)])
            found = _head_pairs(buckets, heads, rule)
            # Heads are compared with their whole bucket and leave it.
            rest = buckets.join(heads.selectExpr("key", "transform(heads, h -> h.a) AS gone"), "key").where("NOT array_contains(gone, node)")
        turn += 1
        pairs = stored(found.join(tried, ["a", "b"], "left_anti"), "jaccard-pairs")
        tried = tried.unionAll(pairs)
        new = stored(linked(pairs, sets, rule), "jaccard-links")
        done += [pairs, new]
        if not new.isEmpty():
            links = links.unionAll(new)
            known = components(links)
        merged = rest.select("key", "node", "own", "size").join(known, "node", "left")
        last, buckets = buckets, _several(_possible(merged.withColumn("component", F.coalesce("component", "node")), rule))
        forget(last)
    forget(buckets, *done)  # what follows reads the nodes and their components

    own = nodes.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = own.where("n_shingles > 0").groupBy("component").agg(F.min("id").alias("least"))
    named = own.join(least, "component", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("id"))
    return named.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"))


def _several(rows: DataFrame) -> DataFrame:
    """Rows (``key``, ``node``, ``component``) of the keys under which several components stand."""
    low, high = F.min("component").alias("low"), F.max("component").alias("high")
    keys = rows.groupBy("key").agg(low, high).where("low <> high").select("key")
    return stored(rows.join(keys, "key", "left_semi"), "jaccard-buckets")


def _bounded(buckets: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Adds ``size`` and ``own``, the number of shingles that no other set of the buckets has."""
    each = sets.join(buckets.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    size = each.select("node", F.size("shingles").alias("size"))
    alone = each.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle")
    alone = alone.agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
    own = size.join(alone.groupBy("node").agg(F.count("*").alias("own")), "node", "left")
    own = stored(own.select("node", "size", F.coalesce("own", F.lit(0)).alias("own")), "jaccard-own")
    bounded = _several(_possible(buckets.join(own, "node"), rule))
    forget(own, buckets)
    return bounded


def _possible(rows: DataFrame, rule: Rule) -> DataFrame:
    """Drops members whose own shingles alone differ too much from any set of their key.

    ``fewest`` own shingles, ``smallest`` and ``largest`` size of the key bound every partner.
    """
    bounds = rows.groupBy("key").agg(
        F.min("own").alias("fewest"), F.min("size").alias("smallest"), F.max("size").alias("largest")
    )
    beyond = F.greatest("fewest", F.col("own") - F.col("size") + F.greatest("smallest", F.ceil(F.col("size") * rule.num / rule.den)))
    most = F.col("size") + F.least(F.col("largest"), F.col("size") * rule.den / rule.num)
    near = (F.col("own") + beyond) * (rule.den + rule.num) <= most * (rule.den - rule.num)
    return rows.join(bounds, "key").where(near).drop("fewest", "smallest", "largest")


def _differ(head: str, rule: Rule) -> str:
    """SQL text: the shingles that must differ from ``head`` are not too many already.

    What one set has beyond the other is at least its own shingles, and the two such
    numbers differ by as much as the sizes.
    """
    differ = f"greatest({head}_own, own + {head}_size - size) + greatest(own, {head}_own - {head}_size + size)"
    return f"({differ}) * {rule.den + rule.num} <= ({head}_size + size) * {rule.den - rule.num}"


def _least_pairs(buckets: DataFrame, rule: Rule) -> DataFrame:
    """Each member beside one other: of the least of its keys that it may be similar to, the least."""
    member = F.struct(F.col("own").alias("a_own"), F.col("node").alias("a"), F.col("size").alias("a_size"))
    least = buckets.groupBy("key").agg(F.min(member).alias("h"))
    beside = buckets.join(least, "key").where("h.a <> node").where(_differ("h.a", rule))
    pairs = beside.groupBy("node").agg(F.min("h").alias("h")).select("node", "h.a")
    return pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def _heads(buckets: DataFrame, of_component: int, count: int) -> DataFrame:
    """At most ``count`` members of each key, those of a component with the fewest own shingles and ``of_component`` of it.

    What is joined already needs few heads: the members of other components meet these.
    """
    at = F.row_number().over(Window.partitionBy("key", "component").orderBy("own", "node"))
    some = buckets.withColumn("at", at).where(F.col("at") <= of_component)
    place = F.row_number().over(Window.partitionBy("key").orderBy("at", "own", "node"))
    member = F.struct(
        F.col("own").alias("a_own"), F.col("node").alias("a"), F.col("size").alias("a_size"), F.col("component").alias("a_component")
    )
    first = some.withColumn("place", place).where(F.col("place") <= count)
    return first.groupBy("key").agg(F.collect_list(member).alias("heads"))


def _head_pairs(buckets: DataFrame, heads: DataFrame, rule: Rule | None = None) -> DataFrame:
    """Each member beside the heads of its key that are not of its component.

    With ``rule``, the shingles that must differ are not too many already.
    """
    told = "h.a_component <> component"
    if rule:
        told += f" AND {_differ('h.a', rule)}"
    near = f"transform(filter(heads, h -> {told}), h -> h.a)"
    beside = buckets.join(heads, "key").select("node", F.expr(near).alias("near")).where("size(near) > 0")
    # A pair that shares many keys becomes one row: heads of a member are merged first.
    merged = beside.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    pairs = merged.select("node", F.explode("near").alias("a"))
    return pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
