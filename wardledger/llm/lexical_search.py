"""Ranked lexical search, reversed: documents stream through an index of the items.

The terms of the items make an inverted index: by term, the items that hold it and how
often. It is cut into blocks of at most ``POSTINGS`` postings by a hash of the item, so
what is sent to every task has a fixed bound however many items there are. For each
block the documents are read once and reduced to their counts of the block's terms.
These counts give the corpus statistics and then stream through the index: every task
keeps the best ``k`` documents of each item in a heap, whose least score is the bound
that a further document must reach. The heaps are merged in two steps.

An item of more than ``LONG`` distinct terms is cut by a hash of the term. Its parts are
items of their own, for which all partial scores are kept and added up by document.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .exact_dedup import LOWER, UPPER
from .kernels import HashIndex, Texts, Words, byte_table, gather, hash_spans, runs, slices
from .shared import stored

K = 10
POSTINGS = 1 << 18  # of a block: a few MB
LONG = 1 << 14  # distinct terms of an item that is not cut
CELLS = 1 << 20  # scores, or postings, that are looked at together
SCALE, HALF, SLOPE, PERCENT = 1_000_000_000, 8, 75, 100


class Terms:
    """Terms of a block by number, found by hash and compared by bytes."""

    def __init__(self, terms: list[str]) -> None:
        raw = [t.encode() for t in terms]
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.size = np.array([len(r) for r in raw], np.int64)
        self.start = np.cumsum(self.size) - self.size
        # Terms of equal hash are chained: the index holds the first, ``after`` the next.
        key = hash_spans(self.data, self.start, self.start + self.size) if terms else np.zeros(0, np.uint64)
        order = np.argsort(key, kind="stable")
        same = np.zeros(key.size, bool)
        same[1:] = key[order][1:] == key[order][:-1]
        self.after = np.full(key.size, -1, np.int64)
        self.after[order[:-1][same[1:]]] = order[1:][same[1:]]
        self.first = order[~same]
        self.index = HashIndex()
        self.index.add(key[self.first])

    def find(self, words: Words) -> np.ndarray:
        """Number of each word, -1 where it is no term."""
        out = np.full(words.start.size, -1, np.int64)
        found = self.index.find(words.hash)
        todo = np.flatnonzero(found >= 0)
        number = self.first[found[todo]] if todo.size else todo
        while todo.size:
            size = words.end[todo] - words.start[todo]
            fits = size == self.size[number]
            a, b, n = words.start[todo[fits]], self.start[number[fits]], size[fits]
            differs = gather(words.data, a, n) != gather(self.data, b, n)
            wrong = np.add.reduceat(differs, np.cumsum(n) - n) > 0 if n.size else np.zeros(0, bool)
            equal = fits.copy()
            equal[fits] = ~wrong
            out[todo[equal]] = number[equal]
            todo, number = todo[~equal], self.after[number[~equal]]
            todo, number = todo[number >= 0], number[number >= 0]
        return out


def term_counts(words: Words, terms: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, term, count)`` of all terms in the texts, by text and then term."""
    number = terms.find(words)
    at = np.flatnonzero(number >= 0)
    width = max(1, terms.size.size)
    key, count = np.unique(words.text[at] * width + number[at], return_counts=True)
    return key // width, key % width, count.astype(np.int64)


def _lists(text: np.ndarray, values: np.ndarray, texts: int, kind: pa.DataType) -> pa.ListArray:
    offsets = np.searchsorted(text, np.arange(texts + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


class Index:
    """Postings of a block by term, with the weights of its terms; ``score`` adds them up by document."""

    def __init__(self, term: np.ndarray, item: np.ndarray, times: np.ndarray, weight: np.ndarray, items: int) -> None:
        order = np.argsort(term, kind="stable")
        self.item, self.value = item[order], (times * weight[term])[order]
        self.held = np.bincount(term, minlength=weight.size)
        self.start = np.cumsum(self.held) - self.held
        self.items = items

    def score(self, text: np.ndarray, term: np.ndarray, gain: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Scores of some texts at a time: their numbers and a row of item scores for each."""
        own, text_at = np.unique(text, return_inverse=True)
        first = np.append(np.searchsorted(text, own), text.size)
        work = np.concatenate([[0], np.cumsum(self.held[term])])
        most = max(1, CELLS // max(1, self.items))
        begin = 0
        while begin < own.size:
            end = int(np.searchsorted(work[first], work[first[begin]] + CELLS, "right")) - 1
            end = min(own.size, begin + most, max(begin + 1, end))
            part = slice(int(first[begin]), int(first[end]))
            group, _ = runs(self.held[term[part]])
            item = gather(self.item, self.start[term[part]], self.held[term[part]])
            value = gather(self.value, self.start[term[part]], self.held[term[part]])
            scores = np.zeros((end - begin) * self.items, np.int64)
            np.add.at(scores, (text_at[part][group] - begin) * self.items + item, value * gain[part][group])
            yield own[begin:end], scores.reshape(end - begin, self.items)
            begin = end


def gains(count: np.ndarray, size: np.ndarray, docs: int, words: int) -> np.ndarray:
    """What a term adds to the score of a document by its count there, before its weight."""
    m = PERCENT - SLOPE + (SLOPE * size * docs) // max(1, words)
    return (SCALE * count) // (1000 * count + HALF * m)


def weights(held: np.ndarray, docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item`` (its id), ``row``, ``part``, ``cut``, ``term``, ``times``: terms of all items, one row each."""
    lowered = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    words = F.expr(r"regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+', 0)")
    numbered = stored(
        items.select(F.col(item_col).alias("item"), lowered.alias("text")).withColumn("row", F.monotonically_increasing_id()),
        "search-items",
    )
    terms = numbered.select("item", "row", F.explode(words).alias("term")).groupBy("item", "row", "term")
    terms = stored(terms.agg(F.count("*").alias("times")), "search-terms")
    sizes = terms.groupBy("row").agg(F.count("*").alias("distinct_terms"))
    part = F.expr(f"pmod(xxhash64(term), cast(ceil(distinct_terms / {LONG}) AS bigint))")
    return terms.join(sizes, "row").select("item", "row", part.alias("part"), (F.col("distinct_terms") > LONG).alias("cut"), "term", "times")


def _blocks(postings: DataFrame, bound: int) -> tuple[DataFrame, list[tuple[bool, int]]]:
    """Postings with their ``block`` and the blocks there are, none of more than ``bound`` postings."""
    total = postings.count()
    blocks = max(1, -(-2 * total // bound)) if total > bound else 1
    while True:
        placed = postings.withColumn("block", F.pmod(F.xxhash64("row", "part"), F.lit(blocks)).cast("int"))
        sizes = placed.groupBy("cut", "block").count().collect()  # one row a block
        if all(s["count"] <= bound for s in sizes):
            return placed, sorted((s["cut"], s["block"]) for s in sizes)
        blocks *= 2


def _read_counts(rows: DataFrame, sent, name: str) -> DataFrame:  # noqa: ANN001
    """``row``, ``id``, ``size`` (all terms), ``terms`` and ``counts`` (those of the block) of every document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        separator, terms = byte_table("symbol"), Terms(sent.value)
        for batch in batches:
            for texts in slices(batch.column(2)):
                words = Words(texts, separator)
                text, term, tf = term_counts(words, terms)
                part = batch.slice(texts.first, len(texts))
                columns = [part.column(0), part.column(1), pa.array(words.count.astype(np.int64))]
                columns += [_lists(text, term, len(texts), pa.int32()), _lists(text, tf, len(texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "size", "terms", "counts"])

    return stored(rows.mapInArrow(count, "row bigint, id bigint, size bigint, terms array<int>, counts array<bigint>"), name)


def _statistics(counted: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and the documents that hold each term of the block."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, words = np.zeros(terms, np.int64), 0, 0
        for batch in batches:
            size = batch.column(0).to_numpy()
            docs, words = docs + int((size > 0).sum()), words + int(size.sum())
            held += np.bincount(batch.column(1).flatten().to_numpy(), minlength=terms)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"term": [-1, -2, *some.tolist()], "n": [docs, words, *held[some].tolist()]})

    sums = counted.select("size", "terms").mapInArrow(add, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = dict(zip(*(c.to_pylist() for c in sums.toArrow().columns), strict=True))  # two rows and one a term of the block
    return found.get(-1, 0), found.get(-2, 0), np.array([found.get(i, 0) for i in range(terms)], np.int64)


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The best ``k`` of each group, numbered from 1; a null id comes after the others of its score."""
    best = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    postings: int = POSTINGS,
) -> DataFrame:
    """The ``k`` best documents of each item by weighted terms: item id, ``rank``, document id, ``score``.

    Terms are runs of letters, digits and other non-ASCII characters, A-Z lower-cased. A
    null or empty text has none: such a document is in no result and such an item has no
    rows, like one that shares no term with a document. Equal scores go by ascending id,
    a null id last. Repeated rows are documents, or items, of their own; each has its
    ranks. Empty tables give no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    item_type = items.schema[item_col].dataType.simpleString()
    placed, blocks = _blocks(_item_terms(items, item_col, text_col), postings)
    placed = stored(placed, "search-postings")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    schema = "item int, id bigint, row bigint, score bigint"
    results: list[DataFrame] = []
    for cut, block in blocks:
        # At most ``postings`` rows.
        own = placed.where((F.col("cut") == cut) & (F.col("block") == block)).select("row", "part", "term", "times", "item").toArrow()
        terms = sorted(set(own.column("term").to_pylist()))
        number = {t: i for i, t in enumerate(terms)}
        keys = list(zip(own.column("row").to_pylist(), own.column("part").to_pylist(), strict=True))
        names = dict(zip(keys, own.column("item").to_pylist(), strict=True))
        item_of = {key: i for i, key in enumerate(sorted(names))}
        term = np.array([number[t] for t in own.column("term").to_pylist()], np.int64)
        item = np.array([item_of[key] for key in keys], np.int64)
        counted = _read_counts(rows, spark.sparkContext.broadcast(terms), "search-counts")
        n_docs, n_words, held = _statistics(counted, len(terms))
        index = Index(term, item, own.column("times").to_numpy(), weights(held, n_docs), len(item_of))
        sent = spark.sparkContext.broadcast(index)

        def scored(batches: Iterator[pa.RecordBatch], sent=sent, n_docs=n_docs, n_words=n_words, whole=not cut) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            index = sent.value
            heaps: list[list[tuple]] = [[] for _ in range(index.items)]
            bound = np.ones(index.items, np.int64)  # a score of 0 is no hit
            for batch in batches:
                of = batch.column(3).offsets.to_numpy()
                text = np.repeat(np.arange(batch.num_rows), np.diff(of))
                term, tf = (batch.column(c).flatten().to_numpy() for c in (3, 4))
                gain = gains(tf, batch.column(2).to_numpy()[text], n_docs, n_words)
                row, ids = batch.column(0).to_numpy(), batch.column(1).to_pylist()
                for own, scores in index.score(text, term.astype(np.int64), gain):
                    at, item = np.nonzero(scores >= bound)
                    value = scores[at, item]
                    if not whole:
                        doc = own[at]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(item, pa.int32()), batch.column(1).take(pa.array(doc)), pa.array(row[doc]), pa.array(value)],
                            names=["item", "id", "row", "score"],
                        )
                        continue
                    for d, i, s in zip(own[at].tolist(), item.tolist(), value.tolist(), strict=True):
                        doc = ids[d]
                        entry = (s, doc is not None, -(doc or 0), -int(row[d]))
                        if len(heaps[i]) < k:
                            heapq.heappush(heaps[i], entry)
                        else:
                            heapq.heappushpop(heaps[i], entry)
                        if len(heaps[i]) == k:
                            bound[i] = heaps[i][0][0]
            kept = [(i, -doc if known else None, -row, s) for i, heap in enumerate(heaps) for s, known, doc, row in heap]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*kept, strict=True) if kept else [[]] * 4, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["item", "id", "row", "score"],
            )

        found = counted.mapInArrow(scored, schema)
        of_item = spark.createDataFrame(
            [(i, key[0], names[key]) for key, i in item_of.items()], f"item int, item_row bigint, {_quoted(item_col)} {item_type}"
        )
        results.append(_with_names(found, of_item, cut, k, item_col))
    if not results:
        return spark.createDataFrame([], f"{_quoted(item_col)} {item_type}, rank int, {_quoted(id_col)} bigint, score bigint")
    whole = [r for (cut, _), r in zip(blocks, results, strict=True) if not cut]
    parts = [r for (cut, _), r in zip(blocks, results, strict=True) if cut]
    best: list[DataFrame] = whole
    if parts:
        summed = _union(parts).groupBy("item_row", item_col, "row", "id").agg(F.sum("score").alias("score"))
        best = [*whole, _ranked(summed, ["item_row"], k)]
    return _union([b.select(item_col, "rank", F.col("id").alias(id_col), "score") for b in best])


def _quoted(name: str) -> str:
    return f"`{name}`"


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _with_names(found: DataFrame, of_item: DataFrame, cut: bool, k: int, item_col: str) -> DataFrame:
    """Merged heaps, first by some tasks each and then all (or all scores of parts), with the ids of their items."""
    if not cut:
        some = found.withColumn("some", F.spark_partition_id() % 64)
        found = _ranked(_ranked(some, ["item", "some"], k).drop("some", "rank"), ["item"], k)
    return found.join(F.broadcast(of_item), "item").drop("item")  # at most a row a posting of the block


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_TERM}')) AS t FROM documents
), tf AS (SELECT r, doc_id, t, count(*) AS tf FROM d GROUP BY r, doc_id, t),
n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
i AS (
  SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_TERM}')) AS t FROM benchmark
), it AS (SELECT q, item_id, t, count(*) AS times FROM i GROUP BY q, item_id, t),
w AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t) AS x, c
), s AS (
  SELECT q, item_id, tf.r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)))) AS BIGINT) AS score
  FROM it JOIN tf ON tf.t = it.t JOIN n ON n.r = tf.r JOIN w ON w.t = it.t, c GROUP BY q, item_id, tf.r, doc_id
)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
WINDOW best AS (PARTITION BY q ORDER BY score DESC, doc_id, r) QUALIFY row_number() OVER best <= {K}
"""
