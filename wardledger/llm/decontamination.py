"""Benchmark decontamination by winnowing.

The hashes of all ``GRAM`` neighbouring words are taken; of every sliding window of
``WINDOW - GRAM + 1`` such hashes the least is a fingerprint. A document that holds
``WINDOW`` consecutive words of an item holds the same hashes there, so it has the
same least one: every shared span of ``WINDOW`` words or more meets in the join of
fingerprints. A hit is then extended to all windows of words around it, which are
joined with the windows of the items as text, so hashes decide nothing.

Documents drop fingerprints that a fixed-size bitmap of the benchmark rules out, so
what is shuffled is about the size of the overlap, not of the corpus, and the
benchmark may be of any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .exact_dedup import LOWER, UPPER
from .kernels import U64, Words, byte_table, grams, mix64, slices, sliding
from .shared import bit_filter, in_filter, stored

WINDOW, GRAM = 10, 4


def _short_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of whole short items: another family than that of the fingerprints."""
    h, same = grams(words, n)
    return mix64(h ^ U64(0xA5A5A5A5A5A5A5A5)), same


def _text_of(words: Words, first: int, last: int) -> list[str]:
    data = words.data
    return [data[words.start[i] : words.end[i]].tobytes().decode("utf-8", "replace") for i in range(first, last)]


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of the items: ``id``, ``len``, ``words`` (joined), ``fp``."""
    separator = byte_table("symbol")
    for batch in batches:
        for texts in slices(batch.column(1)):
            words = Words(texts, separator)
            long_h, _ = grams(words, GRAM)
            least = sliding(long_h, WINDOW - GRAM + 1, np.minimum) if long_h.size > WINDOW - GRAM else long_h
            who, size, text, fp = [], [], [], []
            for i in range(len(texts)):
                first, n = int(words.of[i]), int(words.count[i])
                if n == 0:
                    continue
                m = min(n, WINDOW)
                all_words = _text_of(words, first, first + n)
                short = None if m == WINDOW else _short_hashes(words, m)[0]
                for at in range(n - m + 1):
                    who.append(texts.first + i)
                    size.append(m)
                    text.append(" ".join(all_words[at : at + m]))
                    fp.append((least if short is None else short)[first + at])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(who, pa.int64())),
                    pa.array(size, pa.int32()),
                    pa.array(text, pa.string()),
                    pa.array(np.array(fp, U64).view(np.int64)),
                ],
                names=["id", "len", "words", "fp"],
            )


_HIT = pa.struct([("fp", pa.int64()), ("begin", pa.int64()), ("len", pa.int32()), ("words", pa.list_(pa.string()))])


def _hits(texts_words: Words, bits: np.ndarray, short: list[int]) -> list[tuple[int, int, int, int, int]]:
    """``(text, fp, first word, one past the last word, window length)``, words by number in the slice."""
    w = texts_words
    out: list[tuple[int, int, int, int, int]] = []
    h, same = grams(w, GRAM)
    span = WINDOW - GRAM + 1
    if h.size >= span:
        guarded = np.where(same, h, U64(0xFFFFFFFFFFFFFFFF))
        least = sliding(guarded, span, np.minimum)
        # A window that leaves its text selects nothing.
        inside = w.text[: least.size] == w.text[WINDOW - 1 : WINDOW - 1 + least.size]
        least = np.where(inside, least, U64(0))
        padded = np.concatenate([np.zeros(span - 1, U64), least, np.zeros(span - 1, U64)])
        chosen = np.flatnonzero(same & (sliding(padded, span, np.maximum) == guarded))
        for p in chosen[in_filter(bits, h[chosen])].tolist():
            t = int(w.text[p])
            out.append((t, int(h[p].view(np.int64)), max(int(w.of[t]), p - (WINDOW - GRAM)), min(int(w.of[t + 1]), p + WINDOW), WINDOW))
    for n in short:
        h, same = _short_hashes(w, n)
        for p in np.flatnonzero(same & in_filter(bits, h) if h.size else same).tolist():
            out.append((int(w.text[p]), int(h[p].view(np.int64)), p, p + n, n))
    return out


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    Words are runs of letters, digits and other non-ASCII characters, A-Z lower-cased.
    A window is ``WINDOW`` consecutive words of an item; an item of fewer words is one
    window, one without words or with null text none. ``n_hit`` counts the words inside
    any occurrence of a window, ``n_items`` the items with one, ``items_sha256`` is over
    their ids. A null or empty text has no words and is clean. Repeated ids are judged
    row by row; repeated items count once. Items with a null id hit but are not
    counted. Empty tables give no rows, or clean ones. Other columns are not looked at.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = items.schema[item_col].dataType.simpleString()
    own = items.select(F.col(item_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    windows = stored(
        own.mapInArrow(_item_windows, f"id {item_type}, len int, words string, fp bigint"), "decontamination-items"
    )
    prints = windows.select("fp").distinct()
    bits = bit_filter(prints, "fp")
    short = sorted(r["len"] for r in windows.where(F.col("len") < WINDOW).select("len").distinct().collect())
    sent = spark.sparkContext.broadcast(bits)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        separator = byte_table("symbol")
        for batch in batches:
            for texts in slices(batch.column(2)):
                words = Words(texts, separator)
                hits: list[list[dict]] = [[] for _ in range(len(texts))]
                for t, fp, first, last, n in _hits(words, sent.value, short):
                    begin = first - int(words.of[t])
                    hits[t].append({"fp": fp, "begin": begin, "len": n, "words": _text_of(words, first, last)})
                part = batch.slice(texts.first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(words.count.astype(np.int64)), pa.array(hits, pa.list_(_HIT))],
                    names=["row", "id", "n_words", "hits"],
                )

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    scanned = stored(
        numbered.mapInArrow(
            scan,
            f"row bigint, id {id_type}, n_words bigint, hits array<struct<fp:bigint,begin:bigint,len:int,words:array<string>>>",
        ),
        "decontamination-hits",
    )
    hits = scanned.select("row", F.inline("hits")).join(prints, "fp", "left_semi")
    around = """transform(sequence(0, size(words) - len),
                          i -> struct(begin + i AS begin, array_join(slice(words, i + 1, len), ' ') AS words))"""
    extended = (
        hits.where("size(words) >= len")
        .select("row", "len", F.expr(f"inline({around})"))
        .distinct()
    )
    by_words = windows.groupBy("words").agg(F.collect_set("id").alias("items"))
    found = stored(extended.join(by_words, "words").select("row", "begin", "len", "items"), "decontamination-found")

    earlier = Window.partitionBy("row").orderBy("begin", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("begin") + F.col("len")
    fresh = end - F.greatest("begin", F.least(end, F.coalesce(F.max(end).over(earlier), F.lit(0))))
    covered = found.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    named = found.select("row", F.explode(F.col("items").cast("array<string>")).alias("item")).distinct()
    named = named.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    judged = scanned.select("row", "id", "n_words").join(covered.join(named, "row", "left"), "row", "left")
    items_text = F.coalesce(F.array_join("items", ","), F.lit(""))
    return judged.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(items_text, 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ORACLE_SQL = rf"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_WORD}') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS i FROM b WHERE len(w) > 0) AS x
), d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_WORD}'), []) AS w FROM documents
), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n, -1) + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) AS l) AS x
), hit AS (SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON bw.win = dw.win AND bw.n = dw.n),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit) AS x),
c AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) AS x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
