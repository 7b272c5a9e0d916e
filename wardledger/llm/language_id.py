"""Language ID with word-first backoff.

A known word is scored by its log frequency in each language. An unseen word is
scored by its character n-grams of the greatest order of which any is known: 4,
then 3, 2, 1 characters, word ends included. Each word is one vote (the log of
its posterior over the languages), whichever level scores it.

The model is fitted on a bounded sample of the labelled rows: of each language the
rows that come first by hash, as many as fit in ``SAMPLE_DOCS`` and ``SAMPLE_CHARS``;
texts of more than a ``LONG``-th of these characters come after all others, so that one
of them does not end the sample.
That bounds what is collected and sent to the tasks; scoring reads every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import SLICE_BYTES, U64, HashIndex, Texts, Words, mix64, runs

ORDERS = (4, 3, 2, 1)
SAMPLE_DOCS, SAMPLE_CHARS, LONG = 4000, 2_000_000, 20
SMOOTHING = 0.1
UNKNOWN = "und"
_LETTERS: list[np.ndarray] = []


def held_out(id_col: str, modulus: int = 4, remainder: int = 2) -> Column:
    """Rows that no model learns from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def _not_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(~np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def letter_words(texts: list[str | None]) -> Words:
    """Runs of letters of lower-cased texts; data are code points."""
    lowered = [(t or "").lower() for t in texts]
    data = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in lowered], dtype=np.int64)])
    return Words(Texts(data, offsets.astype(np.int64), 0), _not_letter(), lower=False)


def _parts(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """First row and texts of slices of about ``SLICE_BYTES`` characters."""
    part: list[str | None] = []
    first = size = 0
    for i in range(len(column)):
        text = column[i].as_py()
        part.append(text)
        size += len(text or "")
        if size >= SLICE_BYTES // 2:
            yield first, part
            part, first, size = [], i + 1, 0
    if part:
        yield first, part


def char_grams(words: Words, which: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of the words numbered ``which``, and the place of each in ``which``."""
    length = words.end[which] - words.start[which]
    of, at = runs(length + 2)
    inside = (at > 0) & (at <= length[of])
    padded = np.ones(of.size, np.uint64)  # 1: a word's edge
    padded[inside] = words.data[words.start[which][of[inside]] + at[inside] - 1]
    n = of.size - order + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    h = np.full(n, order, U64)
    for i in range(order):
        h = h * U64(0x100000001B3) + padded[i : n + i]
    whole = of[:n] == of[order - 1 :]
    if order == 1:
        whole &= inside[:n]
    return mix64(h[whole]), of[:n][whole]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (``kind`` 0) and n-grams (``kind`` their order) by language number."""
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False)
        for first, part in _parts(batch.column(1)):
            words = letter_words(part)
            if not words.hash.size:
                continue
            of_lang = label[first + words.text]
            every = np.arange(words.hash.size)
            found = [(0, words.hash, of_lang)]
            found += [(n, h, of_lang[w]) for n in ORDERS for h, w in [char_grams(words, every, n)]]
            for kind, h, lang in found:
                for one in np.unique(lang):
                    keys, n = np.unique(h[lang == one], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(keys.size, kind, np.int32)),
                            pa.array(keys.view(np.int64)),
                            pa.array(np.full(keys.size, one, np.int32)),
                            pa.array(n.astype(np.int64)),
                        ],
                        names=["kind", "key", "lang", "n"],
                    )


@dataclass
class Model:
    """Languages, and for each kind the known keys with their log posterior of each language."""

    languages: list[str]
    tables: dict[int, tuple[np.ndarray, np.ndarray]]

    def __post_init__(self) -> None:
        self.known = {}
        for kind, (keys, table) in self.tables.items():
            index = HashIndex()
            index.add(keys)
            self.known[kind] = (index, table)

    def votes(self, words: Words) -> np.ndarray:
        """Log posterior of each language by each word."""
        out = np.zeros((words.hash.size, len(self.languages)), np.float32)
        index, table = self.known[0]
        number = index.find(words.hash)
        out[number >= 0] = table[number[number >= 0]]
        unseen = np.flatnonzero(number < 0)
        for order in ORDERS:
            if not unseen.size:
                break
            _, one, back = np.unique(words.hash[unseen], return_index=True, return_inverse=True)
            index, table = self.known[order]
            h, place = char_grams(words, unseen[one], order)
            number = index.find(h)
            hit = number >= 0
            total = np.stack(
                [np.bincount(place[hit], table[number[hit], k], one.size) for k in range(len(self.languages))], axis=1
            )
            count = np.bincount(place[hit], minlength=one.size)
            scored = count > 0
            mean = total / np.maximum(count, 1)[:, None]
            out[unseen[scored[back]]] = mean[back[scored[back]]]
            unseen = unseen[~scored[back]]
        return out

    def predict(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Language and its posterior for each text; ``und`` and 0 without letters or model."""
        words = letter_words(texts)
        if not self.languages or not words.hash.size:
            return np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        sums = np.concatenate([np.zeros((1, len(self.languages))), np.cumsum(self.votes(words), axis=0, dtype=np.float64)])
        total = sums[words.of[1:]] - sums[words.of[:-1]]
        best = np.argmax(total, axis=1)  # ties: the first language by code point
        share = 1 / np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -700)).sum(axis=1)
        some = words.count > 0
        name = np.array(self.languages, object)[best]
        return np.where(some, name, UNKNOWN), np.where(some, share, 0.0)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> Model:
    """Model of the labelled rows that are not held out."""
    share = (F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string")), 11) + 1) / F.lit(2.0**53)
    late = F.when(F.length(text_col) > sample_chars // LONG, 1000).otherwise(0)  # beyond the 424 steps of all others
    train = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col)).select(
        F.col(label_col).alias("lang"), F.col(text_col).alias("text"), (F.floor(-8 * F.log2(share)) - late).cast("int").alias("step")
    )
    # Each step holds about a twelfth less of all hashes than the one before, so at any
    # size of the input some step cuts the sample near its bounds. A few rows a language.
    steps = train.groupBy("lang", "step").agg(F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars"))
    cut: dict[str, list[int]] = {}
    for r in sorted(steps.collect(), key=lambda r: (r["lang"], -r["step"])):
        taken = cut.setdefault(r["lang"], [r["step"], 0, 0, 1])
        taken[1:3] = taken[1] + r["docs"], taken[2] + r["chars"]
        if taken[3] and taken[1] <= sample_docs and taken[2] <= sample_chars:
            taken[0] = r["step"]
        else:
            taken[3] = 0
    languages = sorted(cut)
    least = docs.sparkSession.createDataFrame([(x, cut[x][0]) for x in languages], "lang string, least int")
    sample = train.join(F.broadcast(least), "lang").where("step >= least")  # one row a language
    number = F.array_position(F.array(*[F.lit(x) for x in languages] or [F.lit("")]), F.col("lang")) - 1
    counts = (
        sample.select(number.cast("int").alias("lang"), "text")
        .mapInArrow(_count, "kind int, key bigint, lang int, n bigint")
        .groupBy("kind", "key", "lang")
        .agg(F.sum("n").alias("n"))
        .toArrow()  # bounded by the sample
    )
    kind, key, lang, n = (counts.column(c).to_numpy() for c in ("kind", "key", "lang", "n"))
    tables = {}
    for k in (0, *ORDERS):
        keys, row = np.unique(key[kind == k], return_inverse=True)
        table = np.zeros((keys.size, len(languages)))
        table[row, lang[kind == k]] = n[kind == k]
        log = np.log(table + SMOOTHING) - np.log(table.sum(axis=0) + SMOOTHING * max(1, keys.size))
        log -= np.log(np.exp(log).sum(axis=1, keepdims=True)) if languages else 0
        tables[k] = (keys.view(np.uint64), log.astype(np.float32))
    return Model(languages, tables)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct), ``lang_pred`` and ``score`` (0 to 1).

    A null text, an empty one or one without letters is ``und`` with score 0. Rows are
    judged one by one, so repeated rows, ids and other columns do not matter, and a
    table without rows gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.tables))  # bounded by the sample
    at = docs.columns.index(text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            rows = batch.column(0)
            for first, part in _parts(rows.field(at)):
                name, share = own.predict(part)
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(first, len(part)), pa.array(name, pa.string()), pa.array(share, pa.float64())],
                    names=["row", "lang_pred", "score"],
                )

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    row_type = packed.schema["row"].dataType.simpleString()
    return packed.mapInArrow(score, f"row {row_type}, lang_pred string, score double")


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """Id, ``held_out``, ``lang_pred``, ``score`` of every row; learns from the rows not held out."""
    model = fit(docs, id_col, text_col, label_col)
    found = identify(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model)
    return found.select(F.col("row.id").alias(id_col), held_out("row.id").alias("held_out"), "lang_pred", "score")
