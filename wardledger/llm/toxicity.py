"""Toxicity by the votes of the nearest labelled examples.

Examples and texts are TF-IDF vectors over all words (runs of letters) of all examples:
``(1 + log tf) * idf``, times how far a word tells the labels of the examples apart
(``FLOOR`` plus its phi coefficient squared, with Yates' correction), so that a few telling
words are not drowned by the many rare ones, which stay in the vectors. Document
frequencies are counted over all documents.

The nearest examples by exact cosine come from an inverted index whose postings are cut
into blocks of ``BLOCK`` examples; the ``COMMON`` words of most examples are a table of rows instead,
multiplied by some texts at a time. Of a text's other words the heaviest are looked up; for
the rest of them the sum of the blocks' greatest weights bounds what an example can still
gain, and only examples whose bound reaches the k-th best cosine are compared in full.
All examples that tie with the k-th vote.

Examples are labelled rows, those that come first by hash: at most ``SAMPLE`` of them and
at most ``SAMPLE_CHARS`` characters, without texts of more than a ``LONG``-th of that. This
bounds what is collected and sent to the tasks. Every text is scored in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import HashIndex
from .language_id import _parts, held_out, letter_words
from .shared import stored

SAMPLE, SAMPLE_CHARS, LONG = 8000, 40_000_000, 200
NEIGHBOURS, BLOCK = 15, 64
FLOOR = 1e-4  # weight of a word that tells nothing of the label
NEAREST = 1e-6  # added to a distance: an equal text outvotes all others, but has a finite vote
HEAVY = 0.97  # share of a text's greatest possible cosine that is looked up before any bound
COMMON = 512  # so many words of most examples have a row each
AT_ONCE = 64  # texts multiplied by the rows together


def bags(texts: list[str | None], vocabulary: HashIndex | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each text begins (and the end), its distinct words in order, and the occurrences of each.

    Words are hashes, or numbers of ``vocabulary``, of which other words are left out.
    """
    words = letter_words(texts)
    text, word = words.text, words.hash
    if vocabulary is not None:
        number = vocabulary.find(word)
        text, word = text[number >= 0], number[number >= 0]
    order = np.lexsort((word, text))
    text, word = text[order], word[order]
    new = np.ones(word.size, bool)
    new[1:] = (word[1:] != word[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return np.searchsorted(text[at], np.arange(len(texts) + 1)), word[at], np.diff(at, append=word.size)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each example and how often it has them."""
    for batch in batches:
        for first, part in _parts(batch.column(2)):
            begin, word, n = bags(part)
            lists = [
                pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(v))
                for v in (word.view(np.int64), n.astype(np.int32))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(part)), batch.column(1).slice(first, len(part)), *lists],
                names=["id", "label", "word", "n"],
            )


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions of all ranges, one after the other."""
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(int(count.sum()))


def _unit(begin: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of consecutive vectors, each brought to length 1."""
    row = np.repeat(np.arange(begin.size - 1), np.diff(begin))
    return weight / np.maximum(np.sqrt(np.bincount(row, weight**2, begin.size - 1)), 1e-300)[row]


class BlockMaxIndex:
    """Examples by word in blocks, with the greatest weight of each word in each block.

    Example ``i`` has the weights ``weight[first[i] : first[i + 1]]`` of the words ``word``.
    """

    def __init__(self, first: np.ndarray, word: np.ndarray, weight: np.ndarray, words: int) -> None:
        self.first, self.word, self.weight = first, word, weight
        self.examples = first.size - 1
        self.block = np.arange(self.examples) // BLOCK
        order = np.argsort(word, kind="stable")
        self.example = np.repeat(np.arange(self.examples, dtype=np.int32), np.diff(first))[order]
        self.posted = weight[order]
        self.list = np.searchsorted(word[order], np.arange(words + 1))
        blocks = max(1, -(-self.examples // BLOCK))
        place = word[order].astype(np.int64) * blocks + self.example // BLOCK
        new = np.flatnonzero(np.diff(place, prepend=-1))
        self.part = np.searchsorted(place[new], np.arange(words + 1) * blocks)
        self.part_block = place[new] % blocks
        self.part_most = np.maximum.reduceat(self.posted, new) if new.size else np.zeros(0)
        self.most = np.zeros(words)
        np.maximum.at(self.most, word, weight)
        self.blocks = blocks
        self.query = np.zeros(words)
        often = np.argsort(-np.diff(self.list), kind="stable")[:COMMON]
        self.row = np.full(words, -1, np.int32)
        self.row[often] = np.arange(often.size)
        self.rows = np.zeros((often.size, self.examples), np.float32)
        of = self.row[word[order]]
        self.rows[of[of >= 0], self.example[of >= 0]] = self.posted[of >= 0]

    def _cosines(self, examples: np.ndarray) -> np.ndarray:
        start, count = self.first[examples], self.first[examples + 1] - self.first[examples]
        at = _ranges(start, count)
        product = self.weight[at] * self.query[self.word[at]]
        return np.bincount(np.repeat(np.arange(examples.size), count), product, examples.size)

    def common(self, first: np.ndarray, word: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What the common words add to the cosines of consecutive texts, nearly (32 bits)."""
        text, row = np.repeat(np.arange(first.size - 1), np.diff(first)), self.row[word]
        table = np.zeros((first.size - 1, len(self.rows)), np.float32)
        table[text[row >= 0], row[row >= 0]] = weight[row >= 0]
        return table @ self.rows

    def nearest(self, words: np.ndarray, weights: np.ndarray, k: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best examples with all that tie with the last, and their cosines (above 0), best first.

        ``common``: the text's row of what the method of that name returns.
        """
        k = min(k, self.examples)
        self.query[words] = weights
        every, rare = words, self.row[words] < 0
        words, weights = words[rare], weights[rare]
        gain = weights * self.most[words]
        order = np.argsort(-gain, kind="stable")
        cut = int(np.searchsorted(np.cumsum(gain[order]), HEAVY * gain.sum())) + 1
        heavy, light = order[:cut], order[cut:]
        start, count = self.list[words[heavy]], self.list[words[heavy] + 1] - self.list[words[heavy]]
        at = _ranges(start, count)
        bound = common + np.bincount(self.example[at], self.posted[at] * np.repeat(weights[heavy], count), self.examples)
        start, count = self.part[words[light]], self.part[words[light] + 1] - self.part[words[light]]
        at = _ranges(start, count)
        most = np.bincount(self.part_block[at], self.part_most[at] * np.repeat(weights[light], count), self.blocks)
        bound = bound + most[self.block]
        first = np.argpartition(-bound, k - 1)[:k]
        cosine = self._cosines(first)
        also = (bound >= cosine.min() - 1e-5) & (bound > 0)
        also[first] = False
        more = np.flatnonzero(also)
        near = np.concatenate([first, more])
        cosine = np.round(np.concatenate([cosine, self._cosines(more)]), 9)  # equal vectors tie whatever the order of sums
        self.query[every] = 0
        if near.size > k:
            keep = cosine >= np.partition(cosine, near.size - k)[near.size - k]
            near, cosine = near[keep], cosine[keep]
        near, cosine = near[cosine > 0], cosine[cosine > 0]
        order = np.lexsort((near, -cosine))
        return near[order], cosine[order]


class Model:
    """What ``fit`` returns: plain arrays (``state``) and the index made of them.

    ``value``: weight of one occurrence of each word; ``n``: occurrences of ``word`` in the examples.
    """

    def __init__(
        self, keys: np.ndarray, value: np.ndarray, first: np.ndarray, word: np.ndarray, n: np.ndarray,
        labels: np.ndarray, ids: np.ndarray,
    ) -> None:
        self.state = (keys, value, first, word, n, labels, ids)
        self.value, self.labels, self.ids = value, labels, ids
        self.vocabulary = HashIndex()
        self.vocabulary.add(keys)
        self.index = BlockMaxIndex(first, word, self._vectors(first, word, n), keys.size)
        self.rate = float(labels.mean()) if labels.size else 0.0

    def _vectors(self, first: np.ndarray, word: np.ndarray, n: np.ndarray) -> np.ndarray:
        return _unit(first, (1 + np.log(n)) * self.value[word])

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[int]]]:
        """Votes weighted by 1 / distance (0 to 1) and the ids of the nearest three that agree."""
        out, evidence = np.full(len(texts), self.rate), [[] for _ in texts]
        if not self.labels.size:
            return out, evidence
        begin, word, n = bags(texts, self.vocabulary)
        weight = self._vectors(begin, word, n)
        common = np.zeros((0, 0), np.float32)
        for i in range(len(texts)):
            if i % AT_ONCE == 0:
                some = begin[i : i + AT_ONCE + 1]
                common = self.index.common(some, word[some[0] : some[-1]], weight[some[0] : some[-1]])
            own = slice(begin[i], begin[i + 1])
            near, cosine = self.index.nearest(word[own], weight[own], NEIGHBOURS, common[i % AT_ONCE])
            if near.size:
                vote = 1 / (1 + NEAREST - np.minimum(cosine, 1))
                out[i] = (vote * self.labels[near]).sum() / vote.sum()
                evidence[i] = self.ids[near[self.labels[near] == (out[i] >= 0.5)][:3]].tolist()
        return out, evidence


def _frequencies(docs: DataFrame, text_col: str, keys: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of all documents, and of those that hold each of ``keys``."""
    sent = docs.sparkSession.sparkContext.broadcast(keys)  # bounded by the sample

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = HashIndex()
        vocabulary.add(sent.value)
        found = np.zeros(sent.value.size + 1, np.int64)
        for batch in batches:
            for _, part in _parts(batch.column(0)):
                found[:-1] += np.bincount(bags(part, vocabulary)[1], minlength=found.size - 1)
                found[-1] += len(part)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(found[some])], names=["word", "n"])

    counts = (
        docs.select(F.col(text_col).alias("text"))
        .mapInArrow(count, "word int, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    out = np.zeros(keys.size + 1, np.int64)
    out[counts.column("word").to_numpy()] = counts.column("n").to_numpy()
    return int(out[-1]), out[:-1]


def association(toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int) -> np.ndarray:
    """Phi squared, with Yates' correction, of a word (in so many examples of each label) and the label."""
    toxic, clean = toxic.astype(float), clean.astype(float)
    both, every = toxic + clean, all_toxic + all_clean
    apart = np.maximum(0, np.abs(toxic * (all_clean - clean) - clean * (all_toxic - toxic)) - every / 2)
    spread = both * (every - both) * float(all_toxic) * float(all_clean)
    return np.where(spread > 0, apart**2 / np.where(spread > 0, spread, 1), 0.0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
    sample_chars: int = SAMPLE_CHARS,
) -> Model:
    """Model of labelled rows that are not held out (crc32 of the id modulo 5 is 0)."""
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col, 5, 0))
        .groupBy(F.col(id_col).cast("bigint").alias("id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
        .select("id", "label", F.xxhash64("id").alias("turn"))
        .orderBy("turn", "id")
        .limit(sample)
    )
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    rows = rows.where(F.length("text") <= sample_chars // LONG)
    rows = rows.join(F.broadcast(chosen), "id").groupBy("id", "label", "turn").agg(F.max("text").alias("text"))
    rows = stored(rows, "toxicity-sample")
    sizes = rows.select("turn", F.length("text").alias("chars")).toArrow()  # at most `sample` rows
    turn = np.sort(sizes.column("turn").to_numpy())
    chars = sizes.column("chars").to_numpy()[np.argsort(sizes.column("turn").to_numpy(), kind="stable")]
    fits = turn[np.cumsum(chars) <= sample_chars]
    found = (
        rows.where(F.col("turn") <= (int(fits[-1]) if fits.size else -(1 << 63)))
        .select("id", "label", "text")
        .mapInArrow(_bags, "id bigint, label int, word array<bigint>, n array<int>")
        .toArrow()  # bounded by `sample_chars`
        .sort_by("id")
        .combine_chunks()
    )
    ids, label = (found.column(c).to_numpy().astype(np.int64) for c in ("id", "label"))
    size = found.column("word").combine_chunks().value_lengths().to_numpy().astype(np.int64)
    word, n = (found.column(c).combine_chunks().flatten().to_numpy() for c in ("word", "n"))
    keys, word = np.unique(word.view(np.uint64), return_inverse=True)
    word, n = word.astype(np.int32), n.astype(np.int32)
    first = np.concatenate([[0], np.cumsum(size)])
    toxic = label == 1
    of_toxic = np.repeat(toxic, size)
    with_word = np.bincount(word, minlength=keys.size)
    with_toxic = np.bincount(word[of_toxic], minlength=keys.size)
    told = association(with_toxic, with_word - with_toxic, int(toxic.sum()), int((~toxic).sum()))
    documents, frequency = _frequencies(docs, text_col, keys)
    value = np.log((documents + 1) / (frequency + 0.5)) * (FLOOR + told)
    return Model(keys, value, first, word, n, toxic.astype(np.int64), ids)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """Id, ``held_out``, ``score``, ``predicted``, ``evidence`` (ids of near examples) of every row.

    A text without words, null ones too, has the rate of label 1 among the examples as
    its score; without examples all scores are 0. Labels that are null or without a
    document are skipped, of repeated ones the greater counts, as does the greatest of
    several texts of one id. Rows are judged one by
    one; other columns are not looked at; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col).state)
    id_type = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for batch in batches:
            for first, part in _parts(batch.column(1)):
                value, evidence = model.score(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), pa.array(value), pa.array(evidence, pa.list_(pa.int64()))],
                    names=["id", "score", "evidence"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(score, f"id {id_type}, score double, evidence array<bigint>")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select(F.col("id").alias(id_col), held_out("id", 5, 0).alias("held_out"), "score", predicted, "evidence")
