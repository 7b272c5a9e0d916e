"""Mixing sources to target weights by distributed prefix sums; DataFrame functions only.

Every row gets a hash-random key (hex text). A source's key space is cut into
ranges of equal width, which the uniform keys fill evenly however large the source
is; rows are sorted within their range only. A row's position in its source is the
sum of the earlier ranges (one row per source and range, combined before the
shuffle) plus the running sum within its range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
RANGE_DIGITS = 3  # hex digits of the key that name the range: 4096 ranges a source


def budgets(sizes: DataFrame, weights: Sequence[int], share: float, max_epochs: int) -> DataFrame:
    """``target`` and whole-word ``budget`` of each ``source`` from its ``source_size``.

    All sources together get ``share`` of all words by weight. A source that would
    get more than ``max_epochs`` times its size gets just that; the rest goes to the
    others by weight. Sorted by limit over weight, the limited sources come first,
    so one running sum finds them. One row per source goes through one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    limited = ranked.withColumn("limit", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    ) / F.sum("weight").over(onward)
    free = limited.withColumn("level", level)
    # Every source at or after the first free one has the level of that one.
    first_free = F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("limit_rank", "level")))
    at = free.withColumn("limit_rank", F.row_number().over(order))
    at = at.withColumn("free", first_free.over(everything))
    is_free = F.col("free").isNotNull() & (F.col("limit_rank") >= F.col("free.limit_rank"))
    target = F.when(is_free, F.least(F.col("free.level") * F.col("weight"), F.col("limit").cast("double")))
    return at.select(
        "source",
        "source_size",
        F.coalesce(target, F.col("limit").cast("double")).alias("target"),
    ).withColumn("budget", F.floor(F.col("target") + 0.5).cast("bigint"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    max_epochs: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``source_size``, ``target``, ``taken``, ``source``.

    ``size`` counts words (runs of other than space and 0x09-0x0D; a null text has
    none). ``taken`` is the words the mix takes of the row, repeats counted: whole
    epochs of the source first, then rows by key until the budget, where the row at
    the cut gives only what is missing. So a source's ``taken`` is its target to
    the word and no row gives more than ``max_epochs`` times its size. Sources go
    by code point, null last as a source of its own. Ties of the key (repeated
    ids) go by size; full ties are interchangeable. A source without words has
    target 0. An empty table gives no rows. Other columns are not looked at.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), key.alias("key")
    ).withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    rows = stored(rows, "mix-rows")  # texts are read once; what follows is a few numbers a row

    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = budgets(sizes, weights, share, max_epochs)
    # One row per source and range: at most 4096 rows a source.
    same = F.col("r.source").eqNullSafe(F.col("p.source"))
    offsets = ranges.alias("r").join(plan.alias("p"), same).select("r.source", "range", "before", "source_size", "target", "budget")
    offsets = offsets.withColumnsRenamed({"source": "o_source", "range": "o_range"})

    within = Window.partitionBy("source", "range").orderBy("key", "id", "size")
    placed = rows.withColumn("inside", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    joined = placed.join(
        offsets, (F.col("range") == F.col("o_range")) & F.col("source").eqNullSafe(F.col("o_source"))
    )
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    left = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("before") - F.col("inside")
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return joined.withColumn("epochs", epochs).select(
        F.col("id").alias(id_col), "size", "source_size", "target", taken.cast("bigint").alias("taken"), "source"
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", **options: object) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, columns as they are.

    A row is repeated for every started pass over it: documents stay whole, so a
    source exceeds its budget by less than the one document at its cut. Rows of
    the same id (also null) share the decision of the one that is taken most. Rows
    without words are not taken; an empty table gives no rows.
    """
    if id_col not in docs.columns:
        raise ValueError(f"no column {id_col}")
    times = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    copies = mix(docs, id_col=id_col, **options).groupBy(F.col(id_col).alias("mixed_id")).agg(F.max(times).alias("copies"))
    # A row goes as one column, so its names meet no others.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = rows.join(copies.where("copies > 0"), F.col("row").getField(id_col).eqNullSafe(F.col("mixed_id")))
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rk
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE rk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap,
         sum(source_size) OVER () * 1.5::DOUBLE AS pot FROM s
), tried AS (  -- a level for every set of limited sources; the right one is the least that overflows none of its rest
  SELECT a.source, (any_value(a.pot) - coalesce(sum(b.cap) FILTER (WHERE (b.cap / b.weight, b.rk) < (a.cap / a.weight, a.rk)), 0))
           / sum(b.weight) FILTER (WHERE (b.cap / b.weight, b.rk) >= (a.cap / a.weight, a.rk)) AS lvl,
         any_value(a.cap) AS cap, any_value(a.weight) AS weight, any_value(a.rk) AS rk
  FROM w a CROSS JOIN w b GROUP BY a.source, a.rk
), free AS (
  SELECT lvl, cap / weight AS at, rk AS at_rk FROM tried WHERE lvl * weight <= cap ORDER BY cap / weight, rk LIMIT 1
), t AS (
  SELECT w.source, source_size,
         CASE WHEN f.lvl IS NOT NULL AND (cap / weight, rk) >= (f.at, f.at_rk) THEN least(f.lvl * weight, cap::DOUBLE) ELSE cap::DOUBLE END AS target
  FROM w LEFT JOIN free f ON true
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget, d.source,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN (budget // source_size) * size
              + greatest(0, least(size, budget - (budget // source_size) * source_size - before)) ELSE 0 END AS BIGINT) AS taken,
       source
FROM p
"""
