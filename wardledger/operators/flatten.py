"""Flatten JSON payloads through a view definition.

The payload is parsed once per row. Elements come out of ``posexplode``, also
for a payload that is one object: Spark does not move a predicate below a
generator, so the resource-type guard cannot drag a second parse to the scan.
A missing or unreadable payload is a NULL document, which the guard drops. With
``tagged`` such a payload leaves a row that says why, from the same parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fhirpath import Inside, Shape, coerce, is_element, members, text_at
from ..functions.text import listed_json
from ..sources.resources import RESOURCES, Resource
from ..sources.views import VIEWS, View


REJECT, ACCEPTED = "_reject", "none"
REASONS = ("missing", "unreadable", "foreign")


def _listed(df: DataFrame, carried: list[str], payload: str) -> DataFrame:
    """Each payload in a list with its hash behind it, as in ``strict_json``.

    Here every step is a projection and paths start at the list, so all of it is generated
    code and the document is not copied out of the list.
    """
    marked = df.select(*carried, F.col(payload).alias("_payload"), F.md5(payload).alias("_mark"))
    return marked.selectExpr(
        *[f"`{c}`" for c in carried], "_payload IS NULL AS _missing", "_mark", f"{listed_json('_payload', '_mark')} AS _listed"
    )


_WHOLE = "try_variant_get(_listed, '$[1]', 'string') = _mark AND try_variant_get(_listed, '$[2]', 'variant') IS NULL"


def _elements_of(is_array: bool) -> Column:
    """What the nodes of a payload that is whole JSON lie in: its elements, or the list around it."""
    found = "try_variant_get(_listed, '$[0]', 'array<variant>')" if is_array else "array(_listed)"
    return F.expr(f"CASE WHEN {_WHOLE} THEN {found} END")


def _node(is_array: bool) -> str:
    return "_node" if is_array else Inside("_node", "$[0]")


def _tagged_elements(df: DataFrame, carried: list[str], payload: str, is_array: bool, resource: str) -> DataFrame:
    """Elements of the resource, or one row with the reason where a payload has none."""
    listed = _listed(df, carried, payload)
    reason = F.when(F.col("_missing"), "missing")
    if not is_array:
        kind = F.expr(text_at(Inside("_listed", "$[0]"), "$.resourceType"))
        reason = reason.when(~F.coalesce(F.expr(_WHOLE), F.lit(False)), "unreadable").when(kind == resource, ACCEPTED).otherwise("foreign")
        own = F.when(F.col(REJECT) == ACCEPTED, F.col("_listed")).alias("_node")
        return listed.select(*carried, reason.alias(REJECT), "_listed").select(
            *carried, REJECT, F.when(F.col(REJECT) == ACCEPTED, 0).alias("_position"), own
        )
    parsed = listed.select(*carried, "_missing", _elements_of(is_array).alias("_resources"))
    placed = F.transform("_resources", lambda e, i: F.struct(i.alias("_position"), e.alias("_node")))
    own = F.filter(placed, lambda x: F.try_variant_get(x["_node"], "$.resourceType", "string") == resource)
    reason = reason.when(F.col("_resources").isNull(), "unreadable").when(F.size("_own") == 0, "foreign").otherwise(ACCEPTED)
    kept = parsed.select(*carried, "_missing", "_resources", own.alias("_own"))
    return kept.select(*carried, reason.alias(REJECT), F.inline_outer("_own"))


def _elements(df: DataFrame, carried: list[str], payload: str, is_array: bool) -> DataFrame:
    listed = _listed(df, carried, payload)
    return listed.select(*carried, F.posexplode(_elements_of(is_array)).alias("_position", "_node"))


def flatten(
    df: DataFrame,
    view: View,
    passthrough: dict[str, str],
    payload: str = "payload_json",
    is_array: bool = False,
    index_column: str | None = None,
    types: dict[str, str] | None = None,
    renames: dict[str, str] | None = None,
    tagged: bool = False,
) -> DataFrame:
    """One row per resource (and per ``forEach`` element) of ``view``.

    Rows without payload, unreadable payloads and resources of another type
    yield nothing. ``tagged`` (not with ``forEach``) adds the column ``_reject`` and, for a
    payload without any resource of the view, one row that holds the reason there. ``index_column`` holds the 0-based position in the original
    list: of the resource for a list payload, else of the ``forEach`` element.
    A view column wins over a passthrough column of the same name.
    """
    types, renames = types or {}, renames or {}
    carried, node = list(dict.fromkeys(passthrough.values())), _node(is_array)
    if tagged:
        rows = _tagged_elements(df, carried, payload, is_array, view.resource)
    else:
        rows = _elements(df, carried, payload, is_array)
        rows = rows.where(F.expr(text_at(node, "$.resourceType")) == view.resource)
    position = "_position"
    if view.for_each:
        rows = rows.select(
            *carried, "_node", F.posexplode(F.expr(members(node, view.for_each))).alias("_item_position", "_item")
        ).where(is_element("_item"))
        position = "_item_position"

    out = dict(passthrough)
    for place, read, pairs in ((node, "_read", view.columns), ("_item", "_item_read", view.nested)):
        shape = Shape(path for _, path in pairs)
        if not shape.empty:
            rows = rows.selectExpr("*", f"{shape.column(place)} AS {read}")
        for name, path in pairs:
            target = renames.get(name, name)
            out[target] = coerce(shape.value(place, read, path), types.get(target, "STRING"))
    if index_column:
        out[index_column] = position
    if tagged:
        out[REJECT] = REJECT
    return rows.selectExpr(*[f"{expression} AS `{name}`" for name, expression in out.items()])


def flatten_resource(bronze: DataFrame, resource: Resource | str, tagged: bool = False) -> DataFrame:
    """Silver table of one registered resource; ``tagged``: with the payloads that it leaves out."""
    spec = RESOURCES[resource] if isinstance(resource, str) else resource
    return flatten(
        bronze,
        spec.view,
        spec.passthrough,
        is_array=spec.is_array,
        index_column=spec.index_column,
        types=spec.types,
        renames=spec.renames,
        tagged=tagged,
    )


def flatten_children(bronze: DataFrame, view_name: str) -> DataFrame:
    """Nested elements of a resource; key is the document and the position."""
    return flatten(
        bronze,
        VIEWS[view_name],
        {"frappe_doc_name": "name", "modified": "modified"},
        index_column="element_idx",
    )


def _by_reason() -> list[Column]:
    return [F.count_if(F.col(REJECT) == reason).alias(reason) for reason in REASONS]


def flatten_rejects(bronze: DataFrame, resource: Resource | str, by: tuple[str, ...] = (), payload: str = "payload_json") -> DataFrame:
    """Counts of the payloads that ``flatten_resource`` leaves out, by reason (and by the columns ``by``)."""
    spec = RESOURCES[resource] if isinstance(resource, str) else resource
    rows = _tagged_elements(bronze, list(by), payload, spec.is_array, spec.view.resource)
    return rows.groupBy(*by).agg(*_by_reason())


def rejects_sql(tagged: str, name: str, day: str) -> str:
    """SQL text: the counts of a stored tagged table by ``day``; days without a reject have no row."""
    counts = ", ".join(f"count_if({REJECT} = '{reason}') AS {reason}" for reason in REASONS)
    return f"SELECT '{name}' AS table_name, {counts}, {day} FROM {tagged} WHERE {REJECT} <> '{ACCEPTED}' GROUP BY {day}"
