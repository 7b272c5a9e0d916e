"""Compile the path forms of the view definitions into Spark columns.

Supported forms: ``a.b.c``, ``first()`` and ``where(field='text')``. A node is the
name of a VARIANT column and an expression is SQL text, which goes into one
``selectExpr``. A path always walks *collections*: one object and a list of one
object are the same thing, missing values and JSON nulls are no elements, and a
step over several elements maps and flattens.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import Any

_STEP = re.compile(
    r"(?:^|\.)(?:(?P<first>first\(\))|where\((?P<field>\w+)='(?P<text>[^']*)'\)|(?P<name>[A-Za-z_]\w*))(?=\.|$)"
)


def steps_of(path: str) -> list[tuple[str, ...]]:
    """``[("get", name) | ("first",) | ("where", field, text), ...]``"""
    steps: list[tuple[str, ...]] = []
    end = 0
    for match in _STEP.finditer(path):
        if match.start() != end:
            break
        end = match.end()
        if match["first"]:
            steps.append(("first",))
        elif match["field"]:
            steps.append(("where", match["field"], match["text"]))
        else:
            steps.append(("get", match["name"]))
    if not steps or end != len(path) or steps[0][0] != "get":
        raise ValueError(f"unsupported path: {path!r}")
    return steps


class Inside(str):
    """A node that lies at the path ``root`` of the VARIANT column it names."""

    root: str

    def __new__(cls, column: str, root: str) -> Inside:
        node = super().__new__(cls, column)
        node.root = root
        return node


def at(node: str, json_path: str) -> str:
    """The first two arguments of a lookup."""
    return f"{node}, '{getattr(node, 'root', '$')}{json_path[1:]}'"


def text_at(node: str, json_path: str) -> str:
    return f"try_variant_get({at(node, json_path)}, 'string')"


def members(node: str, name: str) -> str:
    """The collection ``node.name`` as an array (may hold NULL or JSON null)."""
    place = at(node, f"$.{name}")
    return f"coalesce(try_variant_get({place}, 'array<variant>'), array(try_variant_get({place}, 'variant')))"


def is_element(node: str) -> str:
    return f"{node} IS NOT NULL AND NOT is_variant_null({node})"


def collection(node: str, steps: list[tuple[str, ...]]) -> str:
    """Array of all elements a path reaches."""
    present = f"e -> {is_element('e')}"
    found = f"filter({members(node, steps[0][1])}, {present})"
    for step in steps[1:]:
        if step[0] == "first":
            found = f"slice({found}, 1, 1)"
        elif step[0] == "where":
            found = f"filter({found}, e -> {text_at('e', '$.' + step[1])} = '{step[2]}')"
        else:
            found = f"filter(flatten(transform({found}, e -> {members('e', step[1])})), {present})"
    return found


def _first_of_walk(node: str, steps: list[tuple[str, ...]]) -> str:
    """The general way, only where the first member is there at all."""
    present = f"try_variant_get({at(node, f'$.{steps[0][1]}')}, 'variant') IS NOT NULL"
    return f"WHEN {present} THEN {text_at(f'get({collection(node, steps)}, 0)', '$')}"


def value_at(node: str, path: str) -> str:
    """First value of ``path`` below the VARIANT column ``node``, as text.

    The usual spelling (a list where ``first()`` is written, else no list) is one
    direct lookup. When it finds nothing but its parent is there in the usual
    spelling, the field is just absent. Only other spellings walk the collection.
    """
    steps = steps_of(path)
    if any(step[0] == "where" for step in steps):
        return f"CASE {_first_of_walk(node, steps)} END"
    usual = "$" + "".join(f".{s[1]}" if s[0] == "get" else "[0]" for s in steps)
    direct = text_at(node, usual)
    branches = f"WHEN {_settled(direct)} THEN {direct} "
    above = usual[: usual.rindex(".")]
    if above != "$" and steps[-1][0] == "get":
        parent = f"try_variant_get({at(node, above)}, 'variant')"
        listed = f"try_variant_get({at(node, above + '[0]')}, 'variant') IS NOT NULL"
        branches += f"WHEN {direct} IS NULL AND {is_element(parent)} AND NOT {listed} THEN NULL "
    return f"CASE {branches}{_first_of_walk(node, steps)} END"


def _settled(direct: str) -> str:
    return f"{direct} IS NOT NULL AND NOT startswith({direct}, '[')"


class Shape:
    """The usual spelling of many paths as one struct type, so that one lookup reads them all.

    A path whose spelling contradicts that of an earlier one, and one with ``where``, stays
    outside and is looked up on its own. A member in another spelling is NULL in the struct.
    """

    def __init__(self, paths: Iterable[str]) -> None:
        self._members: dict[str, Any] = {}
        self._inside = {path for path in paths if self._add(steps_of(path))}

    def _add(self, steps: list[tuple[str, ...]]) -> bool:
        if any(step[0] == "where" for step in steps):
            return False
        members, place = self._members, 0
        while place < len(steps):
            name, place = steps[place][1], place + 1
            lists = 0
            while place < len(steps) and steps[place][0] == "first":
                lists, place = lists + 1, place + 1
            kind = "string" if place == len(steps) else "struct"
            known = members.setdefault(name, (lists, kind, {}))
            if known[:2] != (lists, kind):
                return False
            members = known[2]
        return True

    @property
    def empty(self) -> bool:
        return not self._inside

    def type_text(self, members: dict[str, Any] | None = None) -> str:
        fields = []
        for name, (lists, kind, below) in (self._members if members is None else members).items():
            text = "string" if kind == "string" else self.type_text(below)
            fields.append(f"{name}: {'array<' * lists}{text}{'>' * lists}")
        return f"struct<{', '.join(fields)}>"

    def column(self, node: str) -> str:
        """SQL text of the lookup."""
        return f"try_variant_get({at(node, '$')}, '{self.type_text()}')"

    def value(self, node: str, read: str, path: str) -> str:
        """As ``value_at``; ``read`` is the column that holds ``column(node)``."""
        if path not in self._inside:
            return value_at(node, path)
        steps = steps_of(path)
        parts = [read]
        for step in steps:
            parts.append(f"{parts[-1]}.`{step[1]}`" if step[0] == "get" else f"get({parts[-1]}, 0)")
        direct, parent = parts[-1], parts[-2]
        branches = f"WHEN {_settled(direct)} THEN {direct} "
        if len(steps) > 1 and steps[-1][0] == "get":
            branches += f"WHEN {direct} IS NULL AND {parent} IS NOT NULL THEN NULL "
        return f"CASE {branches}{_first_of_walk(node, steps)} END"


def coerce(value: str, type_name: str) -> str:
    """Cast text to a declared type; what does not fit becomes NULL."""
    targets = {
        "TIMESTAMP": "timestamp_ntz",
        "DATE": "date",
        "DOUBLE": "double",
        "INT": "bigint",
        "BOOLEAN": "boolean",
    }
    return f"try_cast({value} AS {targets[type_name]})" if type_name in targets else value
