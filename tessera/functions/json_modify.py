"""JSON_MODIFY on whole documents by path (JS10-JS14).

Spark has no function that edits JSON text in place, and a typed parse loses what
its schema does not name. An edit here finds the span of the member that the path
names and replaces just that, so all other text stays as it was: members nobody
named, their order, repeated keys, nulls, the text of numbers, white space.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.json_path import ANY, Name, Path, parse_path


def _refuse(text: str):
    raise ValueError(f"not JSON: {text}")


_scan = json.JSONDecoder(parse_constant=_refuse).scan_once
_SPACE = " \t\r\n"


@dataclass(frozen=True)
class Edit:
    """Set the value at ``path``; a NULL value deletes it. ``is_json``: the value is JSON text."""

    path: str
    value: Column
    is_json: bool = False


def _skip(text: str, at: int) -> int:
    while at < len(text) and text[at] in _SPACE:
        at += 1
    return at


def _end(text: str, at: int) -> int:
    """End of the value that begins at ``at``."""
    try:
        return _scan(text, at)[1]
    except StopIteration:
        raise ValueError(f"not JSON: {text[:80]!r}") from None


def check(text: str) -> None:
    """An error unless the whole text is one JSON value."""
    if _skip(text, _end(text, _skip(text, 0))) != len(text):
        raise ValueError(f"not JSON: {text[:80]!r}")


def _children(text: str, at: int):
    """``(key or element number, begin, value begin, value end)`` of what the container at ``at`` holds."""
    is_object, i = text[at] == "{", _skip(text, at + 1)
    number = 0
    while text[i] not in "}]":
        begin, key = i, number
        if is_object:
            key, i = scanstring(text, i + 1)
            i = _skip(text, _skip(text, i) + 1)
        stop = _end(text, i)
        yield key, begin, i, stop
        number += 1
        i = _skip(text, stop)
        if text[i] == ",":
            i = _skip(text, i + 1)


def _close(text: str, at: int) -> tuple[int, bool]:
    """Place of the bracket that closes the container at ``at``, and whether it holds anything."""
    held = None
    for *_, held in _children(text, at):
        pass
    return (_skip(text, held), True) if held is not None else (_skip(text, at + 1), False)


def _added(text: str, at: int, new: str) -> str:
    stop, held = _close(text, at)
    return text[:stop] + ("," if held else "") + new + text[stop:]


def edit(text: str, path: Path, new: str | None) -> str:
    """``text`` with the JSON text ``new`` at ``path`` (None: deleted); a path that cannot be followed changes nothing."""
    at, steps = _skip(text, 0), path.steps
    for k, step in enumerate(steps):
        is_name = isinstance(step, Name)
        if text[at] != ("{" if is_name else "["):
            return text
        want, last, before = step.name if is_name else step, k == len(steps) - 1, None
        for key, begin, start, stop in _children(text, at):
            if key == want:
                break
            before = stop
        else:
            if last and is_name and (new is not None or path.append):
                new = "null" if new is None else new
                return _added(text, at, json.dumps(want, ensure_ascii=False) + ":" + (f"[{new}]" if path.append else new))
            return text
        if last and not path.append:
            if new is not None or not is_name:
                return text[:start] + (new or "null") + text[stop:]
            after = _skip(text, stop)
            if before is not None:  # with the comma in front
                return text[:before] + text[stop:]
            return text[:begin] + (text[_skip(text, after + 1):] if text[after] == "," else text[after:])
        at = start
    if path.append:
        return _added(text, at, "null" if new is None else new) if text[at] == "[" else text
    return "null" if new is None else new


def json_modify_all(doc: Column, edits: Sequence[Edit]) -> Column:
    """``edits`` made one after another, in one pass over the documents."""
    paths = [parse_path(e.path) for e in edits]
    if any(ANY in p.steps for p in paths):
        raise ValueError("an edit names one place, not [*]")
    is_json = [e.is_json for e in edits]

    @F.arrow_udf("string")
    def run(docs: pa.Array, *values: pa.Array) -> pa.Array:
        out, columns = docs.to_pylist(), [v.to_pylist() for v in values]
        for i, text in enumerate(out):
            if text is None:
                continue
            check(text)
            for path, as_json, column in zip(paths, is_json, columns):
                new = column[i]
                if new is not None:
                    if as_json:
                        check(new)
                    else:
                        new = json.dumps(new, ensure_ascii=False)
                text = edit(text, path, new)
            out[i] = text
        return pa.array(out, pa.string())

    return run(doc, *[e.value.cast("string") for e in edits])


def json_modify(doc: Column, path: str, value: Column, value_is_json: bool = False) -> Column:
    """JS10-JS14: ``JSON_MODIFY(doc, path, value)`` in lax mode.

    A NULL value deletes the member (an array element becomes ``null``); a
    missing last member is added; other missing steps leave the document as it
    is; ``append $.x`` adds to an array. A string column gives a JSON string
    unless ``value_is_json``; numbers and booleans should be given as JSON text.
    Of a repeated key the first is edited. A NULL document stays NULL; text that
    is not JSON is an error.
    """
    return json_modify_all(doc, [Edit(path, value, value_is_json)])
