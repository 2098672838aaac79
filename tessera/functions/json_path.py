"""JSON paths over text columns, compiled to native expressions (JS3-JS6, JS8, JS9).

A path such as ``$.a[0]."b c"``, ``$[*].x`` or ``strict $.a`` is parsed once on
the driver; reading a value, a fragment, the existence of a member and the rows of
a document all come from the same compiled steps. The building block is the JSON
text at a path with its quotes: Spark's ``get_json_object`` returns it when the
document is wrapped in an array and read through ``$[*]``. Its first character is
the kind of the value, and of a repeated key it takes the first. A member that
holds JSON null gives the text ``null``, a missing one gives SQL NULL. Numbers
come in Spark's rendering (``1.50`` as ``1.5``).
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: step for every element of an array
ANY = "*"
_STEP = re.compile(r'\.(?:"((?:[^"\\]|\\.)*)"|([A-Za-z_$][\w$]*))|\[(?:(\d+)|(\*))\]')
#: text that SQL Server refuses too
STRICT_TEXT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


@dataclass(frozen=True)
class Name:
    """Step to the member of an object."""

    name: str


@dataclass(frozen=True)
class Path:
    """Steps of a JSON path: ``Name``, element number, or ``ANY``."""

    steps: tuple
    strict: bool = False
    append: bool = False


def parse_path(path: str) -> Path:
    """``Path`` of a text such as ``append lax $.a[0]."b c"``; anything else is an error."""
    text, append, strict = path.strip(), False, False
    if text.startswith("append "):
        append, text = True, text.removeprefix("append ").strip()
    for mode in ("lax ", "strict "):
        if text.startswith(mode):
            strict, text = mode == "strict ", text.removeprefix(mode).strip()
            break
    steps, at = [], 1
    while text.startswith("$") and at < len(text):
        m = _STEP.match(text, at)
        if not m:
            break
        steps.append(ANY if m[4] else int(m[3]) if m[3] is not None else Name(m[2] if m[2] is not None else json.loads(f'"{m[1]}"')))
        at = m.end()
    if not text.startswith("$") or at != max(1, len(text)):
        raise ValueError(f"not a JSON path: {path!r}")
    return Path(tuple(steps), strict, append)


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` written into the plan once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def _spelled(steps) -> str | None:
    """The steps in the spelling of ``get_json_object``; None if a name has characters it cannot express."""
    out = ""
    for s in steps:
        if isinstance(s, int):
            out += f"[{s}]"
        elif set(s.name) & set("'?"):
            return None
        else:
            out += f"['{s.name}']"
    return out


def _wrapped(doc: Column) -> Column:
    return F.concat(F.lit("["), doc, F.lit("]"))


def _starts(text: Column, chars: str) -> Column:
    return F.coalesce(F.substring(text, 1, 1).isin(*chars), F.lit(False))


def unquoted(text: Column) -> Column:
    """The text of a JSON string literal."""
    return F.from_json(_wrapped(text), "array<string>")[0]


def _member(doc: Column, name: str) -> Column:
    """Member text for names that ``get_json_object`` cannot express, by way of VARIANT."""
    key = json.dumps(name, ensure_ascii=False)
    return F.to_json(F.try_variant_get(F.try_parse_json(doc), f"$[{key}]", "variant"))


def text_at(doc: Column, steps: tuple) -> Column:
    """JSON text at ``steps`` (without ``ANY``), strings with their quotes; ``null`` for JSON null, NULL where there is nothing."""
    if not steps:
        root = F.get_json_object(_wrapped(doc), "$[*]")
        return F.when(_starts(root, "[{"), root)
    spelled = _spelled(steps)
    if spelled is None:
        if len(steps) == 1:
            return _member(doc, steps[0].name)
        return _once(text_at(doc, steps[:-1]), lambda parent: F.when(_starts(parent, "[{"), text_at(parent, steps[-1:])))
    found = F.get_json_object(_wrapped(doc), f"$[*]{spelled}")
    # nothing found: the parent tells a stored null from a missing member
    parent = (F.get_json_object(_wrapped(doc), f"$[*]{_spelled(steps[:-1])}") if len(steps) > 1 else doc)
    last = steps[-1]
    if isinstance(last, int):
        stored = _once(parent, lambda p: F.when(_starts(F.ltrim(p), "["), F.coalesce(F.json_array_length(p), F.lit(0)) > last))
    else:
        stored = _once(parent, lambda p: F.when(_starts(F.ltrim(p), "{"), F.map_contains_key(
            F.from_json(p, "map<string,string>", STRICT_TEXT), F.lit(last.name))))
    return F.coalesce(found, F.when(stored, F.lit("null")))


def elements_of(fragment: Column) -> Column:
    """JSON texts of the elements of an array's text, with quotes and ``null``; NULL if it is no array.

    Strings are told from other elements by VARIANT; in an array that repeats a
    key somewhere, which VARIANT refuses, a string element that itself holds an
    object's text is taken for that object.
    """
    def told(x):
        kinds = F.transform(F.try_variant_get(F.try_parse_json(x["p"]), "$", "array<variant>"), lambda v: F.schema_of_variant(v) == "STRING")

        def text(e, kinds, i):
            is_string = F.coalesce(F.get(kinds, i), ~F.rlike(e, F.lit(r"^[\[{]|^(true|false|-?[0-9][0-9.eE+-]*)$")))
            quoted = F.to_json(F.array(e))
            return F.when(e.isNull(), "null").when(is_string, F.substring(quoted, F.lit(2), F.length(quoted) - 2)).otherwise(e)

        # a lambda's body is evaluated for each element: the kinds of all of them are made outside it
        return _once(kinds, lambda k: F.transform(x["raw"], lambda e, i: text(e, k, i)))

    def read(x):
        # texts that make up the array's own text when joined: no element is a string, which would miss its quotes
        plain = F.transform(x["raw"], lambda e: F.coalesce(e, F.lit("null")))
        return _once(plain, lambda t: F.when(F.concat(F.lit("["), F.array_join(t, ","), F.lit("]")) == x["p"], t).otherwise(told(x)))

    return _once(fragment, lambda p: F.when(_starts(p, "["), _once(
        F.struct(p.alias("p"), F.from_json(p, "array<string>", STRICT_TEXT).alias("raw")), read)))


def matches(doc: Column, steps: tuple) -> Column:
    """JSON texts of everything that the path selects, in document order (an array, possibly empty)."""
    if ANY not in steps:
        return F.array_compact(F.array(text_at(doc, steps)))
    at = steps.index(ANY)
    inside = F.coalesce(elements_of(text_at(doc, steps[:at]) if at else F.get_json_object(_wrapped(doc), "$[*]")), F.array().cast("array<string>"))
    rest = steps[at + 1:]
    if not rest:
        return inside
    return F.flatten(F.transform(inside, lambda e: F.when(_starts(e, "[{"), matches(e, rest)).otherwise(F.array().cast("array<string>"))))


def _single(path: Path, text: str) -> tuple:
    if path.append or ANY in path.steps:
        raise ValueError(f"a path to one value is needed, not {text!r}")
    return path.steps


def _or_error(path: Path, text: str, doc: Column, found: Column, what: str) -> Column:
    """Strict mode: a document without the ``what`` asked for is an error."""
    if not path.strict:
        return found
    error = F.raise_error(F.concat(F.lit(f"no {what} at {text} in "), doc)).cast("string")
    return F.when(doc.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(found, error))


def scalar_of(text: Column) -> Column:
    """The scalar of a JSON text with its quotes, NULL for objects, arrays and JSON null."""
    return F.when(_starts(text, '"'), unquoted(text)).when(~_starts(text, "[{") & (text != "null"), text)


def fragment_of(text: Column) -> Column:
    """The JSON text if it is an object or array."""
    return F.when(_starts(text, "[{"), text)


def lax_text(doc: Column, path: str) -> Column | None:
    """JSON text at ``path`` with its quotes, by one native call; None for a strict path and one that ``get_json_object`` cannot express."""
    p = parse_path(path)
    steps = _single(p, path)
    spelled = _spelled(steps)
    return F.get_json_object(_wrapped(doc), f"$[*]{spelled}") if steps and spelled is not None and not p.strict else None


def value(doc: Column, path: str) -> Column:
    """JS3: the scalar at ``path`` as text; NULL for objects, arrays, JSON null and missing paths.

    In strict mode a path that leads to no scalar is an error, JSON null included
    in neither: it stays NULL.
    """
    p = parse_path(path)
    steps = _single(p, path)
    if not steps:
        return _or_error(p, path, doc, F.lit(None).cast("string"), "scalar")

    def read(t):
        scalar = scalar_of(t)
        return F.when(t == "null", F.lit(None).cast("string")).otherwise(_or_error(p, path, doc, scalar, "scalar")) if p.strict else scalar

    spelled = _spelled(steps)
    # outside strict mode a stored null needs no telling from a missing member
    text = text_at(doc, steps) if p.strict or spelled is None else F.get_json_object(_wrapped(doc), f"$[*]{spelled}")
    if p.strict:
        text = F.when(doc.isNotNull(), F.coalesce(text, F.lit("{}")))
    return _once(text, read)


def query(doc: Column, path: str = "$") -> Column:
    """JS4: the object or array at ``path`` as JSON text; NULL for scalars and missing paths."""
    p = parse_path(path)
    spelled = _spelled(_single(p, path))
    text = F.get_json_object(_wrapped(doc), f"$[*]{spelled}") if spelled is not None else text_at(doc, p.steps)
    return _or_error(p, path, doc, _once(text, fragment_of), "object or array")


def exists(doc: Column, path: str) -> Column:
    """JS5: whether ``path`` selects anything, stored nulls included; false for NULL and for text that is not JSON."""
    return F.coalesce(F.size(matches(doc, parse_path(path).steps)) > 0, F.lit(False))


def valid(doc: Column, kind: str | None = None) -> Column:
    """JS6: whether the whole text is one JSON object or array (``kind``: ``OBJECT`` or ``ARRAY`` alone), NULL for NULL.

    Repeated keys are valid. The text is read as the first of two elements, the
    second being its own digest, so nothing in it can end the array early.
    """
    mark = F.md5(doc.cast("binary"))
    two = F.from_json(F.concat(F.lit("["), doc, F.lit(',"'), mark, F.lit('"]')), "array<string>", STRICT_TEXT)
    opening = {"OBJECT": "{", "ARRAY": "[", None: "[{"}[kind.upper() if kind else None]
    return _once(two, lambda t: F.when(doc.isNotNull(), F.coalesce(
        (F.size(t) == 2) & (F.get(t, F.lit(1)) == mark) & _starts(F.ltrim(doc, F.lit(" \t\r\n")), opening), F.lit(False))))
