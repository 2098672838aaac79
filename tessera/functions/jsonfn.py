"""JSON column functions (JS1-JS7, JS15).

Building uses ``struct`` + ``to_json``; reading by path uses ``json_path``,
editing ``json_modify``. Missing paths give NULL (lax mode).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import json_path


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --------------------------------------------------------------------------
# building


def nested_struct(mapping: Mapping[str, str | Column]) -> Column:
    """Dotted aliases (``Info.Nombre``) become nested structs, in the order
    the names first appear."""
    tree: dict = {}
    for alias, col in mapping.items():
        node = tree
        parts = alias.split(".")
        for p in parts[:-1]:
            node = node.setdefault(p, {})
        node[parts[-1]] = _c(col)

    def build(node: dict) -> Column:
        return F.struct(*[(build(v) if isinstance(v, dict) else v).alias(k)
                          for k, v in node.items()])

    return build(tree)


def for_json_path(mapping: Mapping[str, str | Column]) -> Column:
    """JS1: one row as ``FOR JSON PATH`` renders it: dotted names nest and
    NULL members are left out."""
    return F.to_json(nested_struct(mapping))


def json_object(mapping: Mapping[str, str | Column]) -> Column:
    """JS7: ``JSON_OBJECT('k': v, ..)``; NULL members stay as ``null``."""
    return F.to_json(nested_struct(mapping), {"ignoreNullFields": "false"})


def json_root(array_col: str | Column, name: str) -> Column:
    """JS2: ``ROOT('name')``: wrap an array in an object with one member."""
    return F.to_json(F.struct(_c(array_col).alias(name)))


def json_unwrap(array_col: str | Column) -> Column:
    """JS2: ``TRIM('[]' FROM (.. FOR JSON PATH))`` on a one-row result: the
    single object as JSON text. Takes element 0 instead of trimming text, so
    brackets inside values are safe; NULL for an empty or NULL array."""
    return F.to_json(F.element_at(_c(array_col), 1))


def json_raw_array(array_col: str | Column, key: str) -> Column:
    """JS15: object array to a raw value array: ``[{"k":"a"}]`` -> ``["a"]``."""
    return F.transform(_c(array_col), lambda x: x[key])


# --------------------------------------------------------------------------
# reading


def json_value(col: str | Column, path: str) -> Column:
    """JS3: ``JSON_VALUE``: the scalar at ``path`` as text; NULL for objects,
    arrays, JSON null, missing paths and text that is not JSON. Of a repeated
    key the first counts; ``strict $..`` makes a missing path an error."""
    return json_path.value(_c(col), path)


def json_query(col: str | Column, path: str = "$") -> Column:
    """JS4: ``JSON_QUERY``: the object or array at ``path`` as JSON text, its
    members in document order; NULL for scalars and missing paths."""
    return json_path.query(_c(col), path)


def json_path_exists(col: str | Column, path: str) -> Column:
    """JS5: ``JSON_PATH_EXISTS(doc, path)``: whether the path (``[*]`` steps
    included) selects anything; a stored JSON null counts, a missing member
    does not."""
    return json_path.exists(_c(col), path)


def is_json(col: str | Column, kind: str | None = None) -> Column:
    """JS6: ``ISJSON(x)`` / ``ISJSON(x, ARRAY|OBJECT)`` as 1/0, NULL for NULL.
    Bare scalars are not valid JSON text here (SQL Server rule); repeated keys
    are valid."""
    return json_path.valid(_c(col), kind).cast("int")
