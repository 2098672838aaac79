"""Typed documents in a JSON column: build, read, write back, edit (JS16, JS17).

A document's known members are given by a struct type. What the type does not
know, or cannot hold, goes to a rest text and is written back, so nothing stored
is lost by a program that knows an older type.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.json_modify import Edit, json_modify_all
from tessera.functions.json_path import Name, text_at


def _struct(schema: str | T.StructType) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def build_document(members: Mapping[str, Column]) -> Column:
    """JS16: one JSON object from named columns (structs and arrays nest); NULL members are stored as ``null``."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in members.items()]), {"ignoreNullFields": "false"})


def read_document(df: DataFrame, col: str, schema: str | T.StructType, name: str = "doc", rest: str = "rest") -> DataFrame:
    """Adds ``name``, the typed members of the documents in ``col``, and ``rest``, the JSON object of all others.

    Members that the type does not list, and members stored in a shape that the
    type cannot hold (which are NULL in ``name``), are in ``rest``; it is NULL
    where there are none. NULL documents, and text that is no JSON object, give
    NULL for both. Of a repeated key the last counts, as in ``from_json``.
    """
    typed = _struct(schema)
    stored = F.from_json(col, "map<string,string>")
    known = F.from_json(col, typed)
    held = {f.name: f"_m{i}" for i, f in enumerate(typed.fields)}
    out = df.withColumn("_t", known).withColumn("_all", stored)
    unfit = [F.when(F.col("_all")[n].isNotNull() & F.col("_t")[n].isNull(), F.lit(n)) for n in held]
    fits = F.array_except(F.array(*[F.lit(n) for n in held]), F.array_compact(F.array(*unfit)))
    # the rest keeps its JSON kinds, so it is taken from the parsed document, not from the text map
    others = F.map_filter(F.try_variant_get(F.try_parse_json(F.col(col)), "$", "map<string,variant>"), lambda k, _: ~F.array_contains(F.col("_fits"), k))
    out = out.withColumn("_fits", fits).withColumn("_others", others)
    is_object = F.col("_all").isNotNull()
    return out.withColumns({name: F.when(is_object, F.col("_t")),
                            rest: F.when(is_object & (F.size(F.map_keys("_others")) > 0), F.to_json("_others"))}).drop("_t", "_all", "_fits", "_others")


def write_document(doc: Column, rest: Column, members: list[str]) -> Column:
    """The JSON object of the typed ``doc`` and of ``rest``, as ``read_document`` gives them.

    Members come in the order of the type, then the rest; NULL members are stored
    as ``null`` unless the rest holds them.
    """
    in_rest = F.coalesce(F.json_object_keys(rest), F.array().cast("array<string>"))
    one = lambda n: F.to_json(F.struct(doc[n].alias(n)), {"ignoreNullFields": "false"})
    texts = [F.when(~(doc[n].isNull() & F.array_contains(in_rest, n)), F.substring(one(n), F.lit(2), F.length(one(n)) - 2)) for n in members]
    tail = F.when(rest.isNotNull(), F.substring(rest, F.lit(2), F.length(rest) - 2))
    return F.when(doc.isNotNull(), F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*texts, tail)), ","), F.lit("}")))


def edit_document(df: DataFrame, col: str, schema: str | T.StructType, assign: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """JS17: ``col`` with some members given new values, computed from the typed document.

    ``assign`` maps a member to a function of the typed document (a struct of
    ``schema``); its value replaces that member alone, NULL as ``null``, and a
    missing member is added. All other text of the document stays as it was,
    members that the type does not know included. A member that is to be edited
    but is stored in a shape that the type cannot hold is an error, as the edit
    would lose it. NULL documents stay NULL.
    """
    typed = _struct(schema)
    unknown = set(assign) - set(typed.names)
    if unknown:
        raise ValueError(f"members not in the type: {sorted(unknown)}")
    out = df.withColumn("_t", F.from_json(col, typed))
    edits = []
    for name, new in assign.items():
        held = F.coalesce(text_at(F.col(col), (Name(name),)), F.lit("null"))
        boxed = F.to_json(F.struct(new(F.col("_t")).alias("v")), {"ignoreNullFields": "false"})
        text = F.substring(boxed, F.lit(6), F.length(boxed) - 6)
        lost = F.col("_t")[name].isNull() & (held != "null")
        text = F.when(lost, F.raise_error(F.concat(F.lit(f"member {name} is stored in another shape: "), held)).cast("string")).otherwise(text)
        edits.append(Edit(f'$."{name}"', text, True))
    return out.withColumn(col, json_modify_all(F.col(col), edits)).drop("_t")
