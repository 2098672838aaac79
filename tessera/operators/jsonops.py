"""JSON table operators: build per-group documents, shred documents to rows
(C6, C11, D16, D17, JS8, JS9, JS16-JS18).

Children are always aggregated per key *before* the join to the parent
(``collect_list`` of a struct, then one left join): one shuffle per child,
no parent x child x grandchild blow-up, and a parent with no children gets
NULL, as a correlated ``FOR JSON`` subquery does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import json_path
from tessera.functions.jsonfn import nested_struct


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sorted_children(child: DataFrame, key: str, fields: Mapping[str, str | Column],
                    order_by: Sequence[str | Column], name: str) -> DataFrame:
    """Per ``key``: array of child structs sorted by ``order_by`` (then by the
    struct itself, so equal sort keys still give one fixed order)."""
    sort_cols = [_c(c).alias(f"_s{i}") for i, c in enumerate(order_by)]
    packed = child.select(F.col(key).alias("_key"),
                          F.struct(*sort_cols, nested_struct(fields).alias("_v")).alias("_e"))
    return packed.groupBy("_key").agg(
        F.transform(F.array_sort(F.collect_list("_e")), lambda e: e["_v"]).alias(name))


def nest_children(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
                  fields: Mapping[str, str | Column], name: str,
                  order_by: Sequence[str | Column] | None = None, as_json: bool = True) -> DataFrame:
    """Correlated ``(SELECT .. FOR JSON PATH)`` per parent row: the child
    rows as a JSON array, NULL when there are none."""
    order = list(order_by) if order_by else list(fields.values())
    agg = sorted_children(child, child_key, fields, order, "_arr")
    joined = parent.join(agg, parent[parent_key] == agg["_key"], "left").drop("_key")
    value = F.to_json("_arr") if as_json else F.col("_arr")
    return joined.withColumn(name, value).drop("_arr")


def include(parent: DataFrame, parent_key: str,
            children: Sequence[tuple[DataFrame, str, Mapping[str, str | Column], str, Sequence]]
            ) -> DataFrame:
    """C11: eager load of several child collections (split-query form).

    ``children`` holds (child, child_key, fields, name, order_by). A field
    value may itself be a nested array column prepared with ``nest_children``
    (``as_json=False``) for the next level down.
    """
    out = parent
    for child, child_key, fields, name, order_by in children:
        out = nest_children(out, child, parent_key, child_key, fields, name, order_by,
                            as_json=False)
    return out


def json_array_by(df: DataFrame, by: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """``JSON_ARRAYAGG(JSON_OBJECT(..))`` per group, ordered by the
    fields in the order given; NULL members are kept."""
    packed = df.select(*by, F.struct(*fields).alias("_e"))
    return packed.groupBy(*by).agg(F.to_json(F.array_sort(F.collect_list("_e")), {"ignoreNullFields": "false"}).alias(name))


def _json_text(col: Column) -> Column:
    """A string as a JSON string literal (quotes and escapes included)."""
    arr = F.to_json(F.array(col))
    return F.substring(arr, 2, F.length(arr) - 2)


def json_object_by(df: DataFrame, by: Sequence[str], name_col: str, value_col: str,
                   out: str) -> DataFrame:
    """``JSON_OBJECTAGG(name: value)`` per group. Repeated names are kept
    (a map would reject them), so the object text is built from members
    sorted by (name, value). Values of any type are rendered as JSON, NULL as
    ``null``."""
    v = F.col(value_col)
    is_text = isinstance(df.schema[value_col].dataType, T.StringType)
    is_number = isinstance(df.schema[value_col].dataType, T.NumericType)
    boxed = F.to_json(F.struct(v.alias("v")), {"ignoreNullFields": "false"})
    rendered = (_json_text(v) if is_text else v.cast("string") if is_number
                else F.expr("substring(_j, 6, length(_j) - 6)"))
    rendered = F.when(v.isNull(), "null").otherwise(rendered)
    df = df.withColumn("_j", boxed)
    member = F.concat(_json_text(F.col(name_col)), F.lit(":"), rendered)
    packed = df.select(*by, F.struct(F.col(name_col).alias("n"), v.alias("v"),
                                     member.alias("m")).alias("_e"))
    return packed.groupBy(*by).agg(
        F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.collect_list("_e")),
                                                      lambda e: e["m"]), ","),
                 F.lit("}")).alias(out))


def openjson(df: DataFrame, col: str, schema: str | T.DataType, keep: Sequence[str] = (),
             outer: bool = False, path_map: Mapping[str, str] | None = None) -> DataFrame:
    """JS8: ``CROSS/OUTER APPLY OPENJSON(doc) WITH (..)``: a JSON array of
    objects to typed rows. ``schema`` is the element struct; ``path_map``
    renames members (``Cantidad INT '$.Cant'``: {"Cantidad": "Cant"})."""
    elem = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    parsed = F.from_json(F.col(col), T.ArrayType(elem))
    gen = F.explode_outer if outer else F.explode
    rows = df.select(*keep, gen(parsed).alias("_e"))
    cols = [F.col("_e")[f.name].alias(f.name) for f in elem.fields]
    out = rows.select(*keep, *cols)
    for new, old in (path_map or {}).items():
        out = out.withColumnRenamed(old, new)
    return out


def openjson_paths(df: DataFrame, col: str, columns: Mapping[str, tuple[str, str]], path: str = "$",
                   keep: Sequence[str] = (), outer: bool = False) -> DataFrame:
    """JS8: ``OPENJSON(doc, path) WITH (name type 'member path', ..)``.

    The array at ``path`` gives a row for each element, an object one row;
    anything else gives none (``outer``: one of NULLs). ``columns`` maps a name
    to its type and its path from the element, such as ``("decimal(10,4)",
    "$.price.net")``; the type ``json`` is ``AS JSON``, the fragment's text.
    """
    p = json_path.parse_path(path)
    at = json_path.text_at(F.col(col), json_path._single(p, path))
    at = json_path._or_error(p, path, F.col(col), at, "value")
    items = F.coalesce(json_path.elements_of(F.col("_at")), F.when(F.col("_at").startswith("{"), F.array("_at")))
    rows = df.select(*keep, at.alias("_at")).select(*keep, (F.explode_outer if outer else F.explode)(items).alias("_e"))
    # the members' texts in a projection of their own: read once, then mentioned as columns
    texts, cols = [], []
    for i, (name, (kind, member)) in enumerate(columns.items()):
        text, is_json = json_path.lax_text(F.col("_e"), member), kind.lower() == "json"
        if text is not None:
            texts.append(text.alias(f"_t{i}"))
            found = json_path.fragment_of(F.col(f"_t{i}")) if is_json else json_path.scalar_of(F.col(f"_t{i}"))
        else:
            found = json_path.query(F.col("_e"), member) if is_json else json_path.value(F.col("_e"), member)
        cols.append((found if is_json else found.cast(kind)).alias(name))
    return rows.select(*keep, "_e", *texts).select(*keep, *cols)


def openjson_count(df: DataFrame, key: str, col: str, path: str = "$",
                   name: str = "n") -> DataFrame:
    """JS9: ``OUTER APPLY OPENJSON(doc, path)`` then ``COUNT(1)`` per key: an
    absent or empty array still counts 1 (the outer row)."""
    spark = df.sparkSession
    at = df.select(key, F.try_parse_json(json_path.query(F.col(col), path)).alias("_v"))
    # arrays give one row per element, objects one per member; anything else
    # (missing, scalar, not JSON) keeps the outer row
    rows = at.lateralJoin(spark.tvf.variant_explode_outer(F.col("_v").outer()))
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def materialise_json(df: DataFrame, col: str, paths: Mapping[str, str]) -> DataFrame:
    """JS18: persist JSON values as real columns (a computed, persisted
    column) so filters on them reach Parquet statistics when written."""
    from tessera.functions.jsonfn import json_value

    out = df
    for name, path in paths.items():
        out = out.withColumn(name, json_value(col, path))
    return out


def store_json_columns(df: DataFrame, col: str, paths: Mapping[str, str], path: str, mode: str = "errorifexists",
                       files: int | None = None) -> None:
    """JS18: the table with JSON values as stored, indexed columns.

    ``paths`` maps a new column to the path of its value in ``col``. The files
    are range-partitioned and sorted by the first of them, so that a filter on
    it skips files and row groups by their statistics, and every one of them
    has a Parquet bloom filter, by which equality skips row groups whatever
    the order. Rows without the value come first, in files of their own range.
    """
    from tessera.sources.tables import write_clustered

    out = materialise_json(df, col, paths)
    write_clustered(out, path, [next(iter(paths))], mode=mode, files=files, bloom=list(paths))


# OPENJSON type codes (null, string, number, true/false, array, object).
JSON_TYPE_CODES = {"null": 0, "string": 1, "number": 2, "boolean": 3, "array": 4, "object": 5}


def openjson_kv(df: DataFrame, col: str, keep: Sequence[str] = (), outer: bool = True, path: str = "$") -> DataFrame:
    """JS9: ``OPENJSON(doc, path)`` without a schema: one row per member (or array
    element) of the object or array at ``path`` with ``key``, ``value`` and ``type``. Array keys are the element
    positions; ``value`` is the text of a string and the JSON text of
    anything else; ``type`` uses the OPENJSON codes. ``outer`` keeps rows
    whose document is NULL or not JSON (CROSS vs OUTER APPLY)."""
    spark = df.sparkSession
    # raw member text (document order kept) next to the parsed VARIANT
    parsed = df.select(*keep, json_path.query(F.col(col), path).alias("_doc")).select(
        *keep, F.try_parse_json("_doc").alias("_v"), F.from_json("_doc", "map<string,string>").alias("_rawm"),
        F.from_json("_doc", "array<string>").alias("_rawa"))
    gen = spark.tvf.variant_explode_outer if outer else spark.tvf.variant_explode
    rows = parsed.lateralJoin(gen(F.col("_v").outer())).select(
        *keep, F.col("pos").alias("_pos"), F.col("key").alias("_key"), F.col("value").alias("_val"),
        "_rawm", "_rawa")
    kind = F.schema_of_variant("_val")
    code = (F.when(F.col("_val").isNull(), F.lit(None))
            .when(F.is_variant_null("_val"), JSON_TYPE_CODES["null"])
            .when(kind == "STRING", JSON_TYPE_CODES["string"])
            .when(kind == "BOOLEAN", JSON_TYPE_CODES["boolean"])
            .when(kind.startswith("ARRAY"), JSON_TYPE_CODES["array"])
            .when(kind.startswith("OBJECT"), JSON_TYPE_CODES["object"])
            .otherwise(JSON_TYPE_CODES["number"]))
    raw = F.coalesce(F.element_at("_rawm", F.col("_key")), F.element_at("_rawa", F.col("_pos") + 1))
    value = (F.when(F.is_variant_null("_val"), F.lit(None).cast("string"))
             .when(kind == "STRING", F.variant_get("_val", "$", "string"))
             .otherwise(F.coalesce(raw, F.to_json("_val"))))
    return rows.select(*keep, F.coalesce(F.col("_key"), F.col("_pos").cast("string")).alias("key"),
                       value.alias("value"), code.cast("int").alias("type"))
