"""Text and regular-expression column functions.

All of these but ``match_spans`` are built-in expressions, so they stay inside
whole-stage code generation; the helpers only pin the SQL Server rules that
differ from Spark's defaults.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def translate_strict(col: str | Column, src: str, dst: str) -> Column:
    """H2: TRANSLATE. SQL Server refuses unequal lengths; Spark would delete
    the surplus characters, so the lengths are checked here."""
    if len(src) != len(dst):
        raise ValueError("TRANSLATE needs source and target of equal length")
    return F.translate(_c(col), src, dst)


# Accent folding used by the reference's TRANSLATE example.
ACCENTED = "áéíóúüñ"
UNACCENTED = "aeiouun"


def fold_accents(col: str | Column) -> Column:
    return translate_strict(col, ACCENTED, UNACCENTED)


def capitalise(col: str | Column) -> Column:
    """H4: first letter upper case, the rest lower case (not ``initcap``,
    which changes every word)."""
    c = _c(col)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2147483647)))


def case_insensitive(col: str | Column, collation: str = "UNICODE_CI") -> Column:
    """Compare as SQL Server's default collation does (case-insensitive);
    Spark compares exactly unless a collation is asked for."""
    return F.collate(_c(col), collation)


def len_rtrim(col: str | Column) -> Column:
    """H5: LEN ignores trailing spaces (Spark's ``length`` counts them)."""
    return F.length(F.rtrim(_c(col)))


def after_first(col: str | Column, pattern: str) -> Column:
    """The text after the first match of ``pattern`` to the end
    (``SUBSTRING(s, REGEXP_INSTR(s, p) + 1, LEN(s))``)."""
    c = _c(col)
    return F.substring(c, F.regexp_instr(c, F.lit(pattern)) + 1, len_rtrim(c))


def money_es(col: str | Column) -> Column:
    """H7: ``FORMAT(x, 'C', 'es-es')``: two decimals rounded half away from
    zero (``format_number`` alone would round half to even), ``.`` groups,
    ``,`` decimal mark, trailing `` €``. Groups also for four-digit numbers."""
    return F.concat(F.translate(F.format_number(F.round(_c(col), 2), 2), ",.", ".,"), F.lit(" €"))


def regexp_substr(col: str | Column, pattern: str) -> Column:
    """H8: first match or NULL."""
    return F.regexp_substr(_c(col), F.lit(pattern))


def regexp_instr(col: str | Column, pattern: str) -> Column:
    """1-based start of the first match, 0 when none."""
    return F.regexp_instr(_c(col), F.lit(pattern))


def regexp_count(col: str | Column, pattern: str) -> Column:
    """Number of matches (``\\w`` is ASCII, as in the oracle)."""
    return F.regexp_count(_c(col), F.lit(pattern))


def match_spans(col: str | Column, pattern: str) -> Column:
    """All matches of ``pattern`` in the text, found in one pass over it:
    ``array<struct<start, end, value, groups array<struct<start, end, value>>>>``.

    Positions count characters from 1, ``end`` inclusive (an empty match ends
    before it starts). A group that took no part in its match is NULL, one that
    matched nothing is empty. Classes such as ``\\d`` and ``\\w`` are ASCII, as
    in the other functions. NULL for a NULL text.
    """
    compiled = re.compile(pattern, re.ASCII)
    span = "struct<start:int,end:int,value:string>"
    kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])
    match = pa.struct([*kind, pa.field("groups", pa.list_(kind))])

    def part(m, g):
        return {"start": m.start(g) + 1, "end": m.end(g), "value": m[g]} if m.start(g) >= 0 else None

    @F.arrow_udf(f"array<struct<start:int,end:int,value:string,groups:array<{span}>>>")
    def run(texts: pa.Array) -> pa.Array:
        found = [None if t is None else [part(m, 0) | {"groups": [part(m, g) for g in range(1, compiled.groups + 1)]} for m in compiled.finditer(t)]
                 for t in texts.to_pylist()]
        return pa.array(found, pa.list_(match))

    return run(_c(col))


def regexp_matches(df: DataFrame, col: str, pattern: str, groups: int,
                   keep: Sequence[str] = ()) -> DataFrame:
    """``CROSS APPLY REGEXP_MATCHES``: one row per match with match_id,
    start_position, end_position (inclusive), match_value and each capture
    group (NULL if it took no part). Rows without a match produce nothing.

    Matches and groups are found on the whole text in one pass, so look-behind
    sees what lies before a match; no text is shuffled.
    """
    found = df.select(*keep, F.col(col), match_spans(col, pattern).alias("_m"))
    rows = found.select(*keep, F.col(col), F.posexplode("_m").alias("_k", "_e"))
    return rows.select(
        *keep, F.col(col), (F.col("_k") + 1).cast("int").alias("match_id"), F.col("_e.start").alias("start_position"),
        F.col("_e.value").alias("match_value"), F.col("_e.end").alias("end_position"),
        *[F.col("_e.groups")[g]["value"].alias(f"group_{g + 1}") for g in range(groups)])


def regexp_split(df: DataFrame, col: str, pattern: str, keep: Sequence[str] = (),
                 value: str = "value", ordinal: str = "ordinal") -> DataFrame:
    """``OUTER APPLY REGEXP_SPLIT_TO_TABLE``: pieces with a 1-based
    ordinal; a NULL text keeps its row with NULLs."""
    return df.select(*keep, F.col(col),
                     F.posexplode_outer(F.split(F.col(col), pattern, -1)).alias("_pos", value)
                     ).select(*keep, F.col(col), F.col(value),
                              (F.col("_pos") + 1).cast("int").alias(ordinal))
