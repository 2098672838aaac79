"""Text search over a text column (M1, M2).

Texts are tokenised whole with a built-in split (no Python), exploded to an
inverted index of (row, token), and matched against the query's word forms
with a semi-join or join. The forms table is built from the query, so its
size is bounded by the query, never by the data - that is what makes the
broadcast safe.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Word separators (anything not a letter or a digit) and the
# light suffix rule used for word forms.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
FORM_SUFFIXES = ("", "s", "es")


def tokens(df: DataFrame, id_col: str, text_col: str, name: str = "token") -> DataFrame:
    """(id, token) for every word of every text, lower-cased."""
    return (df.select(id_col, F.explode(F.split(F.lower(F.col(text_col)), TOKEN_SPLIT)).alias(name))
            .where(F.col(name) != ""))


def query_words(query: str) -> list[str]:
    import re

    # the same words as TOKEN_SPLIT gives: an underscore separates
    return [w for w in re.split(r"[\W_]+", query.lower()) if w]


def word_forms(words: Sequence[str], forms: bool = True,
               synonyms: Mapping[str, Sequence[str]] | None = None) -> list[tuple[str, str]]:
    """(term, form) pairs: each query word and its synonyms are terms; each
    term matches itself and, with ``forms``, its suffixed forms and, where it
    ends in a suffix itself, the word without it and that word's forms."""
    terms: list[str] = []
    for w in words:
        for term in [w, *((synonyms or {}).get(w, ()))]:
            if term not in terms:
                terms.append(term)
    pairs = []
    for term in terms:
        stems = [term]
        if forms:
            stems += [term[:-len(x)] for x in FORM_SUFFIXES if x and term.endswith(x) and len(term) > len(x) + 2]
        for form in dict.fromkeys(stem + suffix for stem in stems for suffix in (FORM_SUFFIXES if forms else ("",))):
            pairs.append((term, form))
    return pairs


def _forms_df(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(pairs, "term string, form string")


def free_text(df: DataFrame, id_col: str, text_col: str, query: str, forms: bool = True) -> DataFrame:
    """M1: ``FREETEXT(col, query)``: rows whose text holds any query word
    (or one of its forms). The forms are literals, so this is a filter on the
    scan; ``id_col`` is not needed for it."""
    wanted = sorted({f for _, f in word_forms(query_words(query), forms)})
    if not wanted:
        return df.limit(0)
    words = F.split(F.lower(F.col(text_col)), TOKEN_SPLIT)
    return df.where(F.arrays_overlap(words, F.array(*[F.lit(w) for w in wanted])))


def ranked_search(df: DataFrame, id_col: str, text_col: str, query: str, forms: bool = True,
                  synonyms: Mapping[str, Sequence[str]] | None = None, lang: str | None = None,
                  lang_col: str = "lang") -> DataFrame:
    """M2: documents matching the query (word forms and synonyms switchable,
    optional language), ranked by TF-IDF: sum over terms of
    tf(term, doc) * ln(N / df(term))."""
    docs = df.where(F.col(lang_col) == lang) if lang is not None else df
    f = _forms_df(df.sparkSession, word_forms(query_words(query), forms, synonyms))
    n_docs = docs.count()  # one number
    # only the words that are forms leave a text
    wanted = sorted({x for _, x in word_forms(query_words(query), forms, synonyms)}) or [""]
    hits = F.filter(F.split(F.lower(F.col(text_col)), TOKEN_SPLIT), lambda w: w.isin(*wanted))
    found = docs.select(id_col, F.explode(hits).alias("token")).where("token <> ''")
    tf = (found.join(F.broadcast(f), F.col("token") == F.col("form"))
          .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))
    # one row per query term: bounded by the query
    dfreq = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    scored = (tf.join(F.broadcast(dfreq), "term")
              .withColumn("_w", F.col("tf") * F.log(F.lit(float(n_docs)) / F.col("df"))))
    return scored.groupBy(id_col).agg(F.sum("_w").alias("score"))
