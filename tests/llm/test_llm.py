"""Operators of the llm subpackage on small inputs: oracle SQL, brute force,
round trips, held-out accuracy, and the corner cases every operator defines."""

import hashlib
import os
import re
import sys
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import SF01  # noqa: E402

import corpus_pipeline as P  # noqa: E402
from tessera.llm import chat, decontam, langid, lines, materialise, mixing, ngram_join, quality, queries, toxicity, vector_graph  # noqa: E402
from tessera.llm.common import connected_components, fold, scratch_path  # noqa: E402
from tessera.llm.tokenizer import encoder  # noqa: E402
from tools.oracle_check import TABLES, rows_of  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, __b int"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
ODD = [(1, None, None, None, None, "clash", 1), (2, "", "en", "a", 0, None, 2), (3, "same text of a few words here", "en", "a", 9, None, 3),
       (3, "same text of a few words here", "en", "a", 9, None, 3), (4, "same text of a few words here", "de", None, 9, None, 3),
       (None, "no id at all in this row", None, "b", 1, None, None), (5, LONG, "en", "b", len(LONG), None, 0), (6, "Ünï ©ode 日本", "fr", "c", 3, None, 1)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got, exp = queries.QUERIES[name](spark, SF01).toPandas(), duck.execute(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert rows_of(got) == rows_of(exp)


def test_escape_is_reversible():
    for s in ["", "<|im_end|>", r"<\|x", r"<\\\|<||>", "a<b|c", "<|" * 50]:
        assert chat.unescape(chat.escape(s)) == s and "<|" not in chat.escape(s)


def test_chat_corner_cases(spark):
    turns = spark.createDataFrame([(None, 1, "user", "x"), (7, None, None, None), (7, 1, "assistant", LONG), (7, 1, "assistant", "a"), (7, 1, "assistant", "a")],
                                  "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    assert got[7]["n_turns"] == 4 and got[7]["loss_chars"] == len(LONG) + 2
    assert got[7]["loss_sha256"] == hashlib.sha256(("aa" + LONG).encode()).hexdigest()
    assert got[None]["turns_sha256"] == hashlib.sha256(b"user\nx\n").hexdigest()
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def test_encoder_round_trip_and_plain_pattern():
    e = encoder()
    for s in ["", " a  b\t\n c ", "x" * 20_000, LONG, "Ünï ©ode 日本 it's 12,3"]:
        assert e.decode(e.encode(s)) == s
    for s in ["it's one line.\nAnother 12 %%% line", "Ünï ©ode 日本"]:
        assert e.encode(s) == e.enc.encode_ordinary(s)


def test_permutation_is_one_to_one():
    for n in (1, 2, 3, 17, 1000, 4097):
        assert sorted(materialise.permute(np.arange(n), n, "k").tolist()) == list(range(n))
    assert (materialise.permute(np.arange(1000), 1000, "a") != materialise.permute(np.arange(1000), 1000, "b")).any()


def test_shards_hold_every_sequence(spark, odd, none):
    out = materialise.fresh_output(spark)
    man = materialise.materialise(odd, out, seq_len=64, slots_per_shard=500)
    got = materialise.read_shards(spark, out, 64, 500).collect()
    enc, want = encoder(), []
    for d, t, *_ in ODD:
        ids = np.asarray(enc.encode(t or ""), "<u2")
        want += [(d, k // 64, len(ids[k:k + 64]), zlib.crc32(ids[k:k + 64].tobytes())) for k in range(0, len(ids), 64)]
    key = lambda x: (x[0] is None, x)
    assert sorted(((r["doc_id"], r["seq_no"], r["n_tokens"], r["ids_crc32"]) for r in got), key=key) == sorted(want, key=key)
    assert sorted(r["slot"] for r in got) == list(range(len(want)))
    assert man.agg(F.sum("n_slots")).head()[0] == len(want)
    doc, seq, ids = materialise.read_sequence(out, 7, 64, 500)
    assert (doc, seq, len(ids)) in {(r["doc_id"], r["seq_no"], r["n_tokens"]) for r in got if r["slot"] == 7}
    assert materialise.materialise(none, materialise.fresh_output(spark)).count() == 0


def test_mix_corner_cases(spark, odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == len(ODD) and all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mix(none).count() == 0
    assert mixing.mixed_rows(odd).columns == odd.columns
    assert sorted(map(str, mixing.mix(odd).collect())) == sorted(map(str, got))


def test_mix_with_weights_stays_near_its_targets(spark):
    d = spark.range(3000).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "repeat('w ', int(1 + id % 40)) AS text", "double(1 + id % 5) AS w")
    per = mixing.mix(d, weight_col="w", keep=("source",)).groupBy("source").agg(F.sum("taken").alias("k"), F.first("target").alias("t")).collect()
    assert all(abs(r["k"] - r["t"]) <= 0.02 * r["t"] for r in per)


def test_lines_corner_cases(spark):
    page = "<p>Menu</p><p>text {}</p>"
    rows = [(i, "http://a.example/x", page.format(i), 1) for i in range(10)] + [(90, None, None, 1), (91, "not a url", "", 1), (1, "http://a.example/x", page.format(1), 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = lines.drop_boilerplate(df).collect()
    assert len(got) == 13
    assert {r["text"] for r in got if r["page_id"] < 90} == {f"text {i}" for i in range(10)}
    assert all(r["n_lines"] == 0 and r["text"] == "" for r in got if r["page_id"] >= 90)
    assert lines.drop_boilerplate(df.limit(0)).count() == 0


def test_lines_salted_join_equals_broadcast(spark, monkeypatch):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    small = sorted(lines.drop_boilerplate(pages).collect())
    monkeypatch.setattr(lines, "BROADCAST_BYTES", -1)
    assert sorted(lines.drop_boilerplate(pages, salts=5).collect()) == small


def test_components_on_a_chain_and_a_star(spark):
    e = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(5, 5)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}}


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80), (2, 60)])
def test_join_against_brute_force(spark, width, percent):
    rng = np.random.default_rng(width)
    texts = []
    for g in range(12):
        base = [f"v{x}" for x in rng.integers(0, 400, rng.integers(3, 120))]
        for _ in range(9):
            w = list(base)
            for _ in range(rng.integers(0, 5)):
                w[rng.integers(0, len(w))] = f"v{rng.integers(0, 400)}"
            texts.append("  ".join(w))
    texts += ["", " \t", "one", "ONE", "a b c"]
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(texts)))
    for _ in range(len(texts)):
        for i in range(len(texts)):
            for j in range(i):
                n = len(sets[i] & sets[j])
                if n and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                    root[i] = root[j] = min(root[i], root[j])
        if all(root[r] == r for r in root):
            break
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(df, width=width, percent=percent).collect()}
    assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}


def test_join_corner_cases(spark, odd, none):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(odd).collect()]
    assert sorted(c for d, n, c in got if d in (3, 4)) == [3, 3, 3] and (1, 0, 1) in got and (2, 0, 2) in got
    assert ngram_join.jaccard_components(none).count() == 0
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "5", "6", "None"]


def test_keep_one_selects_rows_where_ids_repeat_or_are_null(spark):
    a, b, c, d, e = (" ".join(f"{k}{i}" for i in range(20)) for k in "abcde")
    rows = [(1, a), (1, b), (2, b), (3, a), (4, c), (5, c), (5, d), (0, d), (None, e), (None, e), (None, a), (None, "lone words"), (6, " ")]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["text"], str(r["doc_id"])) for r in kept) == sorted(
        [(a, "1"), (b, "1"), (c, "4"), (d, "0"), (e, "None"), ("lone words", "None"), (" ", "6")])


def test_keep_one_shuffles_no_texts_and_leaves_no_join_tables(spark, monkeypatch):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder))
    texts = [" ".join(f"{k}{i}" for i in range(30)) for k in range(40)]
    df = spark.createDataFrame(list(enumerate([*texts, *texts[:10], " ", None])), "doc_id long, text string")
    kept = ngram_join.keep_one(df)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(40), 50, 51]
    left = set(os.listdir(folder)) - before
    assert not [x for x in left if x.startswith("join-")] and [x for x in left if x.startswith("keep-")]
    # a bit table that is full leaves rows open: those are joined
    monkeypatch.setattr(ngram_join, "NEED_BITS", 4)
    kept = ngram_join.keep_one(df)
    assert "Exchange" in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(40), 50, 51]


def test_only_sets_of_pairs_are_compared(spark):
    sets = spark.createDataFrame([(k << 44, list(range(k, k + 20))) for k in range(50)], "sid long, s array<long>")
    pairs = spark.createDataFrame([(1 << 44, 2 << 44), (3 << 44, 30 << 44)], "a long, b long")
    assert {r["sid"] >> 44 for r in ngram_join._marked_rows(sets, pairs.selectExpr("explode(array(a, b)) sid")).collect()} == {1, 2, 3, 30}
    assert [tuple(r) for r in ngram_join._verified(pairs, sets, 85).collect()] == [(1 << 44, 2 << 44)]


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(700, 16))
    v[100:160] = v[100] + rng.normal(size=(60, 16)) * 0.1
    v[200:205] = v[200]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [
        (900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, []), (905, [1.0, 0.0]), (906, [1.0, 0.0]), (907, [1e-200] * 16), (908, [1e200] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in vector_graph.near_duplicates(df, shard_size=60).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    links = ((u @ u.T) >= 0.95).sum(axis=1) - 1
    found = np.array([got[i]["n_links"] for i in range(700)])
    assert (found <= links).all() and found.sum() >= 0.97 * links.sum()
    assert got[905]["n_links"] == 1 and got[906]["component_id"] == 905 and got[908]["component_id"] == 907
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (900, 901, 902, 903, 904))
    assert vector_graph.near_duplicates(df.limit(0)).count() == 0


def test_automaton_against_brute_force(spark):
    rng = np.random.default_rng(1)
    items = [(i, " ".join(f"t{x}" for x in rng.integers(0, 6, n))) for i, n in enumerate([3, 5, 8, 12, 12, 20, 1, 0])] + [(8, None), (9, "T1 t2; t3")]
    docs = [(i, " ".join(f"t{x}" for x in rng.integers(0, 6, 60))) for i in range(60)] + [(99, None), (98, "")]
    found = decontam.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=4,
                                block_words=20)
    for r in found.collect():
        w = re.findall(r"[a-z0-9]+", (r["text"] or "").lower())
        hit, ids = set(), set()
        for i, t in items:
            x = re.findall(r"[a-z0-9]+", (t or "").lower())
            k = min(4, len(x))
            for s in range(len(x) - k + 1 if k else 0):
                for p in range(len(w) - k + 1):
                    if w[p:p + k] == x[s:s + k]:
                        hit.update(range(p, p + k))
                        ids.add(str(i))
        assert sum(s["end"] - s["start"] for s in r["spans"]) == len(hit) and r["items"] == sorted(ids) and r["n_words"] == len(w)


def test_decontaminate_cuts_spans(spark, odd, none):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame([(1, f"Keep this here and that too, plus more words: {item.upper()}. And the end of it all is here now."), (2, item), (3, "clean")], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in decontam.decontaminate(docs, items).collect()}
    assert got == {1: "Keep this here and that too, plus more words: . And the end of it all is here now.", 3: "clean"}
    assert decontam.decontaminate(none, items).count() == 0
    assert decontam.decontaminate(odd, items.limit(0)).count() == len(ODD)


def test_language_held_out_accuracy(spark, odd, none):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = langid.train(docs, fold(F.col("doc_id"), 5) != 0)
    out = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(fold(F.col("doc_id"), 5) == 0)
    assert out.where("lang = lang_pred").count() >= 0.98 * out.count()
    got = {r["doc_id"]: r for r in langid.identify(odd, model).collect()}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == "und" and got[1]["score"] == 0.0 and got[1]["rejected"]
    assert 0 <= got[5]["score"] <= 1
    empty = langid.train(none, F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(odd, empty).collect()} == {"und"}


def test_language_training_takes_every_language_and_whole_texts(spark, monkeypatch):
    rows = langid.training_rows(spark.range(2400).select(F.col("id").alias("doc_id"), (F.col("id") % 1200).cast("string").alias("lang"),
                                                         F.lit("a few words").alias("text")), F.col("lang"), F.lit(True), "doc_id", "text", 700, "t")
    assert rows.select("label").distinct().count() == 1200
    rng = np.random.default_rng(5)
    long = " ".join("".join(chr(97 + k) for k in rng.integers(0, 26, 7)) for _ in range(2000))
    got, lists = [], langid.list_arrays
    monkeypatch.setattr(langid, "list_arrays", lambda c: got.append(lists(c)) or got[-1])
    langid.train(spark.createDataFrame([(1, long, "x"), (2, "other words", "y")], "doc_id long, text string, lang string"), F.lit(True), epochs=1)
    buf = np.frombuffer(langid.letters(long), dtype=np.uint8)
    assert max(len(x) for x in got[0]) == len(np.unique(np.concatenate([langid.subword_buckets(buf, n, 15)[1] for n in (2, 3, 4)]))) > 1500


def test_quality_training_reads_whole_texts(spark):
    long = " ".join(f"{chr(97 + i % 26)}{'bcdfghklmn'[i // 26 % 10]}{'aeiouxyzqw'[i // 260 % 10]}{chr(97 + i // 2600)}" for i in range(6000))
    docs = spark.createDataFrame([(i, long if i < 6 else "short plain words") for i in range(12)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 6)) for i in range(12)], "doc_id long, quality int")
    model, buckets = quality.train(docs, labels, F.lit(True)), quality.indicators(long, 18)
    assert len(buckets) > 6000 and (model.ratio[buckets] != 0).mean() > 0.99


def test_classifiers_held_out_accuracy(spark, odd, none):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    out = queries.op10_quality(spark, SF01).join(labels, "doc_id").where("held_out")
    assert out.where("predicted = quality").count() >= 0.92 * out.count()
    out = queries.op9_toxicity(spark, SF01).join(labels, "doc_id").where("held_out AND quality = 1")
    assert out.where("predicted = toxic").count() >= 0.95 * out.count()
    for mod, score in ((quality, quality.score_quality), (toxicity, toxicity.score_toxicity)):
        empty = mod.train(none, labels.limit(0), F.lit(True))
        assert {r["score"] for r in score(odd, empty).collect()} == {0.5}
        assert score(none, empty).count() == 0
        model = mod.train(docs, labels, F.lit(True))
        assert all(0 <= r["score"] <= 1 for r in score(odd, model).collect())


@pytest.mark.parametrize("mod, score", [(quality, quality.score_quality), (toxicity, toxicity.score_toxicity)])
def test_scores_do_not_follow_the_size_of_the_sample(spark, mod, score):
    """Texts that say nothing about a label of five in six score about that, whether the sample holds all rows or as many of each class."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 40, 12)) for _ in range(900)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 6 > 0)) for i in range(600)], "doc_id long, label int")
    for per_class in (600, 100):
        model = mod.train(docs, labels, F.lit(True), label_col="label", per_class=per_class)
        mean = score(docs.where("doc_id >= 600"), model).agg(F.avg("score")).head()[0]
        assert abs(mean - 5 / 6) < 0.08, (per_class, mean)


def test_toxicity_folds_disguises_and_spares_exceptions():
    m = toxicity.ToxicityModel({"idiot": 3.0, "troll*": 2.0}, ("troll doll",))
    a = m.automaton()
    for s in ["you IDIOT!", "1d10t", "ïdîot", "іdіоt", "trolling", "i​diot"]:
        assert m.features(s, a)[2] > 0, s
    for s in ["troll doll", "idiotic", "patrolled", "", None, "10 2024"]:
        assert m.features(s, a)[2] == 0, s


def test_pipeline_stages(spark):
    docs, counts = spark.read.parquet(f"{SF01}/documents.parquet"), []
    columns = docs.columns
    for name, stage in P.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, SF01).write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "near_duplicates":
            assert docs.select("doc_id").distinct().count() == counts[-1]
        if name == "decontaminate":
            assert decontam.find_leaks(docs, spark.read.parquet(f"{SF01}/benchmark.parquet")).where("size(spans) > 0").count() == 0
    assert 1000 > counts[0] >= counts[1] >= counts[2] > 0
    assert docs.agg(F.max("slot")).head()[0] == counts[-1] - 1
