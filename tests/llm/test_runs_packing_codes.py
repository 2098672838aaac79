"""Periodic runs, packing and vector codes: brute force, exact round trips, and
the corner cases they define."""

import os
import random
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import SF001  # noqa: E402

from tessera.llm import packing, periodic, queries, vector_codes  # noqa: E402

DOCS = "doc_id long, text string, runs string, size string, __b int"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(60_000)) + " so it is" * 40
ODD = [(1, None, None, "clash", 1), (2, "", "r", None, 2), (3, "la la la la la la", "r", None, 3), (3, "la la la la la la", "r", None, 3),
       (None, "no id at all in this row", None, None, None), (5, LONG, "x", None, 0), (6, "Ünï ©ode 日本 <|endoftext|> it's é", "c", None, 1),
       (7, " \t\n ", "w", None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


# ---- periodic runs --------------------------------------------------------------------------------

def brute_runs(words, min_length=6, min_periods=4):
    """Every lag, every maximal match, smallest periods only."""
    out = []
    for q in range(1, len(words) // min_periods + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            seg = words[start:i + q]
            if len(seg) >= max(min_length, min_periods * q) and not any(seg[p:] == seg[:-p] for p in range(1, q)):
                out.append((start, len(seg), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def as_tuples(found):
    return [(r["start"], r["length"], r["period"]) for r in found[1]]


@given(st.lists(st.tuples(st.text("abc", max_size=8), st.integers(1, 9), st.text("ab", max_size=3)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_runs_equal_brute_force(parts):
    docs = [list(phrase * times + end) for phrase, times, end in parts]
    docs.append([w for d in docs for w in d])
    for words, found in zip(docs, periodic.search([" ".join(w).encode() for w in docs])):
        assert as_tuples(found) == brute_runs(words)


@pytest.mark.parametrize("min_length,min_periods", [(6, 3), (2, 5), (20, 4), (10, 10)])
def test_runs_with_other_thresholds(min_length, min_periods):
    rng = random.Random(min_length)
    for _ in range(300):
        words = []
        while len(words) < 120:
            phrase = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
            words += phrase * rng.randint(1, 12)
        [found] = periodic.search([" ".join(words).encode()], min_length, min_periods)
        assert as_tuples(found) == brute_runs(words, min_length, min_periods)


def test_large_periods_and_many_documents_in_one_group():
    rng = random.Random(5)
    phrase = [f"w{rng.randrange(9)}" for _ in range(700)]
    docs = [phrase * 4 + phrase[:13], phrase * 3 + phrase[:699], ["x"] * 5_000, ["y"]]
    found = periodic.search([" ".join(w).encode() for w in docs])
    assert as_tuples(found[0]) == [(0, 2_813, 700)] and not found[1][1] and as_tuples(found[2]) == [(0, 5_000, 1)] and not found[3][1]
    assert found[0][2] == " ".join(phrase).encode() and found[2][2] == b"x"


def test_run_corner_cases(spark, odd):
    rows = periodic.periodic_runs(odd, keep=("doc_id", "size")).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ODD) and got[1]["n_words"] == 0 == got[2]["n_words"] == got[7]["n_words"] and got[1]["collapsed"] == ""
    assert [tuple(r) for r in got[3]["runs"]] == [(0, 6, 1)] and got[3]["collapsed"] == "la" and sum(r["doc_id"] == 3 for r in rows) == 2
    assert [tuple(r) for r in got[5]["runs"]] == [(60_000, 120, 3)] and got[5]["collapsed"].endswith("so it is") and got[1]["size"] == "clash"
    assert got[None]["collapsed"] == "no id at all in this row"
    assert periodic.periodic_runs(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(odd, min_periods=2)


# ---- packing --------------------------------------------------------------------------------------

def whole_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [[*e.ids, packing.END_ID] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check_pieces(rows, wanted):
    """Every id of every document in one piece, sequences gapless and full but for one, step groups of one size."""
    docs, sequences, steps = {}, {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"] > 0
        steps.setdefault(r["step_id"], {})[r["sequence_id"]] = r["window"]
    assert set(docs) == set(wanted)
    for k, pieces in docs.items():
        pieces.sort(key=lambda r: r["start"])
        ids = np.frombuffer(b"".join(r["ids"] for r in pieces), "<u4").tolist()
        assert ids == wanted[k] and {r["doc_tokens"] for r in pieces} == {len(ids)}
        assert [r["start"] for r in pieces] == [sum(p["length"] for p in pieces[:i]) for i in range(len(pieces))]
    short = 0
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == [sum(p["length"] for p in pieces[:i]) for i in range(len(pieces))]
        total = sum(r["length"] for r in pieces)
        assert len({(r["window"], r["step_id"]) for r in pieces}) == 1 and total <= pieces[0]["window"]
        short += total < pieces[0]["window"]
    assert all(len(set(s.values())) == 1 and sum(s.values()) <= 16_384 for s in steps.values())
    return short


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").repartition(3)
    texts = docs.select("doc_id", "text").collect()
    wanted = dict(zip([r[0] for r in texts], whole_ids([r[1] for r in texts])))
    rows = packing.pack_documents(docs).collect()
    assert check_pieces(rows, wanted) <= 1
    assert {r["window"] for r in rows} <= set(packing.TIERS) and len({r["window"] for r in rows}) > 1


def test_packing_units_and_carried_rests(monkeypatch):
    rng = random.Random(2)
    for tiers in [(2048, 1024, 512, 256), (64, 8), (16,), (1024, 32, 16, 1)]:
        packer, rows, wanted = packing.Packer(0, tiers, 4 * tiers[0], True), [], {}
        for d in range(400):
            ids = np.array([rng.randrange(49_000) for _ in range(rng.choice([1, 2, 7, 30, 300, 1_500]))], "<u4")
            wanted[d] = ids.tolist()
            packer.add((d,), ids.tobytes(), 0, len(ids))
            if packer.pool.tokens >= 9_000:
                rows += packer.unit()
        rows += packer.end()
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_id", "ids", "rest"]
        assert check_pieces([dict(zip(names, r)) for r in rows], wanted) <= 1


def test_step_groups_are_balanced():
    rng = random.Random(4)
    packer = packing.Packer(0, (2048, 1024, 512, 256), 16_384, True)
    for d in range(3_000):
        packer.add((d,), bytes(4 * rng.randint(1, 2_600)), 0, 0)
    cost = {}
    for r in packer.unit():
        if r[7] == 2048:
            cost[r[8]] = cost.get(r[8], 0) + r[2] ** 2
    assert len(cost) > 50 and max(cost.values()) < 1.25 * min(cost.values())


def test_packing_corner_cases(spark, odd):
    distinct = odd.dropDuplicates(["doc_id"])
    texts = distinct.collect()
    wanted = dict(zip([r[0] for r in texts], whole_ids([r[1] for r in texts])))
    assert wanted[1] == wanted[2] == wanted[7] == [1] and 49407 in wanted[6]
    assert check_pieces(packing.pack_documents(distinct).collect(), wanted) <= 1
    assert packing.pack_documents(odd.where("doc_id = 3"), keep=("doc_id", "size")).agg({"length": "sum"}).head()[0] == 2 * len(wanted[3])
    assert packing.pack_documents(odd.limit(0)).count() == 0
    assert packing.pack_documents(odd, with_ids=False).where("ids IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(odd, tiers=(100,))


def test_word_cache_equals_the_tokenizer(spark):
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as fh:
        ids = packing.WordIds(fh.read())
    ids.kept = ids.parts.kept = 3  # generations change often
    texts = ["It's I'LL we'Ve 3.14 a b ΣΑΣ İstanbul ﬁ a\x1cb\x00c 'S", "<|startoftext|>x <|endoftext|>", "é é ́x ½² ​　z", "x" * 3_000]
    for text, want in zip(texts, whole_ids(texts)):
        assert [*np.frombuffer(ids.text_ids(text.encode()), "<u4").tolist(), 1] == want


# ---- vector codes ---------------------------------------------------------------------------------

def brute_codes(rows, parts=4, entries=256, rounds=4):
    """The definition in Python integers; ``rows`` are (id, label, vector), valid and in order of id."""
    import math

    ints = [[math.floor(1024 * float(np.float32(x))) for x in v] for _, _, v in rows]
    w = len(ints[0]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for v in ints]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            at = [near(c[p], books[p])[1] for c in cut]
            for e in set(at):
                mine = [c[p] for c, i in zip(cut, at) if i == e]
                books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    out = []
    for (k, label, _), c in zip(rows, cut):
        best = [near(c[p], books[p]) for p in range(parts)]
        out.append((k, label, "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best)))
    return out, books


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, code string")


@pytest.mark.parametrize("scale", [1.0, 3e5])
def test_codes_equal_brute_force(spark, scale):
    rng = np.random.default_rng(8)
    rows = [(i, int(i % 3) or None, [float(x) for x in np.float32(scale * rng.normal(size=8))], "clash") for i in range(120)]
    rows += [(1_000 + i, 7, rows[5][2], "copy") for i in range(80)]  # one hot vector
    codes, book = vector_codes.compress(vectors(spark, rows), entries=16)
    want, books = brute_codes([r[:3] for r in rows], entries=16)
    assert book.tolist() == books
    got = sorted(((r["vec_id"], r["label"], r["code"], r["error"]) for r in codes.collect()), key=lambda r: r[0])
    assert got == want
    sums = {}
    for _, label, _, e in want:
        sums[label] = sums.get(label, 0) + e
    assert all(r["label_error"] == sums[r["label"]] for r in codes.collect())


def test_members_move_only_when_their_entry_changes(spark):
    """Owners of one entry that nobody leaves are not among the moves."""
    book = vector_codes.Codebook(np.array([[[0], [100]]]), np.array([[1, 3]]))
    shared = type("B", (), {"value": book})
    rows, parts = np.arange(6), np.array([[1], [2], [99], [98], [60], [0]])
    got = list(vector_codes._moves(shared)([((0, 0, 0), (rows, parts))]))
    assert got[0][0] == (0, 0, 0) and not got[0][1][0] and got[0][1][1].tolist() == [0, 1, 5]
    assert all(m[1][0] and m[0][:2] == (0, 1) for m in got[1:]) and sorted(x for m in got[1:] for x in m[1][1].tolist()) == [2, 3, 4]


def test_code_corner_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, None, [1.0, 2.0, 3.0, 4.0], "a"), (2, None, None, "b"), (3, 1, [1.0, None, 0.0, 0.0], None), (4, 1, [nan, 0.0, 0.0, 0.0], None),
            (5, 1, [0.0, inf, 0.0, 0.0], None), (6, 2, [0.0, 0.0, 0.0, -0.0], None), (6, 2, [0.0, 0.0, 0.0, -0.0], None), (7, 1, [-0.0001, 0.0, 0.0, 5.0], None)]
    codes, book = vector_codes.compress(vectors(spark, rows))
    got = codes.collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in got) == [(False, 6), (False, 6), (False, 7), (True, 0)]
    assert {r["error"] for r in got} == {0} and book.shape == (4, 4, 1) and len({r["code"] for r in got if r["vec_id"] == 6}) == 1
    assert book[0, 2, 0] == -1  # floors go down
    empty, none = vector_codes.compress(vectors(spark, rows[1:5]))
    assert empty.count() == 0 and none.size == 0 and empty.columns == codes.columns
    with pytest.raises(ValueError):
        vector_codes.compress(vectors(spark, [(1, 1, [1.0] * 6, "x")]))
    with pytest.raises(ValueError):
        vector_codes.compress(vectors(spark, [(1, 1, [1.0] * 4, "x"), (2, 1, [1.0] * 8, "x")]))


def test_new_queries_are_registered():
    assert {"op11_periodic_runs", "op12_packing", "op13_vector_codes"} <= set(queries.QUERIES)
    assert {"op11_periodic_runs", "op13_vector_codes"} <= set(queries.ORACLE)
