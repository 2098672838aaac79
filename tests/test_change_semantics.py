"""Change collapse, masks and history periods on tiny hand-made logs."""

from pyspark.sql import functions as F

from tessera.operators import changes as C
from tessera.operators import history as H

COLS = ["name", "city"]


def log(spark, rows):
    return spark.createDataFrame(rows, "k int, v long, op string, name string, city string")


def test_changes_since_collapse_and_mask(spark):
    lg = log(spark, [
        (1, 1, "I", "ana", "madrid"), (1, 5, "U", "ana", "sevilla"), (1, 6, "U", "ana", "sevilla"),  # city changed
        (2, 2, "I", "luis", "vigo"), (2, 7, "D", "luis", "vigo"),                                    # deleted after
        (3, 6, "I", "eva", "leon"), (3, 8, "D", "eva", "leon"),                                      # in and out after
        (4, 3, "I", "rob", "cadiz"), (4, 6, "D", "rob", "cadiz"), (4, 9, "I", "rob", "soria"),      # deleted, back
        (5, 8, "I", "sol", "jaen"),                                                                  # new after
        (6, 1, "I", "pep", "lugo"),                                                                  # untouched
    ])
    got = {r.k: (r.CT_Operation, r.CT_Version, r.CT_Columns)
           for r in C.changes_since(lg, "k", "v", "op", COLS, 4).collect()}
    assert got == {1: ("U", 6, 2), 2: ("D", 7, None), 3: ("D", 8, None), 4: ("U", 9, 2), 5: ("I", 8, None)}


def test_net_changes_drop_in_and_out(spark):
    lg = log(spark, [(1, 1, "I", "a", "x"), (1, 2, "D", "a", "x"), (2, 1, "I", "b", "y"), (2, 3, "U", "b", "z"),
                     (3, 2, "U", "c", "w"), (4, 3, "D", "d", "q")])
    got = {r.k: (r.operation, r.commit_id, r.city) for r in C.net_changes(lg, "k", "v", "op", COLS, 1, 3).collect()}
    assert got == {2: (C.CDC_INSERT, 3, "z"), 3: (C.CDC_AFTER, 2, "w"), 4: (C.CDC_DELETE, 3, "q")}


def test_all_changes_codes_masks_and_before_images(spark):
    lg = log(spark, [(1, 1, "I", "a", "x"), (1, 2, "U", "A", "x"), (1, 3, "U", "A", "y"), (1, 4, "D", "A", "y"),
                     (2, 3, "U", "b", "q")])
    rows = C.all_changes(lg, "k", "v", "op", COLS, 2, 4, with_before=True).orderBy("commit_id", "operation").collect()
    got = sorted(((r.k, r.commit_id, r.operation, r.update_mask, r.name, r.city) for r in rows),
                 key=lambda x: (x[1], x[2], x[0]))
    assert got == sorted([
        (1, 2, C.CDC_BEFORE, 1, "a", "x"), (1, 2, C.CDC_AFTER, 1, "A", "x"),
        (1, 3, C.CDC_BEFORE, 2, "A", "x"), (1, 3, C.CDC_AFTER, 2, "A", "y"),
        (2, 3, C.CDC_BEFORE, 3, None, None), (2, 3, C.CDC_AFTER, 3, "b", "q"),
        (1, 4, C.CDC_DELETE, 3, "A", "y")], key=lambda x: (x[1], x[2], x[0]))


def test_snapshot_diff_and_current_state(spark):
    before = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", "z")], "k int, name string, city string")
    after = spark.createDataFrame([(1, "a", "x"), (2, "b", "w"), (4, "d", "q")], "k int, name string, city string")
    got = {r.k: (r.operation, r.mask) for r in C.snapshot_diff(before, after, "k", COLS).collect()}
    assert got == {2: ("U", 2), 3: ("D", None), 4: ("I", None)}
    lg = log(spark, [(1, 1, "I", "a", "x"), (1, 2, "D", "a", "x"), (2, 1, "I", "b", "y")])
    assert [r.k for r in C.current_state(lg, "k", "v", "op", COLS).collect()] == [2]


def test_history_ties_zero_length_and_as_of(spark):
    versions = spark.createDataFrame(
        [(1, 10, "2024-01-01 00:00:00", "a"), (1, 11, "2024-01-01 00:00:00", "b"),  # same instant: a lasts 0
         (1, 12, "2024-01-03 00:00:00", "c"), (2, 20, "2024-01-02 00:00:00", "z")],
        "k int, seq int, ts string, val string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    hist = H.build_history(versions, "k", "ts", "seq").orderBy("k", "seq").collect()
    assert [(r.k, r.val, str(r.valid_from), str(r.valid_to)) for r in hist] == [
        (1, "b", "2024-01-01 00:00:00", "2024-01-03 00:00:00"),
        (1, "c", "2024-01-03 00:00:00", H.END_OF_TIME),
        (2, "z", "2024-01-02 00:00:00", H.END_OF_TIME)]
    h = H.build_history(versions, "k", "ts", "seq")
    assert sorted((r.k, r.val) for r in H.as_of(h, "2024-01-02 12:00:00").collect()) == [(1, "b"), (2, "z")]
    assert sorted((r.k, r.val) for r in H.between(h, "2024-01-02 00:00:00", "2024-01-03 00:00:00").collect()) == [
        (1, "b"), (1, "c"), (2, "z")]
    probes = spark.createDataFrame([(1, "2023-12-31 00:00:00"), (1, "2024-01-03 00:00:00"), (2, "2024-01-05 00:00:00"),
                                    (3, "2024-01-05 00:00:00")], "k int, t string").withColumn(
        "t", F.col("t").cast("timestamp_ntz"))
    joined = H.as_of_join(probes, h.select("k", "val", "valid_from", "valid_to"), "k", "t", ["val"])
    assert sorted((r.k, str(r.t), r.val) for r in joined.collect()) == [
        (1, "2023-12-31 00:00:00", None), (1, "2024-01-03 00:00:00", "c"),
        (2, "2024-01-05 00:00:00", "z"), (3, "2024-01-05 00:00:00", None)]


def test_commit_range_and_retention(spark):
    commits = spark.createDataFrame([(1, "2024-01-18 10:00:00"), (2, "2024-01-19 09:00:00"),
                                     (3, "2024-01-19 12:00:00"), (4, "2024-01-20 08:00:00")],
                                    "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    r = C.commit_range(commits, "id", "ts", "2024-01-19 00:00:00", "2024-01-20 00:00:00").first()
    assert (r.from_commit, r.to_commit) == (2, 3)
    kept = C.retain(commits, "ts", 2, "2024-01-20 09:00:00")
    b = C.version_bounds(kept, "id").first()
    assert (b.min_valid_version, b.current_version) == (1, 4)
    assert C.version_bounds(C.retain(commits, "ts", 1, "2024-01-20 09:00:00"), "id").first().min_valid_version == 2
