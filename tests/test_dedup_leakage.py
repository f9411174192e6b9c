import random
from itertools import combinations

from pyspark.sql import functions as F

from gleanmark.operators import leakage as lk
from gleanmark.operators.dedup import duplicates_beyond_first, keep_first
from gleanmark.plans.splitting import leakage_log, remove_leakage

DUP_EDGES = [
    (5, "a", "x"), (1, "a", "x"), (3, "a", "x"),  # three copies, first row last in file order
    (2, "a", "y"),  # same text, other label
    (4, "b", None), (6, "b", None),  # null label twice
    (7, "a ", "x"),  # equal only after collapsing
    (8, None, "x"), (9, None, "x"),
]


def test_keep_first_by_row_id(spark, rows):
    df = spark.createDataFrame(DUP_EDGES, "row_id long, text string, label string")
    kept = keep_first(df, ["text", "label"], "row_id").select("row_id")
    assert rows(kept) == [(1,), (2,), (4,), (7,), (8,)]


def test_duplicate_counts(spark):
    df = spark.createDataFrame(DUP_EDGES, "row_id long, text string, label string")
    got = df.agg(duplicates_beyond_first("text", "label"), duplicates_beyond_first("text")).first()
    assert tuple(got) == (4, 5)


def test_hot_key_and_any_partitioning(spark, rows):
    rng = random.Random(3)
    data = [(i, "hot" if rng.random() < 0.4 else f"t{rng.randrange(300)}", "l") for i in range(3000)]
    first = {}
    for i, t, _ in data:
        first.setdefault(t, i)
    expected = sorted((i,) for i in first.values())
    for n in (1, 7):
        df = spark.createDataFrame(rng.sample(data, len(data)), "row_id long, text string, label string").repartition(n)
        assert sorted(rows(keep_first(df, ["text", "label"], "row_id").select("row_id"))) == expected


def test_shuffled_join_gives_the_same_rows(spark, rows):
    """Above the broadcast threshold both sides are shuffled; a hot key changes nothing."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(2000).selectExpr("id as row_id", "if(id % 3 = 0, 'hot', concat('t', id % 500)) as text")
        got = {r[0] for r in rows(keep_first(df, ["text"], "row_id").select("row_id"))}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    seen, expected = set(), set()
    for i in range(2000):
        t = "hot" if i % 3 == 0 else f"t{i % 500}"
        if t not in seen:
            seen.add(t)
            expected.add(i)
    assert got == expected


LEAK_EDGES = [
    (1, "tv", "x", "train"), (2, "tv", "x", "val"),
    (3, "tt", "x", "train"), (4, "tt", "x", "test"),
    (5, "vt", "x", "val"), (6, "vt", "x", "test"),
    (7, "all", "x", "train"), (8, "all", "x", "val"), (9, "all", "x", "test"),
    (10, "null", None, "train"), (11, "null", None, "test"),
    (12, "label", "x", "train"), (13, "label", "y", "test"),
    (14, "own", "x", "train"), (15, "own", "x", "train"),
]


def leak_frame(spark):
    return spark.createDataFrame(LEAK_EDGES, "id long, text string, label string, split string")


def test_weaker_split_gives_up_leaked_rows(spark, rows):
    kept = lk.drop_leakage(leak_frame(spark), ["text", "label"], "split").select("id")
    assert rows(kept) == sorted([(i,) for i in (2, 4, 6, 9, 11, 12, 13, 14, 15)], key=repr)


def test_leakage_log_counts_the_nearer_split_first(spark, rows):
    log = leakage_log(lk.tag_leakage(leak_frame(spark), ["text", "label"], "split"))
    # train holds ids 1 3 7 10 12 14 15; 1 and 7 are in val, then 3 and 10 in test
    assert rows(log) == [
        ("train", "drop_leakage_vs_test", 5, 3, 2),
        ("train", "drop_leakage_vs_val", 7, 5, 2),
        ("val", "drop_leakage_vs_test", 3, 1, 2),
    ]


def test_overlap_counts_and_rows(spark, rows):
    df = leak_frame(spark)
    sets = {s: {(t, lb) for _, t, lb, x in LEAK_EDGES if x == s} for s in ("train", "val", "test")}
    expected = sorted((f"{a}-{b}", len(sets[a] & sets[b])) for a, b in combinations(("train", "val", "test"), 2))
    assert rows(lk.overlap_counts(df, ["text", "label"], "split", ["train", "val", "test"])) == expected
    listed = lk.leak_rows(df, "text", "label", "split", ["train", "val", "test"])
    assert ("all", "x", "train,val,test") in rows(listed) and listed.count() == 5


def test_no_overlap_after_removal(spark):
    result = remove_leakage(leak_frame(spark), ["text", "label"])
    assert result.overlap_after.agg(F.sum("n_shared")).first()[0] == 0


def test_settled_copies_equal_the_steps_one_by_one(spark, rows):
    """Keep first within a split, then drop what a stronger split holds, on random copies with null keys."""
    import random

    from gleanmark.operators import leakage as lk
    from gleanmark.operators.dedup import keep_first
    from gleanmark.plans.splitting import remove_leakage, settle_copies

    rng = random.Random(4)
    data = [(i, rng.choice(["a", "b", "c", None, "", f"t{i}"]), rng.choice(["x", None]), rng.choice(["train", "train", "val", "test"])) for i in range(200)]
    df = spark.createDataFrame(data, "id int, text string, label string, split string")
    done = settle_copies(df, ["text", "label"], "id")
    first = keep_first(df, ["split", "text", "label"], "id")
    plain = remove_leakage(first, ["text", "label"])
    assert rows(done.rows) == rows(plain.rows)
    assert {r for r in rows(done.log) if "leakage" in r[1]} == set(rows(plain.log))
    assert rows(done.overlap_before) == rows(lk.overlap_counts(df, ["text", "label"], "split", ["train", "val", "test"]))
    assert [r[1] for r in rows(done.overlap_after)] == [0, 0, 0]
    assert sum(r["dropped"] for r in done.log.collect()) == 200 - done.rows.count()
