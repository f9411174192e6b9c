"""Items inside documents against a plain search, in all alignments."""

import math
import random

import pytest

from gleanmark.operators import containment as ct
from gleanmark.operators.salting import salts


def plain(documents, items, share):
    out = []
    for doc, text in documents:
        words = (text or "").lower().split()
        for item, own in items:
            own = (own or "").lower().split()
            best = (0, 0)
            for shift in range(-len(own) + 1, len(words)):
                run = 0
                for i in range(len(own) + 1):
                    at = i + shift
                    if i < len(own) and 0 <= at < len(words) and words[at] == own[i]:
                        run += 1
                    else:
                        if run:
                            best = max(best, (run, -(at - run)))
                        run = 0
            if own and best[0] >= math.ceil(round(share * 10_000) * len(own) / 10_000):
                out.append((doc, item, -best[1], best[0], round(best[0] / len(own) + 1e-9, 4)))
    return sorted(out)


def corpus(seed, letters="abcdefgh"):
    rng = random.Random(seed)
    some = lambda n: [rng.choice(letters) + rng.choice(letters) for _ in range(n)]
    items = [some(rng.choice([1, 2, 3, 5, 7, 9, 12, 20, 40])) for _ in range(25)]
    documents = []
    for _ in range(60):
        body = some(rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            piece = list(rng.choice(items))
            if rng.random() < 0.5:
                piece[rng.randrange(len(piece))] = "zz"
            if rng.random() < 0.3:
                piece = piece[: max(1, int(0.85 * len(piece)))]
            at = rng.randrange(len(body) + 1)
            body[at:at] = piece
        documents.append(rng.choice([" ", "  \n", "\t"]).join(body).title())
    documents += [None, "", " \n ", "aa " * 30, " ".join(items[3])]
    items = [" ".join(x) for x in items] + [None, "", " ", "aa aa aa aa aa aa aa aa aa aa", " ".join(items[0])]
    return list(enumerate(documents)), list(enumerate(items))


@pytest.mark.parametrize("seed, share, gram, window, salt_rows", [(0, 0.8, 5, 4, 100_000), (1, 0.5, 3, 2, 2), (2, 1.0, 2, 1, 1), (3, 0.25, 4, 8, 3)])
def test_contained_items(spark, rows, seed, share, gram, window, salt_rows):
    documents, items = corpus(seed)
    docs = spark.createDataFrame(documents, "id long, text string").selectExpr("*", "1 as item", "2 as fp", "3 as words")
    asked = spark.createDataFrame(items, "name long, text string").selectExpr("*", "1 as doc", "2 as pos")
    found = ct.contained_items(docs, asked, "id", "name", least_share=share, gram=gram, window=window, salt_rows=salt_rows)
    want = plain(documents, items, share)
    assert len(want) > 10
    assert rows(found) == sorted(want, key=repr)
    flagged = ct.contaminated(docs, found, "id")
    assert {r["id"] for r in flagged.where("contaminated").collect()} == {w[0] for w in want}
    assert flagged.count() == len(documents) and flagged.columns == [*docs.columns, "contaminated"]


def test_a_frequent_fingerprint_is_salted(spark):
    places = spark.range(1000).selectExpr("cast(if(id < 900, 1, id) as bigint) as fp", "id as doc", "0 as pos")
    assert [tuple(r) for r in salts(places, "fp", 100).collect()] == [(1, 9)]


def test_a_passage_in_most_documents_is_dealt_out(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = spark.range(600).selectExpr("id", f"if(id % 3 = 0, 'other words', concat('x', id, ' {passage} y', id)) as text")
    asked = spark.createDataFrame([("p", passage), ("q", "nothing of it stands in any of these texts at all")], "name string, text string")
    found = ct.contained_items(docs, asked, "id", "name", salt_rows=20).collect()
    assert len(found) == 400 and {(r["name"], r["start"], r["n_words"], r["share"]) for r in found} == {("p", 1, 30, 1.0)}


def test_without_items_or_documents(spark):
    none = spark.createDataFrame([], "id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f g h i j")], "id long, text string")
    for docs, asked in ((none, one), (one, none), (none, none)):
        found = ct.contained_items(docs, asked.withColumnRenamed("id", "name"), "id", "name")
        assert found.count() == 0 and found.columns == ["id", "name", "start", "n_words", "share"]


def test_winnowing_marks_the_least_of_some_window(spark):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    for window in (1, 2, 4, 8):
        hashes = [rng.randrange(-50, 50) for _ in range(40)]
        want = {i for a in range(len(hashes) - window + 1) for i in range(a, a + window) if hashes[i] == min(hashes[a : a + window])}
        df = spark.createDataFrame([(hashes,), (hashes[: window - 1],)], "g array<long>")
        got = [r[0] for r in df.select(ct.fingerprints(F.col("g"), window)).collect()]
        assert {m["pos"] for m in got[0]} == want and [m["fp"] for m in got[0]] == [hashes[m["pos"]] for m in got[0]]
        assert got[1] == []


def test_lists_are_worked_on_in_slices(spark, monkeypatch):
    from pyspark.sql import functions as F

    rng = random.Random(6)
    texts = [[rng.choice("ab") for _ in range(n)] for n in [0, 1, 2, 3, 4, 9, 40, 0, 5, 2, 30] * 3] + [None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, w array<string>").coalesce(1)
    for gram, window in ((1, 1), (3, 2), (5, 4)):
        found = []
        for at_once in (1 << 20, 7):
            monkeypatch.setattr(ct, "SLICE_VALUES", at_once)
            hashes = ct.gram_hashes("w", gram)
            found.append(sorted(tuple(r) for r in df.select("id", hashes, ct.fingerprints(hashes, window)).collect()))
        assert found[0] == found[1]
        of, hash_of = {}, {}
        for i, hashed, marked in found[0]:
            words = texts[i] or []
            grams = [tuple(words[k : k + gram]) for k in range(len(words) - gram + 1)]
            assert len(hashed) == len(grams)
            for g, h in zip(grams, hashed):
                assert of.setdefault(h, g) == g and hash_of.setdefault(g, h) == h
            want = {i for a in range(len(hashed) - window + 1) for i in range(a, a + window) if hashed[i] == min(hashed[a : a + window])}
            assert [(m["pos"], m["fp"]) for m in marked] == [(k, hashed[k]) for k in sorted(want)]


def test_each_word_is_hashed_once_and_only_holders_are_cut_again(spark, tmp_path):
    spark.createDataFrame([(i, f"x{i} b c d e f g h i j k l y") for i in range(20)], "id long, text string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    placed = plan(ct._placed(docs.select("id", ct.words_of("text").alias("words")), "id", 5, 4))
    assert placed.count("regexp_replace(") == placed.count("xxhash64(") == 1 and placed.count("zip_with(") == placed.count("slice(") == 0
    asked = spark.createDataFrame([("p", "b c d e f g h i j k l")], "name string, text string")
    found = plan(ct.contained_items(docs, asked, "id", "name"))
    assert found.index("regexp_replace(") < found.index("LeftSemi")  # the plan is printed from its end
