"""Duplicate, mixing, url and vector operators and the pipeline against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleanmark.llm import graph, minhash, mixing, quality, queries, url_filter, vector_dedup, vector_search
from gleanmark.llm.common import importable
from gleanmark.llm.shingles import shingle_set, similarity_sketches


def _roots(nodes, links):
    parent = {n: n for n in nodes}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(500, 900), rng.randrange(500, 900)) for _ in range(150)]
    links += [(5, 5), (7, 6)]
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect())
    want = _roots({x for e in links for x in e if e[0] != e[1]}, links)
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketches_fill_and_estimate():
    sets = [np.array([i], dtype=np.uint64) for i in range(5)] + [np.arange(k, k + 400, dtype=np.uint64) for k in (0, 100)]
    got = similarity_sketches(sets, 200)
    assert (got != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((got[5] == got[6]).mean() - 300 / 500) < 0.12


def _texts(seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    texts, passage = [], [word() for _ in range(40)]
    for g in range(12):
        base = [word() for _ in range(80)]
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(80)] = word()
            texts.append(" ".join(copy if g % 3 else passage + copy))
    texts += [None, "", "  \n", "one two", "ONE  two", "one two", "a b c d e", "A b c d e f", "é È ü b c", "é è ü b c"]
    texts += [" ".join(passage + [word() for _ in range(rng.randrange(5, 60))]) for _ in range(40)]
    return texts


@pytest.mark.parametrize("tile", [minhash.TILE, 7])
def test_near_duplicates(spark, tile):
    importable(spark)
    texts = _texts()
    rows = [(i, t, "n") for i, t in enumerate(texts)] + [(None, texts[0], "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs, tile=tile).collect()}
    sets = {i: set(shingle_set(t or "").tolist()) for i, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = _roots(sets, links)
    assert {i: got[i]["component_id"] for i in sets} == want
    assert all(got[i]["n_shingles"] == len(sets[i]) and got[i]["kept"] == (want[i] == i) for i in sets)
    assert got[None]["component_id"] is None and got[None]["kept"]


def test_a_large_group_is_not_repeated_for_few_strangers(spark):
    """Each two members of other components meet once, and the rows grow with the group, not with its square."""
    rows = [(band, 0, rep, 50, rep if rep % strange == 1 else 0) for band, size, strange in ((1, 400, 80), (2, 800, 160), (3, 9, 4)) for rep in range(size)]
    members = spark.createDataFrame(rows + [(4, 0, rep, 50, 0) for rep in range(30)], "band long, turn int, rep long, n long, component long")
    dealt = minhash._in_tiles(members, 10).collect()
    n = {band: sum(r["band"] == band for r in dealt) for band in (1, 2, 3, 4)}
    assert n[1] < 800 and n[2] < 1600 and n[3] == 9 and not n[4]
    groups = {}
    for r in dealt:
        groups.setdefault((r["band"], r["lo"], r["hi"]), []).append(r)
    met = Counter()
    for (band, lo, hi), g in groups.items():
        for x, a in enumerate(g):
            for b in g[x + 1 :]:
                if a["component"] != b["component"] and (lo == hi or a["mine"] != b["mine"]):
                    met[(band, *sorted((a["rep"], b["rep"])))] += 1
    want = {(p[0], *sorted((p[2], q[2]))) for p in rows for q in rows if p[0] == q[0] and p[4] != q[4]}
    assert set(met) == want and set(met.values()) == {1}


@pytest.mark.parametrize("size", [0, 1, 60])
def test_sets_held_against_one(size):
    rng = np.random.default_rng(size)
    some = lambda n: np.unique(rng.integers(0, 80, n).astype(np.uint64))
    one, others = some(size), [some(n) for n in (0, 1, 50, 60, 70, 400, 0)]
    want = [100 * len(np.intersect1d(one, o)) >= 75 * len(np.union1d(one, o)) for o in [*others, one]]
    assert minhash._reach(one, [*others, one], 75).tolist() == want


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d e f g", "s"), (1, "a b c d e f g", "s"), (2, "A b c d e f g", None), (3, "", "s"), (4, None, "s"), (5, "other words here", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = minhash.without_near_duplicates(docs)
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 3, 4, 5]
    assert minhash.without_near_duplicates(docs.limit(0)).count() == 0
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def _mix_by_hand(rows):
    """Taken words per row of (doc_id, source, size), by the definition."""
    import hashlib

    key = lambda d: int(hashlib.md5(f"0:{'' if d is None else d}".encode()).hexdigest()[:15], 16)
    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(r[2] for r in rows if r[1] == s) for s in names}
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    free, left = set(names), 1.5 * sum(size.values())
    target: dict = {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * size[s]}
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: 2.0 * size[s] for s in over}
        left -= sum(2 * size[s] for s in over)
        free -= over
    copies = []
    for s in names:
        mine, cum = sorted((key(r[0]), -1 if r[0] is None else r[0], r[2], i) for i, r in enumerate(rows) if r[1] == s), 0
        for e in (0, 1):
            for k, _, n, i in mine:
                if n and cum < target[s]:
                    copies.append(((cum + n) / target[s], k, n, i))
                cum += n
    taken, used, budget = [0] * len(rows), 0, int(sum(target.values()) + 1e-6)
    for _, _, n, i in sorted(copies):
        used += n
        if used > budget:
            break
        taken[i] += n
    return target, taken


def test_mix(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", "a", "a", "b", "é", "z", None]), rng.choice([0, 1, 5, 20, 300])) for i in range(300)]
    rows.append((None, "only empty", 0))
    docs = spark.createDataFrame([(d, s, " \t".join(["w"] * n) if n or d else None, 1) for d, s, n in rows], "doc_id long, source string, text string, size int")
    got = mixing.mix(docs).select("row.*", F.col("size").alias("n"), "source_size", "target", "copies", "taken").collect()
    target, taken = _mix_by_hand(rows)
    assert {(r["source"], round(r["target"], 6)) for r in got} == {(s, round(t, 6)) for s, t in target.items()}
    assert {r["doc_id"]: r["taken"] for r in got} == {r[0]: t for r, t in zip(rows, taken)}
    for s, t in target.items():
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - t) <= 300
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None, None)], "doc_id long, source string, text string")
    assert [(r["taken"], r["copies"]) for r in mixing.mix(blank).collect()] == [(0, 1)]


def test_mix_of_repeated_rows(spark):
    """An epoch may end between equal rows; null ids and repeated ids have several sizes."""
    for seed in range(4):
        rng = random.Random(seed)
        ids = [None, None, *range(6)] if seed % 2 else [None, *range(60)]
        rows = [(rng.choice(ids), rng.choice(["a", "a", "b", None]), rng.choice([0, 3, 3, 40])) for _ in range(120)]
        docs = spark.createDataFrame([(d, s, " ".join(["w"] * n)) for d, s, n in rows], "doc_id long, source string, text string")
        # A null id comes last among equal keys; no other id has its key here.
        _, taken = _mix_by_hand(rows)
        got = mixing.mix(docs).select("row.doc_id", "row.source", "size", "copies", "taken").collect()
        assert Counter((r["doc_id"], r["source"], r["size"], r["taken"]) for r in got) == Counter((*r, t) for r, t in zip(rows, taken))
        assert all(r["taken"] == r["size"] * r["copies"] or not r["size"] for r in got)


def test_mix_moves_no_text(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    spark.range(500).selectExpr(
        "id as doc_id", "concat('s', id % 3) as source", "repeat(concat('w', id, ' '), cast(id % 7 as int)) as text"
    ).write.parquet(str(tmp_path / "docs"))
    written, write = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        written.append(self._df.columns)
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    mixed = mixing.mix(spark.read.parquet(str(tmp_path / "docs")))
    p = mixed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in p and "Window" not in p and p.count("regexp_extract_all") == 1
    assert written and not any({"row", "text"} & {*columns} for columns in written)


def test_url_rules(spark):
    urls = {
        "https://www.example.com/en/x?q#f": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://a.EXAMPLE.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "x://net/es/": ("net", "/es/", "net/es/", "block"),
        "x://net/esx": ("net", "/esx", None, "allow"),
        "x://com": ("com", "", None, "allow"),
        "x://com?/": ("com", "", None, "allow"),
        "no scheme com/": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        "a://b.net://fr/": ("b.net:", "//fr/", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(u, "h") for u in urls] * 2, "url string, host string")
    got = url_filter.judged(pages, url_filter.rule_table(spark)).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == urls[r["url"]], r
    none = url_filter.judged(pages, url_filter.rule_table(spark).limit(0), unlisted="block").collect()
    assert {(r["rule"], r["verdict"]) for r in none} == {(None, "block")}
    assert url_filter.judged(pages.limit(0), url_filter.rule_table(spark)).count() == 0


def test_shapes_of_many_rules_stay_a_table(spark):
    """300 shapes of rules: the plan does not grow with them."""
    rules = [("block", f"a{i}.example{i % 7}.org/{'x' * i}") for i in range(300)]
    pages = spark.createDataFrame([(i, f"http://w.a{i}.example{i % 7}.org/{'x' * (i + i % 2)}?q", i) for i in range(300)] + [(-1, None, 0), (-2, "http://", 0)], "page_id long, url string, labels int")
    few = url_filter.judged(pages, url_filter.rule_table(spark, rules[:2]))
    many = url_filter.judged(pages, url_filter.rule_table(spark, rules))
    length = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    assert length(many) < 1.2 * length(few)
    got = {r["page_id"]: r["rule"] for r in many.collect()}
    assert got == {**{i: rules[i][1] for i in range(300)}, -1: None, -2: None}


def test_names_that_clash_inside(spark):
    importable(spark)
    docs = spark.createDataFrame([(1, "a b c d e f g", 1), (2, "a b c d e f g", 2), (3, "z", 3), (3, "y x", 4)], "doc_id long, text string, _decided int")
    docs = docs.selectExpr("*", "7 as _id", "8 as _row", "9 as _q")
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"], r["_decided"]) for r in kept.collect())[0] == (1, 1) and kept.count() == 2
    rows = spark.createDataFrame([(i, [1.0, float(i)], i) for i in range(5)], "vec_id long, embedding array<float>, _q int")
    assert vector_search.nearest(rows, F.col("_q") == 2).count() == 4


def test_bloom_filter_has_no_false_negative(spark):
    rules = [("block", f"h{i}.org/p{i % 7}/") for i in range(500)] + [("allow", None), (None, "x/"), ("allow", "h1.org/p1/")]
    pages = spark.createDataFrame([(f"s://www.h{i}.org/p{i % 7}/x",) for i in range(600)], "url string")
    got = url_filter.judged(pages, spark.createDataFrame(rules, "verdict string, rule string"))
    assert got.where("verdict = 'block'").count() == 500


def _vectors(seed=0, n=400, d=16):
    rng = np.random.default_rng(seed)
    rows, centre = [], rng.normal(size=d)
    for i in range(n):
        kind = i % 8
        v = rng.normal(size=d) if kind < 5 else centre + rng.normal(size=d) * (0.05 if kind == 5 else 0.16)
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 3)))
    rows += [(n + 1, None, 0), (n + 2, [0.0] * d, 0), (n + 3, [float("nan")] * d, 0), (n + 4, rows[5][1], None), (n + 5, rows[5][1], rows[5][2]),
             (n + 6, [float("inf")] * d, 0), (n + 7, [None] * d, 0), (n + 8, [1.0, 2.0], 0), (None, rows[5][1], rows[5][2]), (n + 5, rows[5][1], rows[5][2])]
    return rows


_SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("sizes", [{}, {"window": 4, "block": 64, "tile": 16}, {"window": 4, "block": 8, "tile": 16}])
def test_near_duplicate_vectors(spark, sizes):
    importable(spark)
    rows = _vectors()
    got = vector_dedup.near_duplicate_vectors(spark.createDataFrame(rows, _SCHEMA), **sizes).collect()
    assert len(got) == len(rows)
    good = {i: (np.array(v), y) for i, v, y in rows if i is not None and y is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    cosine = lambda a, b: a @ b / np.sqrt((a @ a) * (b @ b))
    links = [(a, b) for a in good for b in good if a < b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0]) and cosine(good[a][0], good[b][0]) >= 0.98]
    want = _roots({r[0] for r in rows if r[0] is not None}, links)
    assert len(links) > 200
    for r in got:
        if r["vec_id"] is None:
            assert (r["n_links"], r["component_id"]) == (0, None)
            continue
        assert r["component_id"] == want[r["vec_id"]] and r["kept"] == (want[r["vec_id"]] == r["vec_id"])
        assert r["n_links"] == sum(r["vec_id"] in e for e in links), r
    assert vector_dedup.near_duplicate_vectors(spark.createDataFrame([], _SCHEMA)).count() == 0


def test_nearest(spark):
    importable(spark)
    rows = [r for r in _vectors(1, 900)]
    table = spark.createDataFrame(rows, _SCHEMA)
    got = vector_search.nearest(table, F.col("vec_id") % 20 == 0, leaf_rows=20, k=5).collect()
    good = {i: np.array(v) for i, v, _ in rows if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)}
    hits = total = 0
    for q in [i for i in good if i % 20 == 0]:
        best = sorted((-float(good[q] @ v), i) for i, v in good.items() if i != q)[:5]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert [(-m[2], m[1]) for m in mine] == sorted((-m[2], m[1]) for m in mine)
        assert all(abs(m[2] - good[q] @ good[m[1]]) < 1e-9 for m in mine)
        hits += len({b[1] for b in best} & {m[1] for m in mine})
        total += 5
    assert hits / total >= 0.9
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0)], _SCHEMA)
    found = vector_search.nearest(few, F.col("vec_id") == 0).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(found)] == [(1, 1, 1.0), (2, 2, 1.0)]
    assert vector_search.nearest(table.limit(0), F.lit(True)).count() == 0


def test_nearest_among_thousands_of_copies(spark):
    importable(spark)
    rng = np.random.default_rng(1)  # the matrix product of this vector with its copies is greater in the last rows of a block
    one = rng.normal(size=64).astype(np.float32).astype(float).tolist()
    rows = [(i, one if i % 10 else rng.normal(size=64).tolist(), 0) for i in range(40_000)]
    asked = [1, 5001, 39_999]
    table = spark.createDataFrame(rows, _SCHEMA).repartition(7)
    got = vector_search.nearest(table, F.col("vec_id").isin(asked)).collect()
    score = 0.0
    for x in one:
        score += x * x
    for q in asked:
        found = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        copies = [i for i in range(1, 100) if i % 10 and i != q][:20]
        assert found == [(n + 1, i, score) for n, i in enumerate(copies)]


@pytest.mark.parametrize("seed", [1, 5])
def test_copies_in_a_block_are_taken_by_id(seed):
    one = np.random.default_rng(seed).normal(size=64).astype(np.float32).astype(float)
    for n in (5600, 5611, 5623, 5637, 5650, 5663, 5671, 5687):
        for m in (1, 2, 3):
            asked = np.arange(n, n + m)
            got = vector_search._pairs(asked, np.tile(one, (m, 1)), np.arange(n), np.tile(one, (n, 1)), 3)
            assert got["vec_id"].tolist() == [0, 1, 2] * m and got["near"].nunique() == 1, (n, m)


def test_recall_of_the_query(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").toPandas()
    x, ids = np.stack(vectors["embedding"]).astype(float), vectors["vec_id"].to_numpy()
    got = queries.op9_nearest_neighbours(spark, "/root/testdata/sf0.01").toPandas()
    hits = 0
    for q, part in got.groupby("query_id"):
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -s))[:20]]) & set(part["vec_id"]))
    assert hits / len(got) >= 0.9


def test_pipeline_equals_its_parts(spark, tmp_path):
    """Every stage against brute force over what its predecessor kept."""
    texts = [t for t in _texts(7) if t] + ["### %%% $$$ &&& " * 20] * 5
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)] + [(None, None, None, None, None), (900, "", "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 0 if "###" in t else 1) for i, t in enumerate(texts)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    d, steps = str(tmp_path), [f for _, f in corpus_pipeline.STAGES]
    kept = steps[0](spark, docs, d)
    scored = {r["doc_id"]: r["predicted"] for r in quality.scored_documents(docs, spark.read.parquet(f"{d}/labels.parquet")).collect()}
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(i or -1 for i, p in scored.items() if p)
    one = steps[1](spark, kept, d)
    sets = {r["doc_id"]: set(shingle_set(r["text"] or "").tolist()) for r in kept.collect() if r["doc_id"] is not None}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    firsts = {i for i, r in _roots(sets, links).items() if i == r}
    assert {r["doc_id"] for r in one.collect()} - {None} == firsts
    mixed = steps[2](spark, one, d)
    sized = [(r["doc_id"], r["source"], len((r["text"] or "").encode().split())) for r in one.collect()]
    taken = dict(zip([s[0] for s in sized], _mix_by_hand(sized)[1]))
    words = {s[0]: s[2] for s in sized}
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: (t // words[i] if words[i] else 1) for i, t in taken.items() if t or not words[i]}
    final = corpus_pipeline.run(spark, d)
    assert sorted(r["doc_id"] or -1 for r in final.collect()) == sorted(r["doc_id"] or -1 for r in mixed.collect())


def _near(rng, centre, mean):
    """Unit rows whose mean cosine with each other is about ``mean``."""
    d = centre.shape[1]
    noise = rng.normal(size=centre.shape) / np.sqrt(d)
    return np.sqrt(mean) * centre + np.sqrt(1 - mean) * noise


def _planted(n, pairs, mean, d=64, seed=3):
    """Rows about one centre; the last are each at cosine 0.981 of one of the first."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(1, d))
    x = _near(rng, np.repeat(centre / np.linalg.norm(centre), n, axis=0), mean)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = rng.normal(size=(pairs, d))
    aside -= (aside * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    return np.concatenate([x, 0.981 * x[:pairs] + np.sqrt(1 - 0.981**2) * aside])


@pytest.mark.parametrize(("n", "mean", "sizes"), [(20_000, 0.9, {}), (3000, 0.9, {"block": 64}), (3000, 0.3, {"block": 16})])
def test_pairs_in_a_tight_label(spark, n, mean, sizes):
    importable(spark)
    rows = [(i, v, 0) for i, v in enumerate(_planted(n, 300, mean).tolist())]
    got = {r["vec_id"]: r["component_id"] for r in vector_dedup.near_duplicate_vectors(spark.createDataFrame(rows, _SCHEMA), **sizes).collect()}
    assert [i for i in range(300) if got[i] != got[n + i]] == []


def test_dense_group_below_the_threshold(spark):
    importable(spark)
    x = _planted(4000, 0, 0.964)
    # As stored: single precision.
    unit = x.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.98
    want = np.arange(len(x))
    while True:
        least = np.where(linked, want[None, :], len(x)).min(axis=1)
        if (least == want).all():
            break
        want = least
    rows = [(i, v, 0) for i, v in enumerate(x.tolist())]
    got = vector_dedup.near_duplicate_vectors(spark.createDataFrame(rows, _SCHEMA)).collect()
    assert {r["vec_id"]: r["component_id"] for r in got} == dict(enumerate(want.tolist()))
    assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate((linked.sum(axis=1) - 1).tolist()))


@pytest.mark.parametrize("n", [218, 2000, 50_000])
def test_passes_compare_few_pairs(n):
    """Every label goes through the passes; what they compare is far below all pairs."""
    x = np.random.default_rng(n).normal(size=(n, 64))
    compared = sum(len(at) * (len(at) - 1) // 2 for at in vector_dedup.passes_over(x, vector_dedup.WINDOW, vector_dedup.MISS, vector_dedup.COSINE))
    assert 0 < compared < {218: 0.5, 2000: 0.2, 50_000: 0.01}[n] * n * (n - 1) / 2


def test_neighbours_share_their_first_bits():
    codes = np.array([5, 1, 5, 2, 1, 9, 5], dtype=np.uint64)
    assert sorted(sorted(at.tolist()) for at in vector_dedup.runs_of(codes)) == [[0, 2, 6], [1, 4]]


def test_passes_keep_pairs_at_the_threshold():
    """400 pairs at cosine 0.98 in one label: none may be apart in all passes."""
    x = _planted(1000, 400, 0.2, seed=8)
    x[1000:] = 0.98001 * x[:400] + np.sqrt(1 - 0.98001**2) * (x[1000:] - 0.981 * x[:400]) / np.sqrt(1 - 0.981**2)
    links = vector_dedup._links_of_label(x, vector_dedup.WINDOW, vector_dedup.MISS, vector_dedup.COSINE)
    assert {(min(a, b), max(a, b)) for a, b in links} >= {(i, 1000 + i) for i in range(400)}
