"""Sharding, importance resampling and tokenizer alignment against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gleanmark.llm import alignment, resampling, sharding
from gleanmark.llm.common import importable, tokenizer_file

TEXTS = [
    None, "", " ", "one two three", "One TWO  three", "é à\tñ 12-34 x_y", "a" * 300 + " " + "b" * 70 + " c", "<|endoftext|> and </s> <s> <unk>",
    "▁ marked", "  two blanks\n\n\nlines\t\ttabs ", "日本語のテキスト と 🙂🙂 emoji", "\x01\x02 control", " ".join(f"word{i % 37}" for i in range(4000)),
    "the cat sat on the mat and the dog sat on the log while the bird sat on the wire near the old barn door",
]


def _table(spark, copies=40):
    """Texts above with null ids, repeated rows, and columns whose names clash with those inside."""
    rows = [(i if i % 5 else None, t) for i, t in enumerate(TEXTS * 3)]
    rows += [(7, "same row again and again")] * copies + [(None, None)] * 9
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"hash": F.lit(1), "bucket": F.lit("x"), "row": F.lit(2), "rid": F.lit(3), "score": F.lit(4), "pairs": F.lit(5), "_none": F.lit(6)}
    )
    importable(spark)
    return df.repartition(5), rows


def _hash(name):
    return int(hashlib.md5(name.encode()).hexdigest()[:15], 16)


def _plain_shards(rows, bucket_bytes, seed=sharding.SEED, shards=sharding.SHARDS):
    name = lambda v: "-" if v is None else f"={v}"
    met, keyed, total = Counter(), [], 0
    for doc, text in rows:
        h = _hash(f"{seed}:{name(doc)}:{name(text)}")
        k = met[h]
        met[h] += 1
        keyed.append((_hash(f"{h}:{k}") if k else h, doc, text))
        total += len((text or "").encode()) + 1
    n, n_buckets = len(rows), max(1, -(-total // bucket_bytes))
    buckets = defaultdict(list)
    for h, doc, text in sorted(keyed, key=lambda r: r[0]):
        buckets[((h >> 30) * n_buckets) >> 30].append((doc, text))
    order = []
    for b in sorted(buckets):
        held = buckets[b]
        for i in range(len(held) - 1, 0, -1):
            j = _hash(f"{seed}:{b}:{i}") % (i + 1)
            held[i], held[j] = held[j], held[i]
        order += held
    out, at = [], 0
    for s in range(shards):
        for slot in range(n // shards + (s < n % shards)):
            out.append((*order[at], s, slot))
            at += 1
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_bytes, most_tasks", [(1 << 30, 9), (3000, 4), (700, 1000)])
def test_shards_are_those_of_a_plain_shuffle(spark, rows, bucket_bytes, most_tasks):
    docs, plain = _table(spark)
    got = sharding.sharded(docs, bucket_bytes=bucket_bytes, most_tasks=most_tasks)
    assert rows(got.select("row.doc_id", "row.text", "shard", "slot")) == _plain_shards(plain, bucket_bytes)
    again = sharding.sharded(docs.repartition(3), bucket_bytes=bucket_bytes, most_tasks=most_tasks)
    assert rows(again) == rows(got)


def test_shard_files_hold_whole_rows_in_order(spark, tmp_path):
    docs, plain = _table(spark)
    path = str(tmp_path / "shards")
    assert sharding.write_shards(docs, path, bucket_bytes=2000) == len(plain)
    for shard in range(sharding.SHARDS):
        slots = []
        for file in sorted((tmp_path / "shards" / f"shard={shard}").glob("*.parquet")):
            slots += [r["slot"] for r in spark.read.parquet(str(file)).collect()]
        assert slots == list(range(len(slots))) and len(slots) - len(plain) // 8 in (0, 1)
    whole = sharding.read_shards(spark, path, docs.schema).select("row.*")
    assert whole.exceptAll(docs).isEmpty() and docs.exceptAll(whole).isEmpty()
    one = sharding.read_shards(spark, path, docs.schema, shard=3)
    assert {r["shard"] for r in one.collect()} == {3}


def test_empty_table_of_shards(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.sharded(empty).count() == 0


def test_checksum_and_size(spark, rows):
    got = rows(spark.createDataFrame([("é",), ("",), (None,)], "t string").select(sharding.size_of(F.col("t")), sharding.checksum(F.col("t"))))
    assert got == sorted([(3, zlib.crc32("é".encode())), (1, 0), (1, 0)], key=repr)


def test_fisher_yates_permutes():
    assert sorted(sharding.fisher_yates(500, 1, 2)) == list(range(500))
    assert list(sharding.fisher_yates(500, 1, 2)) != list(sharding.fisher_yates(500, 1, 3))
    places = Counter(int(sharding.fisher_yates(4, 9, b)[0]) for b in range(800))
    assert all(140 < places[i] < 260 for i in range(4))


def _plain_features(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(r.encode()) % resampling.BUCKETS for r in runs]


def test_features_of_a_batch_are_those_of_single_texts():
    texts = [t or "" for t in TEXTS]
    found, n, words = resampling.features(texts)
    at = 0
    for i, text in enumerate(texts):
        n_words, want = _plain_features(text)
        assert (words[i], n[i]) == (n_words, len(want))
        assert sorted(found[at : at + n[i]].tolist()) == sorted(want)
        at += n[i]
    assert [len(x) for x in resampling.features([""])] == [0, 1, 1]


def _plain_resample(rows, target):
    size = resampling.BUCKETS
    coded = [(doc, *_plain_features(text)) for doc, text in rows]
    s, t = Counter(), Counter()
    for _, _, found in coded:
        s.update(found)
    for text in target:
        t.update(_plain_features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + size) / ((s[b] + 1) * (all_t + size))))
    scored = []
    for doc, n_words, found in coded:
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        scored.append((doc, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = [r for r in scored if r[1] >= 20]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    out = [(d, f, w, sc, i + 1 if i < 25 * len(able) // 100 else None) for i, (d, _, f, w, sc) in enumerate(able)]
    out += [(d, f, w, sc, None) for d, n, f, w, sc in scored if n < 20]
    return sorted(out, key=repr)


def test_resampling_is_that_of_a_plain_version(spark, rows):
    docs, plain = _table(spark)
    more = [(1000 + i, " ".join(f"w{(i * j) % 53}" for j in range(i))) for i in range(15, 120)]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    target = ["the cat sat on the mat", "w1 w2 w3 w4", None, ""]
    got = resampling.resample(docs, spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int"))
    assert rows(got) == _plain_resample(plain + more, target)
    assert sum(r[4] is not None for r in rows(got)) > 25


def test_resampling_of_empty_tables(spark, rows):
    importable(spark)
    docs = spark.createDataFrame([(i, " ".join(["a"] * 30)) for i in range(8)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(none, docs).count() == 0
    assert rows(resampling.resample(docs, none)) == _plain_resample([(i, " ".join(["a"] * 30)) for i in range(8)], [])
    drawn = resampling.drawn_documents(docs.withColumn("rank", F.lit("z")), none)
    assert drawn.count() == 2 and drawn.columns == ["doc_id", "text", "rank"]


def _plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    from gleanmark.llm.token_counts import byte_alphabet

    a = Tokenizer.from_file(tokenizer_file(alignment.VOCABULARY_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(alignment.VOCABULARY_B))
    alphabet = byte_alphabet()

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    docs, count = [], Counter()
    for doc, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        spelled_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
        spelled_b = [bytes_b(i) for i in ids_b]
        if not text or not b"".join(spelled_a) == b"".join(spelled_b) == b" " + text.encode():
            docs.append((doc, 0, 0, [], ""))
            continue
        end_a, end_b, at = {}, {}, 0
        for i, x in zip(ids_a, spelled_a):
            at += len(x)
            end_a[at] = i
        at = 0
        for i, x in zip(ids_b, spelled_b):
            at += len(x)
            end_b[at] = i
        ends = sorted(end_a.keys() & end_b.keys())
        links = [(end_a[e], end_b[e]) for e in ends]
        count.update(links)
        groups, before = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(v) for k, v in side.items() if before < k <= e) for side in (end_a, end_b)))
            before = e
        docs.append((doc, len(ids_a), len(ids_b), links, ";".join(groups)))
    best = defaultdict(int)
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    return sorted(
        [
            (
                doc, n_a, n_b, len(links), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
                hashlib.sha256(groups.encode()).hexdigest() if groups else "",
            )
            for doc, n_a, n_b, links, groups in docs
        ],
        key=repr,
    ), count


@pytest.mark.parametrize("hot", [alignment.MOST_HOT, 3, 0])
def test_alignment_is_that_of_a_plain_version(spark, rows, monkeypatch, hot):
    monkeypatch.setattr(alignment, "MOST_HOT", hot)  # all irregular pairs broadcast, some, none
    docs, plain = _table(spark)
    want, count = _plain_alignment(plain)
    assert rows(alignment.align(docs)) == want
    links = alignment.linked(docs, "doc_id", "text")
    assert {(r["a"], r["b"]): r["n"] for r in alignment.pair_counts(links).collect()} == dict(count)


def test_alignment_of_an_empty_table(spark):
    importable(spark)
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string")).count() == 0
