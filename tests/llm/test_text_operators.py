"""Token, text and quality operators against the library, brute force and round trips."""

import hashlib
import math
import time
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from gleanmark.llm import bpe, html_text, quality, token_counts, training_order
from gleanmark.llm.common import importable, tokenizer_file
from pyspark.sql import functions as F

ODD = [
    None, "", " ", "a", "I'LL don't 'S ß İ Σ ΣΑΣ é ẛ̣ 日本語 1234 ٣", "<|endoftext|> x<|startoftext|>y", "x" * 3000,
    "ab" * 500, "\r\n \x0b hi\x1c \x85  z", "the  end \n of <|endoftext|>it  ", "word " * 400, "\t\ttabs\t", "a b c " * 300,
]


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(3, "a", "x"), (None, "no id", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_encoding_and_decoding_equal_the_library(docs):
    lib = Tokenizer.from_file(tokenizer_file(bpe.VOCABULARY))
    got = docs.select("doc_id", "text", bpe.encode(F.col("text")).alias("e")).select("*", bpe.decode(F.col("e.ids")).alias("back")).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        want = lib.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["e"]["ids"], "<u4").tolist() == want and r["e"]["n_tokens"] == len(want)
        assert r["back"] == lib.decode(want, skip_special_tokens=False)
    digests = bpe.encoded_documents(docs, keep_ids=True).collect()
    assert {r["ids_sha256"] for r in digests} == {hashlib.sha256(r["ids"]).hexdigest() for r in digests}
    assert bpe.encoded_documents(docs.limit(0)).count() == 0


def test_pair_table_equals_merging(docs):
    """Random words over few letters, which have many tokenisations."""
    lib = Tokenizer.from_file(tokenizer_file(bpe.VOCABULARY))
    enc = bpe.encoder(tokenizer_file(bpe.VOCABULARY))
    rng = np.random.default_rng(1)
    for _ in range(3000):
        word = "".join(rng.choice(list("aeinorst"), rng.integers(1, 30)))
        assert enc.word(word) == lib.encode(word, add_special_tokens=False).ids


@pytest.mark.parametrize("cut", [{}, {"long_chars": 40, "chunk": 30, "overlap": 14}, {"long_chars": 300, "chunk": 200, "overlap": 60}])
def test_counts_equal_the_library_however_texts_are_cut(docs, cut):
    lib = Tokenizer.from_file(tokenizer_file(token_counts.VOCABULARY))
    got = token_counts.token_counts(docs, limit=5, **cut)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    texts = dict(enumerate(ODD)) | {None: "no id"}
    rows = got.collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        text = texts[r["doc_id"]] or ""
        n = len(lib.encode(text, add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(text.encode()), n > 5)


def test_no_documents(docs):
    assert token_counts.token_counts(docs.limit(0)).count() == 0
    assert training_order.training_order(docs.limit(0)).count() == 0
    assert html_text.page_texts(docs.select("doc_id", F.col("text").alias("html")).limit(0)).count() == 0


def test_permutation_hits_every_slot_once():
    for n in (1, 2, 5, 64, 1000, 4097):
        got = training_order.permuted(np.arange(n), n, 7)
        assert sorted(got.tolist()) == list(range(n))
    assert training_order.permuted(np.arange(1000), 1000, 7).tolist() != training_order.permuted(np.arange(1000), 1000, 8).tolist()


def test_training_order_round_trip_and_resume(spark, docs, tmp_path):
    path, shape = str(tmp_path / "shards"), {"length": 16, "per_shard": 8}
    n = training_order.write_training_order(docs, path, **shape)
    rows = training_order.read_training_order(spark, path, **shape).collect()
    assert sorted(r["slot"] for r in rows) == list(range(n))
    lib = Tokenizer.from_file(tokenizer_file(training_order.VOCABULARY))
    texts = dict(enumerate(ODD)) | {None: "no id"}
    parts: dict = {}
    for r in rows:
        assert r["byte_offset"] == r["slot"] % 8 * training_order.record_type(16).itemsize and r["shard"] == r["slot"] // 8
        ids = np.frombuffer(r["tokens"], "<u2")[: r["n_tokens"]].tolist()
        parts.setdefault((r["doc_id"], r["part"]), []).append(ids)
    for doc, text in texts.items():
        copies = 2 if doc == 3 else 1
        ids = [x for (d, _), found in sorted(parts.items(), key=lambda p: p[0][1]) if d == doc for x in found[0]]
        assert ids == lib.encode(text or "", add_special_tokens=False).ids + [training_order.END_TOKEN]
        assert all(len(found) == copies for (d, _), found in parts.items() if d == doc)
    later = training_order.read_training_order(spark, path, from_slot=n - 3, **shape)
    assert sorted(r["slot"] for r in later.collect()) == [n - 3, n - 2, n - 1]
    again = str(tmp_path / "again")
    training_order.write_training_order(docs, again, **shape)
    assert spark.read.parquet(again).exceptAll(spark.read.parquet(path)).count() == 0


def test_main_text():
    boiler = "<nav><a href=x>Home</a></nav><div class='ad'>Buy &amp; save</div>"
    inner = "<h1>Title &eacute;</h1><p><b>One\n two.<br><p>Three   four <a href=y>five</a>.</p><script>no()</script><ul><li>a<li>b</ul>"
    foot = "<section class='comments'><article><p>I agree with all of it, really</p></article></section><footer>&copy; me</footer>"
    want = "Title é\nOne two.\nThree four five.\na\nb"
    assert html_text.main_text(f"<html><body>{boiler}<article>{inner}</article>{foot}") == want
    assert html_text.main_text(f"<body>{boiler}<div id=c>{inner}</div>{foot}</body>") == want
    two = "<section><h2>A</h2><p>" + "long text " * 30 + "</p></section><section><h2>B</h2><p>x.</p></section>"
    assert html_text.main_text(f"<article>{two}</article>").split("\n")[2:] == ["B", "x."]
    for empty in (None, "", "<html></html>", "<nav>only</nav>", "<!-- x -->", "<script>x</script>"):
        assert html_text.main_text(empty) == ""
    assert html_text.main_text("plain") == "plain"
    assert html_text.main_text("<div>" * 5000 + "deep") == "deep"
    assert len(html_text.main_text("<p>" + "long " * 400_000)) == 5 * 400_000 - 1


def test_wrappers_with_marks_of_other_parts():
    text = "Prose of the article, which goes on for a while. " * 8
    article = f"<article><h1>T</h1><p>{text}</p></article>"
    plain = f"<div><h1>T</h1><p>{text}</p><p>{text}</p></div>"
    want, twice = f"T\n{text.strip()}", f"T\n{text.strip()}\n{text.strip()}"
    for mark in ("class='layout has-sidebar'", "class=no-sidebar", "id=social-science", "class='layout sidebar'", "aria-hidden=true"):
        assert html_text.main_text(f"<body><p>Motto.</p><div {mark}>{article}</div><footer>f</footer></body>") == want, mark
        assert html_text.main_text(f"<body><div {mark}>{plain}</div><footer>f</footer></body>") == twice, mark
    form = f"<form id=aspnet><input><div class='widget'>{article}<div class=comments><p>Me too, I agree.</p></div></div></form>"
    assert html_text.main_text(f"<body>{form}</body>") == want
    assert html_text.main_text(f"<html><head><title>x</title><meta charset=utf-8><div>{article}</div>") == want
    assert html_text.main_text(f"<head><title>x</title><h1>T</h1><p>{text}<body class=y><p>{text}") == twice
    # Longer than the article, and still no part of it.
    comments = "".join(f"<article><p>{text}</p></article>" for _ in range(4))
    for tag in ("div class=comments", "section id=comments"):
        assert html_text.main_text(f"<body>{article}<{tag}>{comments}</{tag.split()[0]}></body>") == want
        assert html_text.main_text(f"<body>{plain}<{tag}>{comments}</{tag.split()[0]}></body>") == twice
    assert html_text.main_text(f"<body>{article}<form><p>{text * 9}</p></form><div class=ad>{text * 9}</div></body>") == want


def test_deep_pages():
    more = "<p>" + "More of the article follows here. " * 9 + "</p>"
    nest = "<div>" * 1000 + "deep" + "</div>" * 1000
    want = "First.\ndeep\n" + ("More of the article follows here. " * 9).strip()
    assert html_text.main_text(f"<body><div><article><p>First.</p>{nest}{more}</article></div><p>after</p></body>") == want
    foreign = "<script>no()</script><style>no</style><nav>no</nav><aside>no</aside>"
    assert html_text.main_text("<div>" * 1000 + foreign + "yes") == "yes"
    assert html_text.main_text("<div>" + "<font>" * 1000 + foreign + more + "<font>" * 1000) == want.split("\n")[2]
    assert html_text.main_text("<b><p>" * 50_000 + "x" + "</p></b>" * 50_000) == "x"


def test_one_pass_gives_the_longest_match_at_every_place():
    enc, rng = bpe.encoder(tokenizer_file(bpe.VOCABULARY)), np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdehinorstu"), rng.integers(1, 30))) for _ in range(2000)] + ["internationalization" * 3, "x", "zzzzqqqq"]
    for word in words:
        symbols = word[:-1] + chr(bpe._END + ord(word[-1]))
        ends = lambda i: (enc.tokens.get(symbols[i:j]) for j in range(len(symbols), i, -1))
        assert enc._longest(symbols) == [next((t for t in ends(i) if t is not None), None) for i in range(len(symbols))]
    for token, shorter in list(enc.shorter.items())[::97]:
        symbols = next(x for x, i in enc.tokens.items() if i == token)
        assert shorter == next((enc.tokens[symbols[:j]] for j in range(len(symbols) - 1, 0, -1) if symbols[:j] in enc.tokens), None)


@pytest.mark.parametrize("piece", ["<a ", '<a href="', "<!-- ", "</p ", "<a b='", "<? ", "<![CDATA[ "])
def test_long_pages_that_never_close_a_tag(piece):
    """From the first < without a > all is text, as in the library, in one step."""
    page = "<div><p>First &amp; last.</p><p>x " + piece * 40
    tree = html_text.Tree()
    tree.feed(page)
    tree.close()

    def plain(node):
        return "".join(item if isinstance(item, str) else plain(item) for item in node.items)

    assert plain(html_text.parse(page)) == plain(tree.root) == "First & last.x " + piece * 40
    start = time.process_time()
    text = html_text.main_text("<p>x " + piece * (1_000_000 // len(piece)))
    assert len(text) > 990_000 and time.process_time() - start < 1


def _random_tree(rng, depth=0):
    """Nested lists of strings and (tag, items)."""
    out = []
    for _ in range(rng.integers(1, 5)):
        kind = rng.integers(0, 4)
        if kind == 0 or depth > 4:
            out.append("w" * int(rng.integers(1, 60)))
        elif kind == 1:
            out.append(("a", ["l" * int(rng.integers(1, 30))]))
        else:
            out.append((["div", "p", "section"][rng.integers(0, 3)] if kind == 2 else "div", _random_tree(rng, depth + 1)))
    return out


def _as_html(items):
    return "".join(x if isinstance(x, str) else f"<{x[0]}>{_as_html(x[1])}</{x[0]}>" for x in items)


def _plain_counts(items, link=False):
    """Characters, tags, characters in links, links below a list of items."""
    chars = tags = link_chars = links = 0
    for x in items:
        if isinstance(x, str):
            chars += len(x)
            link_chars += len(x) * link
        else:
            c, t, lc, n = _plain_counts(x[1], link or x[0] == "a")
            chars, tags, link_chars, links = chars + c, tags + t + 1, link_chars + lc, links + n + (x[0] == "a")
    return chars, tags, link_chars, links


def _plain_density(counts, page):
    chars, tags, link_chars, links = counts
    if not chars:
        return 0.0
    inside = chars / max(1, link_chars) * max(1, tags) / max(1, links)
    base = chars / max(1, chars - link_chars) * link_chars + page * chars + math.e
    return chars / max(1, tags) * math.log(max(inside, 1.0) + 1e-9) / (1 + math.log(math.log(base)))


@pytest.mark.parametrize("seed", range(8))
def test_density_sums_equal_a_plain_recursion(seed):
    """The sum of a node: its children's densities and that of the text that lies in it directly."""
    rng = np.random.default_rng(seed)
    items = [x for x in _random_tree(rng) + [("div", _random_tree(rng))]]
    items = [("div", [x] if isinstance(x, str) or x[0] == "a" else x[1]) if isinstance(x, str) or x[0] in ("a", "p") else x for x in items]
    page = _plain_counts(items)
    share = page[2] / page[0] if page[0] else 0.0
    want = []

    def walk(below):
        own = _plain_counts([x for x in below if isinstance(x, str) or x[0] == "a"])
        blocks = [x for x in below if not isinstance(x, str) and x[0] != "a"]
        want.append(round(sum(_plain_density(_plain_counts(x[1]), share) for x in blocks) + _plain_density(own, share), 6))
        for x in blocks:
            walk(x[1])

    # No paragraph holds a block here: the parser would close it.
    def without_paragraphs(below):
        return [x if isinstance(x, str) or x[0] == "a" else ("div", without_paragraphs(x[1])) for x in below]

    items = without_paragraphs(items)
    walk(items)
    order = html_text._weighed(html_text.parse(_as_html(items)))
    got = [round(node.sum, 6) for node, _ in order if node.tag not in html_text.INLINE]
    assert sorted(got) == sorted(want)
    sums = [node.sum for node, _ in order if node.tag not in html_text.INLINE and node.chars]
    assert max(sums) == order[0][0].best == order[0][0].best_node.sum


def test_page_texts(spark):
    importable(spark)
    rows = [(1, None, None, 7), (1, "u", "<p>x</p>", 7), (None, "u", "<p>x</p>", 7), (1, "u", "<p>x</p>", 7)]
    got = html_text.page_texts(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r["text"] + str(r["n_chars"]) for r in got.collect()) == ["0", "x1", "x1", "x1"]


def _labelled(spark, n=600):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        good = bool(i % 4)
        some = rng.choice(words, 60)
        text = " ".join(some) + "." if good else " ".join(w + "###" for w in some) if i % 8 else " ".join(np.repeat(some[:8], 8)).upper()
        docs.append((i, text, 0.5))
        labels.append((i, int(good)))
    labels += [(None, 1), (1, None), (2, 0), (2, 1), (10**9, 1)]
    docs += [(None, "x", 0.1), (n, None, 0.1), (n + 1, "", 0.1), (3, docs[3][1], 0.5)]
    return spark.createDataFrame(docs, "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_classifier_on_held_out_rows(spark):
    importable(spark)
    docs, labels = _labelled(spark)
    rows = quality.scored_documents(docs, labels).collect()
    assert len(rows) == 604 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in held) and len(held) > 100
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 > 0) for r in held if r["doc_id"] < 600]) > 0.97
    # Held-out labels teach nothing.
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {(r["doc_id"], r["score"]) for r in quality.scored_documents(docs, flipped).collect()}
    assert {(r["doc_id"], r["score"]) for r in rows} == again
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in rows)


def test_classifier_without_labels_or_documents(spark):
    docs, labels = _labelled(spark, 8)
    assert {r["score"] for r in quality.scored_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.scored_documents(docs.limit(0), labels).count() == 0
    one = quality.scored_documents(docs, labels.where("quality = 1")).collect()
    assert all(0 <= r["score"] <= 1 for r in one)


def test_discriminant_equals_the_densities():
    rng = np.random.default_rng(0)
    d = len(quality.STATISTICS)
    x = [rng.normal(size=(50, d)), rng.normal(1, 2, size=(80, d))]
    m = quality.discriminant([50, 80], [a.sum(0) for a in x], [a.T @ a for a in x], pooled=0.0, sphere=0.0)
    probe = rng.normal(size=(5, d))
    logs = []
    for a in x:
        c = np.cov(a.T, bias=True) + 1e-6 * np.eye(d)
        diff = probe - a.mean(0)
        logs.append(np.log(len(a)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(c), diff))
    assert np.allclose(m.score(probe), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_encoders_agree_with_the_library_on_every_code_point():
    """Whole texts go past the library; both must split, lower and merge alike."""
    counter, encoder = token_counts.Counter(tokenizer_file(token_counts.VOCABULARY)), bpe.Encoder(tokenizer_file(bpe.VOCABULARY))
    chars = [chr(k) for k in range(1, 0x20000) if not 0xD800 <= k < 0xE000]
    texts = [f"A{c}b {c}{c}1{c} {c}!{c}.\n{c} 'L{c} <|endoftext|>{c}" for c in chars] + ["", " ", "a" * 3000, " \n" * 3000]
    for lib, ids in (
        (counter.tokenizer, (counter.ids(t).tolist() for t in texts)),
        (encoder.library, (np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode(texts))),
    ):
        expected = lib.encode_batch_fast(texts, add_special_tokens=False)
        assert [t for t, e, got in zip(texts, expected, ids, strict=True) if e.ids != got] == []


def test_counter_agrees_on_every_token_and_on_endless_blanks():
    counter = token_counts.Counter(tokenizer_file(token_counts.VOCABULARY))
    names = [counter.whole.decode_single_token_bytes(i).decode(errors="ignore") for i in range(counter.whole.n_vocab)]
    for text in [*names, " " * 2_500_000 + "x"]:
        assert counter.ids(text).tolist() == counter.tokenizer.encode(text, add_special_tokens=False).ids
