"""Operators against brute force on small fixtures with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlake.llm import bpe, common, embed_dedup, html_extract, langid, line_dedup, ngram_join, packing, quality, queries, token_records, topk
from sessionlake.llm.common import fold
from tests.compare import assert_same

SF = "/root/testdata/sf0.001"
EMPTY = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(3)
    words = [f"w{k}" for k in range(60)] + ["Ünïted", "don't", "42"]
    texts = [None, "", "   ", "one", "one two", "One  TWO", "x " * 3000]
    for _ in range(25):
        base = [draw.choice(words) for _ in range(draw.choice([4, 12, 40, 120]))]
        texts.append(" ".join(base))
        for _ in range(draw.randrange(3)):
            copy = list(base)
            copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(" ".join(copy))
    texts += texts[-3:]
    rows = [(k, t, draw.choice(["aa", "bb", None]), "s", 0, 9) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id long").cache()


def partition(pairs, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert_same(spark, SF, queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_components_against_union_find(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(80), draw.randrange(80)) for _ in range(60)] + [(k, k + 1) for k in range(100, 140)] + [(200, 200)]
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = partition(edges, {x for e in edges for x in e})
    assert got == {k: v for k, v in want.items() if k in got} and {k for k, v in want.items() if v != k} <= set(got)


def test_packing_plan_and_places(spark, docs):
    rows = packing.pack_documents(docs, capacity=64).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r["length"] for r in rows)
    assert len(by) <= 1.25 * -(-total // 64) + 1
    assert packing.pack_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("percent,width", [(90, 3), (80, 5)])
def test_jaccard_against_brute_force(docs, percent, width):
    def shingles(t):
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall("[^\x20\x09-\x0d]+", t or "")]
        return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()

    sets = {r["doc_id"]: shingles(r["text"]) for r in docs.collect()}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = partition(links, sets)
    got = ngram_join.jaccard_components(docs, width, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {k: (len(s), want[k]) for k, s in sets.items()}


def test_similar_sets_share_a_signature():
    draw = np.random.default_rng(1)
    for _ in range(3000):
        percent, size = int(draw.choice([80, 90])), int(draw.integers(2, 150))
        base = draw.integers(0, 2**64, size, dtype=np.uint64)
        gone, new = int(draw.integers(0, size // 6 + 1)), int(draw.integers(0, size // 6 + 1))
        a, b = np.unique(base), np.unique(np.concatenate([base[: size - gone], draw.integers(0, 2**64, new, dtype=np.uint64)]))
        both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if either > both and 100 * both >= percent * either:
            assert len(np.intersect1d(ngram_join.signatures(a, percent), ngram_join.signatures(b, percent)))


def test_records_round_trip(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(token_records.default_tokenizer())
    rows = token_records.digests(token_records.write_records(docs, files=3)).collect()
    start = 0
    for r, d in zip(sorted(rows, key=lambda r: r["doc_id"]), docs.orderBy("doc_id").collect(), strict=True):
        ids = [*tok.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_damaged_record_is_found():
    framed = bytearray(token_records.record(7, np.array([1, 2, 3]), "<u2"))
    assert token_records.contents(bytes(framed))[:2] == (7, 3)
    framed[20] ^= 1
    with pytest.raises(ValueError):
        token_records.unframe(bytes(framed))


def test_byte_bpe_against_tiktoken(docs):
    import base64

    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bpe.digests(bpe.encode(docs)).join(docs.select("doc_id", "text"), "doc_id").collect():
        text = r["text"] or ""
        ids = enc.encode_ordinary(text)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_line_dedup(spark):
    line = "the quick brown fox jumps over the lazy dog near the river bank today"
    rows = [(1, f"{line}\nshort"), (2, line.replace("fox", "cat")), (3, f"own words that nobody else has written here\n{line.upper()}"), (4, None), (5, ""), (6, "short\nshort"), (7, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("", 1), 3: ("own words that nobody else has written here", 1), 4: (None, 0), 5: ("", 0), 6: ("short\nshort", 0), 7: ("", 1)}
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def vectors(spark):
    draw = np.random.default_rng(2)
    base = draw.normal(size=(40, 8))
    x = np.concatenate([base, base[:20] + 0.05 * draw.normal(size=(20, 8)), base[:5]]).astype("f4")
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(100, None), (101, [0.0] * 8), (102, [float("nan")] * 8), (103, [1.0, None] * 4)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>"), {k: v.astype("f8") for k, v in enumerate(x)}


def test_near_vectors_against_brute_force(spark):
    df, x = vectors(spark)
    cos = {(a, b): x[a] @ x[b] / np.linalg.norm(x[a]) / np.linalg.norm(x[b]) for a, b in itertools.combinations(x, 2)}
    links = [p for p, c in cos.items() if c >= 0.95]
    want = partition(links, [*x, 100, 101, 102, 103])
    got = embed_dedup.near_duplicates(df, 0.95, interval=8).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == {k: (sum(k in p for p in links), v, v == k) for k, v in want.items()}


def test_top_k_against_brute_force(spark):
    df, x = vectors(spark)
    q = {k: np.floor(256 * v) for k, v in x.items()}
    got = {}
    for r in topk.top_k(df, k=5, every=5, annulus=8).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    want = {a: {i + 1: (b, int(-s)) for i, (s, b) in enumerate(sorted((-(q[a] @ q[b]), b) for b in q if b != a)[:5])} for a in q if a % 5 == 0}
    assert got == want


def test_main_text(spark):
    shared = "<div><p>Site wide box of words</p></div>"
    html = [f"<html><body><nav>menu</nav>{shared}<div><p>Text {k} &amp; more</p>\n<p>second   part {k}</p></div><footer>foot</footer></body></html>" for k in range(6)] + [None, "", "<p>open <b>tags"]
    rows = [(k, "http://a.example/x" if k < 6 else None, h, "clash") for k, h in enumerate(html)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()}
    assert got == {**{k: f"Text {k} & more\nsecond part {k}" for k in range(6)}, 6: "", 7: "", 8: "open tags"}


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    lang = queries.op6_language(spark, "/root/testdata/sf0.01").join(docs, "doc_id").filter("held_out and lang is not null and lang_pred <> 'und'")
    assert lang.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] >= 0.9
    good = queries.op10_quality(spark, "/root/testdata/sf0.01").join(labels, "doc_id").filter("held_out")
    assert good.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] >= 0.85


def test_models_take_any_text(spark, docs):
    model = langid.fit(docs, F.lit(True))
    assert langid.predict(docs, model).count() == docs.count()
    assert {r["lang_pred"] for r in langid.predict(docs, model).filter("doc_id < 3").collect()} == {"und"}
    labels = docs.filter("doc_id > 6").select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    scored = quality.score(docs, quality.fit(docs, labels, fold(F.col("doc_id")) != 0)).collect()
    assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    empty = spark.createDataFrame([], EMPTY)
    assert langid.predict(empty, langid.fit(empty, F.lit(True))).count() == 0
    assert quality.score(empty, quality.fit(empty, labels.limit(0))).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0
    whole = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert whole.filter("n <> end or n > 2048").count() == 0


def texts_of(spark, html, url="http://a.example/x"):
    rows = [(k, url, h) for k, h in enumerate(html)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(got, key=lambda r: r["page_id"])]


def test_template_inside_articles_and_text_outside(spark, monkeypatch):
    box = "<div><p>Ann writes for us</p></div>"
    html = [f"<body><p>Lead {k}</p><article><h1>Title {k}</h1><p>Text {k}</p>{box}</article><div>Rest {k}</div></body>" for k in range(6)]
    want = [f"Lead {k}\nTitle {k}\nText {k}\nRest {k}" for k in range(6)]
    assert texts_of(spark, html) == want
    monkeypatch.setattr(html_extract, "BROADCAST_ROWS", -1)
    assert texts_of(spark, html) == want
    same = [f"<body><div class='ad'>Advert {k}</div><article><p>One article</p></article></body>" for k in range(6)]
    assert texts_of(spark, same) == ["One article"] * 6
    teaser = "<article><p>Read this too</p></article>"
    shared = [f"<body><p>Long text of the page {k}</p>{teaser}{box}</body>" for k in range(6)]
    assert texts_of(spark, shared) == [f"Long text of the page {k}" for k in range(6)]


def test_text_on_few_pages_of_a_host_stays(spark):
    notice = "<p>The office is shut on Mondays</p>"
    html = [f"<body><div>Site box</div><p>Text {k} <b>in short</b> goes on</p>{notice if k < 6 else ''}</body>" for k in range(40)]
    assert texts_of(spark, html) == [f"Text {k} in short goes on" + ("\nThe office is shut on Mondays" if k < 6 else "") for k in range(40)]


def test_furniture_is_named_in_whole_and_holds_no_main_text(spark):
    for wrapper in ('<div class="layout has-sidebar">', '<div id="content" class="with-sidebar">', '<div class="sidebar">', "<form>"):
        menu = '<nav>menu menu</nav><ul class="share-buttons"><li>Share</li></ul>'
        table = '<div class="share-price-table">Price 5</div><p id="social-policy">Policy</p><p data-id="menu">Food</p><div class="site-footer">foot</div>'
        assert texts_of(spark, [f"<body>{wrapper}{menu}<article><p>Long main text here</p>{table}</article></div></form></body>"]) == ["Long main text here\nPrice 5\nPolicy\nFood"]
        assert texts_of(spark, [f"<body>{wrapper}{menu}<p>Long main text here</p></div></form></body>"]) == ["Long main text here"]


def test_line_dedup_finds_lines_with_replaced_words(spark):
    draw = random.Random(7)
    word = lambda: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randrange(4, 9)))
    rows, near = [], 0
    for size in (6, 10, 20, 50, 80):
        for _ in range(40):
            line = [word() for _ in range(size)]
            rows.append((len(rows), " ".join(line)))
            for k in draw.sample(range(size), max(1, size // 12)):
                line[k] = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=len(line[k])))
            rows.append((len(rows), " ".join(line)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = docs.alias("x").join(docs.alias("y"), F.expr("x.doc_id + 1 = y.doc_id and x.doc_id % 2 = 0"))
    near = {r[0] for r in pairs.filter("levenshtein(x.text, y.text) <= 0.2 * greatest(length(x.text), length(y.text))").select("y.doc_id").collect()}
    gone = {r["doc_id"] for r in line_dedup.dedup_lines(docs).filter("n_removed > 0").collect()}
    print(f"{len(gone)} of {len(near)} near copies found")
    assert gone <= near and len(gone) >= 0.95 * len(near) and len(near) > 150


def test_line_dedup_of_few_words_other_scripts_and_white_space(spark):
    chinese = "".join(map(chr, random.Random(4).sample(range(0x4E00, 0x9000), 60)))
    texts = ["All rights reserved.\n" + chinese, "all rights reserved.\t\r\nown line of this text here", chinese[:30] + "\u6c38" + chinese[31:], "one\ttwo\tthree", "\xa0one\ttwo\tthree\u3000"]
    got = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {0: texts[0], 1: "own line of this text here", 2: "", 3: texts[3], 4: ""}


def word_sets(docs, width):
    def shingles(t):
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall("[^\x20\x09-\x0d]+", t or "")]
        return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()

    return [shingles(t) for t in docs]


def test_jaccard_of_large_groups_in_many_tiles(spark):
    draw = random.Random(11)
    texts = []
    for _ in range(3):
        base = [f"w{draw.randrange(5000)}" for _ in range(150)]
        for _ in range(30):
            base = list(base)
            base[draw.randrange(len(base))] = f"n{draw.randrange(5000)}"
            texts.append(" ".join(base))
    sets = word_sets(texts, 3)
    want = partition([(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])], range(len(sets)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(df, 3, 90, tile_rows=4).collect()}
    assert got == want and len(set(want.values())) < 20


def test_union_bounds_what_a_group_can_share():
    draw = np.random.default_rng(4)
    group = [np.unique(draw.integers(0, 2**64, 50, dtype=np.uint64)) for _ in range(5)]
    union = np.unique(np.concatenate([ngram_join.short(x) for x in group]))
    near, far = np.unique(np.concatenate([group[2][:46], group[3][:1]])), np.unique(np.concatenate([group[0][:20], draw.integers(0, 2**64, 30, dtype=np.uint64)]))
    asked = ngram_join.Tile(b"", np.array([len(near), len(far)], "i8").tobytes(), np.concatenate([ngram_join.short(near), ngram_join.short(far)]).tobytes(), "<u4")
    assert ngram_join.qualifying(asked, union, 90).tolist() == [0]


def test_one_row_of_each_group_of_near_copies_stays(spark):
    draw = random.Random(12)
    texts = [None, "", " ", None]
    for _ in range(12):
        base = [f"w{draw.randrange(300)}" for _ in range(60)]
        texts += [" ".join(base)] * draw.choice([1, 2, 3])
        base[30] = "other"
        texts.append(" ".join(base))
    ids = [draw.choice([None, 5, 6]) if draw.random() < 0.3 else 100 + k for k in range(len(texts))]
    docs = spark.createDataFrame([(i, t, k, 1, 2) for k, (i, t) in enumerate(zip(ids, texts, strict=True))], "doc_id long, text string, n long, _doc long, component_id long")
    sets = word_sets(texts, 5)
    root = partition([(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])], range(len(sets)))
    kept = ngram_join.without_near_copies(docs)
    assert kept.columns == docs.columns
    rows = [r["n"] for r in kept.collect()]
    assert sorted(root[k] for k in rows) == sorted(set(root.values()))
    for k in rows:
        same = [ids[j] for j in root if root[j] == root[k]]
        assert ids[k] == min((i for i in same if i is not None), default=None)
    assert ngram_join.without_near_copies(docs.limit(0)).count() == 0


def test_line_dedup_with_clashing_columns_and_null_ids(spark):
    line = "a line of several words that stands in more than one document"
    rows = [(None, line, 1, 2, 3, 4), (1, line, 1, 2, 3, 4), (1, line, 5, 6, 7, 8), (None, None, 1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines long, key long, gone long, `a.b` long")
    got = sorted(((r["doc_id"] is None, r["text"], r["n_removed"], r["a.b"]) for r in line_dedup.dedup_lines(docs).collect()), key=repr)
    assert got == [(False, "", 1, 4), (False, "", 1, 8), (True, line, 0, 4), (True, None, 0, 4)]
    assert sorted(line_dedup.dedup_lines(docs).columns) == sorted(docs.columns + ["n_removed"])


def test_long_lines_are_compared_word_by_word(spark):
    draw = random.Random(13)
    word = lambda: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    one = [word() for _ in range(400)]
    near, far = list(one), list(one)
    for k in range(0, 400, 10):
        near[k] = word()
    for k in range(0, 400, 3):
        far[k] = word()
    docs = spark.createDataFrame(list(enumerate(map(" ".join, (one, near, far)))), "doc_id long, text string")
    assert [r["n_removed"] for r in line_dedup.dedup_lines(docs).orderBy("doc_id").collect()] == [0, 1, 0]


def clustered(spark):
    draw = np.random.default_rng(9)
    centres = draw.normal(size=(12, 8))
    x = np.concatenate([c + 0.02 * draw.normal(size=(50, 8)) for c in centres])
    return spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>"), x


def test_search_stops_before_far_annuli(spark):
    df, x = clustered(spark)
    held = common.stage(topk.packed(df, "vec_id", "embedding", topk.quantise), "vectors")
    opened = []
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.search(held, 5, 50, 12, 20, opened).collect()}
    q = np.floor(256 * x)
    want = {(a, i + 1): (b, int(-s)) for a in range(0, len(q), 50) for i, (s, b) in enumerate(sorted((-(q[a] @ q[b]), b) for b in range(len(q)) if b != a)[:5])}
    print(f"{opened[0]} of {opened[1]} pairs of a query and an annulus opened")
    assert got == want and opened[0] < 0.5 * opened[1]


def test_grid_order_skips_distant_intervals(spark):
    df, _ = clustered(spark)
    held = common.stage(embed_dedup.packed(df, "vec_id", "embedding", embed_dedup.unit), "units").withColumn("n", F.lit(1).cast("long"))
    eps = np.sqrt(2 - 2 * 0.95)
    parts = embed_dedup.intervals(held, embed_dedup.principal(embed_dedup.sample(held, 4096)), eps, 25)
    n = parts.select("interval").distinct().count()
    pairs = embed_dedup.near_intervals(parts, eps, 8, 1).count()
    print(f"{pairs} of {n * (n + 1) // 2} pairs of intervals joined")
    assert pairs < 0.5 * n * (n + 1) / 2


def test_vectors_of_unlike_dimensions_and_repeated_ids(spark):
    rows = [(k, [1.0, 0.1 * k]) for k in range(6)] + [(50, [1.0, 0.0, 0.0]), (51, [1.0, 0.01, 0.0]), (52, [0.0, 0.0, 1.0]), (52, [0.0, 0.0, 1.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame([(a, b, a) for a, b in rows], "vec_id long, embedding array<double>, id long")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in topk.top_k(df).collect()}
    assert {k: v for k, v in got.items() if k[0] == 50} == {(50, 1): 51, (50, 2): 52, (50, 3): 52} and {k[0] for k in got} == {0, 50}
    near = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.near_duplicates(df).filter("vec_id >= 50").collect()}
    assert near == {50: (1, 50), 51: (1, 50), 52: (2, 52)}
    assert topk.top_k(df.limit(0)).count() == 0 and embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_sample_is_bounded_and_a_digit_is_no_letter(spark):
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("label"))
    assert {r["label"]: r["count"] for r in common.hashed_sample(rows, "label", ["k"], 500).groupBy("label").count().collect()} == {"a": 500, "b": 500}
    docs = spark.createDataFrame([(k, t, "aa", 1, 2) for k, t in enumerate(["some words", "other words", "\u00bd\u00b2", "\u2167", None])] + [(None, "no id", "aa", 1, 2)], "doc_id long, text string, lang string, label long, _id long")
    got = langid.predict(docs, langid.fit(docs, F.lit(True))).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got] == ["aa", "aa", "aa", "und", "und", "und"]
    assert langid.keep(docs, langid.fit(docs, F.lit(True))).columns == docs.columns


def test_markup_parts_character_references(spark):
    assert texts_of(spark, ["<p>a &am<b>p;</b> b &amp; c</p>"]) == ["a &amp; b & c"]
