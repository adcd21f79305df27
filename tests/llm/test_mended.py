"""Cases that failed before: overflow of sample shares, groups of unlike sets, comments and forms longer than the article."""

import random
import string
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from sessionlake.llm import bpe, common, html_extract, line_dedup, ngram_join, quality, queries
from sessionlake.llm.shingles import mix


def test_sample_of_a_label_with_very_many_rows(spark, monkeypatch):
    rows = spark.range(1000).select("id", (F.col("id") % 2).alias("label"))
    monkeypatch.setattr(common, "small", lambda df, n: F.broadcast(df.withColumn("_of", F.col("_of") * 10**9)))
    got = common.hashed_sample(rows, "label", ["id"], 10).collect()
    assert len(got) <= 20  # a share so small that hardly a row is in it, without an overflow


def random_set(draw, n):
    return np.unique(mix(np.array([draw.randrange(1 << 62) for _ in range(n)], np.uint64)))


def test_unlike_sets_share_no_signature():
    draw = random.Random(6)
    seen = Counter(s for _ in range(10_000) for s in ngram_join.signatures(random_set(draw, draw.randrange(20, 60)), 80).tolist())
    assert max(seen.values()) <= 3


def test_similar_sets_share_a_signature():
    draw = random.Random(7)
    for percent in (80, 90):
        for n in [*range(4, 60), 100, 150, 300]:
            for _ in range(25):
                whole = random_set(draw, n)
                most = int(n * (100 - percent) / 100)  # the union is the whole; two sets lack some of it each
                lack = draw.sample(range(len(whole)), most)
                cut = draw.randrange(most + 1)
                a, b = np.delete(whole, lack[:cut]), np.delete(whole, lack[cut:])
                same = ngram_join.set_id(a) == ngram_join.set_id(b)
                assert same or set(ngram_join.signatures(a, percent).tolist()) & set(ngram_join.signatures(b, percent).tolist())


def test_comments_and_forms_go_whatever_their_length():
    article = "<article><h1>Title</h1><p>The short article.</p>{}</article>"
    long = "<p>" + "a reader says much " * 50 + "</p>"
    want = "Title\nThe short article."
    for extra in (f'<section class="comments">{long}</section>', f'<div id="comment-list"><article class="comment">{long}</article></div>', f'<div id="disqus_thread">{long}</div>'):
        assert html_extract.main_text(f"<body>{article.format('')}{extra}</body>") == want
        assert html_extract.main_text(f"<body>{article.format(extra)}</body>") == want
        assert html_extract.main_text(f"<body><div><h1>Title</h1><p>The short article.</p></div>{extra}</body>") == want
    assert html_extract.main_text(f"<body>{article.format(f'<form>{long}</form>')}</body>") == want
    assert html_extract.main_text(f"<body><form>{article.format('')}{'<input>' * 3}</form></body>") == want
    for name in ("alert", "recommended", "related-articles", "author-bio", "site-nav-v2", "pagination"):
        assert html_extract.main_text(f'<body>{article.format("")}<div class="{name}">Other</div></body>') == want
    assert html_extract.main_text("<body><article><div/><p>In <a href=/x/>a link</a></p></article></body>") == "In a link"


def test_menus_count_as_template(spark):
    menu = '<nav><ul><li>Home</li><li>More</li></ul></nav><div class="x"><p>Follow our letter</p></div>'
    rows = [(k, "http://h.example/a", f"<body>{menu}<p>Text number {k}</p></body>") for k in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen = html_extract.page_subtrees(pages).filter("subtree is not null").groupBy("subtree").count().filter("count = 8").count()
    assert seen >= 5  # the menu, its parts, and the box
    assert {r["text"] for r in html_extract.extract(pages).collect()} == {f"Text number {k}" for k in range(8)}


def test_registered_queries_have_their_operators():
    assert {f"op{k}" for k in range(1, 14)} == {n.split("_")[0] for n in queries.QUERIES}


def test_decoding_rows_that_have_a_column_decoded(spark):
    docs = spark.createDataFrame([(1, "a text", "x"), (2, None, "y")], "doc_id long, text string, decoded string")
    encoded = bpe.encode(docs)
    assert [bytes(r["decoded"] or b"") for r in bpe.decode(encoded.withColumn("decoded", encoded["doc_id"])).orderBy("doc_id").collect()] == [b"a text", b""]


def test_quality_sample_holds_one_text_of_a_repeated_id(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"bad text {k}") for k in range(50)] + [(2, "a good text, with care.")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    sizes = []
    monkeypatch.setattr(quality, "train", lambda x, y, weight, pairs: sizes.append(len(x)))
    quality.fit(docs, labels)
    assert sizes == [2]


def test_signatures_are_dealt_once(spark, monkeypatch):
    plans, real = {}, ngram_join.stage

    def staged(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(ngram_join, "stage", staged)
    words = [f"w{k}" for k in range(40)]
    texts = [" ".join(words), " ".join(words), " ".join([*words, "end"]), " ".join(reversed(words))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(docs).collect()} == {0: 0, 1: 0, 2: 0, 3: 3}
    assert plans["signatures"].count("Exchange hashpartitioning") == 2  # by signature and by set
    assert plans["tiles"].count("Exchange hashpartitioning") == 1  # the sets' shingles move once


def test_line_dedup_finds_lines_with_scattered_letters_changed(spark):
    draw, rows = random.Random(5), []
    for size in (8, 12, 20, 40):
        for _ in range(40):
            words = ["".join(draw.choices(string.ascii_lowercase, k=draw.randrange(3, 10))) for _ in range(size)]
            rows.append((len(rows), " ".join(words)))
            for i in range(draw.randrange(4), size, 4):
                j = draw.randrange(len(words[i]))
                words[i] = words[i][:j] + draw.choice(string.ascii_lowercase) + words[i][j + 1 :]
            rows.append((len(rows), " ".join(words)))
    gone = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).filter("n_removed > 0").count()
    assert gone >= 0.9 * len(rows) / 2  # 103 of 160 in a like run before there were keys of runs
