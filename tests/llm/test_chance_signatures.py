"""Near copies: sets that share a signature by chance go no further, signatures aren't staged, stages are deleted once read."""

import os
import random

import numpy as np

import corpus_pipeline
from sessionlake.llm import ngram_join
from sessionlake.session import shared_folder

SF = "/root/testdata/sf0.001"


def staged_by(monkeypatch):
    found = {}

    def kept(df, name, stage=ngram_join.stage):
        out = stage(df, name)
        found.setdefault(name, (out.columns, out.count()))
        return out

    monkeypatch.setattr(ngram_join, "stage", kept)
    return found


def test_sets_that_share_a_signature_by_chance_make_no_tiles(spark, monkeypatch):
    draw, staged = random.Random(5), staged_by(monkeypatch)
    common = [" ".join(f"c{k}w{i}" for i in range(5)) for k in range(20)]
    texts = []
    for k in range(300):
        words = [f"d{k}w{i}" for i in range(280)]
        for place, part in zip(sorted(draw.sample(range(280), 20), reverse=True), common, strict=True):
            words.insert(place, part)
        texts.append(" ".join(words))
    rows = [*enumerate(texts), (1000, texts[7] + " more"), (1001, "other " + texts[7])]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), width=5, percent=80).collect()}
    assert got == {k: k if k < 1000 else 7 for k, _ in rows}
    assert staged["groups"][1] == 3  # the copies alone
    assert "sigs" not in {c for columns, _ in staged.values() for c in columns}


def test_counts_keep_all_similar_sets():
    draw = np.random.default_rng(3)
    for percent in (40, 80, 90):
        for size in (1, 2, 5, 30, 130, 700, 5000):
            for kind in range(8):
                a = draw.integers(0, 1 << 63, size, "u8") << np.uint64(1)
                if kind % 2:
                    a >>= np.uint64(9)  # crowded in few ranges
                common = -(-percent * size // 100) if kind % 4 < 2 else size  # fewer elements, or more
                b = a[:common] if kind % 4 < 2 else np.concatenate([a, draw.integers(0, 1 << 63, size * (100 - percent) // percent, "u8")])
                sets = [np.unique(x) for x in (a, b, draw.integers(0, 1 << 63, 4 * size, "u8"))]
                assert 100 * len(np.intersect1d(*sets[:2])) >= percent * len(np.union1d(*sets[:2]))
                assert ngram_join.paired(np.array([len(x) for x in sets]), [ngram_join.counts_of(x) for x in sets], percent)[:2].all()
    far = [np.unique(draw.integers(0, 1 << 63, 300, "u8") << np.uint64(1)) for _ in range(50)]
    assert not ngram_join.paired(np.array([len(x) for x in far]), [ngram_join.counts_of(x) for x in far], 80).any()


def test_pipeline_deletes_stages_once_they_are_read(spark):
    folder = shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert [x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before if x.startswith("pipeline-")] == ["pipeline-near_copies"]
