"""op7: the keys of lines are shuffled, but never written to a staged table beside that."""

from sessionlake.llm import line_dedup


def test_keys_of_lines_are_not_staged(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(line_dedup, "stage", lambda df, name, stage=line_dedup.stage: staged.append(df.columns) or stage(df, name))
    line = "the quick brown fox jumps over the lazy dog by the river"
    docs = spark.createDataFrame([(1, f"{line}\nshort"), (2, f"{line}s"), (3, line)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: f"{line}\nshort", 2: "", 3: ""}
    assert staged and not [c for c in staged if {"k0", "runs", "sim"} & set(c)]
