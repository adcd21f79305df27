"""Fingerprints, the conversation trie and the divergence audit against brute force on small fixtures."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from sessionlake.llm import common, conversation_trie, divergence, fingerprints
from tests.compare import rows_of

DOCS = "doc_id long, text string, lang string, source string, range int, head string, n long, term string"


def texts(seed, n):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["Ünïted", "DON'T", "42", "日本"]
    out = [None, "", " ", "a", "ab", "x" * 5000, "é" * 700]
    while len(out) < n:
        out.append(" ".join(draw.choice(words) for _ in range(draw.choice([3, 30, 200, 900]))))
    return [*out, *out[-4:]]


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(1)
    rows = [(k if k != 20 else None, t, draw.choice(["aa", "bb", None]), draw.choice(["s", "t", "ü", None, ""]), 7, "h", 1, "t") for k, t in enumerate(texts(2, 60))]
    rows += [rows[9], rows[9]]
    return spark.createDataFrame(rows, DOCS).cache()


def slow_ends(data):
    """Chunk ends by the rolling hash, byte by byte."""
    out, start, h = [], 0, 0
    for k, b in enumerate(data):
        h = (2 * h + int(fingerprints.GEAR[b])) % (1 << 32)
        n = k + 1 - start
        bits = fingerprints.STRICT if n < fingerprints.USUAL else fingerprints.LOOSE
        if n >= fingerprints.LEAST and h >> (32 - bits) == 0 or n == fingerprints.MOST or k + 1 == len(data):
            out.append(k + 1)
            start = k + 1
    return out


def slow_print(text):
    data, at, found = text.encode(), 0, set()
    for e in slow_ends(data):
        found.add((fingerprints.xxhash.xxh3_64_intdigest(data[at:e]), e - at))
        at = e
    return found


def slow_near(a, b):
    return sum(n for _, n in a & b) / sum(n for _, n in a) if a else float(not b)


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_fingerprints_equal_rolling_hash(spark, docs, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = fingerprints.edited_fingerprints(docs.filter("doc_id is null or doc_id <> 9")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = sorted([(r["doc_id"], r["text"] or "") for r in docs.collect() if r["doc_id"] != 9], key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(text)
        edited = text[: n - n // 2] + after[: n // 2]
        r, a, b = by[i], slow_print(text), slow_print(edited)
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert r["fingerprint"] == "".join(f"{d:016x}{m:04x}" for d, m in sorted(a)) == fingerprints.fingerprint(text)
        assert r["edited_fingerprint"] == "".join(f"{d:016x}{m:04x}" for d, m in sorted(b))
        assert r["near_edited"] == pytest.approx(slow_near(a, b)) and r["near_next"] == pytest.approx(slow_near(a, slow_print(after)))


def test_fingerprints_of_repeated_rows_one_row_and_none(spark, docs):
    got = fingerprints.edited_fingerprints(docs.filter("doc_id = 9")).collect()
    assert len(got) == 3 and {r["near_next"] for r in got} == {1.0} and len({r["fingerprint"] for r in got}) == 1
    assert [r["near_next"] for r in fingerprints.edited_fingerprints(docs.filter("doc_id is null")).collect()] == [1.0]
    assert fingerprints.edited_fingerprints(docs.limit(0)).count() == 0


def test_gear_blocks_join_without_a_seam(monkeypatch):
    data = random.Random(4).randbytes(9000)
    whole = fingerprints.chunk_ends(data)
    monkeypatch.setattr(fingerprints, "BLOCK", 100)
    assert fingerprints.chunk_ends(data) == whole == slow_ends(data)


def test_chunks_resist_a_shift():
    text = " ".join(texts(5, 40)[30:])
    a, b = slow_print(text), slow_print("one more line\n" + text)
    assert slow_near(a, b) > 0.9


def test_range_column(spark):
    df = spark.createDataFrame([(k % 50 if k % 7 else None,) for k in range(500)], "v long")
    got = common.range_column(df, "v", 5, "r").collect()
    order = sorted((r["v"], r["r"]) for r in got if r["v"] is not None)
    assert [r for _, r in order] == sorted(r for _, r in order) and len({r for _, r in order}) == 5
    assert {r["r"] for r in got if r["v"] is None} == {-1}
    assert common.range_column(df.limit(0), "v", 5, "r").count() == 0


def rebuilt(rows, size=20):
    by = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by[c].append((role or "", text or ""))
    out = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = by.get(c - c % size, [])[:h] + own[h:]
    return out


def slow_trie(rows):
    convs = rebuilt(rows)
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[: len(path)] == path]
        ends = ",".join(map(str, sorted(c for c in members if len(convs[c]) == len(path))))
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode().split()) for p in under if p)
        leaves = sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in under) for p in under)
        children = sum(len(p) == len(path) + 1 for p in under)
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module")
def conversations():
    draw = random.Random(8)
    rows = []
    for c in [*range(70), 103, 119, 200, 201, 1000]:
        for t in range(draw.randrange(1, 6)):
            rows.append((c, t, draw.choice(["user", None]), draw.choice(["hello there", "a  b\tc", "", None, "日 本"])))
    rows += [(205, None, "user", "first"), (205, 0, "user", "z"), (205, 0, "user", "a"), (205, 0, "user", "a"), (None, 1, "user", "lost")]
    return rows + [(c, t, "user", "the same") for c in range(300, 360) for t in range(3)]


@pytest.mark.parametrize("held", [100_000, 3])
def test_trie_equals_brute_force(spark, conversations, held, monkeypatch):
    monkeypatch.setattr(conversation_trie, "HELD_NODES", held)
    monkeypatch.setattr(conversation_trie, "IDS_AT_ONCE", 7)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in conversations], "conv_id long, turn long, role string, text string, depth int, key string, base long").repartition(5)
    got = conversation_trie.trie(df)
    assert rows_of(got.columns, got.collect()) == rows_of(TRIE, slow_trie(conversations))


def test_trie_of_turnless_conversations_and_none(spark):
    lone = [(c, 0, "user", "x") for c in (21, 22, 23, 25, 26)]
    got = conversation_trie.trie(spark.createDataFrame(lone, "conv_id long, turn long, role string, text string"))
    assert rows_of(got.columns, got.collect()) == rows_of(TRIE, slow_trie(lone))
    assert conversation_trie.trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def slow_audit(rows, least=10, top=10):
    groups, seen = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        text = "".join(c if c.isascii() and c.isalpha() or ord(c) > 127 else " " for c in text or "")
        words = "".join(c.lower() if c.isascii() else c for c in text).split(" ")
        words = [w for w in words if w]
        groups[lang or "", source or ""].update(words)
        seen[lang or ""].update(set(words))
    out = []
    for lang in {x for x, _ in groups}:
        kept = sorted(t for t, n in seen[lang].items() if n >= least)
        here = {s: g for (x, s), g in groups.items() if x == lang}
        whole = sum(here.values(), Counter())

        def shares(g, kept=kept):
            total = sum(g[t] for t in kept)
            return {t: 1 + 10**9 * (g[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: shares(g) for s, g in here.items()}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in here:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in here if o != s))
            terms = sorted(((-f(p[s][t], q[t]), t.encode(), t) for t in kept if here[s][t] and p[s][t] > q[t]))[:top]
            out += [(lang, s, "pair", x[2], -x[0], k) for k, x in enumerate(pairs, 1)] + [(lang, s, "term", x[2], -x[0], k) for k, x in enumerate(terms, 1)]
    return out


AUDIT = ["lang", "source", "part", "item", "value", "rank"]


@pytest.mark.parametrize("held", [800_000, 5])
def test_audit_equals_brute_force(spark, docs, held, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_COUNTS", held)
    rows = [(r["lang"], r["source"], r["text"]) for r in docs.collect()] + [("cc", s, t) for s, t in (("s", "one two"), ("t", None), ("", "  "))]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "lang string, source string, text string, n int, a string")
    got = divergence.audit(df)
    assert rows_of(got.columns, got.collect()) == rows_of(AUDIT, slow_audit(rows))
    assert divergence.audit(df.limit(0)).count() == 0


def test_shares_of_very_large_counts(spark):
    row = spark.range(1).select(divergence.share(*(common.F.lit(x).cast("long") for x in (9 * 10**17, 10**18, 10**6))).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (9 * 10**17 + 2) // (10**18 + 2 * 10**6)
