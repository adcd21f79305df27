"""A prefix trie over conversations, built family by family and then merged."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import drop_staged, range_column, shuffle_partitions, slices, stage

#: Nodes of a family that a task holds; more are handed on in parts, which the merging puts together again.
HELD_NODES = 100_000
#: Conversation ids whose text is put together at once.
IDS_AT_ONCE = 4096
ROOT = b"\0" * 16
NODES = "key binary, parent binary, depth long, words long, before long, members array<long>, ends array<long>"


def families(conversations: DataFrame, size: int = 20) -> DataFrame:
    """Each family's small trie: key, parent, depth, words, before, members, ends.

    A conversation's base is the conversation of id c - c % size; conversations of one base are a family, which meets
    in one task: base turns first, then conversation by conversation in turn order, read in one pass. A node's key is the
    128-bit hash of its turns; words are those of its last text, before those of the texts above it; members lists the
    family's conversations that start so (at most 2 * size), ends those of them that have no further turn.
    """
    base = F.col("conv_id") - F.col("conv_id") % size
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    rows = rows.filter("conv_id is not null").withColumn("base", base).withColumn("first", F.col("conv_id") == F.col("base"))
    rows = rows.withColumn("head", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4)
    met = rows.repartition(shuffle_partitions(conversations.sparkSession), "base")
    met = met.sortWithinPartitions("base", F.desc("first"), "conv_id", F.col("turn").asc_nulls_first(), "role", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: dict[bytes, list] = {}
        shared: list[tuple[str, str]] = []
        family = conv = None
        key, depth, before, at = ROOT, 0, 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [[k, *x] for k, x in nodes.items()]
            nodes.clear()
            for k in range(0, len(rows), 5000):
                kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                part = [pa.array(c, t) for c, t in zip(zip(*rows[k : k + 5000], strict=True), kinds, strict=True)]
                yield pa.record_batch(part, ["key", "parent", "depth", "words", "before", "members", "ends"])

        def visit(parent: bytes | None, words: int) -> None:
            node = nodes.get(key)
            if node is None:
                nodes[key] = [parent, depth, words, before, [conv], []]
            else:
                node[4].append(conv)

        def turn(role: str, text: str) -> None:
            nonlocal key, depth, before
            r, t = role.encode(), text.encode()
            parent, words = key, len(t.split())
            key = hashlib.blake2b(b"%b%d:%b%b" % (parent, len(r), r, t), digest_size=16).digest()
            depth += 1
            visit(parent, words)
            before += words

        def end() -> None:
            if key not in nodes:  # handed on meanwhile
                nodes[key] = [last, depth, last_words, before - last_words, [], []]
            nodes[key][5].append(conv)

        last: bytes | None = None
        last_words = 0
        for batch in slices(batches):
            for of, c, head, role, text in zip(*(batch.column(n).to_pylist() for n in ("base", "conv_id", "head", "role", "text")), strict=True):
                if c != conv or of != family:
                    if conv is not None:
                        end()
                    if of != family:
                        yield from flush()
                        shared, family = [], of
                    elif len(nodes) > HELD_NODES:
                        yield from flush()
                    conv, key, depth, before, at, last, last_words = c, ROOT, 0, 0, 0, None, 0
                    visit(None, 0)
                    if c != family:
                        for x in shared[:head]:
                            last, was = key, before
                            turn(*x)
                            last_words = before - was
                at += 1
                if c == family:
                    if len(shared) < 3:
                        shared.append((role, text))
                elif at <= head:
                    continue
                if len(nodes) > HELD_NODES:
                    yield from flush()
                last, was = key, before
                turn(role, text)
                last_words = before - was
        if conv is not None:
            end()
        yield from flush()

    return met.mapInArrow(build, NODES)


def ends_hash(ends: DataFrame) -> DataFrame:
    """key, ends_sha256 of rows (key, conv_id): SHA-256 of a key's decimal ids, ascending, joined by commas.

    Ids are put together by ranges first, so a key with very many is one row a range where it is hashed, in a stream.
    """
    n = max(1, ends.count() // IDS_AT_ONCE)
    ranged = range_column(ends, "conv_id", n, "range")
    texts = ranged.groupBy("key", "range").agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    texts = texts.repartition(shuffle_partitions(ends.sparkSession), "key").sortWithinPartitions("key", "range")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = state = None
        keys, sums = [], []
        for batch in batches:
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if key != now:
                    if now is not None:
                        keys.append(now)
                        sums.append(state.hexdigest())
                    now, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if len(keys) > 10_000:
                yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(sums)], ["key", "ends_sha256"])
                keys, sums = [], []
        if now is not None:
            keys.append(now)
            sums.append(state.hexdigest())
        if keys:
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(sums)], ["key", "ends_sha256"])

    return texts.select("key", "ids", "range").mapInArrow(digest, "key binary, ends_sha256 string")


def trie(conversations: DataFrame, size: int = 20) -> DataFrame:
    """Every node of the trie over rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    A conversation is rebuilt from the first crc32(id) % 4 turns of its family's base and its own turns after so many.
    Families build their tries by themselves; only their combined nodes are merged, by partial sums, so the root and
    other common nodes are a row a task. Sums over subtrees take no walk level by level: a conversation that is the
    smallest member of some nodes is so of all from some depth on, its own stretch; what a subtree holds is then its
    members' stretches, the conversation of its top counted from that top on, and a sum over members gives it.

    Turns are ordered by turn (null first), role and text; a null role or text is an empty one; rows without conv_id are
    ignored; repeated rows are turns of their own; other columns are ignored; an empty table gives no node. A
    conversation of very many turns is read in order by one task, in bounded memory.
    """
    fam = stage(families(conversations, size), "families")
    merged = fam.groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("words").alias("words"), F.first("before").alias("before"),
        F.sum(F.size("members")).alias("n_convs"), F.min(F.array_min("members")).alias("conv_id"))
    nodes = stage(merged, "nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes_of = stage(nodes.join(children, "key", "left").fillna(0, ["n_children"]), "nodes")
    drop_staged(nodes)
    stretches = nodes_of.groupBy("conv_id").agg(F.min("depth").alias("_from"), F.sum("words").alias("_words"), F.count_if(F.col("n_children") == 0).alias("_leaves"))
    ends = stage(fam.select("key", F.explode("ends").alias("conv_id"), (F.col("before") + F.col("words")).alias("total")), "ends")
    convs = ends.drop("key").join(stretches, "conv_id", "left")
    members = fam.select("key", "depth", F.explode("members").alias("conv_id")).join(convs, "conv_id")
    below = F.col("_from") > F.col("depth")
    sums = members.groupBy("key").agg(F.sum("total").alias("totals"), F.sum(F.when(below, F.col("_words")).otherwise(0)).alias("others"), F.sum(F.when(below, F.col("_leaves")).otherwise(0)).alias("leaves"))
    tops = nodes_of.join(convs.select("conv_id", "total", "_leaves"), "conv_id").join(sums, "key").join(ends_hash(ends.select("key", "conv_id")), "key", "left")
    distinct = F.col("total") - F.col("before") + F.col("others")
    found = tops.select(
        "parent", "conv_id", "depth", "n_convs", "n_children", (F.col("leaves") + F.col("_leaves")).alias("n_leaves"),
        (F.col("totals") - F.col("n_convs") * F.col("before") - distinct).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
    parents = nodes_of.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return found.join(parents, "parent", "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
