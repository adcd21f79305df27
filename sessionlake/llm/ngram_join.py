"""N-gram Jaccard self-join by a token-group matrix."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import components, drop_staged, slices, small, stage
from sessionlake.llm.shingles import mix, shingler

#: Documents and shingles of a tile, the part of a group that one task opens, and rows that may be broadcast; to texts more may, as they are larger.
TILE_ROWS, TILE_TOKENS, BROADCAST_ROWS, TEXT_ROWS = 256, 200_000, 300_000, 1_000_000
#: Parts of fewer elements than this, on average, are often empty; so many parts that differences can't hit all of them.
FEW_ELEMENTS, MANY = 6, 24
#: Sets whose signatures a task remembers to have given.
HAD = 50_000
#: Ways to part a set that has hardly any elements in some part.
WAYS = 6
#: Sets of one signature that are compared by their counts, all with all; those of a signature that more share stay without that.
PAIRED = 1024


@lru_cache
def bands(limit: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Size bands and their numbers of parts.

    Two sets with a Jaccard similarity of at least percent / 100 lie in one band or in neighbouring ones. For such a
    pair whose smaller set lies in band b at most parts[b] - 1 elements lie in one of them alone. The first band is 1.
    """
    t = Fraction(percent, 100)
    starts = [1, 2]
    while starts[-1] <= limit:
        starts.append(max(int((starts[-1] - 1) / t) + 1, starts[-1] + 1))
    x = [s - 1 for s in starts[1:]]
    parts = [int((a + int(a / t)) * (1 - t) / (1 + t)) + 1 for a in x]
    return np.array(starts[:-1], "i8"), np.array(parts, "i8")


def less_one(tokens: np.ndarray, mixed: np.ndarray, band: int, m: int) -> list[np.ndarray]:
    """Hashes of the nonempty ones of m parts, and of what is left of them without any one element, if anything is.

    Sets with a part that differs in one element at most share one, unless the part has that element alone or none; then
    it has one at most in either set, and both sets are parted anew, in another way. After so many ways the empty
    hash counts, too; few sets get there, so it makes no large group.
    """
    out = []
    for way in range(WAYS):
        spread = mix(tokens ^ np.uint64(way)) if way else tokens
        part = (((spread >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype("i8")
        sums, counts = np.zeros(m, np.uint64), np.bincount(part, minlength=m)
        np.add.at(sums, part, mixed)
        names = mix(np.arange(m, dtype=np.uint64) + np.uint64(band * 1_000_003 + way * 500_009))
        least = -1 if way + 1 == WAYS else 0
        whole, rest = counts > least, counts[part] > least + 1
        out += [mix(sums[whole] ^ names[whole]), mix((sums[part] - mixed)[rest] ^ names[part][rest])]
        if counts.min() > 1:
            break
    return out


def signatures(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the parts of a set, for its own band and the one below.

    The hash space is cut into as many parts as the band has. Sets that differ in fewer elements than there are parts
    have a part in common, so similar sets share a signature. Bands where only equal sets qualify give none. Where parts
    hold few elements, many are empty, and unlike sets would share those: with MANY parts or more an empty part gives no
    signature (differences would have to hit each of the others, a chance below 1 in 10^8); with fewer, half as many
    parts are made, one of which differs in one element at most, and parts without any one element are hashed as well.
    """
    starts, parts = bands(1 << max(10, int(len(tokens)).bit_length()), percent)
    own = int(np.searchsorted(starts, len(tokens), "right")) - 1
    mixed = mix(tokens)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    out = []
    for band in (own, own - 1):
        if band >= 0 and (m := int(parts[band])) > 1:
            sparse = int(starts[band]) < FEW_ELEMENTS * m
            if sparse and m < MANY:
                out += less_one(tokens, mixed, band, (m + 1) // 2)
                continue
            part = ((tokens >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            ends = np.searchsorted(part, np.arange(m + 1, dtype=np.uint64))
            sums, names = total[ends[1:]] - total[ends[:-1]], mix(np.arange(m, dtype=np.uint64) + np.uint64(band * 1_000_003))
            if sparse:
                full = ends[1:] > ends[:-1]
                sums, names = sums[full], names[full]
            out.append(mix(sums ^ names))
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def counts_of(tokens: np.ndarray) -> bytes:
    """How many tokens lie in each of equal ranges, one for some four tokens, 32 at least and a power of two; 255 stands for more, too."""
    k = max(32, 1 << (len(tokens) // 4).bit_length())
    return np.minimum(np.bincount((tokens >> np.uint64(65 - k.bit_length())).astype("i8"), minlength=k), 255).astype("u1").tobytes()


def paired(sizes: np.ndarray, counts: list[bytes], percent: int) -> np.ndarray:
    """Which of some sets may be similar to another of them.

    What their counts differ by in all ranges is at most the number of elements that one of two sets has alone, which is
    bounded for similar sets; so no similar pair is lost. Counts of more ranges are added up to those of fewer.
    """
    found, widths = np.zeros(len(sizes), bool), np.array([len(x) for x in counts])
    for k in np.unique(widths):
        rows = np.flatnonzero(widths >= k)
        of = np.stack([np.minimum(np.frombuffer(counts[i], "u1").reshape(k, -1).sum(1, dtype="i4"), 255).astype("i2") for i in rows])
        for at in np.flatnonzero((widths[rows] == k) & ~found[rows]):
            near = (100 + percent) * np.abs(of - of[at]).sum(1) <= (100 - percent) * (sizes[rows] + sizes[rows[at]])
            near[at] = False
            found[rows[near]] = True
            found[rows[at]] |= near.any()
    return found


def likely_sets(few: DataFrame, percent: int) -> DataFrame:
    """set_id and sig of the sets (set_id, size, counts) of each sig that may be similar to another set of it."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            ids, sigs = [np.empty(0, "i8")], [np.empty(0, "i8")]
            for sig, of in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names, sizes, counts = of.values.flatten()
                near = paired(sizes.to_numpy(), counts.to_pylist(), percent)
                ids.append(names.to_numpy()[near])
                sigs.append(np.full(near.sum(), sig, "i8"))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(sigs))], ["set_id", "sig"])

    return few.select("sig", "sets").mapInArrow(kept, "set_id long, sig long")


def set_id(tokens: np.ndarray) -> int | None:
    """64-bit fingerprint of a set; None where it is empty."""
    return int(mix(mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))).view(np.int64)) if len(tokens) else None


def sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, counts (of tokens in ranges), set_id (fingerprint of the set; null where it is empty), sigs (its signatures; none for a set that its task has just had)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, had = shingler(width), set()
        for batch in slices(batches):
            found = [make.shingles(text) for text in batch.column(2).to_pylist()]
            names, sigs = [set_id(x) for x in found], []
            for name, tokens in zip(names, found, strict=True):
                sigs.append(np.empty(0, np.int64) if name in had else (signatures(tokens, percent) >> np.uint64(16)).view(np.int64))  # 48 bits: sets that share one by chance part by their counts
                had.add(name)
            if len(had) > HAD:
                had.clear()
            flat = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sigs)]), pa.int32()), pa.array(np.concatenate(sigs)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(x) for x in found], pa.int64()), pa.array([counts_of(x) for x in found], pa.binary()), pa.array(names, pa.int64()), flat], ["doc_id", "text_hash", "n_shingles", "counts", "set_id", "sigs"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string"))
    return rows.mapInArrow(hashed, "doc_id long, text_hash long, n_shingles long, counts binary, set_id long, sigs array<long>")


class Tile:
    """Sets of one tile: their ids, and their sorted tokens one after the other."""

    def __init__(self, ids: bytes, sizes: bytes, tokens: bytes, kind: str = "<u8"):
        self.ids, self.sizes, self.tokens = np.frombuffer(ids, "i8"), np.frombuffer(sizes, "i8"), np.frombuffer(tokens, kind)
        self.rows = np.repeat(np.arange(len(self.sizes)), self.sizes)


def short(tokens: np.ndarray) -> np.ndarray:
    """The upper halves of tokens: what two sets share can only seem more by them."""
    return (tokens >> np.uint64(32)).astype("<u4")


def held_in(tokens: np.ndarray, union: np.ndarray) -> np.ndarray:
    """Which tokens are in a sorted union."""
    return union[np.minimum(np.searchsorted(union, tokens), len(union) - 1)] == tokens if len(union) else np.zeros(len(tokens), bool)


def qualifying(queries: Tile, union: np.ndarray, percent: int) -> np.ndarray:
    """Rows of queries that may have a partner in the group of a union: similar sets share at least percent of either."""
    return np.flatnonzero(np.bincount(queries.rows, held_in(queries.tokens, union), len(queries.sizes)) * 100 >= percent * queries.sizes)


def links(a: Tile, b: Tile, queries: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between the sets of a that queries tells and those of b (perhaps a itself), as many as keep the same sets connected."""
    good_a, good_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
    good_a[queries] = True
    asked = np.unique(a.tokens[good_a[a.rows]])
    inside = held_in(b.tokens, asked)
    good_b[np.bincount(b.rows, inside, len(b.ids)) * 100 >= percent * b.sizes] = True
    rows_a, rows_b = np.flatnonzero(good_a), np.flatnonzero(good_b)
    take_b = inside & good_b[b.rows]
    take_a = good_a[a.rows] & held_in(a.tokens, np.unique(b.tokens[take_b]))
    vocabulary, local = np.unique(np.concatenate([a.tokens[take_a], b.tokens[take_b]]), return_inverse=True)
    cut = int(take_a.sum())
    to_a, to_b = np.zeros(len(a.ids), "i8"), np.zeros(len(b.ids), "i8")
    to_a[rows_a], to_b[rows_b] = np.arange(len(rows_a)), np.arange(len(rows_b))
    ra, rb, ca, cb = to_a[a.rows[take_a]], to_b[b.rows[take_b]], local[:cut], local[cut:]
    common = np.zeros((len(rows_a), len(rows_b)), np.float32)
    step = 8192
    for lo in range(0, len(vocabulary), step):
        x, y = np.zeros((len(rows_a), step), np.float32), np.zeros((len(rows_b), step), np.float32)
        sa, sb = (ca >= lo) & (ca < lo + step), (cb >= lo) & (cb < lo + step)
        x[ra[sa], ca[sa] - lo] = 1
        y[rb[sb], cb[sb] - lo] = 1
        common += x @ y.T
    common = common.astype("i8")
    union = a.sizes[rows_a][:, None] + b.sizes[rows_b][None, :] - common
    linked = 100 * common >= percent * union
    ids = np.concatenate([a.ids[rows_a], b.ids[rows_b]])
    return spanning(linked, ids)


def spanning(linked: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """For a matrix of links between len(linked) rows and the other ids: each id that has a link, with one of its component."""
    n = len(linked)
    label = np.arange(len(ids))
    for i in np.flatnonzero(linked.any(1)):
        mine = np.concatenate([[i], n + np.flatnonzero(linked[i])])
        roots = np.unique(label[mine])
        if len(roots) > 1:
            label[np.isin(label, roots)] = roots[0]
    least = label[label]
    return [(int(ids[k]), int(ids[r])) for k, r in enumerate(least) if ids[k] != ids[r]]


def tiled(rows: DataFrame) -> DataFrame:
    """Tiles of (group, tile, set_id, tokens), staged: ids, sizes and tokens of their sets, and in short form too with their union."""

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("set_id")
        tokens = np.frombuffer(b"".join(rows["tokens"]), "<u8")
        out = {"group": rows["group"].iloc[:1], "tile": rows["tile"].iloc[:1], "ids": [rows["set_id"].to_numpy("i8").tobytes()], "sizes": [(rows["tokens"].str.len() // 8).to_numpy("i8").tobytes()], "tokens": [tokens.tobytes()]}
        return pd.DataFrame(out | {"short": [short(tokens).tobytes()], "union": [np.unique(short(tokens)).tobytes()]})

    return stage(rows.groupBy("group", "tile").applyInPandas(gather, "group long, tile long, ids binary, sizes binary, tokens binary, short binary, union binary"), "tiles")


def within(tiles: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) inside each tile."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            out: list[tuple[int, int]] = []
            for row in zip(*batch.columns, strict=True):
                tile = Tile(*(x.as_py() for x in row))
                if len(tile.ids) > 1:
                    out += links(tile, tile, np.arange(len(tile.ids)), percent)
            x = np.array(out, "i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["a", "b"])

    return tiles.select("ids", "sizes", "tokens").mapInArrow(compare, "a long, b long")


def opened(pairs: DataFrame, asking: DataFrame, tiles: DataFrame, percent: int) -> DataFrame:
    """Links between tiles: pairs (a, ta, b, tb) of a tile of asking and one of tiles.

    The stored union of (b, tb) bounds what each set of (a, ta) can share with any set there; only where some set
    qualifies are both tiles opened, and only such sets are compared.
    """
    place = ["a", "ta", "b", "tb"]
    a, b = [F.col("group").alias("a"), F.col("tile").alias("ta")], [F.col("group").alias("b"), F.col("tile").alias("tb")]

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found = [qualifying(Tile(b"", sizes.as_py(), tokens.as_py(), "<u4"), np.frombuffer(union.as_py(), "<u4"), percent) for sizes, tokens, union in zip(*batch.columns[4:], strict=True)]
            out = pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([x.astype("<i4").tobytes() for x in found], pa.binary())], [*place, "queries"])
            yield out.filter(pa.array([len(x) > 0 for x in found], pa.bool_()))

    pairs = small(stage(pairs, "tile-pairs"), BROADCAST_ROWS)
    met = small(stage(pairs.select("b", "tb").distinct(), "tiles-met"), BROADCAST_ROWS)  # so that tiles without a pair aren't shuffled
    unions = tiles.select(*b, "union").join(met, ["b", "tb"], "left_semi")
    bounds = asking.select(*a, "sizes", "short").join(pairs, ["a", "ta"]).join(unions, ["b", "tb"]).select(*place, "sizes", "short", "union")
    wanted = stage(bounds.mapInArrow(bound, "a long, ta long, b long, tb long, queries binary"), "opened")
    met = small(stage(wanted.select("b", "tb").distinct(), "tiles-met"), BROADCAST_ROWS)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            out: list[tuple[int, int]] = []
            for row in zip(*batch.columns, strict=True):
                queries, *parts = (x.as_py() for x in row)
                out += links(Tile(*parts[:3]), Tile(*parts[3:]), np.frombuffer(queries, "<i4"), percent)
            x = np.array(out, "i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["a", "b"])

    one = asking.select(*a, *(F.col(c).alias(f"{c}_a") for c in ("ids", "sizes", "tokens")))
    two = tiles.select(*b, *(F.col(c).alias(f"{c}_b") for c in ("ids", "sizes", "tokens")))
    both = one.join(small(wanted, BROADCAST_ROWS // 10), ["a", "ta"]).join(two.join(met, ["b", "tb"], "left_semi"), ["b", "tb"])
    return both.select("queries", *(f"{c}_{s}" for s in "ab" for c in ("ids", "sizes", "tokens"))).mapInArrow(compare, "a long, b long")


def link_sets(docs: DataFrame, width: int = 3, percent: int = 90, broadcast_rows: int = BROADCAST_ROWS, tile_rows: int = TILE_ROWS, text_rows: int = TEXT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(sets of all documents, components of set ids).

    1. Equal sets become one. A set's tokens, for looking up groups, are the signatures of its parts; a signature that
       one set alone has is dropped at once, and so are those of sets that are unlike all others that share one, by
       their counts of tokens in ranges.
    2. A set joins the group of the signature that most sets share with it, so copies of a text fall together. Groups
       come in tiles, which store their sets and the union of their shingles.
    3. The token-group matrix: per signature the groups that hold it. Two groups that share none can't hold similar
       sets. For the other pairs the stored union bounds how much a set can share with a group; only where that is
       enough is the group opened, and what qualifies is compared by exact counts.
    4. The first round compares the sets of a tile, each tile with the first of its group, and first tiles of groups
       with each other. Most sets of a large group are then connected; the second round compares only the others with
       all tiles. A task passes on only links that connect, never all pairs of a group.
    """
    # documents and signatures are dealt together, so signatures, most of which no other set has, are never staged
    of_sig, of_set = Window.partitionBy("sig"), Window.partitionBy("set_id")
    rows = sets(docs, width, percent).select("set_id", F.struct("doc_id", "text_hash", "n_shingles", "counts").alias("doc"), F.explode(F.array_prepend("sigs", F.lit(None).cast("long"))).alias("sig"))
    rows = rows.select("set_id", F.coalesce("sig", F.xxhash64("doc.doc_id", "doc.text_hash")).alias("sig"), F.when(F.col("sig").isNull(), F.col("doc")).alias("doc"))
    bounds = rows.withColumns({"_least": F.min("set_id").over(of_sig), "_most": F.max("set_id").over(of_sig)})
    dealt = stage(bounds.filter("doc is not null or _least <> _most").drop("_least", "_most"), "sets")
    held, n = dealt.filter("doc is not null").select("doc.*", "set_id"), F.count("*").over(of_sig)
    shared = stage(dealt.filter("doc is null").select("set_id", "sig").distinct().withColumn("n", n), "shared")
    # unlike sets share a signature by chance, the more sets there are, so only sets whose counts allow a link go on
    of_each = held.filter("set_id is not null").groupBy("set_id").agg(F.first("n_shingles").alias("size"), F.first("counts").alias("counts"))
    few = shared.filter(F.col("n") <= PAIRED).join(of_each, "set_id").groupBy("sig").agg(F.collect_list(F.struct("set_id", "size", "counts")).alias("sets"))
    likely = shared.filter(F.col("n") > PAIRED).select("set_id", "sig").union(likely_sets(few, percent))
    live = stage(likely.withColumn("n", n).select("set_id", "sig", F.max_by("sig", F.struct("n", "sig")).over(of_set).alias("group")), "signatures")
    members = stage(live.select("set_id", "group").distinct(), "groups")
    matrix = live.select("sig", "group").distinct()
    left, right = matrix.select("sig", F.col("group").alias("a")), matrix.select("sig", F.col("group").alias("b"))
    met = stage(left.join(right, "sig").filter("a < b").select("a", "b").distinct(), "met")

    # the sets of groups, shingled again from one text each
    first = stage(held.join(small(members, broadcast_rows), "set_id").groupBy("set_id", "group").agg(F.min(F.struct("text_hash", "doc_id")).alias("_of"), F.first("n_shingles").alias("size")), "first")
    sizes = stage(first.groupBy("group").agg(F.greatest(F.ceil(F.count("*") / tile_rows), F.ceil(F.sum("size") / TILE_TOKENS)).alias("tiles")), "group-sizes")
    wanted = stage(first.join(small(sizes, broadcast_rows), "group").select(F.col("_of.text_hash").alias("_hash"), F.col("_of.doc_id").alias("_id"), F.col("set_id").alias("_set"), "group", F.pmod(F.xxhash64("set_id"), "tiles").alias("tile")), "wanted")
    texts = docs.select(F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(small(wanted, text_rows), (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id"))).select("text", "_set", "group", "tile")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = shingler(width)
        for batch in slices(batches):
            found = [make.shingles(x) for x in batch.column("text").to_pylist()]
            same = pa.array([set_id(x) == b for x, b in zip(found, batch.column("_set").to_pylist(), strict=True)])  # of texts of one hash
            yield pa.RecordBatch.from_arrays([batch.column("group"), batch.column("tile"), batch.column("_set"), pa.array([x.tobytes() for x in found], pa.binary())], ["group", "tile", "set_id", "tokens"]).filter(same)

    tiles = tiled(texts.mapInArrow(again, "group long, tile long, set_id long, tokens binary").repartition("group", "tile").dropDuplicates(["group", "tile", "set_id"]))
    numbers = tiles.select("group", "tile")
    to_first = numbers.filter("tile > 0").select(F.col("group").alias("a"), F.col("tile").alias("ta"), F.col("group").alias("b"), F.lit(0).cast("long").alias("tb"))
    firsts = met.select("a", F.lit(0).cast("long").alias("ta"), "b", F.lit(0).cast("long").alias("tb"))
    edges = stage(within(tiles, percent).union(opened(to_first.union(firsts), tiles, tiles, percent)), "set-links")

    large = stage(sizes.filter("tiles > 1").select("group"), "large-groups")
    if not large.isEmpty():
        begun = stage(components(edges), "begun")
        state = first.select("group", "set_id").join(begun.withColumnRenamed("id", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
        counts = state.groupBy("group", "component").count()
        main = stage(counts.groupBy("group").agg(F.max_by("component", F.struct("count", "component")).alias("main")), "main")
        pairs = met.join(main.select(F.col("group").alias("a"), F.col("main").alias("ma")), "a").join(main.select(F.col("group").alias("b"), F.col("main").alias("mb")), "b")
        pairs = pairs.join(sizes.select(F.col("group").alias("a"), F.col("tiles").alias("na")), "a").join(sizes.select(F.col("group").alias("b"), F.col("tiles").alias("nb")), "b").filter("na > 1 or nb > 1")
        alike, unlike = pairs.filter("ma = mb"), pairs.filter("ma <> mb")
        asks = large.select(F.col("group").alias("a"), F.col("group").alias("b")).union(alike.select("a", "b")).union(alike.select(F.col("b").alias("a"), F.col("a").alias("b")))
        others = state.join(main, "group").filter("component <> main").select("group", F.col("set_id").alias("_set")).join(asks.select(F.col("a").alias("group")).distinct(), "group", "left_semi")
        others = stage(others, "others")
        held_by = small(stage(others.select("group").distinct(), "groups-of-others"), broadcast_rows)
        asking = tiled(_unpacked(tiles.join(held_by, "group", "left_semi")).join(small(others, broadcast_rows), ["group", "_set"]).select("group", "tile", F.col("_set").alias("set_id"), "tokens"))
        by_b = numbers.select(F.col("group").alias("b"), F.col("tile").alias("tb"))
        of_others = asks.join(asking.select(F.col("group").alias("a"), F.col("tile").alias("ta")), "a").join(by_b, "b").select("a", "ta", "b", "tb")
        of_all = unlike.join(numbers.select(F.col("group").alias("a"), F.col("tile").alias("ta")), "a").join(by_b, "b").filter("ta > 0 or tb > 0").select("a", "ta", "b", "tb")
        edges = edges.union(stage(opened(of_others, asking, tiles, percent).union(opened(of_all, tiles, tiles, percent)), "set-links"))
    found = components(edges)
    drop_staged(shared, live, members, met, first, sizes, wanted, tiles)
    return held, found


def _unpacked(tiles: DataFrame) -> DataFrame:
    """group, tile, _set and tokens of the sets of tiles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8):
            for group, tile, ids, sizes, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, ends = np.frombuffer(ids, "i8"), np.cumsum(np.frombuffer(sizes, "i8")) * 8
                parts = [tokens[b - n : b] for b, n in zip(ends.tolist(), (np.frombuffer(sizes, "i8") * 8).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([group] * len(ids), pa.int64()), pa.array([tile] * len(ids), pa.int64()), pa.array(ids), pa.array(parts, pa.binary())], ["group", "tile", "_set", "tokens"])

    return tiles.select("group", "tile", "ids", "sizes", "tokens").mapInArrow(rows, "group long, tile long, _set long, tokens binary")


def jaccard_components(docs: DataFrame, width: int = 3, percent: int = 90, tile_rows: int = TILE_ROWS) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable over links, for every row of documents.

    Two documents link when their sets of distinct word shingles have a Jaccard similarity of at least percent / 100.
    Words lie between ASCII white space and A-Z are lowered; a text of fewer words than a shingle is one shingle; null
    texts and those without words are empty sets, linked with nothing. The join is exact but for shingles being 64-bit
    hashes, and, where sets have parts of few elements in MANY or more parts (only below 90 %), a chance under 1 in
    10^8 for a pair at the threshold to be missed. Repeated rows each give a row; rows of one doc_id with unlike texts
    belong to their own texts' components; null ids count as larger than all others. Other columns are left out; an
    empty table gives no row.
    """
    held, found = link_sets(docs, width, percent, tile_rows=tile_rows)
    labels = set_labels(held, found, F.min("doc_id"))
    return held.join(labels, "set_id", "left").select("doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def set_labels(held: DataFrame, found: DataFrame, least) -> DataFrame:
    """set_id, component and least, an aggregate over the documents of the component, for sets of more than one document or with links."""
    per = held.filter("set_id is not null").groupBy("set_id").agg(least.alias("least"), F.count("*").alias("n"))
    per = per.join(found.withColumnRenamed("id", "set_id"), "set_id", "left").filter("n > 1 or component is not null")
    per = stage(per.select("set_id", F.coalesce("component", "set_id").alias("component"), "least"), "set-labels")
    of_all = stage(per.groupBy("component").agg(F.min("least").alias("least")), "components")
    return small(stage(per.drop("least").join(small(of_all, BROADCAST_ROWS), "component"), "set-labels"), BROADCAST_ROWS)


def without_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs with all its columns, of each connected group of similar documents exactly one row.

    Links as in jaccard_components. The row with the smallest doc_id stays (null ids last, then the smaller text hash;
    of rows alike in both any one). Rows whose text is null or has no word stay, all of them.
    """
    held, found = link_sets(docs, width, percent)
    place = F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "text_hash")
    labels = set_labels(held, found, F.min(place))
    members = held.join(labels, "set_id").groupBy("doc_id", "text_hash").agg(F.first("least").alias("least"), F.count("*").alias("rows"))
    kept = place == F.col("least")
    names = docs.columns
    decided = stage(members.filter(~kept | (F.col("rows") > 1)).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), kept.alias("_kept")), "copies")
    decided = small(decided, BROADCAST_ROWS)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    out = rows.join(decided, same, "left").filter("_kept is null or _kept")
    once = out.filter("_kept").dropDuplicates(["doc_id", "text_hash"])
    return out.filter("_kept is null").union(once).select("row.*")
