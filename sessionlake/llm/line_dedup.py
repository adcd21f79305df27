"""Fuzzy line deduplication with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlake.llm.common import components, drop_staged, small, stage

#: Characters of a line that takes part whatever its words; white space that Spark's own trim() leaves.
MIN_CHARS, SPACES = 12, " \t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Bytes a word, on average, above which runs of GRAM characters stand for words (scripts without spaces).
LONG_WORD, GRAM = 30, 4
#: Words of a line that takes part, edit similarity of a link.
MIN_WORDS, SIMILARITY = 5, 0.8
#: Words with fewer bytes come last in a line's order of words; distinct words that vote for its SimHash bits, and
#: those whose triples are keys; words after the second of that order that are keys with the next two.
SHORT_WORD, VOTERS, SKETCH, RUNS = 6, 32, 4, 12
#: Positions and keys that may be broadcast, some 24 bytes each.
BROADCAST_ROWS = 500_000
#: Copies of a line above which one row stands for all of them; a table of such lines has less than a thousandth of all rows.
OFTEN = 1000
#: Words above which edit similarity is that of the sequences of words, not of characters, and the values that stand for words.
WORDWISE, CODES = 48, 127
#: Longs whose bits stand for the words of a line.
MARKS = 8
#: Edit distances that are tried one after the other, as far as the line allows.
TIERS = (8, 32, 128, 512)
#: One in each of the eight counters that share a long, and the bits of a half of the SimHash.
LANES, HALF = 0x0101010101010101, 31


def normalised(text: Column) -> Column:
    """Lowered; occurrences() takes white space off the ends of each line."""
    return F.lower(text)


def trimmed(line: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.trim(line, F.lit(SPACES))


def with_words(rows: DataFrame) -> DataFrame:
    """Add words: those between white space, or runs of GRAM characters where words are very long, as in scripts without spaces."""
    odd = F.lit(False)
    for c in "\t\xa0\u3000":
        odd = odd | F.contains("line", F.lit(c))
    rows = rows.withColumn("words", F.split(F.when(odd, F.translate("line", SPACES, " " * len(SPACES))).otherwise(F.col("line")), " "))
    chars = F.transform(F.array(F.split("line", "")), lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.size(c) - GRAM + 1, F.lit(1))), lambda k: F.concat_ws("", F.slice(c, k, GRAM))))
    return rows.withColumn("words", F.when(F.octet_length("line") > LONG_WORD * F.size("words"), F.flatten(chars)).otherwise(F.col("words")))


def signed(rows: DataFrame) -> DataFrame:
    """Add sim, a SimHash, and keys, k0 to k3 and an array runs, to rows with a line.

    The distinct words' hashes are sorted, short words last, so that common words seldom come first. The first VOTERS of
    them vote: each adds its bits to counters, eight of which share a long, so a word costs eight sums of a shift and a
    mask; a bit of the SimHash is set where more than half of the voters have it. The keys are the triples of the first
    SKETCH words: lines of which one such word at most differs share one. Where more words differ, lines still share one
    of runs, the triples of neighbours further on that begin with a word that isn't short, if such a triple is untouched.
    """
    value = "shiftrightunsigned(xxhash64(w), 2) | if(octet_length(w) < {0}, {1}L, 0L)".format(SHORT_WORD, 1 << 62)
    rows = with_words(rows).withColumn("h", F.expr(f"slice(sort_array(array_distinct(transform(words, w -> {value}))), 1, {VOTERS})")).drop("words")
    rows = rows.withColumn("most", F.expr(f"(63L - size(h) div 2) * {LANES}L"))  # a count over half comes to 64 with it
    votes = [f"shiftleft(shiftrightunsigned((aggregate(h, 0L, (a, x) -> a + (shiftrightunsigned(x, {k}) & {LANES}L)) + most) & {64 * LANES}L, 6), {k})" for k in range(8)]
    triples = [(0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3)]
    whole = F.expr(f"size(h) < {SKETCH}")
    keys = [F.when(whole, F.xxhash64("h") if k == 0 else F.lit(None).cast("long")).otherwise(F.xxhash64(*(F.get("h", F.lit(i)) for i in t))).alias(f"k{k}") for k, t in enumerate(triples)]
    run = f"transform(sequence({SKETCH - 2}, least(size(h), {SKETCH + RUNS}) - 3), i -> if(h[i] < {1 << 62}L, xxhash64(h[i], h[i + 1], h[i + 2]), null))"
    runs = F.expr(f"if(size(h) > {SKETCH}, {run}, cast(array() as array<bigint>))")
    return rows.select(*(c for c in rows.columns if c not in ("h", "most")), F.expr(" | ".join(votes)).alias("sim"), *keys, runs.alias("runs"))


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of the text), pos, line (normalised), id (its 64-bit hash) and length of the lines that take part; staged."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), F.posexplode(F.split(normalised(F.col("text")), "\n")).alias("pos", "raw"))
    rows = rows.select("doc_id", "key", "pos", trimmed(F.col("raw")).alias("line"))
    head = F.substring_index("line", " ", MIN_WORDS - 1)  # ends before the last word that is asked for
    rows = rows.withColumn("length", F.length("line")).filter((F.octet_length(head) < F.octet_length("line")) | (F.col("length") >= MIN_CHARS))
    return stage(rows.withColumn("id", F.xxhash64("line")), "line-occurrences")


def word_codes(similar: DataFrame) -> DataFrame:
    """Add size, the count of words, and coded, the words as a string of CODES characters by their hashes (null for a few words)."""
    coded = F.expr(f"array_join(transform(words, w -> char(1 + pmod(xxhash64(w), {CODES}))), '')")
    rows = with_words(similar).withColumn("size", F.size("words"))
    return rows.withColumn("coded", F.when(F.col("size") > WORDWISE // 2, coded)).drop("words")


def with_kinds(rows: DataFrame, texts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Add size, the words of each row's line, and m0 to m7, a bit for the hash of each word."""
    found = with_words(texts(rows.select("id").distinct())).withColumn("size", F.size("words"))
    found = found.withColumn("hashes", F.expr("transform(words, w -> hash(w))"))
    marks = [F.expr(f"aggregate(hashes, 0L, (a, x) -> a | if((shiftright(x, 6) & {MARKS - 1}) = {k}, shiftleft(1L, x & 63), 0L))").alias(f"m{k}") for k in range(MARKS)]
    return rows.join(stage(found.select("id", "size", *marks), "line-kinds"), "id")


def may_link(similarity: float) -> Column:
    """False for pairs that verified() would compare by words and whose distinct words alone make more edits than it allows.

    Each word that one line has and the other lacks takes an edit of its own, and so does each bit that one has and the
    other lacks, so their number is a lower bound of the edits between the words. verified() takes some unlike words as
    equal (see CODES), so pairs that would link by that alone are left out here. Pairs that are compared by characters stay.
    """
    most = F.greatest("wa", "wb")
    lacks = lambda x, y: sum(F.bit_count(F.col(f"{x}{k}").bitwiseAND(F.bitwise_not(F.col(f"{y}{k}")))) for k in range(MARKS))
    return (most <= WORDWISE) | (F.greatest(lacks("ma", "mb"), lacks("mb", "ma")) <= allowed(most, similarity))


def allowed(length: Column, similarity: float) -> Column:
    """Edits of a pair that still links, the longer of them being so long."""
    return F.floor(length * F.lit(round(1 - similarity, 9)) + 1e-9).cast("int")


def verified(pairs: DataFrame, texts: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """The pairs (a, b and what comes with them) of lines whose edit similarity is enough; small distances are tried first.

    Pairs with a line of more than WORDWISE words are compared word by word (if the other has not half as many, they
    don't link): each word becomes one of CODES characters by its hash,
    so of the words that differ one in CODES counts as equal. Other pairs are compared by characters.
    """
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    found = word_codes(texts(wanted)).select("id", F.when(F.col("size") <= WORDWISE, F.col("line")).alias("line"), "coded", (F.col("size") > WORDWISE).alias("long"))
    found = stage(found, "line-texts")
    one, two = (found.select(F.col("id").alias(k), F.struct("line", "coded", "long").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    both = pairs.join(one, "a").join(two, "b")
    words = F.col("x.long") | F.col("y.long")
    both = both.select(*pairs.columns, F.when(words, F.col("x.coded")).otherwise(F.col("x.line")).alias("x"), F.when(words, F.col("y.coded")).otherwise(F.col("y.line")).alias("y")).filter("x is not null and y is not null")
    most = F.greatest(F.length("x"), F.length("y"))
    both = both.withColumn("allowed", allowed(most, similarity))
    enough = F.when(F.lit(False), False)
    for limit in TIERS:
        enough = enough.when(F.expr(f"levenshtein(x, y, least(allowed, {limit}))") >= 0, True).when(F.col("allowed") <= limit, False)
    enough = enough.otherwise(F.expr("levenshtein(x, y, allowed)") >= 0)
    linked = stage(both.filter(enough).select(*pairs.columns), "line-links")
    drop_staged(found)
    return linked


def fuzzy_groups(lines: DataFrame, texts: Callable[[DataFrame], DataFrame], similarity: float = SIMILARITY) -> DataFrame:
    """(id, component) of lines that link: a key in common and enough edit similarity.

    lines: id, sim, length, k0 to k3, runs, a line as often as it occurs; the halves of sim are keys too. texts(ids) gives
    the normalised lines of ids. First the lines of a key are compared with the least of them; what links becomes
    connected. Then the other pairs follow, but none whose lines are connected already, so many copies of a line with
    small changes don't make all their pairs.
    """
    near = F.least("na", "nb") >= similarity * F.greatest("na", "nb")
    half = F.lit((1 << HALF) - 1).cast("long")
    halves = [F.shiftrightunsigned("sim", HALF * k).bitwiseAND(half) + F.lit(k << HALF) for k in (0, 1)]
    rows = lines.select("id", "length", F.explode(F.concat(F.array("k0", "k1", "k2", "k3", *halves), "runs")).alias("key")).filter("key is not null")
    # all keys are dealt once: which are shared is told where they meet
    of_key = Window.partitionBy("key")
    met = rows.withColumns({"first": F.min("id").over(of_key), "last": F.max("id").over(of_key)})
    live = stage(met.filter("first <> last").drop("last").dropDuplicates(["key", "id"]), "live-lines")
    ends = live.filter("id = first").select(F.col("id").alias("a"), F.col("length").alias("na")).distinct()
    stars = live.select(F.col("first").alias("a"), F.col("id").alias("b"), F.col("length").alias("nb")).filter(F.col("a") != F.col("b")).distinct()
    first = stage(stars.join(ends, "a").filter(near).select("a", "b"), "line-pairs")
    groups = stage(components(verified(first, texts, similarity)), "line-groups")
    grouped = live.drop("first").join(groups, "id", "left").withColumn("group", F.coalesce("component", "id")).drop("component")
    mixed = grouped.groupBy("key").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).filter("lo <> hi").select("key")  # others are connected
    mixed = stage(mixed, "mixed-keys")
    rest = stage(grouped.join(small(mixed, BROADCAST_ROWS), "key", "left_semi"), "mixed-lines")
    marked = stage(with_kinds(rest, texts), "marked-lines")
    names = {"group": "g", "id": "", "length": "n", "size": "w"}
    one, two = (marked.select("key", *(F.col(c).alias(to + k) for c, to in names.items()), *(F.col(f"m{i}").alias(f"m{k}{i}") for i in range(MARKS))) for k in "ab")
    more = two.join(one, "key").filter((F.col("a") < F.col("b")) & (F.col("ga") != F.col("gb")) & near & may_link(similarity)).select("a", "b", "ga", "gb").distinct()
    more = stage(more.join(first, ["a", "b"], "left_anti"), "line-pairs")
    drop_staged(live, mixed, rest, marked)
    if more.isEmpty():
        return groups
    joined = verified(more, texts, similarity).select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    joined = stage(components(joined).select(F.col("id").alias("component"), F.col("component").alias("joined")), "line-groups")
    alone = joined.join(groups.select(F.col("id").alias("component")), "component", "left_anti").select(F.col("component").alias("id"), F.col("joined").alias("component"))
    return stage(groups.join(joined, "component", "left").select("id", F.coalesce("joined", "component").alias("component")).union(alone).distinct(), "line-groups")


def thinned(seen: DataFrame, lines: DataFrame) -> DataFrame:
    """id, line and length of the rows of seen, of lines that occur more than OFTEN times only one each, so that no key gathers their copies."""
    often = stage(lines.filter(F.col("times") > OFTEN).select("id"), "lines-often")
    rows = seen.select("id", "line", "length")
    if often.isEmpty():
        return rows
    return rows.join(F.broadcast(often), "id", "left_anti").union(rows.join(F.broadcast(often), "id", "left_semi").dropDuplicates(["id"]))


def dropped_positions(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, key (xxhash64 of the text) and gone, the positions of lines that repeat an earlier one; staged."""
    seen = occurrences(docs)
    lines = stage(seen.groupBy("id").agg(F.count("*").alias("times")), "lines")

    def texts(wanted: DataFrame) -> DataFrame:
        return seen.select("id", "line").join(small(stage(wanted, "wanted"), BROADCAST_ROWS), "id", "left_semi").dropDuplicates(["id"])

    # keys, some 18 longs a line, are made where they are dealt and never staged
    groups = fuzzy_groups(signed(thinned(seen, lines)), texts, similarity).withColumnRenamed("component", "group")
    repeated = lines.select("id", "times").join(groups, "id", "left").filter("times > 1 or group is not null")
    repeated = stage(repeated.select("id", F.coalesce("group", "id").alias("group")), "repeated")
    places = stage(seen.select("id", "doc_id", "key", "pos").join(small(repeated, BROADCAST_ROWS), "id").drop("id"), "places")
    place = F.struct("doc_id", "key", "pos")
    keepers = stage(places.groupBy("group").agg(F.min(place).alias("keep")), "keepers")
    gone = places.join(small(keepers, BROADCAST_ROWS), "group").filter(~place.eqNullSafe(F.col("keep")))
    found = stage(gone.groupBy("doc_id", "key").agg(F.collect_set("pos").alias("gone")), "gone")
    drop_staged(seen, lines, repeated, places, keepers)
    return found


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs with all its columns, repeated lines taken out of text, and n_lines and n_removed added (in place of columns so named).

    Lines are normalised (case, white space at the ends). Lines of MIN_WORDS words or MIN_CHARS characters or more link
    when they are equal, or when they have a key in common (see signed: a triple of sorted word hashes, or half of the
    SimHash) and their edit similarity is at least `similarity`; of each
    connected group the occurrence with the smallest doc_id (nulls first; then text hash, then position) stays. Shorter
    and blank lines stay. No document is taken out: one that only repeats others keeps its row, with the text that is
    left, perhaps empty. Null texts stay null with 0 lines; rows with one doc_id and text are one document, and alike in
    the result; an empty table gives none.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    gone = dropped_positions(docs.select("doc_id", F.col("text").cast("string")), similarity)
    size = gone.agg(F.coalesce(F.sum(F.size("gone") + 4), F.lit(0))).first()[0]
    gone = F.broadcast(gone) if size <= BROADCAST_ROWS * 4 else gone
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").alias("text"))
    rows = rows.alias("d").join(gone.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.key") == F.col("g.key")), "left").select("row", "text", "gone")
    left = F.array_join(F.expr("filter(split(text, '\\n'), (x, i) -> not array_contains(gone, i))"), "\n")
    total = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1, F.lit(0))
    return rows.select(
        *(F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names),
        total.cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
