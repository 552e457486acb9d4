r"""Operator 8: line dedup by an exact set-similarity join, with DataFrame functions only.

A line is the set of its words. A line is removed if an earlier line (smaller document id, then line number) has a Jaccard
similarity of at least ``SIMILARITY`` with it; the first one stays.

1. Words are ordered by rarity: by their count in a table of ``COUNTERS`` counters over the whole corpus, then by hash. Any
   fixed order gives the same pairs, so that words share counters costs time, never a pair.
2. Lines with the same set are one class, of which one line goes on.
3. Prefix filter: similar lines share ``SHARED`` of their rarest ``n - ceil(t n) + SHARED`` words. Each class is first compared
   with the earliest class at its very rarest words; what is settled there is not joined as a later line again, so a family of
   thousands of near copies costs as many comparisons as it has lines.
4. Classes that share a prefix word pass the length filter, the positional filter and a filter by 64-bit parities of
   their sets (each bit that differs is a word that differs), and must pass them at ``SHARED`` words. None of them loses a pair:
   every common word of similar lines passes. A set too small to be similar to a different one is not joined.
5. What is left is verified on the words themselves. Only lines that take part in a candidate pair are read for that,
   found by a bitmap of fixed size.

Defined cases: null and empty texts have one line without words; lines without words (or with fewer than ``least_words``, repeated ones counted)
always stay; null ids come last; rows equal in id and text are treated alike; very long texts are split whole, very long lines are
one set of words; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridlens.llm.common import BLANK, WORD, fresh, stored, whole

#: Jaccard similarity as a fraction.
SIMILARITY = (4, 5)
#: Counters of the rarity order and bits of the bitmap of candidate lines, as powers of two.
COUNTER_BITS, BITMAP_BITS = 20, 23
COUNTERS = 1 << COUNTER_BITS
#: Rarest words at which a class meets the earliest class first.
LEADERS = 3
#: Prefix words that similar lines share at least; no more than the words of the smallest set that is similar to another one.
SHARED = 2
_HASH_BITS = 43


def words_of(line: str | Column) -> Column:
    """Different words of a line."""
    return F.array_distinct(F.array_remove(F.split(line, BLANK), ""))


def hashes_of(line: str | Column) -> Column:
    """Hashes of all words of a line, the hash of the empty string for blanks at its ends."""
    return F.transform(F.split(line, BLANK), lambda w: F.xxhash64(w))


def lines_of(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """doc, h (hash of the text), line (number from 0), s (the line)."""
    rows = docs.select(F.col(id_column).alias("doc"), whole(text).alias("t"))
    return rows.select("doc", F.xxhash64("t").alias("h"), F.posexplode(F.split("t", "\n", -1)).alias("line", "s"))


def has_words(line: str, least: int) -> Column:
    """Whether a line has ``least`` words, repeated ones counted; reads no further than that."""
    return F.col(line).rlike(rf"\A{BLANK[:-1]}*+(?:{WORD}+{BLANK}+){{{max(least, 1) - 1}}}{WORD[:-1]}")


def rarity(lines: DataFrame) -> Column:
    """One-row subquery: how often the words of each counter stand in all lines."""
    spark = lines.sparkSession
    place = F.xxhash64("w").bitwiseAND(F.lit(COUNTERS - 1))
    counted = lines.select(F.explode(F.split("s", BLANK)).alias("w")).groupBy(
        place.alias("i")).agg(F.count("*").alias("n"))
    every = counted.union(spark.range(COUNTERS).select("id", F.lit(0).cast("long"))).groupBy("i").agg(F.sum("n").alias("n"))
    packed = F.shiftleft(F.col("i"), 32).bitwiseOR(F.least(F.col("n"), F.lit((1 << 19) - 1)))
    kept = stored(every.select(packed.alias("p")), "rarity")
    counts = F.transform(F.sort_array(F.collect_list("p")), lambda p: p.bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))
    return kept.agg(counts).scalar()


def ordered_words(hashes: Column, counts: Column) -> Column:
    """Different words as longs, rarest first: 20 bits of their counter, then 43 of their hash. ``counts``: the counters."""
    def key(t: Column, w: Column) -> Column:
        n = F.coalesce(F.get(t, w.bitwiseAND(F.lit(COUNTERS - 1)).cast("int")).cast("long"), F.lit(0).cast("long"))
        return F.shiftleft(n, _HASH_BITS).bitwiseOR(F.shiftrightunsigned(w, 64 - _HASH_BITS))

    # The table is bound once a line; the sort stands outside, where it is one of primitive longs.
    keys = F.get(F.transform(F.array(counts), lambda t: F.transform(hashes, lambda w: key(t, w))), F.lit(0))
    return F.sort_array(keys)


def least_common(n: Column) -> Column:
    """Fewest words a set of ``n`` shares with a similar one: ceil(t n)."""
    a, b = SIMILARITY
    return F.floor((n * a + (b - 1)) / b).cast("int")


def could_match(n1: Column, p1: Column, s1: Column, n2: Column, p2: Column, s2: Column) -> Column:
    """Length, positional and parity filters. ``p``: places of a common word; words before it may be common too, so the
    bound takes the nearer place's words as common."""
    a, b = SIMILARITY
    need = F.floor(((n1 + n2) * a + (a + b - 1)) / (a + b))  # ceil(t / (1 + t) (n1 + n2))
    most = F.least(p1, p2) + 1 + F.least(n1 - p1 - 1, n2 - p2 - 1)
    return ((n1 * a <= n2 * b) & (n2 * a <= n1 * b) & (most >= need)
            & (F.bit_count(s1.bitwiseXOR(s2)) <= n1 + n2 - 2 * need))


def one_bit(place: Column) -> Column:
    """A long with the bit of ``place`` modulo 64."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))


def _unpacked(packed: Column) -> tuple[Column, Column]:
    """Words of the set and place in it, from n << 32 | place << 1 | open."""
    return F.shiftright(packed, 32).cast("int"), F.shiftright(packed, 1).bitwiseAND(F.lit((1 << 31) - 1)).cast("int")


def line_sets(lines: DataFrame, least_words: int = 1) -> DataFrame:
    """doc, h, line, n, prefix (hashes of the rarest words), parity, a and b (digests of the set) of each line; stored."""
    # Lines are told apart by a test that ends early: a filter on the words would hash them twice.
    words = F.array_distinct(F.array_remove(hashes_of("s"), F.xxhash64(F.lit(""))))
    worded = lines.filter(has_words("s", least_words)).select("doc", "h", "line", words.alias("words"))
    keyed = worded.withColumn("counts", rarity(lines)).select(
        "doc", "h", "line", ordered_words(F.col("words"), F.col("counts")).alias("set"))
    n = F.size("set")
    parity = F.aggregate("set", F.lit(0).cast("long"), lambda p, w: p.bitwiseXOR(one_bit(w)))
    prefix = F.transform(F.slice("set", F.lit(1), n - least_common(n) + SHARED), lambda w: w.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))
    return stored(keyed.select("doc", "h", "line", n.alias("n"), prefix.alias("prefix"), parity.alias("parity"),
                               F.xxhash64("set").alias("a"), F.hash("set").alias("b")), "lines")


def line_classes(sets: DataFrame) -> DataFrame:
    """One row for each set of words: c (rises with the first place), a, b, doc, h, line (first place), n, prefix,
    parity; stored."""
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "h", "line").alias("place")
    grouped = sets.select("a", "b", place, "n", "prefix", "parity").groupBy("a", "b").agg(
        F.min("place").alias("place"), F.first("n").alias("n"), F.first("prefix").alias("prefix"),
        F.first("parity").alias("parity"))
    in_order = grouped.repartitionByRange("place").sortWithinPartitions("place")
    return stored(in_order.withColumn("c", F.monotonically_increasing_id()), "line-classes")


def bitmap(rows: DataFrame, key: Column, bits: int = BITMAP_BITS) -> Column:
    """One-row subquery: bits of the hashes of ``key``, in 64-bit pieces."""
    spark = rows.sparkSession
    place = key.bitwiseAND(F.lit((1 << bits) - 1))
    found = rows.select(F.shiftright(place, 6).alias("i"), one_bit(place).alias("m"))
    every = found.union(spark.range(1 << bits - 6).select("id", F.lit(0).cast("long")))
    pieces = stored(every.groupBy("i").agg(F.bit_or("m").alias("m")), "bitmap")
    in_order = F.array_sort(F.collect_list(F.struct("i", "m")))
    return pieces.agg(F.transform(in_order, lambda s: s["m"])).scalar()


def in_bitmap(table: Column, key: Column, bits: int = BITMAP_BITS) -> Column:
    place = key.bitwiseAND(F.lit((1 << bits) - 1))
    piece = F.get(table, F.shiftright(place, 6).cast("int"))
    return F.getbit(piece, place.bitwiseAND(F.lit(63)).cast("int")) == 1


def verified(pairs: DataFrame, classes: DataFrame, lines: DataFrame) -> DataFrame:
    """c of the later classes of ``pairs`` (later, earlier: class numbers; different ones) that are similar, by their words."""
    pairs = stored(pairs, "line-pairs")
    return stored(_similar(pairs, classes, lines), "line-removed")


def _similar(pairs: DataFrame, classes: DataFrame, lines: DataFrame) -> DataFrame:
    """c of the later classes of the pairs that are similar."""
    taking_part = pairs.select("later").union(pairs.select("earlier")).distinct().withColumnRenamed("later", "c")
    places = stored(classes.join(taking_part, "c").select("c", "place.doc", "place.h", "place.line"), "line-places")
    at = F.xxhash64("h", "line")
    read = lines.withColumn("bits", bitmap(places, at)).filter(in_bitmap(F.col("bits"), at)).drop("bits")
    found = read.join(places.withColumnRenamed("doc", "own"), ["h", "line"]).filter(F.col("doc").eqNullSafe(F.col("own")))
    sets = stored(found.groupBy("c").agg(F.first("s").alias("s")).select("c", words_of("s").alias("words")), "line-words")
    a, b = SIMILARITY
    both = pairs.join(sets.select(F.col("c").alias("later"), F.col("words").alias("w1")), "later").join(
        sets.select(F.col("c").alias("earlier"), F.col("words").alias("w2")), "earlier")
    common = F.size(F.array_intersect("w1", "w2"))
    good = common * b >= (F.size("w1") + F.size("w2") - common) * a
    return both.filter(good).select(F.col("later").alias("c")).distinct()


def later_matches(classes: DataFrame, lines: DataFrame) -> DataFrame:
    """c of the classes that an earlier class matches."""
    # Different sets are similar only if they have this many words.
    a, b = SIMILARITY
    classes = classes.filter(F.col("n") * (b - a) >= a)

    # The earliest class at each of the rarest words.
    at_word = classes.select("c", "n", "parity", F.posexplode(F.slice("prefix", 1, LEADERS)).alias("p", "w"))
    first = at_word.groupBy("w").agg(F.min(F.struct("c", "n", "p", "parity")).alias("f"), F.count("*").alias("k"))
    met = at_word.join(first.filter("k > 1"), "w").filter(F.col("c") != F.col("f.c"))
    fits = could_match(F.col("n"), F.col("p"), F.col("parity"), F.col("f.n"), F.col("f.p"), F.col("f.parity"))
    leading = met.filter(fits).select(F.col("c").alias("later"), F.col("f.c").alias("earlier"))
    settled = verified(leading.distinct(), classes, lines)

    # All classes at all prefix words; both sides of the join are the same shuffle, so "open" is part of the condition.
    packed = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(
        F.shiftleft(F.col("p").cast("long"), 1)).bitwiseOR(F.col("done").isNull().cast("long"))
    flagged = classes.join(settled.withColumn("done", F.lit(True)), "c", "left")
    every = flagged.select("c", "n", "parity", "done", F.posexplode("prefix").alias("p", "w")).select(
        "w", "c", packed.alias("q"), "parity").filter("w is not null and c is not null and q is not null and parity is not null")
    (n1, p1), (n2, p2) = _unpacked(F.col("x.q")), _unpacked(F.col("y.q"))
    before = F.when(F.col("x.q").bitwiseAND(F.lit(1)) == 1, F.col("x.c")).otherwise(F.lit(-1))
    pairs = every.alias("x").join(every.alias("y"), (F.col("x.w") == F.col("y.w")) & (F.col("y.c") < before) & could_match(
        n1, p1, F.col("x.parity"), n2, p2, F.col("y.parity")))
    often = pairs.groupBy(F.col("x.c").alias("later"), F.col("y.c").alias("earlier")).agg(F.count("*").alias("k"))
    others = verified(often.filter(F.col("k") >= SHARED).drop("k"), classes, lines)
    return settled.union(others)


def removed_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least_words: int = 1) -> DataFrame:
    """doc, h (hash of the text), removed (numbers of the removed lines, rising) for the documents that lose lines."""
    lines = lines_of(docs, id_column, text)
    sets = line_sets(lines, least_words)
    classes = line_classes(sets)
    gone = later_matches(classes, lines).withColumn("gone", F.lit(True))
    marked = classes.join(gone, "c", "left").select("a", "b", F.col("place").alias("first"), "gone")
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "h", "line")
    lost = sets.select("doc", "h", "line", "a", "b").join(marked, ["a", "b"]).filter(
        F.col("gone").isNotNull() | (place != F.col("first")))
    # Lines of rows equal in id and text have equal places: the first one's lines stay in each of them.
    return lost.groupBy("doc", "h").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def without_removed(docs: DataFrame, removed: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with a text less its removed lines; all other columns stay. A null text without removed lines stays null."""
    key, = fresh(docs, "_h")
    gone = removed.select(F.col("doc").alias("_doc"), F.col("h").alias("_gone_h"), F.col("removed").alias("_removed"))
    joined = docs.withColumn(key, F.xxhash64(whole(text))).join(
        gone, (F.col(key) == F.col("_gone_h")) & F.col(id_column).eqNullSafe(F.col("_doc")), "left")
    parts = F.transform(F.split(whole(text), "\n", -1), lambda s, i: F.when(~F.array_contains("_removed", i), s))
    kept = F.array_join(F.filter(parts, lambda s: s.isNotNull()), "\n")
    cleaned = F.when(F.col("_removed").isNull(), F.col(text)).otherwise(kept)
    return joined.select(*[cleaned.alias(c) if c == text else docs[c] for c in docs.columns])


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least_words: int = 1) -> DataFrame:
    """Documents without the lines that repeat an earlier line."""
    return without_removed(docs, removed_lines(docs, id_column, text, least_words), id_column, text)


def document_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, removed of every document."""
    removed = removed_lines(docs)
    own = docs.select("doc_id", F.xxhash64(whole("text")).alias("_h"), F.size(F.split(whole("text"), "\n", -1)).alias("n_lines"))
    joined = own.join(removed, (F.col("_h") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("doc")), "left")
    gone = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", F.size(gone).alias("n_removed"), gone.alias("removed"))


def sql() -> str:
    """DuckDB SQL for ``document_lines``."""
    a, b = SIMILARITY
    return rf"""
    WITH cut AS (
        SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
    lines AS (
        SELECT doc_id, i - 1 AS line, list_distinct(regexp_extract_all(parts[i], '[^\x20\x09-\x0D]+')) AS words
        FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM cut)),
    sets AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, line) AS c, *, len(words) AS n FROM lines WHERE len(words) > 0),
    tokens AS (SELECT c, n, unnest(words) AS w FROM sets),
    counted AS (SELECT w, count(*) AS k FROM tokens GROUP BY w),
    ranked AS (SELECT c, n, w, row_number() OVER (PARTITION BY c ORDER BY k, w) AS place FROM tokens JOIN counted USING (w)),
    prefix AS (SELECT c, n, w FROM ranked WHERE place <= n - CAST(ceil(n * {a} / {b}.0) AS BIGINT) + 1),
    pairs AS (
        SELECT DISTINCT x.c AS later, y.c AS earlier FROM prefix x JOIN prefix y
        ON x.w = y.w AND y.c < x.c AND y.n * {b} >= x.n * {a} AND x.n * {b} >= y.n * {a}),
    gone AS (
        SELECT DISTINCT later FROM (
            SELECT later, x.n + y.n AS both_n, len(list_intersect(x.words, y.words)) AS common
            FROM pairs JOIN sets x ON x.c = later JOIN sets y ON y.c = earlier)
        WHERE common * {b} >= (both_n - common) * {a}),
    removed AS (SELECT doc_id, list(CAST(line AS INTEGER) ORDER BY line) AS removed FROM sets JOIN gone ON c = later GROUP BY doc_id)
    SELECT cut.doc_id, CAST(len(parts) AS INTEGER) AS n_lines, CAST(coalesce(len(removed), 0) AS INTEGER) AS n_removed,
           coalesce(removed, CAST([] AS INTEGER[])) AS removed
    FROM cut LEFT JOIN removed ON cut.doc_id IS NOT DISTINCT FROM removed.doc_id"""
