"""Operator 2: mixing sources to target weights along a time-varying curriculum.

Every source has a weight and a schedule that moves this weight over training time. The schedules are integrated to the
words each source has to supply, the cumulative demand is inverted to the training time at which a document is due, and
documents are range-sorted by this time. A document that is due several times (a source that repeats) is laid out once
for each time.

Prefix sums of words run within (source, first digits of a hash), never within a whole source, so a source that holds a
third of all rows is spread over thousands of groups; one small row per group carries the sums before it.

Defined cases: a null text has size 0 and is never taken, nor is an empty or blank one; null sources are one source, after all
others; the order of a source goes by a hash of id and text, so rows of one id (or none) are ordered by their texts and spread
over the groups, rows that tie are equal and reruns agree however the table is laid out; a very long text is one row of its size;
with no words at all every target is 0; an empty table gives an empty result; columns whose names clash with helper columns are
kept.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import DataFrame, Window, functions as F

from gridlens.llm.common import fresh, stored, word_count

#: Weights by the source's place in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
#: Relative weight at points of training time, one schedule per weight: early, even, late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)))
#: Hex digits of the order key that make a group: 4,096 groups for each source.
GROUP_DIGITS = 3


def normalised(schedule: Sequence[tuple[float, float]]) -> list[tuple[float, float, float]]:
    """(time, weight, integral before it) of a piecewise linear schedule over [0, 1], scaled to integral 1."""
    if len(schedule) < 2 or schedule[0][0] != 0 or schedule[-1][0] != 1:
        raise ValueError("a schedule runs from time 0 to time 1")
    if any(b <= a for (a, _), (b, _) in pairwise(schedule)) or any(w <= 0 for _, w in schedule):
        raise ValueError("times must rise and weights be positive")
    total, sums = 0.0, [0.0]
    for (t0, w0), (t1, w1) in pairwise(schedule):
        total += (t1 - t0) * (w0 + w1) / 2
        sums.append(total)
    return [(t, w / total, s / total) for (t, w), s in zip(schedule, sums, strict=True)]


def due_time_sql(share: str, place: str, schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES) -> str:
    """SQL for the time at which ``share`` (0 to 1) of a source's demand has been met: the inverse of the integral."""
    cases = []
    for k, schedule in enumerate(schedules):
        parts = []
        for (t0, w0, s0), (t1, w1, s1) in pairwise(normalised(schedule)):
            bend = 2 * (w1 - w0) / (t1 - t0)
            rest = f"({share} - {s0!r}D)"
            parts.append(f"WHEN {share} <= {s1!r}D THEN {t0!r}D + 2.0D * {rest} "
                         f"/ ({w0!r}D + sqrt(greatest({w0 * w0!r}D + {bend!r}D * {rest}, 0.0D)))")
        cases.append(f"WHEN pmod({place}, {len(schedules)}) = {k} THEN CASE {' '.join(parts)} ELSE 1.0D END")
    return f"CASE {' '.join(cases)} END"


def source_targets(sized: DataFrame, source: str, size: str, weights: Sequence[float] = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: place, source_size, target.

    Weights share all words; a target stops at ``max_repeats`` times its source, and what is above is shared again by
    weight until nothing is. In order of (limit / weight) the stopped sources come first, so one running sum finds them.
    """
    totals = sized.groupBy(source).agg(F.sum(size).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place"), F.lit(len(weights))) + 1).cast("int"))
    limits = (
        totals.withColumn("place", place.cast("long")).withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * max_repeats)
    )
    everything = Window.partitionBy()
    earlier = Window.orderBy(F.col("limit") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    level = (
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(earlier), F.lit(0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
    )
    ranked = limits.withColumn("level", level).withColumn("stopped", F.col("limit") <= F.col("weight") * F.col("level"))
    # The level of the first source that is not stopped holds for all that follow.
    shared = F.min(F.when(~F.col("stopped"), F.struct(F.col("limit") / F.col("weight"), "place", "level"))).over(everything)["level"]
    target = F.when(F.col("stopped"), F.col("limit").cast("double")).otherwise(F.col("weight") * shared)
    return ranked.select(source, "place", "source_size", target.alias("target"))


def assign(docs: DataFrame, size: str, order: str, source: str = "source", weights: Sequence[float] = WEIGHTS,
           schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``docs`` with source_size, target, taken (words the mix takes, repeats counted) and due_times (one training time
    in [0, 1] for each time the document is due, earliest first).

    ``order`` is a hex string column that orders the documents of a source; ``size`` its words.
    """
    group, key, before, inside, place, all_words, goal = fresh(
        docs, "_group", "_source", "_before", "_inside", "_place", "_all", "_goal")
    # Rows without words add nothing wherever they stand, so a third of all rows without text is spread over all groups.
    nowhere = F.lpad(F.hex(F.pmod(F.monotonically_increasing_id(), F.lit(16 ** GROUP_DIGITS))), GROUP_DIGITS, "0")
    keyed = docs.withColumn(group, F.when(F.col(size) > 0, F.substring(order, 1, GROUP_DIGITS)).otherwise(F.lower(nowhere)))
    sums = stored(keyed.groupBy(F.col(source).alias(key), F.col(group)).agg(F.sum(size).alias(inside)), "mix-sums")
    targets = source_targets(sums, key, inside, weights, max_repeats).select(
        F.col(key).alias("_s"), F.col("place").alias(place), F.col("source_size").alias(all_words), F.col("target").alias(goal))
    running = Window.partitionBy(key).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    groups = sums.withColumn(before, F.coalesce(F.sum(inside).over(running), F.lit(0))).drop(inside)
    groups = stored(
        groups.join(targets, F.col(key).eqNullSafe(F.col("_s"))).drop("_s").withColumnRenamed(group, f"{group}_g"),
        "mix-groups")

    window = Window.partitionBy(source, group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn(inside, F.coalesce(F.sum(size).over(window), F.lit(0)))
    joined = placed.join(groups, F.col(source).eqNullSafe(F.col(key)) & (F.col(group) == F.col(f"{group}_g")))
    start = F.col(before) + F.col(inside)
    whole_goal = F.round(F.col(goal)).cast("long")

    def words(copy: int):
        return F.greatest(F.least(F.col(size), whole_goal - copy * F.col(all_words) - start), F.lit(0))

    def due(copy: int):
        share = f"((CAST(`{before}` + `{inside}` AS DOUBLE) + {copy} * `{all_words}`) / `{goal}`)"
        return F.expr(due_time_sql(share, f"`{place}`", schedules))

    taken = sum((words(copy) for copy in range(1, max_repeats)), words(0))
    times = F.filter(F.array(*[F.when(words(c) > 0, due(c)) for c in range(max_repeats)]), lambda t: t.isNotNull())
    return joined.select(
        *[docs[c] for c in docs.columns], F.col(all_words).alias("source_size"), F.col(goal).alias("target"),
        taken.cast("long").alias("taken"), times.alias("due_times"))


def order_key(*columns: str, text: str = "text"):
    """Hex order of the documents of a source, the same on every run: by a hash of ``columns`` and the text."""
    parts = [*[F.col(c).cast("string") for c in columns], F.md5(F.col(text))]
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(p, F.lit("\x00")) for p in parts]))


def lay_out(assigned: DataFrame, time: str = "due_time") -> DataFrame:
    """One row per time a document is due, range-sorted by that time: the training order."""
    due = assigned.withColumn(time, F.explode("due_times")).drop("due_times")
    return due.repartitionByRange(F.col(time)).sortWithinPartitions(time)


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Documents in training order, repeated as often as they are due, with all their columns and nothing else."""
    size, order, due = fresh(docs, "_size", "_order", "_due")
    sized = docs.withColumn(size, word_count(text)).withColumn(order, order_key(*key, text=text))
    clash = [c for c in docs.columns if c in ("source_size", "target", "taken", "due_times")]
    renamed = sized.withColumnsRenamed({c: f"_own_{c}" for c in clash})
    placed = lay_out(assign(renamed, size, order, source), due)
    return placed.withColumnsRenamed({f"_own_{c}": c for c in clash}).select(*docs.columns) if not clash else (
        placed.select(*[F.col(f"_own_{c}" if c in clash else c).alias(c) for c in docs.columns]))


def mix_sizes(docs: DataFrame) -> DataFrame:
    """The contract's rows: what the mix takes of each document, in order of first use."""
    light = docs.select("doc_id", "source", word_count().alias("size"), order_key("doc_id").alias("ordering"))
    first = F.round(F.get("due_times", F.lit(0)), 9)
    due = assign(light, "size", "ordering").select(
        "doc_id", "size", "source_size", "target", "taken", first.alias("first_due"))
    return due.repartitionByRange(F.col("first_due").asc_nulls_last(), "doc_id").sortWithinPartitions(
        F.col("first_due").asc_nulls_last(), "doc_id")


def sql() -> str:
    """DuckDB SQL for ``mix_sizes``."""
    time = due_time_sql("((CAST(b AS DOUBLE) + 0 * source_size) / target)", "place").replace("pmod(", "mod(")
    time = re.sub(r"(\d)D\b", r"\1", time)
    n = len(WEIGHTS)
    weight = " ".join(f"WHEN {k} THEN CAST({w} AS DOUBLE)" for k, w in enumerate(WEIGHTS))
    words = " + ".join(f"greatest(least(size, goal - {c} * source_size - b), 0)" for c in range(MAX_REPEATS))
    return f"""
    WITH sized AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
               md5(coalesce(CAST(doc_id AS VARCHAR), chr(0)) || chr(31) || coalesce(md5(text), chr(0))) AS k FROM documents),
    totals AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM sized GROUP BY source),
    limits AS (
        SELECT *, CASE mod(place, {n}) {weight} END AS weight, source_size * {MAX_REPEATS} AS lim FROM totals),
    leveled AS (
        SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(lim) OVER w, 0) AS DOUBLE)
                  / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
        FROM limits WINDOW w AS (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    targets AS (
        SELECT source, place, source_size, CASE WHEN lim <= weight * level THEN CAST(lim AS DOUBLE) ELSE weight * (
            SELECT arg_min(level, lim / weight) FROM leveled WHERE NOT lim <= weight * level) END AS target FROM leveled),
    placed AS (
        SELECT s.doc_id, s.size, t.place, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS goal,
               CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS b
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target, CAST({words} AS BIGINT) AS taken,
           round(CASE WHEN least(size, goal - b) > 0 THEN {time} END, 9) AS first_due
    FROM placed"""
