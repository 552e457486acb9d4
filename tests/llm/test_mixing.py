from pyspark.sql import functions as F

from gridlens.llm import mixing


def test_schedules_integrate_to_one_and_invert(spark):
    for place, schedule in enumerate(mixing.SCHEDULES):
        points = mixing.normalised(schedule)
        assert points[0][2] == 0 and abs(points[-1][2] - 1) < 1e-12
        rows = spark.range(101).select((F.col("id") / 100).alias("u"), F.lit(place).alias("p"))
        times = [r[0] for r in rows.select(F.expr(mixing.due_time_sql("u", "p"))).collect()]
        assert times == sorted(times) and times[0] == 0 and abs(times[-1] - 1) < 1e-9
        for u, t in zip((k / 100 for k in range(101)), times):
            total = 0.0
            for (t0, w0, _), (t1, w1, _) in zip(points, points[1:]):
                x = min(max(t - t0, 0), t1 - t0)
                total += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
            assert abs(total - u) < 1e-9


def _water(sizes, weights, most=3):
    """Reshare until no target is above its limit."""
    targets, stopped = {}, {}
    while True:
        free = [s for s in sizes if s not in stopped]
        left = sum(sizes.values()) - sum(stopped.values())
        total = sum(weights[s] for s in free)
        targets = {s: left * weights[s] / total for s in free} if total else {}
        over = [s for s in free if targets[s] > most * sizes[s]]
        if not over:
            return {**targets, **stopped}
        stopped |= {s: most * sizes[s] for s in over}


def test_targets_as_resharing_by_hand(spark):
    rows = [("a", 10), ("b", 5), ("c", 1000), ("d", 0), ("e", 300), (None, 7), ("a", 1)]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long"), "source", "size").collect()}
    sizes = {}
    for s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = _water(sizes, {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)})
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_taken_meets_targets(documents):
    rows = mixing.mix_sizes(documents).join(documents.select("doc_id", "source"), "doc_id").collect()
    sources = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        s = sources.setdefault(r["source"], [0, r["target"]])
        s[0] += r["taken"]
    assert all(abs(a - b) <= 1 for a, b in sources.values())
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix_sizes(documents).join(documents.select("doc_id", "source"), "doc_id").collect()))


def test_odd_rows(odd, empty):
    rows = mixing.mix_sizes(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["size"] == 0 and r["taken"] == 0 for r in rows if r["doc_id"] in (3, 4, 5))
    assert mixing.mix_sizes(empty).count() == 0
    assert mixing.mix(odd.filter("doc_id in (3, 4, 5)")).count() == 0


def test_mixed_documents_keep_their_columns(clashing):
    mixed = mixing.mix(clashing)
    assert mixed.columns == clashing.columns
    assert mixed.filter("target <> 4 or taken <> 5").count() == 0


def test_training_order_follows_due_times(documents):
    sized = documents.select("source", F.length("text").alias("size"), mixing.order_key("doc_id").alias("k"))
    times = [r[0] for r in mixing.lay_out(mixing.assign(sized, "size", "k")).select("due_time").collect()]
    assert times == sorted(times)


def test_one_id_and_other_texts_in_two_layouts(spark):
    """A third of the rows without id, ids repeated: what is taken does not depend on where rows stand."""
    rows = [(None if k % 3 == 0 else k % 17, "word " * (k % 23), "abc"[k % 3 if k % 5 else 0], k) for k in range(600)]
    schema = "doc_id long, text string, source string, k int"
    one = spark.createDataFrame(rows, schema).coalesce(1)
    two = spark.createDataFrame(rows[::-1], schema).repartition(7, "k")

    def taken(df):
        columns = ("doc_id", "size", "source_size", "target", "taken", "first_due")
        return sorted(map(tuple, mixing.mix_sizes(df).select(*columns).collect()), key=repr)

    def laid_out(df):
        return sorted((r.text, r.k % 23) for r in mixing.mix(df).select("text", "k").collect())

    assert taken(one) == taken(two)
    assert [t for t, _ in laid_out(one)] == [t for t, _ in laid_out(two)]
