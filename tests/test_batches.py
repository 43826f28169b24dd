"""Merging, numbering, substitution, joins of hot keys, streams."""

import random

from pyspark.sql import functions as F

import reference_rules as rules
from pressroom import fixed_values as fv
from pressroom.operators import delivery, merge, quality, selection
from pressroom.operators.skew import salted_join
from pressroom.streaming import streams


def test_merge_does_not_depend_on_row_order(spark):
    rng = random.Random(1)
    rows = [(f"k{rng.randrange(5)}", i, f"t{i}", rng.choice([["b"], ["a"]]), rng.choice([3, 7, None]), rng.choice([None, f"2024-01-0{rng.randint(1, 9)} 00:00:00"])) for i in range(60)]
    ddl = "key string, seq int, title string, categories_seen array<string>, discovery_window_days int, p string"

    def merged(r):
        df = spark.createDataFrame(r, ddl).withColumn("published", F.to_timestamp("p")).drop("p")
        return sorted(map(str, merge.merge_rows(df).collect()))

    want = {}
    for key, seq, title, cats, days, published in rows:
        m = want.setdefault(key, {"title": title, "cats": set(), "days": 7, "published": None})
        m["cats"] |= set(cats)
        m["days"] = min(m["days"], days or 7)
        m["published"] = m["published"] or published
    got = spark.createDataFrame(rows, ddl).withColumn("published", F.to_timestamp("p")).drop("p")
    for r in merge.merge_rows(got).collect():
        w = want[r.key]
        assert (r.title, r.categories_seen, r.discovery_window_days) == (w["title"], sorted(w["cats"]), w["days"])
        assert (str(r.published) if r.published else None) == w["published"]
    assert merged(rows) == merged(rows[::-1])


def test_numbering_equals_a_global_row_number(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("d"), "id")
    got = merge.number_rows(df, [F.col("d").desc(), F.col("id").asc()], "n").collect()
    want = sorted(((r.d, r.id) for r in got), key=lambda x: (-x[0], x[1]))
    assert [(r.d, r.id) for r in sorted(got, key=lambda r: r.n)] == want
    assert sorted(r.n for r in got) == list(range(1, 1001))


def test_salted_join_equals_plain_join(spark):
    left = spark.range(300).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11).alias("k"), F.col("id").alias("l"))
    right = spark.range(200).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 13).alias("k"), F.col("id").alias("r"))
    plain = left.join(right, "k").select("k", "l", "r")
    salted = salted_join(left, right, ["k"], F.col("l"), F.col("r"), hot=10).select("k", "l", "r")
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))


def by_hand(rows, recovering):
    """The walk of one batch: keep what is clean, else the first clean reserve of the branch."""
    def repeats(a, b):
        return rules.compare(a["title"], b["title"], None, fv.EVENT_CLASSES)[0]

    main = [r for r in rows if not r["reserve"]]
    spare = [r for r in rows if r["reserve"]]
    accepted = [r for r in main if r["healthy"]] if recovering else []
    used, out = set(), []
    for slot, row in enumerate(main, 1):
        if recovering:
            clean = row["healthy"]
        else:
            clean = not row["blocked"] and not any(repeats(row, a) for a in accepted)
        if clean:
            if not recovering:
                accepted.append(row)
            out.append((slot, row["seq"], "kept"))
            continue
        for r in spare:
            if r["seq"] in used or r["editorial_branch"] != row["editorial_branch"] or r["blocked"] or any(repeats(r, a) for a in accepted):
                continue
            used.add(r["seq"])
            accepted.append(r)
            out.append((slot, r["seq"], "replaced"))
            break
        else:
            out.append((slot, row["seq"], "no_reserve"))
    return out


def test_substitution_equals_walking_each_batch(spark):
    rng = random.Random(3)
    subjects = ["Falcon Rocket Harbor", "Quantum Lantern Signal", "Nebula Garden Market", "Falcon Rocket Market"]
    verbs = ["announced", "delayed", "launch", "beta"]
    rows = []
    for batch in range(30):
        for i in range(12):
            rows.append({
                "batch": batch, "seq": batch * 100 + i, "title": f"{rng.choice(subjects)} {rng.choice(verbs)} {rng.choice(['today', 'weekly', ''])}",
                "link": "", "editorial_branch": fv.BRANCHES[rng.randrange(3)], "reserve": i >= 6, "blocked": rng.random() < 0.15,
                "healthy": batch < 15 or rng.random() < 0.7,
            })
    df = spark.createDataFrame(rows)
    got = {}
    for r in selection.substitute(df, "batch").collect():
        got.setdefault(r.batch, []).append((r.slot, r.seq, r.status))
    for batch in range(30):
        mine = [r for r in rows if r["batch"] == batch]
        recovering = any(not r["healthy"] for r in mine if not r["reserve"])
        assert sorted(got[batch]) == by_hand(mine, recovering), batch
    assert {s for b in got.values() for _, _, s in b} == {"kept", "replaced", "no_reserve"}
    big = selection.substitute(df, "batch", max_rows=5).collect()
    assert {r.status for r in big} == {"invalid_batch"} and len(big) == 180


def test_batch_repeats(spark):
    rows = [(0, i, t, "") for i, t in enumerate(["Falcon Rocket delayed", "Falcon Rocket delayed again", "Falcon Rocket announced"])]
    df = spark.createDataFrame(rows, "batch int, seq int, title string, link string")
    assert [(r.earlier, r.later) for r in selection.batch_repeats(df, "batch").collect()] == [(0, 1)]


def test_quota_moves_one_slot_only(spark):
    def batch(n, counts):
        return [(n, f"{b}{i}", b, 10 - i, n * 100 + i) for b, c in zip(fv.BRANCHES, counts) for i in range(c)]

    rows = batch(1, (3, 3, 3)) + batch(2, (4, 3, 1)) + batch(3, (5, 5, 0)) + batch(4, (2, 1, 1))
    df = spark.createDataFrame(rows, "batch int, id string, editorial_branch string, editorial_score int, seq int")
    got = {}
    for r in selection.quota_select(df, "batch").collect():
        got.setdefault((r.batch, r.complete), []).append(r.id)
    sizes = {k: len(v) for k, v in got.items()}
    assert sizes == {(1, True): 6, (2, True): 6, (3, False): 4, (4, False): 4}
    assert "gaming2" in got[(2, True)]


def test_missing_fields_are_reported(spark):
    df = spark.createDataFrame([(1, 1, "01", "gaming", "T", ["T"], "R", ["R", "x", "y"])],
                               "batch int, place int, numero string, rama string, titulo string, tituloDestacado array<string>, resumen string, resumenDestacado array<string>")
    found = {(r.rule, r.detail) for r in quality.batch_violations(df, "batch").collect()}
    assert {("missing_field", "url"), ("highlight_count", "resumenDestacado"), ("count", "1")} <= found


def test_streams_in_several_batches(spark, tmp_path):
    src = str(tmp_path / "in")
    for i in range(3):
        spark.range(20).select(
            F.concat(F.lit("k"), (F.col("id") % 5).cast("string")).alias("key"), F.lit(None).cast("timestamp").alias("published"),
            F.to_timestamp(F.lit(f"2024-01-0{i + 1} 00:00:00")).alias("arrived"), F.lit("m").alias("model"), F.lit(0.5).alias("cost_usd"),
        ).coalesce(1).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)

    once = streams.drain(streams.dedupe_stream(stream()), str(tmp_path / "out"), str(tmp_path / "c1"))
    assert sorted(r.key for r in once.collect()) == [f"k{i}" for i in range(5)]
    calls = stream().withColumnRenamed("arrived", "ts")
    spend = streams.drain_updates(streams.spend_windows(calls), str(tmp_path / "sp"), str(tmp_path / "c2"), ["start", "model"])
    assert sorted((r.calls, r.spent_usd) for r in spend.collect()) == [(20, 10.0)] * 3
    news = stream().select(F.col("key").alias("title"), F.lit("gaming").alias("branch"), F.lit("s").alias("source"), F.lit("").alias("url"), F.lit(1).alias("seq"))
    start = spark.createDataFrame([("2024-01-31", "gaming", "k0", "s", "", "k0")], "date string, branch string, title string, source string, url string, story_key string")
    args = (str(tmp_path / "reg"), str(tmp_path / "c3"), "2024-01-31 00:00:00", "2024-01-31")
    reg = streams.register_stream(news, start, *args)
    assert sorted(r.title for r in reg.collect()) == [f"k{i}" for i in range(5)]


def test_late_calls_count(spark, tmp_path):
    src = str(tmp_path / "in")
    for i, day in enumerate(["2024-01-20", "2024-01-01", "2024-01-20"]):
        spark.range(5).select(F.lit("m").alias("model"), F.lit(0.5).alias("cost_usd"), F.to_timestamp(F.lit(day)).alias("ts")).coalesce(1).write.parquet(f"{src}/part={i}")
    schema = spark.read.parquet(f"{src}/part=0").schema
    calls = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src)
    spend = streams.drain_updates(streams.spend_windows(calls), str(tmp_path / "sp"), str(tmp_path / "c"), ["start", "model"])
    assert sorted((str(r.start)[:10], r.calls) for r in spend.collect()) == [("2024-01-01", 5), ("2024-01-20", 10)]


def test_used_reserves_are_not_placed_again(spark):
    rows = [(1, 1, "Falcon Rocket delayed", "", "gaming", False, False, False), (1, 2, "Quantum Lantern launch", "", "gaming", True, False, True),
            (1, 3, "Nebula Garden beta", "", "gaming", True, False, True)]
    df = spark.createDataFrame(rows, "batch int, seq int, title string, link string, editorial_branch string, reserve boolean, blocked boolean, healthy boolean")
    used = spark.createDataFrame([(1, 2), (1, 2), (9, 3)], "batch int, seq int")
    assert [(r.seq, r.status) for r in selection.substitute(df, "batch").collect()] == [(2, "replaced")]
    assert [(r.seq, r.status) for r in selection.substitute(df, "batch", used=used).collect()] == [(3, "replaced")]


def test_completed_runs_are_logged_once(spark):
    log = spark.createDataFrame([("a", "completed", None), ("b", "failed", None)], "date string, status string, completed_at timestamp")
    runs = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "date string")
    once = delivery.mark_completed(runs, log, "2024-01-31 00:00:00")
    assert sorted((r.date, r.status) for r in once.collect()) == [("a", "completed"), ("b", "completed"), ("b", "failed"), ("c", "completed")]
    assert delivery.mark_completed(runs, once, "2024-02-01 00:00:00").count() == 4


def test_status_counts(spark):
    df = spark.createDataFrame([("OK",), ("OK",), ("PARCIAL",), (None,), ("other",)], "estado string")
    assert tuple(delivery.status_counts(df, "estado", {"OK": "ok", "PARCIAL": "partial"}).first()) == (2, 1, 5)
    assert delivery.status_counts(df.limit(0), "estado", {"OK": "ok"}).first().total == 0


def test_no_task_holds_a_hot_key(spark):
    """A third of both sides share one key; nothing is broadcast but the bounded table of hot keys, and nothing is split at run time."""
    n = 60_000
    left = spark.range(n).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("l"))
    right = spark.range(300).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("r"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(keep, ("-1", "false", "40"), strict=True):
            spark.conf.set(k, v)
        for how in ("inner", "left"):
            out = salted_join(left, right.filter("k <> -1 or r = 0") if how == "left" else right, ["k"], F.col("l"), F.col("r"), hot=500, how=how)
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert max(sizes) < 0.12 * sum(sizes), (how, sorted(sizes))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    plain = left.join(right, "k", "left").select("k", "l", "r")
    salted = salted_join(left, right, ["k"], F.col("l"), F.col("r"), hot=500, how="left").select("k", "l", "r")
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0


def test_registry_batches_move_what_they_bring(spark, tmp_path):
    """Bytes and rows that a micro-batch writes do not grow with the history; days past the retention and old versions go."""
    import os

    from pressroom.sources import versions

    written = {}
    for size in (100, 20_000):
        root = tmp_path / str(size)
        src = str(root / "in")
        for i in range(4):
            spark.range(30).select(
                F.concat(F.lit(f"story {i} "), F.col("id")).alias("title"), F.lit("gaming").alias("branch"), F.lit("s").alias("source"),
                F.when(F.col("id") % 2 == 0, F.concat(F.lit(f"http://a/{i % 2}/"), F.col("id"))).otherwise("").alias("url"), F.col("id").alias("seq"),
            ).coalesce(1).write.mode("append").parquet(src)
        news = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
        day = F.date_format(F.date_sub(F.lit("2024-01-31").cast("date"), (F.col("id") % 50).cast("int")), "yyyy-MM-dd")
        start = spark.range(size).select(day.alias("date"), F.lit("gaming").alias("branch"), F.concat(F.lit("old "), F.col("id")).alias("title"), F.lit("s").alias("source"), F.lit("").alias("url"), F.concat(F.lit("old-"), F.col("id")).alias("story_key"))
        path = str(root / "reg")
        got = streams.register_stream(news, start, path, str(root / "c"), "2024-01-31 00:00:00", "2024-01-31")
        kept = start.filter("date >= '2024-01-01'").count()
        # two of the four batches bring the links of the two before, and titles of their own without a link
        assert got.filter("date >= '2024-01-01'").count() == got.count() == kept + 30 + 60
        written[size] = [sum(os.path.getsize(f"{d}/{f}") for f in os.listdir(d) if f.endswith(".parquet")) for n in range(4) if os.path.isdir(d := f"{path}/data/batch={n}")]
        assert versions.manifests(spark, path).select("version").distinct().count() == 2
        again = streams.register_stream(news, start, path, str(root / "c"), "2024-01-31 00:00:00", "2024-01-31")
        assert again.count() == got.count()
    assert written[100] == written[20_000]


def test_registry_folders_of_a_day_become_one(spark, tmp_path):
    from pressroom.sources import versions

    src, path = str(tmp_path / "in"), str(tmp_path / "reg")
    for i in range(5):
        spark.range(3).select(F.concat(F.lit(f"story {i} "), F.col("id")).alias("title"), F.lit("gaming").alias("branch"), F.lit("s").alias("source"), F.lit("").alias("url"), F.col("id").alias("seq")).coalesce(1).write.mode("append").parquet(src)
    news = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    start = spark.createDataFrame([("2024-01-31", "gaming", "k0", "s", "", "k0")], "date string, branch string, title string, source string, url string, story_key string")
    got = streams.register_stream(news, start, path, str(tmp_path / "c"), "2024-01-31 00:00:00", "2024-01-31", merge_at=2)
    assert got.count() == 16 and len(versions.newest(spark, path)[1]) <= 2
