"""Streaming pipelines driven by the file source with availableNow triggers."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tastespark import fixtures
from tastespark.operators import content, neighbors, segments
from tastespark.sources import streams
from tastespark.sinks.upsert import UpsertTable
from tastespark.streaming import jobs as P

NOW = {"availableNow": True}


def test_running_totals_equal_batch(spark, tmpdir_path):
    msgs = streams.order_message_stream(spark, SF001)
    out = os.path.join(tmpdir_path, "totals")
    ck = os.path.join(tmpdir_path, "ck")
    P.start_running_totals(spark, msgs, out, ck, NOW).awaitTermination()
    got = P.current_totals(spark, out).select("id", "n_orders", "total_price")
    want = segments.order_totals(segments.parse_orders(fixtures.order_payloads(spark, SF001)))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_restart_from_checkpoint_adds_nothing(spark, tmpdir_path):
    msgs = streams.order_message_stream(spark, SF001)
    out = os.path.join(tmpdir_path, "totals")
    ck = os.path.join(tmpdir_path, "ck")
    P.start_running_totals(spark, msgs, out, ck, NOW).awaitTermination()
    first = P.current_totals(spark, out).orderBy("id").collect()
    # same source, same checkpoint: no new offsets, nothing is re-added
    P.start_running_totals(spark, streams.order_message_stream(spark, SF001), out, ck, NOW).awaitTermination()
    assert P.current_totals(spark, out).orderBy("id").collect() == first


def test_minute_totals_stream_matches_batch(spark, tmpdir_path):
    msgs = streams.order_message_stream(spark, SF001)
    out = os.path.join(tmpdir_path, "minutes")
    P.start_minute_totals(spark, msgs, out, os.path.join(tmpdir_path, "ck"), NOW).awaitTermination()
    got = spark.read.parquet(out)
    want = segments.minute_totals(segments.parse_orders(fixtures.order_payloads(spark, SF001)))
    # append mode emits windows closed by the watermark; each emitted window is exact
    assert got.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_batch_counter(spark, tmpdir_path):
    msgs = streams.rating_message_stream(spark, SF001)
    out = os.path.join(tmpdir_path, "counts")
    P.start_batch_counter(spark, msgs, out, os.path.join(tmpdir_path, "ck"), NOW).awaitTermination()
    assert spark.read.parquet(out).agg(F.sum("n_records")).first()[0] == \
        fixtures.rating_events(spark, SF001).count()


def test_variant_a_stream_equals_batch(spark, tmpdir_path):
    cat = fixtures.catalog(spark, SF001)
    sim = content.content_similarity(cat, 0.4).checkpoint()
    hist = fixtures.ratings(spark, SF001)
    out = os.path.join(tmpdir_path, "a")
    msgs = streams.rating_message_stream(spark, SF001)
    P.start_variant_a(spark, msgs, hist, sim, out, os.path.join(tmpdir_path, "ck"), NOW).awaitTermination()
    got = spark.read.parquet(out).select("user_id", "item_id", "event_ts", "score")
    ev = fixtures.rating_events(spark, SF001)
    ev = ev.withColumn("ts", F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp"))))
    want = neighbors.neighbor_score_a(ev, hist, sim, **neighbors.VARIANT_A).select(
        "user_id", "item_id", F.col("event_ts").cast("timestamp").alias("event_ts"), "score")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_recommender_stream_upserts(spark, tmpdir_path):
    cat = fixtures.catalog(spark, SF001)
    sim = content.content_similarity(cat, 0.4).checkpoint()
    top = content.content_similarity(cat, None, top_n=10).checkpoint()
    hist = fixtures.ratings(spark, SF001)
    out = os.path.join(tmpdir_path, "recs")
    msgs = streams.rating_message_stream(spark, SF001)
    P.start_recommender(spark, msgs, hist, sim, top, cat, out, os.path.join(tmpdir_path, "ck"),
                        NOW, neighbors.VARIANT_B1).awaitTermination()
    cur = P.current_lists(spark, out)
    known = fixtures.rating_events(spark, SF001).select("user_id").distinct() \
        .join(hist.select("user_id"), "user_id", "left_semi").count()
    assert cur.select("user_id").distinct().count() == known
    # every packed list has at most N entries, each "item:priority,"
    n = neighbors.VARIANT_B1["n"]
    lens = [r["packed"].count(",") for r in cur.select("packed").collect()]
    assert lens and max(lens) <= n


def test_user_router_stream(spark, tmpdir_path):
    from tastespark.operators import factors, segments as seg

    hist = fixtures.ratings(spark, SF001)
    model = factors.train_als(hist, rank=4, max_iter=2, reg=0.1)
    popular = seg.popular_items(hist, 5)
    out = os.path.join(tmpdir_path, "route")
    msgs = streams.rating_message_stream(spark, SF001)
    P.start_user_router(spark, msgs, hist, model, popular, out, os.path.join(tmpdir_path, "ck"), NOW).awaitTermination()
    got = spark.read.parquet(out)
    ev = fixtures.rating_events(spark, SF001)
    known, new = seg.split_users(ev, hist)
    assert got.filter("source = 'popular'").select("user_id").distinct().count() == new.count()
    assert got.filter("source = 'model'").select("user_id").distinct().count() == known.count()


def test_grand_and_batch_totals(spark, tmpdir_path):
    want = segments.grand_total(segments.parse_orders(fixtures.order_payloads(spark, SF001))).first()
    g = os.path.join(tmpdir_path, "grand")
    P.start_grand_total(spark, streams.order_message_stream(spark, SF001), g,
                        os.path.join(tmpdir_path, "ck1"), NOW).awaitTermination()
    last = spark.read.parquet(g).orderBy(F.col("batch_id").desc()).first()
    assert (last.n_orders, last.total_price) == (want.n_orders, want.total_price)
    b = os.path.join(tmpdir_path, "batch")
    P.start_batch_totals(spark, streams.order_message_stream(spark, SF001), b,
                         os.path.join(tmpdir_path, "ck2"), NOW).awaitTermination()
    per_batch = spark.read.parquet(b).agg(F.sum("n_orders").alias("n"), F.sum("total_price").alias("p")).first()
    assert (per_batch.n, per_batch.p) == (want.n_orders, want.total_price)


def test_rejects_are_kept_not_fatal(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "msgs")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("1,2,3.0,1700000000000\n7,abc,3.0,1\n")
    msgs = spark.readStream.schema("value string").text(src)
    hist = spark.createDataFrame([(1, 5, 4.0, 1)], "user_id bigint, item_id bigint, rating double, ts bigint")
    sim = spark.createDataFrame([(2, 5, 0.9)], "id1 bigint, id2 bigint, similarity double")
    out, rej = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "rej")
    P.start_variant_a(spark, msgs, hist, sim, out, os.path.join(tmpdir_path, "ck"), NOW, rejects_path=rej) \
        .awaitTermination()
    assert [r.value for r in spark.read.parquet(rej).collect()] == ["7,abc,3.0,1"]
    assert spark.read.parquet(out).count() == 1


def test_kafka_missing_is_explained(spark):
    with pytest.raises(Exception) as e:
        streams.kafka_stream(spark, "localhost:9092", "ratings")
    assert "kafka" in str(e.value).lower()


def test_recommender_stream_equals_batch_and_replay_is_idempotent(spark, tmpdir_path):
    cat = fixtures.catalog(spark, SF001)
    basic = fixtures.catalog_basic(spark, SF001)
    sim, top = content.similarity_tables(cat, 0.4, 10)
    hist = fixtures.ratings(spark, SF001).select("user_id", "item_id", "rating", "ts")
    out = os.path.join(tmpdir_path, "recs")
    ck = os.path.join(tmpdir_path, "ck")
    P.start_recommender(spark, streams.rating_message_stream(spark, SF001), hist, sim, top, basic, out, ck,
                        NOW, neighbors.VARIANT_B1).awaitTermination()
    got = P.current_lists(spark, out).select("user_id", F.explode("entries").alias("e")).select(
        "user_id", "e.item_id", "e.slot", F.round("e.priority", 9).alias("priority"))
    # batch form over the same events (one micro-batch holds them all)
    p = neighbors.VARIANT_B1
    users = fixtures.rating_events(spark, SF001).select("user_id")
    now = neighbors.neighbor_score_b(users, hist, top, sim, basic, n=p["n"], min_similarity=p["min_similarity"],
                                     score_cut=p["score_cut"], score_source=p["score_source"])
    merged = neighbors.merge_decayed(now, now.limit(0), p["n"])
    anchors = ratings_latest(hist.join(users, "user_id", "left_semi"))
    want = neighbors.supplement(merged, anchors, basic, hist).select(
        "user_id", "item_id", "slot", F.round("priority", 9).alias("priority"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    before = P.list_table(spark, out).manifest()
    P.start_recommender(spark, streams.rating_message_stream(spark, SF001), hist, sim, top, basic, out, ck,
                        NOW, neighbors.VARIANT_B1).awaitTermination()
    assert P.list_table(spark, out).manifest() == before


def ratings_latest(h):
    from tastespark.operators.ratings import latest_rating
    return latest_rating(h)


def test_recommender_chains_lists(spark, tmpdir_path):
    """Four micro-batches: the table holds each user's newest list, and later batches merge with earlier lists."""
    cat = fixtures.catalog(spark, SF001)
    basic = fixtures.catalog_basic(spark, SF001)
    sim, top = content.similarity_tables(cat, 0.4, 10)
    hist = fixtures.ratings(spark, SF001).select("user_id", "item_id", "rating", "ts")
    src = os.path.join(tmpdir_path, "msgs")
    os.makedirs(src)
    users = [r.user_id for r in hist.select("user_id").distinct().orderBy("user_id").limit(3).collect()]
    for i, u in enumerate(users + users[:1]):
        with open(os.path.join(src, f"m{i}.txt"), "w") as f:
            f.write(f"{u},1,4.0,{1700000000000 + i}\n")
        os.utime(os.path.join(src, f"m{i}.txt"), (1700000000 + i, 1700000000 + i))
    msgs = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
    out = os.path.join(tmpdir_path, "recs")
    P.start_recommender(spark, msgs, hist, sim, top, basic, out, os.path.join(tmpdir_path, "ck"), NOW,
                        neighbors.VARIANT_B1, buckets=4).awaitTermination()
    cur = P.current_lists(spark, out)
    assert sorted(r.user_id for r in cur.select("user_id").collect()) == sorted(users)
    # the first user came back in the last batch: its current list is that batch's
    assert {r.user_id: r.batch_id for r in cur.collect()} == {users[0]: 3, users[1]: 1, users[2]: 2}
    assert P.list_table(spark, out, 4).files() <= 4 and P.rating_table(spark, out, 4).files() <= 4


def _message_files(folder, lines):
    os.makedirs(folder)
    for i, line in enumerate(lines):
        with open(os.path.join(folder, f"m{i}.txt"), "w") as f:
            f.write(line + "\n")


def _recommender(spark, folder, tmp, hist, seen=None):
    """Run the recommender over the files; ``seen`` collects the lists after each batch."""
    cat = fixtures.catalog(spark, SF001)
    sim, top = content.similarity_tables(cat, 0.4, 10)
    msgs = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(folder)
    upsert = UpsertTable.upsert

    def recorded(self, rows, batch):
        wrote = upsert(self, rows, batch)
        if seen is not None and self.path.endswith("/lists"):
            seen.update({(r.batch_id, r.user_id): r.packed for r in self.read().collect()})
        return wrote

    patch = pytest.MonkeyPatch()
    patch.setattr(UpsertTable, "upsert", recorded)
    P.start_recommender(spark, msgs, hist, sim, top, fixtures.catalog_basic(spark, SF001), f"{tmp}/recs", f"{tmp}/ck", NOW,
                        neighbors.VARIANT_B1, buckets=4).awaitTermination()
    patch.undo()
    return seen


def test_batch_replayed_after_its_write_writes_the_same(spark, tmpdir_path):
    """A batch fails after its output is written and before it is committed: it runs again, and computes the same."""
    hist = fixtures.ratings(spark, SF001).select("user_id", "item_id", "rating", "ts").checkpoint()
    user = hist.agg(F.min("user_id")).first()[0]
    _message_files(f"{tmpdir_path}/msgs", [f"{user},{i + 1},4.0,{1700000000000 + i}" for i in range(3)])
    first = _recommender(spark, f"{tmpdir_path}/msgs", tmpdir_path, hist, {})
    assert {b for b, _ in first} == {0, 1, 2}
    table = P.list_table(spark, f"{tmpdir_path}/recs", 4)
    kept, ratings = table.read().collect(), P.rating_table(spark, f"{tmpdir_path}/recs", 4).read().collect()
    for name in os.listdir(f"{tmpdir_path}/ck/commits"):
        if name.strip(".").split(".")[0] == "2":
            os.remove(f"{tmpdir_path}/ck/commits/{name}")
    again = []
    patch = pytest.MonkeyPatch()
    patch.setattr(P.UpsertTable, "upsert", lambda self, rows, batch: again.append((self.path, batch, rows.collect())))
    _recommender(spark, f"{tmpdir_path}/msgs", tmpdir_path, hist)
    patch.undo()
    _recommender(spark, f"{tmpdir_path}/msgs", tmpdir_path, hist)
    assert table.read().collect() == kept and P.rating_table(spark, f"{tmpdir_path}/recs", 4).read().collect() == ratings


def test_user_first_seen_by_the_stream_gets_a_list(spark, tmpdir_path):
    hist = fixtures.ratings(spark, SF001).select("user_id", "item_id", "rating", "ts").checkpoint()
    _message_files(f"{tmpdir_path}/msgs", [f"7777777,{i + 1},4.0,{1700000000000 + i}" for i in range(3)])
    got = _recommender(spark, f"{tmpdir_path}/msgs", tmpdir_path, hist, {})
    # nothing is known at the first event; from the second one on, the ratings before it are
    assert (0, 7777777) not in got and got[1, 7777777] and got[2, 7777777]


def test_broken_table_is_not_taken_for_an_empty_one(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/recs/lists/manifest")
    with open(f"{tmpdir_path}/recs/lists/manifest/v0.json", "w") as f:
        f.write("not a manifest")
    with pytest.raises(Exception):
        P.current_lists(spark, f"{tmpdir_path}/recs")
    assert P.current_lists(spark, f"{tmpdir_path}/none") is None


def test_totals_by_batches(spark, tmpdir_path):
    lines = [f'{{"id": "{i % 2}", "price": {i}}}' for i in range(1, 6)]
    _message_files(f"{tmpdir_path}/msgs", lines)
    msgs = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(f"{tmpdir_path}/msgs") \
        .withColumn("ts", F.current_timestamp())
    P.start_running_totals(spark, msgs, f"{tmpdir_path}/t", f"{tmpdir_path}/ck", NOW, buckets=2).awaitTermination()
    assert P.total_table(spark, f"{tmpdir_path}/t", 2).manifest()["batch"] == 4
    got = {str(r.id): r.asDict() for r in P.current_totals(spark, f"{tmpdir_path}/t").collect()}
    assert sorted(got) == ["0", "1"] and 6 in got["0"].values() and 9 in got["1"].values()


def test_recent_ratings_are_state(spark, tmpdir_path):
    """Variant A over many batches equals the plain rule: the user's latest five, as of before the batch; a restart goes on."""
    rnd = random.Random(2)
    hist = [(u, i, float(rnd.randint(1, 5)), 1600000000000 + rnd.randrange(10 ** 9)) for u in (1, 2, 3) for i in range(8)]
    events = [(rnd.randint(1, 4), rnd.randrange(12), float(rnd.randint(1, 5)), 1700000000000 + rnd.randrange(10 ** 6)) for _ in range(24)]
    os.makedirs(f"{tmpdir_path}/msgs")
    batches = [events[i:i + 3] for i in range(0, len(events), 3)]

    def put(n, rows):
        with open(f"{tmpdir_path}/msgs/m{n:02d}.txt", "w") as f:
            f.write("".join(f"{u},{i},{r},{t}\n" for u, i, r, t in rows) + ("broken line\n" if n % 3 == 0 else ""))
        os.utime(f"{tmpdir_path}/msgs/m{n:02d}.txt", (1700000000 + n, 1700000000 + n))

    told = spark.createDataFrame(hist, "user_id long, item_id long, rating double, ms long").withColumn("ts", F.timestamp_millis("ms")).drop("ms")
    sim = spark.createDataFrame([(a, b, 0.51 + (a * 7 + b) % 40 / 100) for a in range(12) for b in range(12) if a != b],
                                "id1 long, id2 long, similarity double")

    def run():
        msgs = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(f"{tmpdir_path}/msgs")
        P.start_variant_a(spark, msgs, told, sim, f"{tmpdir_path}/a", f"{tmpdir_path}/ck", NOW,
                          rejects_path=f"{tmpdir_path}/rejects").awaitTermination()

    for n, rows in enumerate(batches[:5]):
        put(n, rows)
    run()
    for n, rows in enumerate(batches[5:], 5):
        put(n, rows)
    run()
    got = sorted((r.batch_id, r.user_id, r.item_id, round(r.score, 9)) for r in spark.read.parquet(f"{tmpdir_path}/a").collect())
    known, want = [*hist], []
    for n, rows in enumerate(batches):
        before = spark.createDataFrame(known, "user_id long, item_id long, rating double, ms long").groupBy("user_id", "item_id").agg(
            F.max(F.struct("ms", "rating")).alias("m")).select("user_id", "item_id", "m.rating", F.timestamp_millis("m.ms").alias("ts"))
        ev = spark.createDataFrame([(k, u, i, t) for k, (u, i, _, t) in enumerate(rows)], "event_id long, user_id long, item_id long, ts long")
        want += [(n, r.user_id, r.item_id, round(r.score, 9)) for r in
                 neighbors.neighbor_score_a(ev, before, sim, sim, **neighbors.VARIANT_A).collect()]
        known += rows
    assert got == sorted(want) and got
    assert spark.read.parquet(f"{tmpdir_path}/rejects").count() == 3


def test_equal_messages_of_a_batch_are_all_scored(spark, tmpdir_path):
    """The same message three times in one batch and once in the next: four scores, and a replay names them alike."""
    os.makedirs(f"{tmpdir_path}/msgs")
    for i, n in enumerate((3, 1)):
        with open(f"{tmpdir_path}/msgs/m{i}.txt", "w") as f:
            f.write("1,2,3.0,1700000000000\n" * n)
        os.utime(f"{tmpdir_path}/msgs/m{i}.txt", (1700000000 + i, 1700000000 + i))
    hist = spark.createDataFrame([(1, 5, 4.0, 1)], "user_id bigint, item_id bigint, rating double, ts bigint")
    sim = spark.createDataFrame([(2, 5, 0.9)], "id1 bigint, id2 bigint, similarity double")

    def scored(name):
        msgs = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(f"{tmpdir_path}/msgs")
        P.start_variant_a(spark, msgs, hist, sim, f"{tmpdir_path}/{name}", f"{tmpdir_path}/ck-{name}", NOW).awaitTermination()
        return sorted((r.batch_id, r.event_id) for r in spark.read.parquet(f"{tmpdir_path}/{name}").collect())

    first = scored("a")
    assert [b for b, _ in first] == [0, 0, 0, 1] and len(set(first)) == 4
    assert scored("b") == first
