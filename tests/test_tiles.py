"""The multi-tile path of the all-pairs plans, and the bipartite candidate search."""

import numpy as np
from conftest import SF001
from pyspark.sql import functions as F

from tastespark import fixtures
from tastespark.operators import content, neighbors, vectors
from tastespark.plans import tiles


def test_registered_sizes_run_in_several_tiles():
    """2,000 items on eight cores are cut, and no tile is cut below the least size."""
    assert tiles.n_tiles_for(2000, 2048, 6) >= 4
    assert tiles.n_tiles_for(100, 2048, 6) == 1
    assert tiles.n_tiles_for(100_000, 2048, 6) == 49


def test_pair_index_is_dense_and_wide(spark):
    rep = tiles.replicate_to_tile_pairs(spark.range(400).withColumnRenamed("id", "item"), "item", 7)
    t, lo, hi = 7, F.col("_lo").cast("bigint"), F.col("_hi").cast("bigint")
    idx = F.shiftright(lo * (F.lit(2 * t + 1) - lo), 1) + (hi - lo)
    got = rep.select(idx.alias("i"), "_lo", "_hi").distinct().collect()
    assert sorted(r.i for r in got) == list(range(t * (t + 1) // 2))


def test_zero_vectors_score_nothing_across_tiles(spark):
    rows = [(i, [0.0, 0.0] if i < 3 else [1.0, float(i)]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, vec array<float>")
    for size, top in ((64, 5), (4, 5), (64, None), (4, None)):
        pairs = vectors.vector_similarity(df, "id", "vec", min_similarity=None, top_n=top, tile_size=size).collect()
        assert all(np.isfinite(r.similarity) and r.id1 > 2 and r.id2 > 2 for r in pairs), size


def test_similar_to_is_the_all_pairs_table(spark):
    cat = fixtures.catalog(spark, SF001)
    feats = content.item_features(cat).checkpoint(eager=True)
    asked = feats.select("id").filter("id % 7 = 0")
    for how in ({"min_similarity": 0.5}, {"top_n": 6}):
        want = content.content_similarity(cat, **{"min_similarity": None, **how}).filter("id1 % 7 = 0")
        got = content.similar_to(asked, feats, block_size=32, **how)
        assert sorted(map(tuple, got.select("id1", "id2", "similarity").collect())) == \
            sorted(map(tuple, want.select("id1", "id2", "similarity").collect()))


def test_variant_a_drops_dissimilar_pairs(spark):
    """A pair below the threshold is dropped, and the default stands only for unknown pairs."""
    ev = spark.createDataFrame([(1, 9, 10, 0)], "event_id long, user_id long, item_id long, ts long")
    hist = spark.createDataFrame([(9, 20, 4.0, 1), (9, 21, 4.0, 2), (9, 30, 2.0, 3)], "user_id long, item_id long, rating double, ts long")
    similar = spark.createDataFrame([(10, 30, 0.9), (10, 31, 0.8)], "id1 long, id2 long, similarity double")
    exact = {(20, 30): 0.4, (21, 30): 0.7, (20, 31): 0.5, (21, 31): 0.51, (30, 31): 0.1}

    def scores(pairs):
        assert all(r.id1 < r.id2 for r in pairs.collect())
        table = spark.createDataFrame([(*k, v) for k, v in exact.items()], "id1 long, id2 long, similarity double")
        return pairs.join(table, ["id1", "id2"])

    got = {r.item_id: r.score for r in neighbors.neighbor_score_a(ev, hist, similar, scores).collect()}
    # 30: 0.7 with 21, the default with itself; 31: 0.51 with 21; three kept pairs
    assert got == {30: round((0.7 * 4 + 0.6 * 2) / 3, 9), 31: round(0.51 * 4 / 3, 9)}


def test_genre_pools_match_substrings(spark):
    cat = spark.createDataFrame([(1, "Drama/War", 5.0), (2, "Warm", 7.0), (3, None, 9.0), (4, "Comedy", 1.0), (5, "", 2.0)],
                                "id long, filmtype string, score double")
    genres = spark.createDataFrame([("War",), ("Drama",), ("",), (None,)], "genre string")
    got = sorted((r.genre, r.id) for r in neighbors.genre_pools(genres, cat).collect())
    assert got == [("", 1), ("", 2), ("", 4), ("", 5), ("Drama", 1), ("War", 1), ("War", 2)]
    plan = neighbors.genre_pools(genres, cat)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
