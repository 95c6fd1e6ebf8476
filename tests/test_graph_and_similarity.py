"""Search and similarity against brute force in plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from tablewright.operators import graph as G
from tablewright.operators import similarity as M
from tests.conftest import plan_text

RATINGS = "u int, i int, r int"


def brute_similarity(ratings):
    by_user = defaultdict(list)
    for user, item, value in ratings:
        if user is not None and item is not None:
            by_user[user].append((item, value))
    sums = defaultdict(lambda: [0, 0, 0, 0])
    for lines in by_user.values():
        for i, x in lines:
            for j, y in lines:
                if i < j:
                    total = sums[i, j]
                    total[1] += 0 if x is None else x * x
                    total[2] += 0 if y is None else y * y
                    if x is not None and y is not None:
                        total[0] += x * y
                        total[3] += 1
    result = {}
    for pair, (xy, xx, yy, n) in sums.items():
        below = math.sqrt(xx) * math.sqrt(yy)
        result[pair] = (round(xy / below, 9) if below else 0.0, n)
    return result


def found(df):
    return {(r["item1"], r["item2"]): (round(r["score"], 9), r["num_pairs"]) for r in df.collect()}


def some_ratings(seed, nulls=False):
    """Repeated ratings, zero ratings, and one user who owns a third of all rows."""
    rng = random.Random(seed)
    data = [(0, rng.randrange(25), rng.randrange(6)) for _ in range(100)]
    data += [(rng.randrange(1, 40), rng.randrange(25), rng.randrange(6)) for _ in range(200)]
    if nulls:
        data += [(None, 1, 5), (3, None, 5)]
    return data


@pytest.mark.parametrize("items_per_task", [5_000, 4, 1])
def test_similarity_equals_brute_force(spark, items_per_task):
    data = some_ratings(1, nulls=True)
    df = spark.createDataFrame(data, RATINGS).repartition(4)
    got = M.item_similarity(df, "u", "i", "r", items_per_task=items_per_task)
    assert found(got) == brute_similarity(data)
    assert all(-1 - 1e-9 <= score <= 1 + 1e-9 for score, _ in found(got).values())


def test_scores_stay_within_one_and_zero_vectors_score_zero(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 2, 5), (2, 1, 0), (2, 2, 4), (1, 3, 5), (2, 3, 4)], RATINGS)
    got = found(M.item_similarity(df, "u", "i", "r"))
    assert got == {(1, 2): (0.0, 2), (1, 3): (0.0, 2), (2, 3): (1.0, 2)}


def test_missing_ratings_do_not_count_as_pairs(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 3), (2, 1, 2), (2, 2, 2)], RATINGS)
    assert found(M.item_similarity(df, "u", "i", "r")) == brute_similarity(
        [(1, 1, None), (1, 2, 3), (2, 1, 2), (2, 2, 2)]
    )


def test_one_item_only_and_minimum_pairs(spark):
    data = some_ratings(2)
    df = spark.createDataFrame(data, RATINGS)
    every = brute_similarity(data)
    assert found(M.item_similarity(df, "u", "i", "r", only=7)) == {
        pair: value for pair, value in every.items() if 7 in pair
    }
    assert found(M.item_similarity(df, "u", "i", "r", min_pairs=5)) == {
        pair: value for pair, value in every.items() if value[1] > 5
    }


def test_neighbours_on_either_side_with_strict_limits(spark):
    sims = spark.createDataFrame(
        [(1, 2, 0.99, 60), (2, 5, 0.98, 80), (2, 6, 0.97, 80), (2, 7, 0.99, 50), (3, 4, 1.0, 90)],
        "item1 int, item2 int, score double, num_pairs long",
    )
    got = M.similar_items(sims, 2)
    assert [tuple(r) for r in got.collect()] == [(1, 0.99, 60), (5, 0.98, 80)]


def test_popular_items(spark, rows):
    df = spark.createDataFrame([(1, 10, 1), (2, 10, 1), (1, 20, 1), (1, 30, 1)], RATINGS)
    names = spark.createDataFrame([(10, "Ten")], "id int, title string")
    assert rows(M.popular_items(df, names, "i", "id", "title", 2)) == [(10, 2, "Ten"), (20, 1, "Unknown")]


LINES = ["5 1 2 ", "5  3", "7", "1 5 5", ""]


def test_degree(spark, rows):
    df = spark.createDataFrame([(line,) for line in LINES], "value string")
    assert rows(G.degree(df).filter("id IS NOT NULL")) == [(1, 2), (5, 3), (7, 0)]
    raw = {tuple(r) for r in G.degree(df, raw=True).filter("id IS NOT NULL").collect()}
    assert raw == {(1, 2), (5, 5), (7, 0)}


def test_edges_of_lines(spark, rows):
    df = spark.createDataFrame([(line,) for line in LINES], "value string")
    assert rows(G.adjacency_edges(df)) == [(1, 5), (1, 5), (5, 1), (5, 2), (5, 3)]


def test_most_and_least_connected(spark, rows):
    degrees = spark.createDataFrame([(1, 4), (2, 9), (3, 1), (4, 1), (5, 9)], "id long, connections long")
    names = spark.createDataFrame([(2, "Two"), (3, "Three")], "id long, name string")
    assert rows(G.most_connected(degrees, names)) == [(2, 9, "Two")]
    assert rows(G.least_connected(degrees, names)) == [(3, 1, "Three"), (4, 1, "Unknown")]


def brute_search(edges, start, depth):
    out = defaultdict(list)
    for a, b in edges:
        out[a].append(b)
    distance, queue = {start: 0}, deque([start])
    while queue:
        at = queue.popleft()
        if distance[at] < depth:
            for b in out[at]:
                if b not in distance:
                    distance[b] = distance[at] + 1
                    queue.append(b)
    return distance


@pytest.fixture(params=["10MB", "-1"])
def broadcast_limit(spark, request):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, request.param)
    yield
    spark.conf.unset(key)


def test_distances_equal_brute_force(spark, broadcast_limit):
    rng = random.Random(3)
    # Vertex 0 has a third of all edges; some edges repeat.
    edges = [(0, rng.randrange(60)) for _ in range(60)]
    edges += [(rng.randrange(60), rng.randrange(100)) for _ in range(120)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r["id"]: r["distance"] for r in G.bfs_distances(df, 59, 4).collect()}
    assert got == brute_search(edges, 59, 4)


def test_neighbours_differ_by_at_most_one_round(spark):
    edges = [(1, 2), (2, 3), (3, 4), (1, 4), (4, 9), (8, 1)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r["id"]: r["distance"] for r in G.bfs_distances(df, 1, keep_unreached=True).collect()}
    assert got == {1: 0, 2: 1, 4: 1, 3: 2, 9: 2, 8: 9999}
    assert all(got[b] <= got[a] + 1 for a, b in edges if got[a] < 9999)


def test_search_counts_ways_and_respects_rounds_and_direction(spark, rows):
    df = spark.createDataFrame([(1, 2), (1, 3), (2, 4), (3, 4), (3, 4), (4, 1)], "src long, dst long")
    assert rows(G.bfs(df, 1, 4)) == [(2, 3)]
    assert rows(G.bfs(df, 1, 1)) == [(3, 1)]
    assert rows(G.bfs(df, 1, 4, max_depth=1)) == []
    assert rows(G.bfs(df, 1, 77)) == []
    assert rows(G.bfs(df, 42, 1)) == []


def test_no_edges_and_no_ratings(spark, rows):
    edges = spark.createDataFrame([], "src long, dst long")
    assert rows(G.bfs_distances(edges, 1)) == [(1, 0)]
    assert G.bfs(edges, 1, 2).count() == 0
    assert M.item_similarity(spark.createDataFrame([], RATINGS), "u", "i", "r").count() == 0


def test_search_has_no_limit_unless_asked(spark, rows):
    chain = spark.createDataFrame([(n, n + 1) for n in range(14)], "src long, dst long")
    assert rows(G.bfs_distances(chain, 0)) == [(n, n) for n in range(15)]
    alone = spark.createDataFrame([(3,), (99,)], "id long")
    found = G.bfs_distances(chain, 0, 2, keep_unreached=True, vertices=alone)
    assert {r[0]: r[1] for r in found.collect()} == {**{n: n if n < 3 else 9999 for n in range(15)}, 99: 9999}


@pytest.mark.parametrize("back", [True, False])
def test_unreached_vertices_of_edges_that_go_back(spark, tmp_path, back):
    """Where each edge also goes back, the targets are not shuffled to know the vertices; else they are."""
    pairs = [(n, n + 1) for n in range(0, 40, 2)] + [(0, 1), (1, 3), (100, 100)]
    pairs += [(b, a) for a, b in pairs] if back else [(7, 200)]
    edges = spark.createDataFrame([*pairs, (None, 5), (5, None)], "src long, dst long")
    laid = G._Edges(edges, "src", "dst", 1000, 4)
    assert laid.balanced() == back
    assert sorted(row[0] for row in laid.vertices().collect()) == sorted({end for pair in pairs for end in pair})
    assert ("Union" not in laid.vertices()._jdf.queryExecution().optimizedPlan().toString()) == back
    alone = spark.createDataFrame([(300,), (300,), (3,), (22,), (None,)], "id long")
    found = G.bfs_distances(edges, 0, keep_unreached=True, vertices=alone).collect()
    near = {0: 0, 1: 1, 3: 2, 2: 3} if back else {0: 0, 1: 1, 3: 2}
    every = {end for pair in pairs for end in pair} | {300}
    assert sorted(found) == sorted((n, near.get(n, G.UNREACHED)) for n in every)


def test_blank_lines_are_no_vertices(spark, rows):
    lines = spark.createDataFrame([("1 2 3",), ("",), ("  ",), ("7",)], "value string")
    assert rows(G.degree(lines)) == [(1, 2), (7, 0)]


# Search over edges in buckets


def web(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(150)] + [(0, n) for n in range(60, 400)]
    edges += [(n, n % 50) for n in range(60, 400, 7)] + [(None, 1), (1, None), (3, 3)]
    return spark.createDataFrame(edges, "src long, dst long")


@pytest.mark.parametrize("options", [{"hub_edges": 4}, {"recent_rows": 1}, {"hub_edges": 30, "recent_rows": 20}])
def test_search_does_not_depend_on_how_edges_and_vertices_are_kept(spark, rows, options):
    edges = web(spark)
    pairs = [tuple(row) for row in edges.collect() if None not in tuple(row)]
    found = {row["id"]: row["distance"] for row in G.bfs_distances(edges, 5, **options).collect()}
    assert found == brute_search(pairs, 5, 99)
    before = found[61] - 1
    assert rows(G.bfs(edges, 5, 61, **options)) == [(found[61], sum(b == 61 and found.get(a) == before for a, b in pairs))]


def exchanges(df):
    df.collect()
    return re.findall(r"Exchange (\w+)\(([^)]*)", plan_text(df).split("== Initial Plan ==")[0])


def test_a_round_moves_its_frontier_and_hits_only(spark):
    edges = web(spark).repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        laid = G._Edges(edges, "src", "dst", 10_000, 8)
        seen = G._Seen(spark.range(1).select("id", F.lit(0).alias("distance")), 8, 2)
        seen.add(spark.range(1, 4).select("id", F.lit(1).alias("distance")), 3)
        seen.add(spark.range(4, 5).select("id", F.lit(2).alias("distance")), 1)
        assert [size for size, _ in seen.old] == [4] and seen.rows == 1
        frontier = spark.range(4, 5)
        hits = laid.ways_from(frontier)
        # One exchange for the frontier, one for the hits; none for the edges.
        assert len(exchanges(hits)) == 2
        # The recent vertices move, the old ones in buckets do not.
        assert len(exchanges(seen.mark(hits))) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


# Pairs above a co-rating count


def crowd():
    rng = random.Random(8)
    data = [("all", item, 1 + item % 5) for item in range(120)]
    data += [(f"u{user}", rng.randrange(40), rng.randrange(1, 6)) for user in range(60) for _ in range(12)]
    data += [("twice", 1, 2), ("twice", 1, 3), ("twice", 2, 4), (None, 1, 1), ("u1", None, 1), ("u2", 3, None), ("none", 3, None)]
    return data


@pytest.mark.parametrize("min_pairs", [0, 1, 3, 6, 500])
@pytest.mark.parametrize("items_per_task", [5_000, 4])
def test_pruned_similarity_equals_the_full_one(spark, rows, min_pairs, items_per_task):
    data = crowd() if min_pairs > 1 else crowd()[60:260]
    df = spark.createDataFrame(data, "u string, i int, r int")
    full = M.cosine_similarity(M.item_pairs(df, "u", "i", "r"), min_pairs)
    pruned = M.pruned_similarity(df, "u", "i", "r", min_pairs, items_per_task)
    assert [(a, b, round(s, 9), n) for a, b, s, n in rows(pruned)] == [(a, b, round(s, 9), n) for a, b, s, n in rows(full)]


def test_a_user_of_very_many_items_forms_no_pairs(spark):
    data = [("all", item, 1) for item in range(50_000)]
    data += [(f"u{user}", item, 1 + user % 3) for user in range(30) for item in range(user % 4, 24, 2)]
    moments = M.rating_moments(spark.createDataFrame(data, RATINGS.replace("u int", "u string")), "u", "i", "r")
    found = M.candidate_pairs(moments, 4)
    assert found.count() <= 24 * 23 / 2  # 1,249,975,000 pairs without the filter


def test_nearest_items(spark, rows):
    df = spark.createDataFrame(crowd(), "u string, i int, r int")
    sims = [r for r in M.item_similarity(df, "u", "i", "r", min_pairs=3).collect() if r["score"] > 0.5]
    best = defaultdict(list)
    for r in sims:
        best[r["item1"]].append((-r["score"], -r["num_pairs"], r["item2"]))
        best[r["item2"]].append((-r["score"], -r["num_pairs"], r["item1"]))
    wanted = [(item, near, n + 1) for item, found in best.items() for n, (_, _, near) in enumerate(sorted(found)[:2])]
    found = M.nearest_items(df, "u", "i", "r", k=2, min_score=0.5, min_pairs=3)
    assert rows(found, "item", "neighbour", "rank") == sorted(wanted)


def test_candidates_are_not_worked_out_where_all_pairs_are_fewer(spark, monkeypatch):
    """Users of few items and items of many users: a candidate would be looked up under each of its users."""
    data = [(u, (u * 7 + n * n) % 10, 1 + (u + n) % 3) for u in range(300) for n in range(3)]
    df = spark.createDataFrame(data, RATINGS)
    wanted = {pair: value for pair, value in brute_similarity(data).items() if value[1] > 3}
    for few in (M.FEW_PAIRS, 0):
        monkeypatch.setattr(M, "FEW_PAIRS", few)
        with monkeypatch.context() as only:
            only.setattr(M, "_checked", None)
            assert found(M.pruned_similarity(df, "u", "i", "r", 3)) == wanted


def test_users_are_dealt_to_more_tasks_when_they_form_more_pairs(spark, monkeypatch):
    monkeypatch.setattr(M, "PAIRS_PER_TASK", 100)
    data = [(u, (u + n) % 50, 1 + n) for u in range(100) for n in range(6)]
    df = spark.createDataFrame(data, RATINGS)
    pairs = M.item_pairs(df, "u", "i", "r")
    assert "REPARTITION_BY_NUM" in plan_text(pairs) and pairs.rdd.getNumPartitions() == 15
    assert found(M.cosine_similarity(pairs)) == brute_similarity(data)
