"""Similarity, popularity, degree and breadth-first search."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.tables import as_long, table
from tablewright.operators import graph as G
from tablewright.operators import similarity as M
from tablewright.runtime import dealt, scratch_path
from tablewright.sinks.files import write_parquet


def _lines(spark, folder):
    """Order lines, dealt to tasks by user and item: sums per pair then need no other shuffle."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    return dealt(lines, table(spark, folder, "lineitem").count(), "l_orderkey", "l_suppkey")


def _ratings(spark, folder):
    return _lines(spark, folder).groupBy("l_orderkey", "l_suppkey").agg(
        F.max("l_quantity").cast("long").alias("rating")
    )


def _rounded(similarities):
    return similarities.withColumn("score", F.round("score", 9))


def item_similarity(spark, folder):
    return _rounded(M.item_similarity(_ratings(spark, folder), "l_orderkey", "l_suppkey", "rating"))


def item_similarity_repeats(spark, folder):
    """Every order line is a rating, so a user may rate an item several times."""
    lines = _lines(spark, folder).select(
        "l_orderkey", "l_suppkey", F.col("l_quantity").cast("long").alias("rating")
    )
    return _rounded(M.item_similarity(lines, "l_orderkey", "l_suppkey", "rating", min_pairs=1))


def item_similarity_blocked(spark, folder):
    """The same with users of more than three items cut into blocks."""
    ratings = _ratings(spark, folder)
    return _rounded(
        M.item_similarity(ratings, "l_orderkey", "l_suppkey", "rating", items_per_task=3)
    )


def similar_items(spark, folder):
    found = M.item_similarity(_ratings(spark, folder), "l_orderkey", "l_suppkey", "rating", only=1)
    best = M.similar_items(_rounded(found), 1, min_score=0.5, min_pairs=3, k=10)
    supplier = table(spark, folder, "supplier")
    named = M.lookup(best, supplier, "item", "s_name", "unknown", dim_key="s_suppkey")
    return named


def nearest_items(spark, folder):
    """The three best neighbours of every supplier, over orders with both."""
    found = M.nearest_items(_rounded_ratings(spark, folder), "l_orderkey", "l_suppkey", "rating", 3, 0.5, 3)
    return _rounded(found)


def similarity_above_limit(spark, folder):
    """Pairs with more than three co-ratings, found without forming the others."""
    return _rounded(M.pruned_similarity(_rounded_ratings(spark, folder), "l_orderkey", "l_suppkey", "rating", 3))


def _rounded_ratings(spark, folder):
    """Ratings of 1 to 3: many pairs tie, so ranks depend on the tie rule."""
    return _ratings(spark, folder).withColumn("rating", F.floor(F.col("rating") % 3) + 1)


def similarity_stored(spark, folder):
    """All pairs written once; the neighbours of item 1 come from the files."""
    path = scratch_path(spark, "similarities")
    write_parquet(item_similarity(spark, folder), path)
    best = M.similar_items(spark.read.parquet(path), 1, min_score=0.5, min_pairs=3, k=10)
    return M.lookup(best, table(spark, folder, "supplier"), "item", "s_name", "unknown", dim_key="s_suppkey")


# Lines of odd parts name a part that the table doesn't have.
_SOLD = "CASE WHEN l_partkey % 2 = 1 THEN l_partkey + 1000000000 ELSE l_partkey END"


def popular_items(spark, folder):
    lines = table(spark, folder, "lineitem")
    lines = lines.selectExpr(f"{_SOLD} AS l_partkey")
    names = table(spark, folder, "part")
    return M.popular_items(lines, names, "l_partkey", "p_partkey", "p_name", 10)


def _adjacency(spark, folder):
    """Lines ``supplier order part``."""
    return table(spark, folder, "lineitem").select(
        F.concat_ws(" ", "l_suppkey", "l_orderkey", "l_partkey", F.lit("")).alias("value")
    )


def _names(spark, folder):
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )


def degree(spark, folder):
    return G.degree(_adjacency(spark, folder))


def degree_raw(spark, folder):
    """Single-space splitting counts the trailing empty token."""
    return G.degree(_adjacency(spark, folder), raw=True)


def most_connected(spark, folder):
    return G.most_connected(degree(spark, folder), _names(spark, folder))


def least_connected(spark, folder):
    return G.least_connected(degree(spark, folder), _names(spark, folder))


# Order ids are moved out of the range of part ids.
ORDER_OFFSET = 100_000_000


def _edges(spark, folder):
    lines = table(spark, folder, "lineitem")
    order = F.col("l_orderkey") + ORDER_OFFSET
    forward = lines.select(F.col("l_partkey").alias("src"), order.alias("dst"))
    return forward.unionByName(forward.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def adjacency_edges(spark, folder):
    return G.adjacency_edges(_adjacency(spark, folder))


def bfs_distances(spark, folder):
    return G.bfs_distances(_edges(spark, folder), 1).withColumns(as_long("distance"))


def bfs_all_vertices(spark, folder):
    """Suppliers stand for vertices without edges."""
    alone = table(spark, folder, "supplier").select(F.col("s_suppkey") + 2 * ORDER_OFFSET)
    reached = G.bfs_distances(_edges(spark, folder), 1, keep_unreached=True, vertices=alone)
    return reached.withColumns(as_long("distance"))


def bfs_target(spark, folder):
    """Rounds from part 1 to part 2 over orders, and how many edges lead there."""
    return G.bfs(_edges(spark, folder), 1, 2).withColumns(as_long("distance"))


QUERIES = {
    "item_similarity": item_similarity,
    "item_similarity_repeats": item_similarity_repeats,
    "item_similarity_blocked": item_similarity_blocked,
    "similar_items": similar_items,
    "nearest_items": nearest_items,
    "similarity_above_limit": similarity_above_limit,
    "similarity_stored": similarity_stored,
    "popular_items": popular_items,
    "degree": degree,
    "degree_raw": degree_raw,
    "most_connected": most_connected,
    "least_connected": least_connected,
    "adjacency_edges": adjacency_edges,
    "bfs_distances": bfs_distances,
    "bfs_all_vertices": bfs_all_vertices,
    "bfs_target": bfs_target,
}

_RATINGS = (
    "ratings AS (SELECT l_orderkey AS u, l_suppkey AS i, CAST(max(l_quantity) AS BIGINT) AS r "
    "FROM lineitem GROUP BY 1, 2)"
)
_SMALL_RATINGS = (
    "ratings AS (SELECT l_orderkey AS u, l_suppkey AS i, CAST(max(l_quantity) AS BIGINT) % 3 + 1 AS r "
    "FROM lineitem GROUP BY 1, 2)"
)
_LINES = "ratings AS (SELECT l_orderkey AS u, l_suppkey AS i, CAST(l_quantity AS BIGINT) AS r FROM lineitem)"
_COSINE = """
    SELECT a.i AS item1, b.i AS item2,
        round(CASE WHEN sqrt(sum(a.r * a.r)) * sqrt(sum(b.r * b.r)) <> 0
            THEN sum(a.r * b.r) / (sqrt(sum(a.r * a.r)) * sqrt(sum(b.r * b.r))) ELSE 0 END, 9) AS score,
        count(a.r * b.r) AS num_pairs
    FROM ratings AS a JOIN ratings AS b ON a.u = b.u AND a.i < b.i GROUP BY 1, 2"""
_DEGREE = "SELECT l_suppkey AS id, CAST(2 * count(*) AS BIGINT) AS connections FROM lineitem GROUP BY 1"
_NAMED = f"""WITH d AS ({_DEGREE})
    SELECT id, connections, coalesce(s_name, 'Unknown') AS name FROM d LEFT JOIN supplier ON id = s_suppkey"""
_EDGES = f"""edges AS (
    SELECT l_partkey AS src, l_orderkey + {ORDER_OFFSET} AS dst FROM lineitem
    UNION ALL SELECT l_orderkey + {ORDER_OFFSET}, l_partkey FROM lineitem)"""
# More rounds than any of the graphs needs.
_ROUNDS = 16


def _walk(depth: int) -> str:
    return f"""
    WITH RECURSIVE {_EDGES},
    walk(id, distance) AS (
        SELECT CAST(1 AS BIGINT), CAST(0 AS BIGINT)
        UNION SELECT e.dst, w.distance + 1 FROM walk AS w JOIN edges AS e ON e.src = w.id
        WHERE w.distance < {depth}),
    reached AS (SELECT id, min(distance) AS distance FROM walk GROUP BY id)"""


ORACLE = {
    "item_similarity": f"WITH {_RATINGS} {_COSINE}",
    "item_similarity_repeats": f"WITH {_LINES} {_COSINE} HAVING count(a.r * b.r) > 1",
    "item_similarity_blocked": f"WITH {_RATINGS} {_COSINE}",
    "similar_items": f"""WITH {_RATINGS}, sims AS ({_COSINE})
        SELECT item, score, num_pairs, coalesce(s_name, 'unknown') AS s_name FROM (
            SELECT CASE WHEN item1 = 1 THEN item2 ELSE item1 END AS item, score, num_pairs FROM sims
            WHERE (item1 = 1 OR item2 = 1) AND score > 0.5 AND num_pairs > 3) AS s
        LEFT JOIN supplier ON item = s_suppkey
        ORDER BY score DESC, num_pairs DESC, item LIMIT 10""",
    "nearest_items": f"""WITH {_SMALL_RATINGS}, sims AS ({_COSINE}),
        sides AS (SELECT item1 AS item, item2 AS neighbour, score, num_pairs FROM sims
            UNION ALL SELECT item2, item1, score, num_pairs FROM sims)
        SELECT * FROM (SELECT item, neighbour, row_number() OVER (
            PARTITION BY item ORDER BY score DESC, num_pairs DESC, neighbour) AS rank, score, num_pairs
            FROM sides WHERE score > 0.5 AND num_pairs > 3) AS t WHERE rank <= 3""",
    "similarity_above_limit": f"WITH {_SMALL_RATINGS} {_COSINE} HAVING count(a.r * b.r) > 3",
    "popular_items": f"""SELECT t.sold AS l_partkey, count, coalesce(p_name, 'Unknown') AS p_name
        FROM (SELECT {_SOLD} AS sold, count(*) AS count FROM lineitem GROUP BY 1
              ORDER BY count(*) DESC, sold LIMIT 10) AS t
        LEFT JOIN part ON t.sold = p_partkey""",
    "degree": _DEGREE,
    "degree_raw": "SELECT l_suppkey AS id, CAST(3 * count(*) AS BIGINT) AS connections FROM lineitem GROUP BY 1",
    "most_connected": f"{_NAMED} ORDER BY connections DESC, id LIMIT 1",
    "least_connected": f"{_NAMED} WHERE connections = (SELECT min(connections) FROM d)",
    "adjacency_edges": """SELECT l_suppkey AS src, l_orderkey AS dst FROM lineitem
        UNION ALL SELECT l_suppkey, l_partkey FROM lineitem""",
    "bfs_distances": f"{_walk(_ROUNDS)} SELECT id, distance FROM reached",
    "bfs_all_vertices": f"""{_walk(_ROUNDS)}
        SELECT id, distance FROM reached
        UNION ALL SELECT id, 9999 FROM (SELECT DISTINCT src AS id FROM edges
            WHERE src NOT IN (SELECT id FROM reached)) AS rest
        UNION ALL SELECT s_suppkey + {2 * ORDER_OFFSET}, 9999 FROM supplier""",
    "bfs_target": f"""{_walk(_ROUNDS)}
        SELECT t.distance, count(*) AS directions FROM reached AS t
        JOIN edges AS e ON e.dst = t.id JOIN reached AS r ON r.id = e.src AND r.distance = t.distance - 1
        WHERE t.id = 2 GROUP BY 1""",
}
ORACLE["similarity_stored"] = ORACLE["similar_items"]
