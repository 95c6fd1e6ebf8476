"""Vertex degree and breadth-first distance over edge tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.joins import lookup
from tablewright.operators.ordering import min_ties, top_k
from tablewright.operators.skew import GROUP_ROWS, hot_groups
from tablewright.runtime import cut_and_measure, cut_in_buckets, cut_lineage

# Distance given to vertices that were not reached.
UNREACHED = 9999

# A vertex with more edges than this is worked on by several tasks.
HUB_EDGES = 1_000_000

# Vertices of recent rounds that are compared before they are put into buckets.
RECENT_ROWS = 1_000_000


def _tokens(column: str, raw: bool):
    if raw:
        return F.split(F.col(column), " ")
    return F.split(F.trim(F.regexp_replace(column, r"\s+", " ")), " ")


def adjacency_edges(lines: DataFrame, column: str = "value", kind: str = "long") -> DataFrame:
    """Edges (src, dst) of lines ``id n1 n2 ...``; an id may own several lines."""
    tokens = lines.select(_tokens(column, False).alias("_t")).filter(F.get("_t", F.lit(0)) != "")
    edges = tokens.select(
        F.get("_t", F.lit(0)).try_cast(kind).alias("src"),
        F.explode(F.slice("_t", 2, F.greatest(F.size("_t") - 1, F.lit(0)))).alias("_dst"),
    )
    return edges.select("src", F.col("_dst").try_cast(kind).alias("dst"))


def degree(
    lines: DataFrame, column: str = "value", raw: bool = False, kind: str = "long"
) -> DataFrame:
    """Neighbours listed per vertex, over all its lines.

    ``raw=True`` splits on single spaces, so a trailing space counts as one more. Blank
    lines name no vertex and are left out unless ``raw``.
    """
    split = lines.select(_tokens(column, raw).alias("_t"))
    if not raw:
        split = split.filter(F.get("_t", F.lit(0)) != "")
    tokens = split.select(
        F.get("_t", F.lit(0)).try_cast(kind).alias("id"), (F.size("_t") - 1).alias("_n")
    )
    return tokens.groupBy("id").agg(F.sum("_n").alias("connections"))


def most_connected(degrees: DataFrame, names: DataFrame, default: str = "Unknown") -> DataFrame:
    """The vertex of highest degree with its name (lowest id on ties)."""
    return lookup(top_k(degrees, ["-connections", "id"], 1), names, "id", "name", default)


def least_connected(degrees: DataFrame, names: DataFrame, default: str = "Unknown") -> DataFrame:
    """All vertices tied at the lowest degree, with names."""
    return lookup(min_ties(degrees, "connections"), names, "id", "name", default)


class _Edges:
    """Edges in buckets of their source: a round reads them where they lie.

    Where a vertex owns more than ``hub_edges`` edges, the buckets are those of source and
    share: its edges are dealt out over several shares by their target, and the vertex goes
    to all of them.
    """

    def __init__(self, edges: DataFrame, src: str, dst: str, hub_edges: int, buckets: int):
        pairs = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
        pairs = pairs.filter("src IS NOT NULL AND dst IS NOT NULL")
        hubs = hot_groups(pairs, ["src"], hub_edges)
        self.hubs, self.keys = None, ["src"]
        if hubs is not None:
            shares = F.ceil(F.col(GROUP_ROWS) / F.lit(max(hub_edges, 1))).cast("long")
            self.hubs, self.keys = hubs.select(F.col("src").alias("id"), shares.alias("shares")), ["src", "share"]
            share = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("shares")), F.lit(0).cast("long"))
            pairs = pairs.join(self.hubs, F.col("src") == F.col("id"), "left").select("src", share.alias("share"), "dst")
        self.table = cut_in_buckets(pairs, buckets, *self.keys)

    def ways_from(self, frontier: DataFrame) -> DataFrame:
        """Vertices that edges from ``frontier`` (id) lead to, with the number of edges."""
        ahead = frontier.select(F.col("id").alias("src"))
        if self.hubs is not None:
            last = F.coalesce("shares", F.lit(1).cast("long")) - 1
            shares = F.explode(F.sequence(F.lit(0).cast("long"), last))
            ahead = frontier.join(self.hubs, "id", "left").select(F.col("id").alias("src"), shares.alias("share"))
        return self.table.join(ahead, self.keys).groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("ways"))

    def balanced(self) -> bool:
        """Whether every vertex is as often a source as a target, by four 32-bit sums of its hashes.

        So it is where each edge also goes back. Edges of which this is not true have other
        sums, but for a chance of 2^-128.
        """
        def parts(column: str) -> list[Column]:
            hashes = [F.xxhash64(column), F.xxhash64(column, F.lit(1))]
            return [part for one in hashes for part in (F.shiftright(one, 32), one.bitwiseAND(F.lit(0xFFFFFFFF)))]

        # A sum too large for 64 bits is null.
        sums = [F.try_sum(out - into) for out, into in zip(parts("src"), parts("dst"))]
        return all(total == 0 for total in self.table.agg(*sums).first())

    def vertices(self) -> DataFrame:
        """Different vertices: the sources where they lie, and the targets only where one may be no source."""
        sources = self.table.select(F.col("src").alias("id")).distinct()
        return sources if self.balanced() else sources.union(self.table.select("dst")).distinct()


class _Seen:
    """Vertices met so far: recent rounds as they were written, older ones in buckets of id.

    When the recent ones exceed ``recent_rows`` they are put into buckets, together with
    every older table up to twice as large, so a vertex is moved a logarithmic number of
    times and there are few tables. A round compares its hits with the tables in place.
    """

    def __init__(self, first: DataFrame, buckets: int, recent_rows: int):
        self.buckets, self.recent_rows = buckets, recent_rows
        self.recent, self.rows = [first], 1
        self.old: list[tuple[int, DataFrame]] = []

    def add(self, frontier: DataFrame, rows: int) -> None:
        self.recent.append(frontier)
        self.rows += rows
        if self.rows <= self.recent_rows:
            return
        tables, rows = self.recent, self.rows
        while self.old and self.old[-1][0] <= 2 * rows:
            size, table = self.old.pop()
            tables, rows = [table, *tables], rows + size
        self.old.append((rows, cut_in_buckets(reduce(DataFrame.unionByName, tables), self.buckets, "id")))
        self.recent, self.rows = [], 0

    def tables(self) -> list[DataFrame]:
        recent = [reduce(DataFrame.unionByName, self.recent)] if self.recent else []
        return [table for _, table in self.old] + recent

    def all(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.tables())

    def mark(self, hits: DataFrame) -> DataFrame:
        """``hits`` with ``fresh``: whether a vertex was not seen before."""
        fresh = F.lit(True)
        for number, table in enumerate(self.tables()):
            known = table.select("id", F.lit(True).alias(f"_known{number}"))
            hits = hits.join(known, "id", "left")
            fresh = fresh & F.col(f"_known{number}").isNull()
        return hits.select("id", "ways", fresh.alias("fresh"))


def _rounds(
    edges: _Edges, start: object, max_depth: int | None, buckets: int, recent_rows: int, target: object = None
) -> Iterator[tuple[int, int, _Seen]]:
    """Breadth-first rounds as (depth, ways into the target, vertices seen so far).

    A round sends its frontier to the edges' buckets and the hits, added up per vertex
    before they move, to those of the vertices seen; edges and old vertices stay where
    they are. The round is written down, and one row about it reaches the driver. By
    the size of those files Spark sends a small frontier to all tasks instead.
    """
    kind = edges.table.schema["src"].dataType
    frontier = edges.table.sparkSession.range(1).select(
        F.lit(start).cast(kind).alias("id"), F.lit(0).alias("distance")
    )
    seen = _Seen(frontier, buckets, recent_rows)
    for depth in count(1):
        if max_depth is not None and depth > max_depth:
            return
        reached, state = cut_and_measure(
            seen.mark(edges.ways_from(frontier)),
            found=F.count(F.when(F.col("fresh"), 1)),
            ways=F.sum(F.when(F.col("id") == F.lit(target), F.col("ways"))),
        )
        frontier = reached.filter("fresh").select("id", F.lit(depth).alias("distance"))
        if state["found"]:
            seen.add(frontier, state["found"])
        yield depth, state["ways"] or 0, seen
        if not state["found"]:
            return


def _buckets(df: DataFrame) -> int:
    """As many buckets as a shuffle has partitions, so that both fit together."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bfs_distances(
    edges: DataFrame,
    start: object,
    max_depth: int | None = None,
    src: str = "src",
    dst: str = "dst",
    keep_unreached: bool = False,
    vertices: DataFrame | None = None,
    hub_edges: int = HUB_EDGES,
    recent_rows: int = RECENT_ROWS,
) -> DataFrame:
    """Distance in directed edges from ``start``, until nothing new is reached.

    ``max_depth`` ends the search earlier. With ``keep_unreached`` the other vertices
    follow at distance 9999: those of the edges, and of the one-column table ``vertices``,
    which may list vertices without edges. Vertices with more than ``hub_edges`` edges are
    worked on by several tasks; ``recent_rows`` vertices are compared before they are put
    into buckets. Neither changes the result.
    """
    buckets = _buckets(edges)
    laid = _Edges(edges, src, dst, hub_edges, buckets)
    seen = None
    for _, _, seen in _rounds(laid, start, max_depth, buckets, recent_rows):
        pass
    reached = seen.all() if seen else None
    if not keep_unreached:
        return reached
    rest = laid.vertices()
    if vertices is not None:
        # What is given is left out of the edges' vertices, which then stay where they lie.
        given = vertices.select(F.col(vertices.columns[0]).cast(rest.schema["id"].dataType).alias("id"))
        given = cut_lineage(given.filter("id IS NOT NULL").distinct())
        rest = rest.join(given, "id", "left_anti").union(given)
    rest = rest.join(reached, "id", "left_anti").withColumn("distance", F.lit(UNREACHED))
    return reached.unionByName(rest)


def bfs(
    edges: DataFrame,
    start: object,
    target: object,
    max_depth: int | None = None,
    src: str = "src",
    dst: str = "dst",
    hub_edges: int = HUB_EDGES,
    recent_rows: int = RECENT_ROWS,
) -> DataFrame:
    """First round in which a frontier edge points at ``target``.

    One row ``(distance, directions)``, where directions counts those edges, or
    no row when the target is not met.
    """
    buckets = _buckets(edges)
    laid = _Edges(edges, src, dst, hub_edges, buckets)
    found = []
    for depth, ways, _ in _rounds(laid, start, max_depth, buckets, recent_rows, target):
        if ways:
            found.append((depth, ways))
            break
    return edges.sparkSession.createDataFrame(found, "distance int, directions long")
