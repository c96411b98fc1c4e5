"""User geography: observations, centres, reply graph, propagation.

Propagation (G1) runs synchronous rounds: every round reads the state of the
previous round only (Q10), so the result does not depend on partition order.
The undirected pairs are written once (checkpoint). What anchors add to their
neighbours is the same in every round, so it is summed once, with the users;
rounds then read the edges between users without an anchor only. Those are
hash-partitioned and sorted by ``dst``, the state by user, in persisted copies
whose layout the planner knows, so a round shuffles partial sums, never edges or
state. A lost block is made anew from the checkpoint and the rounds before.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.geo import bbox_center, centre_aggs, centre_from_vector, geo_point
from tidewatch.operators.common import checked_broadcast, checkpointed

FINAL_CONFIDENCE = 0.5
DEFAULT_ITERATIONS = 5
MEDIAN_ACCURACY = 10_000


# ------------------------------------------------------------- observations

def condense_locations(obs: DataFrame) -> DataFrame:
    """A5: per user, unique points (by coordinates) and places (by id) with
    occurrence counts (true counts, Q8).

    ``obs``: (user_id, kind 'geo'|'place', key, lat, lon); for points the key
    is the coordinate pair, for places the place id and lat/lon its centre.
    """
    return obs.groupBy("user_id", "kind", "key").agg(
        F.count(F.lit(1)).alias("occurrences"), F.first("lat").alias("lat"), F.first("lon").alias("lon")
    )


def point_observations(points: DataFrame) -> DataFrame:
    """(user_id, lat, lon) → A5 input rows of kind 'geo' keyed by coordinates."""
    return points.select(
        "user_id", F.lit("geo").alias("kind"),
        F.concat_ws(",", F.col("lat").cast("string"), F.col("lon").cast("string")).alias("key"),
        "lat", "lon",
    )


def user_centroid(condensed: DataFrame, weighted: bool = False) -> DataFrame:
    """A6 (and X4 with ``weighted``): centre of a user's distinct locations,
    confidence 1 → (user_id, location struct<lat,lon,confidence>)."""
    if weighted:
        rows = condensed.withColumn("_w", F.col("occurrences").cast("double"))
    else:
        rows = condensed.withColumn("_w", F.lit(1.0))
    la, lo = F.radians("lat"), F.radians("lon")
    agg = rows.groupBy("user_id").agg(
        F.sum(F.col("_w") * F.cos(la) * F.cos(lo)).alias("_cx"),
        F.sum(F.col("_w") * F.cos(la) * F.sin(lo)).alias("_cy"),
        F.sum(F.col("_w") * F.sin(la)).alias("_cz"),
    )
    c = centre_from_vector("_cx", "_cy", "_cz")
    return agg.select(
        "user_id",
        F.when(c.isNotNull(), F.struct(c["lat"].alias("lat"), c["lon"].alias("lon"), F.lit(1.0).alias("confidence")))
        .alias("location"),
    )


def robust_centroid(condensed: DataFrame, max_ratio: float = 2.0) -> DataFrame:
    """Weighted centre after rejecting outliers.

    1. weighted centre of the user's distinct points (weights = occurrences);
    2. great-circle distance of every point to it;
    3. drop points farther than ``max_ratio`` × the user's (lower) median
       distance, from a quantile sketch of bounded size per user: exact up to
       MEDIAN_ACCURACY distinct points, else off by at most 1 / MEDIAN_ACCURACY
       of their number in rank;
    4. weighted centre of the remaining points (confidence 1).
    """
    first = user_centroid(condensed, weighted=True).select("user_id", "location.lat", "location.lon")
    c = condensed.join(first.withColumnRenamed("lat", "_clat").withColumnRenamed("lon", "_clon"), "user_id")
    la1, lo1, la2, lo2 = (F.radians(F.col(x)) for x in ("lat", "lon", "_clat", "_clon"))
    dist = 2 * F.asin(F.sqrt(
        F.pow(F.sin((la2 - la1) / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2)))
    c = c.withColumn("_d", F.round(dist, 9))
    med = c.groupBy("user_id").agg(F.percentile_approx("_d", 0.5, MEDIAN_ACCURACY).alias("_med"))
    kept = c.join(med, "user_id").filter(F.col("_d") <= F.col("_med") * max_ratio)
    return user_centroid(kept.select("user_id", "kind", "key", "occurrences", "lat", "lon"), weighted=True)


# ---------------------------------------------------------------- the graph

def distinct_pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct (a, b) with one shuffle into all shuffle partitions: a task holds the pairs of one
    partition only. Left to the planner, every map task keeps the pairs of its whole split, and few
    large partitions are merged from the many (pairs of numbered users compress well)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select(a, b).repartition(n, a, b).distinct()


def reply_edges(tweets: DataFrame, src: str = "user_id", dst: str = "in_reply_to") -> DataFrame:
    """Distinct directed edges author → replied-to user (Q15)."""
    return distinct_pairs(tweets.filter(F.col(dst).isNotNull()).select(
        F.col(src).cast("string").alias("src"), F.col(dst).cast("string").alias("dst")
    ), "src", "dst")


def adjacency(edges: DataFrame) -> DataFrame:
    """Per-user adjacency summary of the distinct directed edges.

    The neighbour lists themselves stay in long form (the edge table, which
    the propagation joins); a hub user would otherwise become one unbounded
    array in one row. Reported per user: out/in degree and the first/last
    neighbour id in each direction. Each edge is seen from both ends and one
    conditional aggregate (partial/final) does the rest: one shuffle.
    """
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("src").alias("user_id"), F.lit(True).alias("out"), F.col("dst").alias("other")),
        F.struct(F.col("dst").alias("user_id"), F.lit(False).alias("out"), F.col("src").alias("other")),
    )))
    to = F.when(F.col("out"), F.col("other"))
    by = F.when(~F.col("out"), F.col("other"))
    return ends.groupBy("user_id").agg(
        F.count_if("out").cast("long").alias("n_to"),
        F.count_if(~F.col("out")).cast("long").alias("n_by"),
        F.min(to).alias("first_to"), F.max(to).alias("last_to"),
        F.min(by).alias("first_by"), F.max(by).alias("last_by"),
    )


def adjacency_rows(edges: DataFrame) -> DataFrame:
    """A7 in long form: (user_id, direction 'to' | 'by', neighbour), every edge
    once from each end. A hub's neighbours are rows, never one array. Repeated
    edges go before they are seen from both ends, which gives distinct rows."""
    return edges.select("src", "dst").distinct().select(F.inline(F.array(
        F.struct(F.col("src").alias("user_id"), F.lit("to").alias("direction"), F.col("dst").alias("neighbour")),
        F.struct(F.col("dst").alias("user_id"), F.lit("by").alias("direction"), F.col("src").alias("neighbour")),
    )))


def tweet_observations(rows: DataFrame, geo_order: str = "latlon") -> DataFrame:
    """A5 input rows of tweet rows (user_id, geo, place): points keyed by their
    coordinates, places by their id with the centre of their bounding box. A
    place without an id or a polygon gives none."""
    user = F.col("user_id").cast("string").alias("user_id")
    points = rows.select(user, geo_point("geo", geo_order).alias("p")).filter(F.col("p").isNotNull())
    places = rows.select(
        user, F.get_json_object("place", "$.id").alias("key"), bbox_center("place").alias("p")
    ).filter(F.col("p").isNotNull() & F.col("key").isNotNull())
    return point_observations(points.select("user_id", "p.lat", "p.lon")).unionByName(
        places.select("user_id", F.lit("place").alias("kind"), "key", "p.lat", "p.lon"))


def user_state(rows: DataFrame, geo_order: str = "latlon") -> DataFrame:
    """A8 as a batch: one row per user seen as an author or as the target of a
    reply (a new user without locations): number of distinct points and places,
    users replied to and replying, and the centre of points and places (A6).
    The lists behind the numbers are ``condense_locations`` and ``adjacency_rows``."""
    condensed = condense_locations(tweet_observations(rows, geo_order))
    counts = condensed.groupBy("user_id").agg(
        F.count_if(F.col("kind") == "geo").alias("n_points"), F.count_if(F.col("kind") == "place").alias("n_places"))
    edges = reply_edges(rows)
    ends = adjacency_rows(edges).groupBy("user_id").agg(
        F.count_if(F.col("direction") == "to").alias("n_to"), F.count_if(F.col("direction") == "by").alias("n_by"))
    users = rows.select(F.col("user_id").cast("string").alias("user_id")).unionByName(
        rows.select(F.col("in_reply_to").cast("string").alias("user_id"))).filter("user_id is not null").distinct()
    out = users.join(counts, "user_id", "left").join(ends, "user_id", "left").join(user_centroid(condensed), "user_id", "left")
    return out.select("user_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_points", "n_places", "n_to", "n_by")],
                      "location")


def edge_pairs(edges: DataFrame) -> DataFrame:
    """Distinct (a, b) with a <= b of edges in either direction, self loops kept; edges without both ends dropped."""
    whole = edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    return distinct_pairs(whole.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")), "a", "b")


def both_ways(pairs: DataFrame) -> DataFrame:
    """Every pair of two users as (src, dst) from both ends."""
    return pairs.filter("a != b").select(F.inline(F.array(
        F.struct(F.col("a").alias("src"), F.col("b").alias("dst")), F.struct(F.col("b").alias("src"), F.col("a").alias("dst")))))


def undirected(edges: DataFrame) -> DataFrame:
    """Union of both directions, distinct; self loops dropped."""
    return both_ways(edge_pairs(edges))


def all_users(pairs: DataFrame, anchors: DataFrame, anchor_pts: DataFrame) -> DataFrame:
    """Every user of the pairs (self loops included) or the anchor table, with the sums of the unit
    vectors of the anchors next to them (``_ax``, ``_ay``, ``_az``) and their number (``_an``)."""
    pts = anchor_pts.select(F.col("user_id").alias("dst"), "lat", "lon", F.lit(1).alias("_hit"))
    near = both_ways(pairs).join(checked_broadcast(pts), "dst", "left").select(F.col("src").alias("user_id"), "lat", "lon", "_hit")
    alone = pairs.filter("a = b").select(F.col("a").alias("user_id")).unionByName(anchors.select("user_id"))
    seen = near.unionByName(alone, allowMissingColumns=True)
    return seen.groupBy("user_id").agg(*centre_aggs("lat", "lon", "_a"), F.count("_hit").alias("_an"))


def laid_out(und: DataFrame, partitions: int) -> DataFrame:
    """Undirected edges partitioned and sorted by ``dst``, persisted: joins on
    ``dst`` with ``partitions`` shuffle partitions need no exchange of them."""
    return und.repartition(partitions, "dst").sortWithinPartitions("dst").persist(StorageLevel.MEMORY_AND_DISK)


# Neighbours with at least this share of all edges are "hot": joined by
# broadcast instead of by hash partition. At most 1/share keys can qualify,
# which bounds the broadcast table.
HOT_SHARE = 0.001


def split_hot(und: DataFrame, share: float = HOT_SHARE, min_degree: int = 1000) -> tuple[DataFrame, DataFrame | None]:
    """(cold edges, hot keys): hot keys are ``dst`` values whose degree is at
    least ``share`` of all edges (and ``min_degree``); at most 1/share keys."""
    from tidewatch.operators.common import cut_lineage

    total = und.count()  # ``und`` is persisted here, which the rounds need anyway
    bound = max(total * share, min_degree)
    deg = und.groupBy("dst").agg(F.count(F.lit(1)).alias("deg"))
    hot = cut_lineage(deg.filter(F.col("deg") >= F.lit(bound)).select("dst"))
    if hot.isEmpty():
        return und, None
    return und.join(F.broadcast(hot), "dst", "left_anti"), hot


def neighbour_sums(und: DataFrame, located: DataFrame, hot: DataFrame | None = None,
                   und_hot: DataFrame | None = None) -> DataFrame:
    """J6 + A9: per user with located neighbours, the sums of their unit vectors
    (``_cx``, ``_cy``, ``_cz``).

    ``located``: (user_id, lat, lon) of neighbours allowed to contribute.
    With a hot-key split, ``und`` holds the cold edges (hash join on ``dst``)
    and ``und_hot`` the edges into hot neighbours, joined with a broadcast of
    the hot neighbours' rows (at most 1/HOT_SHARE of them).
    """
    loc = located.withColumnRenamed("user_id", "dst")
    contrib = und.join(loc, "dst")
    if hot is not None and und_hot is not None:
        hot_loc = loc.join(F.broadcast(hot), "dst", "left_semi")
        contrib = contrib.unionByName(und_hot.join(F.broadcast(hot_loc), "dst"))
    return contrib.groupBy(F.col("src").alias("user_id")).agg(*centre_aggs("lat", "lon"))


def neighbour_centroid(und: DataFrame, located: DataFrame, hot: DataFrame | None = None,
                       und_hot: DataFrame | None = None) -> DataFrame:
    """J6 + A9: per user, centre of the neighbours' points (see ``neighbour_sums``)."""
    c = centre_from_vector("_cx", "_cy", "_cz")
    return neighbour_sums(und, located, hot, und_hot).select("user_id", c.alias("c")).filter(F.col("c").isNotNull()).select(
        "user_id", F.col("c.lat").alias("lat"), F.col("c.lon").alias("lon")
    )


def _checkpoint(df: DataFrame, enabled: bool) -> DataFrame:
    return checkpointed(df) if enabled else df


def _kept(state: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """The state of a round, persisted and computed; the one before it is given up."""
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    state.count()
    if before is not None:
        before.unpersist()
    return state


def _added(a: str, c: str) -> Column:
    """Sum of two sums, either of which may be null."""
    return F.when(F.col(a).isNull(), F.col(c)).when(F.col(c).isNull(), F.col(a)).otherwise(F.col(a) + F.col(c))


def propagate_locations(
    edges: DataFrame,
    anchors: DataFrame,
    iterations: int = DEFAULT_ITERATIONS,
    checkpoint: bool = True,
    partitions: int | None = None,
    hot_share: float = HOT_SHARE,
    hot_min_degree: int = 1000,
    split_hot_keys: bool = True,
    placeholder_seed: int | None = None,
) -> dict[str, DataFrame]:
    """Infer home locations for users without one.

    ``edges``: directed (src, dst); ``anchors``: (user_id, location
    struct<lat,lon,confidence>) with confidence 1 for reported locations.
    Round 1 averages anchor neighbours only; rounds 2..n-1 average each
    neighbour's last inferred point, else its anchor location; rounds 1..n-1
    append to ``inferred`` (round 1 starts it afresh, an empty round 1 leaves
    it empty); round n writes the final location with confidence 0.5.
    Users with no located neighbour stay unchanged; placeholder locations
    (confidence 0) never contribute (Q11).

    G3: users left without a location get null; with ``placeholder_seed``
    they get a seeded random point with confidence 0 instead (opt-in; it is
    only reported, never used as a neighbour location).

    Returns ``users`` (user_id, location, inferred) and ``metrics``
    (iteration, processed, inferences) (A10).
    """
    spark = edges.sparkSession
    n_part = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = _checkpoint(edge_pairs(edges), checkpoint)
    anchor_pts = anchors.filter(F.col("location.confidence") >= 1).select(
        "user_id", F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon")
    )
    fixed = checked_broadcast(anchor_pts.select("user_id").distinct())
    # state: users without an anchor (user_id, sums over their anchors, point of each round or null)
    users = all_users(pairs, anchors, anchor_pts).join(fixed, "user_id", "left_anti")
    first = F.when(F.col("_an") > 0, centre_from_vector("_ax", "_ay", "_az"))
    sums = ["_ax", "_ay", "_az", "_an"]
    state = users.repartition(n_part, "user_id").sortWithinPartitions("user_id").select("user_id", *sums, first.alias("_p1"))
    points = ["_p1"]
    if iterations > 1:
        state = _kept(state)
        open_pairs = pairs
        for end in ("a", "b"):
            open_pairs = open_pairs.join(fixed.withColumnRenamed("user_id", end), end, "left_anti")
        # the hot/cold split is a broadcast (anti/semi) filter that keeps the layout
        und_all = laid_out(both_ways(open_pairs), n_part)
        und, hot = split_hot(und_all, hot_share, hot_min_degree) if split_hot_keys else (und_all, None)
        und_hot = _checkpoint(und_all.join(F.broadcast(hot), "dst", "left_semi"), checkpoint) if hot is not None else None
    for it in range(2, iterations + 1):
        last = state.select("user_id", F.coalesce(*reversed(points)).alias("_l")).filter(F.col("_l").isNotNull())
        located = last.select("user_id", F.col("_l.lat").alias("lat"), F.col("_l.lon").alias("lon"))
        # one row a user, dealt like the state: a hash table of a partition saves its sort in every round
        near = neighbour_sums(und, located, hot, und_hot).withColumn("_cn", F.lit(1)).hint("shuffle_hash")
        found = (F.col("_an") > 0) | F.col("_cn").isNotNull()
        totals = state.join(near, "user_id", "left").select(
            "user_id", *sums, *points, found.alias("_found"), *[_added(f"_a{x}", f"_c{x}").alias(f"_{x}") for x in "xyz"])
        nxt = totals.select("user_id", *sums, *points, F.when(F.col("_found"), centre_from_vector("_x", "_y", "_z")).alias(f"_p{it}"))
        points.append(f"_p{it}")
        if it < iterations:
            nxt = _kept(nxt, state)
        state, before = nxt, state
    final = _checkpoint(state.select("user_id", *points), checkpoint)
    if checkpoint and iterations > 1:  # the result is written
        before.unpersist()
        und_all.unpersist()
    anchor_loc = anchors.select("user_id", F.col("location").alias("aloc"))
    no_points = F.array().cast("array<struct<lat:double,lon:double>>")
    end = F.col(points[-1])
    guessed = final.join(anchor_loc, "user_id", "left").select(
        "user_id",
        F.when(end.isNotNull(), F.struct(end["lat"].alias("lat"), end["lon"].alias("lon"), F.lit(FINAL_CONFIDENCE).alias("confidence")))
        .alias("location"),
        (F.array_compact(F.array(*points[:-1])) if points[1:] else no_points).alias("inferred"),
    )
    reported = anchor_pts.select("user_id").join(anchor_loc, "user_id").select(
        "user_id", F.col("aloc").alias("location"), no_points.alias("inferred"))
    users_out = guessed.unionByName(reported)
    if placeholder_seed is not None:
        users_out = users_out.withColumn("location", F.coalesce("location", F.struct(
            (F.rand(placeholder_seed) * 180 - 90).alias("lat"),
            (F.rand(placeholder_seed + 1) * 360 - 180).alias("lon"),
            F.lit(0.0).alias("confidence"),
        )))
    # a user is an inference of the first round that found a point; the last round counts none
    firsts = [F.coalesce(*points[:t]).isNull() & F.col(points[t]).isNotNull() if t else F.col(points[0]).isNotNull() for t in range(iterations - 1)]
    flags = [f"_f{t}" for t in range(1, iterations)]
    processed = final.select(*[c.alias(f) for c, f in zip(firsts, flags, strict=True)], F.lit(True).alias("_user")).unionByName(
        anchor_pts.filter("user_id is not null").select(*[F.lit(False).alias(f) for f in flags], F.lit(True).alias("_user")))
    counts = processed.agg(F.count("_user").alias("processed"), *[F.count_if(f).alias(f) for f in flags])
    m = counts.select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("iteration"), F.col("processed"), (F.col(f"_f{t}") if t < iterations else F.lit(0).cast("long")).alias("inferences"))
        for t in range(1, iterations + 1)])))
    return {"users": users_out, "metrics": m}


def merge_users(old: DataFrame, new: DataFrame, key: str = "user_id") -> DataFrame:
    """Insert-or-merge; columns present in ``new`` overwrite, absent
    (null) values keep the old ones. Full outer join on the key."""
    cols = [c for c in new.columns if c != key]
    o = old.select(key, *[F.col(c).alias(f"_old_{c}") for c in cols if c in old.columns])
    n = new.select(key, *[F.col(c).alias(f"_new_{c}") for c in cols])
    j = o.join(n, key, "full")
    return j.select(
        key,
        *[
            (F.coalesce(F.col(f"_new_{c}"), F.col(f"_old_{c}")) if c in old.columns else F.col(f"_new_{c}")).alias(c)
            for c in cols
        ],
    )
