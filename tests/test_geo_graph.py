import math
import random


from tidewatch.functions import geo as gf
from tidewatch.operators import graph as gr


def centre(spark, pts):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pts], "lat double, lon double")
    r = df.agg(*gf.centre_aggs("lat", "lon")).select(gf.centre_from_vector("_cx", "_cy", "_cz").alias("c")).first().c
    return None if r is None else (r.lat, r.lon)


def test_centre_dateline_antipodes_single(spark):
    assert centre(spark, [(0, 179), (0, -179)]) == (0.0, 180.0)
    assert centre(spark, [(0, 0), (0, 180)]) is None
    assert centre(spark, [(12.5, -3.25)]) == (12.5, -3.25)


def test_geo_point_cases(spark):
    rows = [("",), ("{}",), ("bad",), ('{"type":"Point","coordinates":[10,20]}',),
            ('{"type":"Polygon","coordinates":[10,20]}',), ('{"type":"Point","coordinates":[1]}',)]
    df = spark.createDataFrame(rows, "g string")
    got = df.select(gf.geo_point("g", "latlon").alias("a"), gf.geo_point("g", "lonlat").alias("b")).collect()
    assert [r.a for r in got[:3]] == [None, None, None]
    assert (got[3].a.lat, got[3].a.lon, got[3].b.lat, got[3].b.lon) == (10.0, 20.0, 20.0, 10.0)
    assert got[4].a is None and got[5].a is None


def test_bbox_center(spark):
    poly = '{"id":"x","bounding_box":{"type":"Polygon","coordinates":[[[-1,-1],[1,-1],[1,1],[-1,1]]]}}'
    other = '{"id":"y","bounding_box":{"type":"Point","coordinates":[[[0,0]]]}}'
    df = spark.createDataFrame([(poly,), (other,)], "p string")
    r = df.select(gf.bbox_center("p").alias("c")).collect()
    assert (r[0].c.lat, r[0].c.lon) == (0.0, 0.0) and r[1].c is None


def _anchors(spark, rows):
    return spark.createDataFrame(
        [(u, (float(a), float(b), 1.0)) for u, a, b in rows],
        "user_id string, location struct<lat:double,lon:double,confidence:double>")


def _run(spark, edges, anchors, it=5):
    e = spark.createDataFrame(edges, "src string, dst string")
    res = gr.propagate_locations(e, _anchors(spark, anchors), it, checkpoint=True)
    users = {r.user_id: (None if r.location is None else (r.location.lat, r.location.lon, r.location.confidence),
                         len(r.inferred)) for r in res["users"].collect()}
    return users, sorted(tuple(r) for r in res["metrics"].collect())


def test_chain_isolated_duplicates_self(spark):
    edges = [("b", "a"), ("b", "a"), ("c", "b"), ("c", "c"), ("d", "d")]
    users, metrics = _run(spark, edges, [("a", 10, 20)])
    assert users["a"] == ((10.0, 20.0, 1.0), 0)
    assert users["b"] == ((10.0, 20.0, 0.5), 4)   # inferred in rounds 1-4, final in round 5
    assert users["c"] == ((10.0, 20.0, 0.5), 3)   # reached in round 2
    assert users["d"] == (None, 0)                 # isolated (self loop only)
    assert metrics[0] == (1, 4, 1) and metrics[1] == (2, 4, 1) and metrics[2][2] == 0


def test_propagation_invariant_to_edge_order(spark):
    rnd = random.Random(3)
    nodes = [f"u{i}" for i in range(30)]
    edges = list({(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(60)})
    anchors = [("u0", 5, 5), ("u1", -5, 40), ("u2", 30, -60)]
    a, _ = _run(spark, edges, anchors)
    rnd.shuffle(edges)
    b, _ = _run(spark, [(d, s) for s, d in edges], anchors)  # direction does not matter either
    assert a == b


def test_merge_users_keeps_absent(spark):
    old = spark.createDataFrame([("1", 1.0, "x"), ("2", 2.0, "y")], "user_id string, a double, b string")
    new = spark.createDataFrame([("2", None, "z"), ("3", 3.0, None)], "user_id string, a double, b string")
    got = sorted(tuple(r) for r in gr.merge_users(old, new).collect())
    assert got == [("1", 1.0, "x"), ("2", 2.0, "z"), ("3", 3.0, None)]


def test_hot_neighbour_split_equals_plain_join(spark):
    rnd = random.Random(5)
    edges = [(f"u{i}", "hub") for i in range(40)] + [("hub", "a0")]
    edges += [(f"u{rnd.randrange(40)}", f"u{rnd.randrange(40)}") for _ in range(30)]
    e = spark.createDataFrame(edges, "src string, dst string")
    anchors = _anchors(spark, [("a0", 10, 20), ("u1", -5, 40)])
    def run(split):
        r = gr.propagate_locations(e, anchors, 5, hot_share=0.2, hot_min_degree=5, split_hot_keys=split)
        return sorted((u.user_id, None if u.location is None else (u.location.lat, u.location.lon), len(u.inferred))
                      for u in r["users"].collect())
    assert run(True) == run(False)


def test_robust_centroid_drops_far_point(spark):
    pts = [("u", 0.0, 0.0), ("u", 0.0, 1.0), ("u", 1.0, 0.0), ("u", 1.0, 1.0), ("u", 50.0, 50.0)]
    obs = spark.createDataFrame(pts, "user_id string, lat double, lon double")
    c = gr.condense_locations(gr.point_observations(obs))
    plain = gr.user_centroid(c, weighted=True).first().location
    robust = gr.robust_centroid(c, 2.0).first().location
    assert plain.lat > 5 and abs(robust.lat - 0.5) < 0.01 and abs(robust.lon - 0.5) < 0.01


def test_placeholder_locations_are_opt_in_and_inert(spark):
    e = spark.createDataFrame([("b", "a"), ("x", "y")], "src string, dst string")
    anchors = _anchors(spark, [("a", 10, 20)])
    res = gr.propagate_locations(e, anchors, 5, placeholder_seed=7)
    users = {r.user_id: r.location for r in res["users"].collect()}
    assert (users["a"].confidence, users["b"].confidence) == (1.0, 0.5)
    assert users["x"].confidence == 0.0 and users["y"].confidence == 0.0
    assert -90 <= users["x"].lat <= 90 and -180 <= users["x"].lon <= 180
    assert (users["b"].lat, users["b"].lon) == (10.0, 20.0)   # placeholders never contribute


def test_rounds_do_not_shuffle_the_edges(spark):
    from tidewatch.operators.graph import laid_out, neighbour_centroid, undirected

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = spark.range(2000).selectExpr("cast(id % 97 as string) src", "cast(id % 31 + 200 as string) dst")
        und = laid_out(undirected(edges), n)
        und.count()
        located = spark.range(150).selectExpr("cast(id as string) user_id", "cast(id as double) lat", "cast(id as double) lon")
        round_ = neighbour_centroid(und, located)
        round_.collect()
        plan = round_._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("SortMergeJoin"):]
        edge_side = join[: join.index("InMemoryTableScan")]
        assert "Exchange" not in edge_side and "Sort [" not in edge_side
        und.unpersist()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_distinct_edges_stay_in_all_partitions_and_are_shuffled_once(spark):
    rows = [(f"u{i % 50}", f"v{i % 7}") for i in range(400)] + [(None, "v1"), (None, "v1"), ("u1", None)]
    tweets = spark.createDataFrame(rows, "src string, dst string")
    edges = gr.reply_edges(tweets, "src", "dst")
    assert edges.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = gr.adjacency_rows(edges)
    assert both._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    want = {(s, "to", d) for s, d in rows if d} | {(d, "by", s) for s, d in rows if d}
    got = [tuple(r) for r in both.collect()]
    assert set(got) == want and len(got) == len(want)
    again = gr.adjacency_rows(tweets.filter("dst is not null")).collect()  # repeated edges are reported once
    assert len(again) == len(want)


def plain_propagation(edges, anchors, rounds):
    """Rounds over plain lists: (user, location or None, number of inferred points) of users without an anchor, new users per round."""
    near = {}
    for s, d in edges:
        for a, b in ((s, d), (d, s)):
            near.setdefault(a, set()).update({b} - {a})
    at, n, new, end = {}, {}, [], {}
    for it in range(1, rounds + 1):
        known, nxt = dict(at), {}
        for u in set(near) - {a for a, *_ in anchors}:
            pts = [(la, lo) for v in near[u] for w, la, lo in anchors if w == v] + [known[v] for v in near[u] if v in known]
            if pts:
                v = [sum(f(math.radians(la), math.radians(lo)) for la, lo in pts) for f in (
                    lambda a, o: math.cos(a) * math.cos(o), lambda a, o: math.cos(a) * math.sin(o), lambda a, o: math.sin(a))]
                nxt[u] = math.degrees(math.atan2(v[2], math.hypot(v[0], v[1]))), math.degrees(math.atan2(v[1], v[0]))
        if it == rounds:
            end = nxt
        else:
            new.append(len(set(nxt) - set(n)))
            at |= nxt
            n |= {u: n.get(u, 0) + 1 for u in nxt}
    return {u: (end.get(u), n.get(u, 0)) for u in set(near) - {a for a, *_ in anchors}}, new


def test_rounds_read_the_edges_between_users_without_an_anchor_only(spark, monkeypatch):
    rnd = random.Random(11)
    anchors = [(f"a{i}", rnd.uniform(-50, 50), rnd.uniform(-90, 90)) for i in range(4)] + [("a0", 40, 10)]  # one comes twice
    edges = [(f"u{rnd.randrange(25)}", f"u{rnd.randrange(25)}") for _ in range(30)]
    edges += [(f"u{rnd.randrange(25)}", f"a{i % 4}") for i in range(8)] + [("a1", "a2"), ("u1", "u1"), (None, "u2"), ("a3", "w")]
    laid, plain = [], gr.laid_out
    monkeypatch.setattr(gr, "laid_out", lambda und, n: laid.extend(und.collect()) or plain(und, n))
    e = spark.createDataFrame(edges, "src string, dst string")
    res = gr.propagate_locations(e, _anchors(spark, anchors), 4)
    assert laid and not [r for r in laid if r.src.startswith("a") or r.dst.startswith("a")]
    want, new = plain_propagation([x for x in edges if x[0]], anchors, 4)
    rows = res["users"].collect()
    got = {r.user_id: (None if r.location is None else (r.location.lat, r.location.lon), len(r.inferred)) for r in rows}
    assert {u for u in got if u[0] != "a"} == set(want)
    for u, (at, n) in want.items():
        assert got[u][1] == n and (at is None) == (got[u][0] is None)
        assert at is None or max(abs(x - y) for x, y in zip(at, got[u][0], strict=True)) < 1e-4
    assert sum(r.user_id == "a0" for r in rows) == 4 and sum(r.user_id == "a1" for r in rows) == 1  # as a join on a repeated key gives
    processed = len(want) + len(anchors)
    assert [tuple(r) for r in res["metrics"].collect()] == [(t + 1, processed, k) for t, k in enumerate([*new, 0])]
