"""The state of all users kept current from the tweet stream.

Every tweet row gives observations of users: seen, a point, a place, an edge to
the user replied to and one back from there. An observation belongs to a cell
(user, kind, shard): the shard is a hash of the item, so the neighbours of a hub
or the points of a busy user spread over ``shards`` keys. The state is kept by
Spark's own operators: every distinct item (``dropDuplicates``) and a cell's
totals, which are its numbers of distinct items and of observations and the sum
of the unit vectors of its items; a micro-batch reads and writes only the items
and cells it brings. Where the number of each single item is wanted in the state
too, ``item_numbers`` keeps cells as maps in Python (``transformWithState``),
which costs several calls a cell. Changed cells are merged into a versioned table under the batch's
number, so a batch that is run again is merged once, and ``current_user_state``
adds up the cells of a user to the row that the batch ``user_state`` gives. A row
without an author gives nothing (on raw lines it is a dead letter).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.geo import bbox_center, centre_from_vector, geo_point, unit_vector
from tidewatch.sources import merge_table
from tidewatch.streaming.dead_letters import state_store
from tidewatch.streaming.pipelines import foreach_batch_available_now

SHARDS = 8
CELL_KEYS = ["user_id", "kind", "shard"]
CELL = "user_id string, kind string, shard int, n long, occurrences long, cx double, cy double, cz double"


def observations(rows: DataFrame, shards: int = SHARDS, geo_order: str = "latlon") -> DataFrame:
    """(user_id, kind, shard, item, lat, lon) of tweet rows, on a batch or a stream: kinds ``seen``,
    ``geo`` (item: the coordinates), ``place`` (its id), ``to`` and ``by`` (the other user)."""
    user, target = F.col("user_id").cast("string"), F.col("in_reply_to").cast("string")
    none = F.lit(None).cast("double")

    def of(who, kind, item, lat=none, lon=none):
        return F.struct(who.alias("user_id"), F.lit(kind).alias("kind"), item.alias("item"), lat.alias("lat"), lon.alias("lon"))

    p, place, place_id = F.col("_p"), F.col("_b"), F.get_json_object("place", "$.id")
    point = F.concat_ws(",", p["lat"].cast("string"), p["lon"].cast("string"))
    found = F.array(
        of(user, "seen", F.lit("")),
        F.when(p.isNotNull(), of(user, "geo", point, p["lat"], p["lon"])),
        F.when(place.isNotNull() & place_id.isNotNull(), of(user, "place", place_id, place["lat"], place["lon"])),
        F.when(target.isNotNull(), of(user, "to", target)),
        F.when(target.isNotNull(), of(target, "by", user)),
        F.when(target.isNotNull(), of(target, "seen", F.lit(""))),
    )
    located = rows.filter(F.col("user_id").isNotNull()).withColumn("_p", geo_point("geo", geo_order)).withColumn("_b", bbox_center("place"))
    items = located.select(F.inline(F.filter(found, lambda x: x.isNotNull())))
    return items.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)).cast("int"))


def running_cells(items: DataFrame) -> DataFrame:
    """Cells of observations: on a stream in update mode, the running totals of those that a micro-batch changes.

    An observation counts 1 for its cell; the first one of an item counts for the item and its place as well."""
    zero = F.lit(0.0)
    place = [F.coalesce(v, zero).alias(c) for c, v in zip(("cx", "cy", "cz"), unit_vector("lat", "lon"), strict=True)]
    first = items.dropDuplicates(["user_id", "kind", "item"]).select(
        *CELL_KEYS, F.lit(1).alias("n"), F.lit(0).alias("occurrences"), *place)
    every = items.select(*CELL_KEYS, F.lit(0).alias("n"), F.lit(1).alias("occurrences"), *[zero.alias(c) for c in ("cx", "cy", "cz")])
    return every.unionByName(first).groupBy(*CELL_KEYS).agg(*[F.sum(c).alias(c) for c in ("n", "occurrences", "cx", "cy", "cz")])


def cell_processor():
    """State of a cell with the number of each item: distinct items with their numbers, and the totals that are given out.

    Rows come one by one: most cells of a micro-batch hold a few, for which a pandas table costs
    far more than the work. The one item of a ``seen`` cell is counted in its totals."""
    from math import cos, radians, sin

    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    class Cells(StatefulProcessor):
        def init(self, handle) -> None:
            self.items = handle.getMapState("items", "item string", "occurrences long")
            self.total = handle.getValueState("total", "n long, occurrences long, cx double, cy double, cz double")

        def handleInputRows(self, key, rows, timer_values) -> Iterator[Row]:  # noqa: N802
            own: dict = {}
            for r in rows:
                times, lat, lon = own.get(r["item"], (0, None, None))
                own[r["item"]] = times + 1, r["lat"] if lat is None else lat, r["lon"] if lon is None else lon
            n, occurrences, x, y, z = self.total.get() or (0, 0, 0.0, 0.0, 0.0)
            seen = key[1] == "seen"
            for item in sorted(own):
                times, lat, lon = own[item]
                held = occurrences if seen else (self.items.getValue((item,)) or (0,))[0]
                if not seen:
                    self.items.updateValue((item,), (held + times,))
                occurrences += times
                if held == 0:
                    n += 1
                    if lat is not None:
                        la, lo = radians(lat), radians(lon)
                        x, y, z = x + cos(la) * cos(lo), y + cos(la) * sin(lo), z + sin(la)
            total = (n, occurrences, x, y, z)
            self.total.update(total)
            yield Row(**dict(zip(("user_id", "kind", "shard", "n", "occurrences", "cx", "cy", "cz"), (*key, *total), strict=True)))

        def close(self) -> None:
            pass

    return Cells()


def run_user_state(spark: SparkSession, rows: DataFrame, table_path: str, checkpoint: str, shards: int = SHARDS,
                   geo_order: str = "latlon", state_partitions: int | None = None, buckets: int = merge_table.BUCKETS,
                   item_numbers: bool = False) -> None:
    """Drain the stream of tweet rows into the table of cells at ``table_path``. A checkpoint stays with
    the ``item_numbers`` it began with; the table is the same."""
    def write(batch: DataFrame, batch_id: int) -> None:
        merge_table.merge(spark, table_path, batch, CELL_KEYS, fill=False, token=batch_id, buckets=buckets)

    with state_store(spark, state_partitions):
        items = observations(rows, shards, geo_order)
        cells = items.groupBy(*CELL_KEYS).transformWithState(
            statefulProcessor=cell_processor(), outputStructType=CELL, outputMode="Update", timeMode="None",
        ) if item_numbers else running_cells(items)
        foreach_batch_available_now(cells, write, checkpoint, mode="update")


def current_user_state(spark: SparkSession, table_path: str) -> DataFrame:
    """One row per user: n_points, n_places, n_to, n_by and the centre of points and places, as ``graph.user_state``."""
    cells = merge_table.read_table(spark, table_path)
    if cells is None:
        cells = spark.createDataFrame([], CELL)

    def n(kind):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))

    located = F.col("kind").isin("geo", "place")
    vector = [F.sum(F.when(located, F.col(c))).alias(f"_{c}") for c in ("cx", "cy", "cz")]
    users = cells.groupBy("user_id").agg(
        n("geo").alias("n_points"), n("place").alias("n_places"), n("to").alias("n_to"), n("by").alias("n_by"), *vector)
    c = centre_from_vector("_cx", "_cy", "_cz")
    centre = F.when((F.col("n_points") + F.col("n_places") > 0) & c.isNotNull(),
                    F.struct(c["lat"].alias("lat"), c["lon"].alias("lon"), F.lit(1.0).alias("confidence")))
    return users.select("user_id", "n_points", "n_places", "n_to", "n_by", centre.alias("location"))
