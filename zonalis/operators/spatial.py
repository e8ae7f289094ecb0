"""Range, distance and nearest joins on hierarchical grids.

A grid of level n has cells of SPAN / 2^n degrees.  Boxes are stored at the level of their own
extent, so that small boxes get small cells however many of them crowd in a degree, and a
large one few cells; points probe the levels in use.  Nearest joins read off a pyramid of
counts how far a search must reach.  No pair is formed outside a cell; hot cells are salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.functions import geo
from zonalis.operators.common import attach_row, salted_join
from zonalis.session import materialise

KM_PER_DEGREE = 111.19492664455873  # arc of one degree on a 6371 km sphere
CELL = ["_cx", "_cy"]
LEVELLED = ["_level", *CELL]
SPAN, DEEPEST = 512.0, 26


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size).cast("int")


def _point_cells(df: DataFrame, lon: str, lat: str, size: float) -> DataFrame:
    return df.withColumns({"_cx": _cell(F.col(lon), size), "_cy": _cell(F.col(lat), size)})


def _across(level: Column) -> Column:
    """Cells side by side on a level."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), level)


def _at_level(c: Column, level: Column) -> Column:
    """The cell of a coordinate in degrees; the same expression on every side of a join."""
    return F.floor((c + SPAN / 2) * _across(level) / SPAN)


def _stored(boxes: DataFrame, box: list[str]) -> DataFrame:
    """Boxes with `_own`, the finest level whose cells are no smaller than the box."""
    x0, x1, y0, y1 = (F.col(b) for b in box)
    extent = F.greatest(x1 - x0, y1 - y0)
    level = F.when(extent > 0, F.floor(F.log2(F.lit(SPAN) / extent))).otherwise(DEEPEST)
    valid = (x0 <= x1) & (y0 <= y1) & ~F.isnan(extent)
    return boxes.filter(F.coalesce(valid, F.lit(False))).withColumn("_own", F.greatest(F.lit(0), F.least(F.lit(DEEPEST), level)).cast("int"))


def _levels(stored: DataFrame) -> DataFrame:
    """One row: the levels in use, DEEPEST + 1 at most."""
    return stored.agg(F.collect_set("_own").alias("_used"))


def _box_cells(df: DataFrame, box: list[str]) -> DataFrame:
    """One row per cell of level `_level` that a box touches: four where it is no larger than a cell."""
    x0, x1, y0, y1 = (_at_level(F.col(b), F.col("_level")) for b in box)
    return df.withColumn("_cx", F.explode(F.sequence(x0, x1))).withColumn("_cy", F.explode(F.sequence(y0, y1)))


def points_in_boxes(points: DataFrame, boxes: DataFrame, *, point: tuple[str, str, str], box_id: str,
                    box: list[str], hot_rows: int | None = None) -> DataFrame:
    """(point id, box id) for every box that holds the point, borders included.  Rows with a
    null or undefined coordinate, and boxes whose ends are swapped, meet nothing."""
    pid, lon, lat = point
    b = _stored(boxes.select(box_id, *box), box)
    p = attach_row(points.select(pid, lon, lat).filter(F.col(lon).isNotNull() & F.col(lat).isNotNull()), _levels(b))
    p = p.withColumn("_level", F.explode("_used")).drop("_used")
    p = p.withColumns({"_cx": _at_level(F.col(lon), F.col("_level")), "_cy": _at_level(F.col(lat), F.col("_level"))})
    b = _box_cells(b.withColumnRenamed("_own", "_level"), box)
    j = salted_join(p, b, LEVELLED, [pid], hot_rows=hot_rows)
    inside = F.col(lon).between(F.col(box[0]), F.col(box[1])) & F.col(lat).between(F.col(box[2]), F.col(box[3]))
    return j.filter(inside).select(pid, box_id)


def _meeting(a: DataFrame, b: DataFrame, a_box: list[str], b_box: list[str], spread: str, hot_rows: int | None) -> DataFrame:
    """Rows of a and b whose boxes are not disjoint, each pair once.

    The larger box of a pair waits in its own cells, the smaller one visits the cells around
    it on that level.  A pair is reported only by the cell of its intersection's low corner, so no
    distinct is needed.
    """
    ax0, ax1, ay0, ay1 = (F.col(c) for c in a_box)
    bx0, bx1, by0, by1 = (F.col(c) for c in b_box)
    meet = (ax0 <= bx1) & (bx0 <= ax1) & (ay0 <= by1) & (by0 <= ay1)
    low_x, low_y = _at_level(F.greatest(ax0, bx0), F.col("_level")), _at_level(F.greatest(ay0, by0), F.col("_level"))
    first, second = _stored(a, a_box), _stored(b, b_box)

    def waiting(stored: DataFrame, box: list[str]) -> DataFrame:
        return _box_cells(stored.withColumnRenamed("_own", "_level"), box)

    def visiting(stored: DataFrame, box: list[str], hosts: DataFrame, strictly: bool) -> DataFrame:
        levels = F.filter("_used", lambda n: (n < F.col("_own")) if strictly else (n <= F.col("_own")))
        each = attach_row(stored, _levels(hosts)).withColumn("_level", F.explode(levels)).drop("_used", "_own")
        return _box_cells(each, box)

    out = None
    for left, right in ((waiting(first, a_box), visiting(second, b_box, first, False)), (visiting(first, a_box, second, True), waiting(second, b_box))):
        j = salted_join(left, right, LEVELLED, [spread], hot_rows=hot_rows)
        j = j.filter(meet & (F.col("_cx") == low_x) & (F.col("_cy") == low_y)).select(*a.columns, *b.columns)
        out = j if out is None else out.unionAll(j)
    return out


def boxes_meeting(a: DataFrame, b: DataFrame, *, a_id: str, b_id: str, a_box: list[str], b_box: list[str],
                  hot_rows: int | None = None) -> DataFrame:
    """(a id, a box, b id, b box) of boxes that are not disjoint, each pair once; no two of the
    columns share a name.  Boxes with a null or undefined end, or swapped ends, meet nothing."""
    return _meeting(a.select(a_id, *a_box), b.select(b_id, *b_box), a_box, b_box, a_id, hot_rows)


def adjacency_problems(boxes: DataFrame, box: list[str], tolerance: float, hot_rows: int | None = None) -> DataFrame:
    """Overlaps and slivers between distinct boxes: one row per unordered pair of
    boxes, with how many areas share each box."""
    d = boxes.groupBy(*box).agg(F.count(F.lit(1)).alias("copies"))
    d = d.withColumn("_id", F.struct(*box))
    grown = d.select("_id", "copies", *[(F.col(c) + s * tolerance).alias(f"{c}_g") for c, s in zip(box, (-1, 1, -1, 1))], *box)
    other = grown.select(*[F.col(c).alias(f"o_{c}") for c in grown.columns])
    g = [f"{c}_g" for c in box]
    j = _meeting(grown, other, g, [f"o_{c}" for c in g], "_id", hot_rows).filter(F.col("_id") < F.col("o__id"))
    ax0, ax1, ay0, ay1 = (F.col(c) for c in box)
    bx0, bx1, by0, by1 = (F.col(f"o_{c}") for c in box)
    gx = F.greatest(ax0 - bx1, bx0 - ax1, F.lit(0.0))
    gy = F.greatest(ay0 - by1, by0 - ay1, F.lit(0.0))
    gap = F.sqrt(gx * gx + gy * gy)
    overlap = (F.greatest(F.least(ax1, bx1) - F.greatest(ax0, bx0), F.lit(0.0))
               * F.greatest(F.least(ay1, by1) - F.greatest(ay0, by0), F.lit(0.0)))
    kind = F.when(overlap > 0, "overlap").when((gap > 0) & (gap < tolerance), "gap")
    return j.select(
        *box, *[f"o_{c}" for c in box], "copies", F.col("o_copies").alias("other_copies"),
        kind.alias("problem"), overlap.alias("overlap_area"), gap.alias("gap")).filter("problem IS NOT NULL")


def _locations(df: DataFrame, lon: str, lat: str) -> DataFrame:
    return df.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull()).groupBy(
        F.col(lon).alias("lon"), F.col(lat).alias("lat")).agg(F.count(F.lit(1)).alias("copies"))


def _cubes(lon: Column, lat: Column, km: float) -> dict[str, Column]:
    """The cube of a little over km that holds a point of the globe."""
    x, y, size = F.radians(lon), F.radians(lat), km * (1 + 1e-9)
    on = lambda c: F.floor(c * (geo.EARTH_KM / size)).cast("long")
    return {"_cx": on(F.cos(y) * F.cos(x)), "_cy": on(F.cos(y) * F.sin(x)), "_cz": on(F.sin(y))}


def close_locations(df: DataFrame, lon: str, lat: str, km: float = 0.1, hot_rows: int | None = None) -> DataFrame:
    """Locations with another one nearer than km: how many, the nearest distance,
    and how many areas share the location.  Rows are per location, not per pair."""
    loc = _locations(df, lon, lat)
    # Cells are cubes around the globe, so neither the meridian of 180 degrees nor a pole is a
    # border; a chord is shorter than its arc, so what is near lies in a neighbouring cube.
    cube = ["_cx", "_cy", "_cz"]
    here = loc.withColumns(_cubes(F.col("lon"), F.col("lat"), km))
    steps = [F.lit(i) for i in (-1, 0, 1)]
    around = F.explode(F.array(*[F.struct(i.alias("dx"), j.alias("dy"), k.alias("dz")) for i in steps for j in steps for k in steps]))
    there = loc.select(F.col("lon").alias("lon2"), F.col("lat").alias("lat2")).withColumns(_cubes(F.col("lon2"), F.col("lat2"), km))
    there = there.withColumn("_d", around).withColumns({c: F.col(c) + F.col("_d")[f"d{c[-1]}"] for c in cube}).drop("_d")
    j = salted_join(here, there, cube, ["lon", "lat"], hot_rows=hot_rows)
    d = geo.haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    near = j.filter((F.col("lon") != F.col("lon2")) | (F.col("lat") != F.col("lat2"))).withColumn("_km", d).filter(F.col("_km") < km)
    return near.groupBy("lon", "lat", "copies").agg(F.count(F.lit(1)).alias("close"), F.min("_km").alias("nearest_km"))


def far_locations(df: DataFrame, lon: str, lat: str, km: float = 4000.0, sizes: tuple[float, ...] = (2.0, 0.25)) -> DataFrame:
    """Locations with another one farther than km.

    Whole cells are judged by the bounds of their distance, first coarse ones, then
    the finer cells inside pairs that straddle the limit; only what still straddles
    it is measured point by point.  Cell lists are bounded by the grid, not the data.
    """
    def x(c, size):
        return (c + 0.5) * size

    def reach(size):
        return F.lit(size / 2 * 2 ** 0.5 * KM_PER_DEGREE)

    loc = _locations(df, lon, lat)
    size = sizes[0]
    cells = _point_cells(loc, "lon", "lat", size).select(*CELL).distinct()
    listed = cells.agg(F.collect_list(F.struct(*CELL)).alias("_cells"))
    own = attach_row(cells, listed)

    def coarse_gap(c):
        return geo.haversine_km(x(F.col("_cy"), size), x(F.col("_cx"), size), x(c["_cy"], size), x(c["_cx"], size))

    own = own.select(
        F.struct(*CELL).alias("a"), F.exists("_cells", lambda c: coarse_gap(c) - 2 * reach(size) > km).alias("sure"),
        F.filter("_cells", lambda c: coarse_gap(c) + 2 * reach(size) > km).alias("maybe"))
    pairs = materialise(own.select("a", "sure", F.explode_outer("maybe").alias("b")), "far")

    def placed(d, size):
        p = _point_cells(d, "lon", "lat", size)
        return p.withColumn("cell", F.struct(*CELL)).drop(*CELL)

    done, todo = None, loc
    for n, size in enumerate(sizes):
        here = placed(todo, size)
        sure_cells = pairs.filter("sure").select(F.col("a").alias("cell")).distinct()
        found = here.join(sure_cells, "cell", "left_semi").select("lon", "lat", "copies")
        done = found if done is None else done.unionByName(found)
        open_pairs = pairs.filter("NOT sure AND b IS NOT NULL").select("a", "b")
        todo = here.join(open_pairs.select(F.col("a").alias("cell")).distinct(), "cell", "left_semi").select("lon", "lat", "copies")
        if n + 1 == len(sizes):
            break
        fine = sizes[n + 1]

        def nested(d, parent, child):
            outer = placed(d, size).withColumnRenamed("cell", parent)
            return placed(outer, fine).withColumnRenamed("cell", child).select(parent, child).distinct()

        j = nested(todo, "a", "fa").join(open_pairs, "a").join(nested(loc, "b", "fb"), "b")
        gap = geo.haversine_km(x(F.col("fa._cy"), fine), x(F.col("fa._cx"), fine), x(F.col("fb._cy"), fine), x(F.col("fb._cx"), fine))
        j = j.select("fa", "fb", gap.alias("gap")).filter(F.col("gap") + 2 * reach(fine) > km)
        j = materialise(j, "far")
        best = j.groupBy("fa").agg((F.max("gap") - 2 * reach(fine) > km).alias("sure"))
        pairs = materialise(j.join(best, "fa").select(F.col("fa").alias("a"), "sure", F.col("fb").alias("b")).filter(
            ~F.col("sure")).unionByName(best.filter("sure").select(F.col("fa").alias("a"), "sure", F.lit(None).cast(j.schema["fb"].dataType).alias("b"))), "far")
    asked = placed(todo, size).join(open_pairs, F.col("cell") == F.col("a")).select("lon", "lat", "copies", F.col("b").alias("cell"))
    others = placed(loc, size).select(F.col("lon").alias("lon2"), F.col("lat").alias("lat2"), "cell")
    d = geo.haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    measured = salted_join(asked, others, ["cell"], ["lon", "lat"]).filter(d > km)
    return done.unionByName(measured.groupBy("lon", "lat", "copies").agg(F.count(F.lit(1)).alias("_n")).drop("_n"))


PYRAMID = 18  # finest level of the pyramid, cells of 360 / 2^18 degrees
MOST_COLUMNS = 16  # cells side by side that one search may ask


def _globe(lon: Column, lat: Column, level: Column) -> dict[str, Column]:
    """The cell of a place on a grid whose columns close around the globe."""
    n = _across(level)
    return {"_cx": F.pmod(F.floor((lon + 180) * n / 360), n), "_cy": F.floor((lat + 90) * n / 360)}


def _search_window(lon: Column, lat: Column, level: Column) -> dict[str, Column]:
    """Of a search that reaches 1.5 cells: first cell and number of columns and rows."""
    n = _across(level)
    size = F.lit(360.0) / n
    reach = size * 1.5 + 1e-9  # degrees of arc; a place is this near to any other of its cell
    over_pole = F.abs(lat) + reach >= 89.9
    wide = F.when(over_pole, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.sin(F.radians(F.least(reach, F.lit(90.0)))) / F.cos(F.radians(lat)), F.lit(1.0))))) + 1e-9
    first = F.floor((lon + 180 - wide) * n / 360)
    columns = F.least(n, F.floor((lon + 180 + wide) * n / 360) - first + 1)
    low = F.greatest(F.lit(0), F.floor((lat + 90 - reach) * n / 360))
    high = F.least(n - 1, F.floor((lat + 90 + reach) * n / 360))
    return {"_n": n, "_first": first, "_columns": columns, "_low": low, "_high": high}


def nearest_services(areas: DataFrame, services: DataFrame, *, area: tuple[str, str, str], service: tuple[str, str, str], k: int = 3,
                     hot_rows: int | None = None) -> DataFrame:
    """(area id, rank from 1, service_id, distance_km): each area's k nearest services on the
    sphere (all, if there are fewer), ties by service id.

    A pyramid counts the services per cell on every level.  An area looks up the finest
    level on which its own cell holds k of them: so many lie within the diagonal of that
    cell, and one join with the cells that a circle of this size touches finds the k nearest.  Columns close
    around the globe; near a pole, levels whose circle would touch many columns are passed
    over.  Places of the same id are asked each; those without a coordinate are left out.
    """
    aid, alon, alat = area
    sid, slon, slat = service
    asked = areas.select(aid, F.col(alon).cast("double").alias("_lon"), F.col(alat).cast("double").alias("_lat")).dropna(subset=["_lon", "_lat"]).distinct()
    by_point = Window.partitionBy("_slon", "_slat").orderBy("service_id")
    there = services.select(F.col(sid).alias("service_id"), F.col(slon).cast("double").alias("_slon"), F.col(slat).cast("double").alias("_slat")).dropna()
    there = there.distinct().withColumn("_r", F.row_number().over(by_point)).filter(F.col("_r") <= k).drop("_r")
    every = F.explode(F.sequence(F.lit(0), F.lit(PYRAMID)))
    pyramid = there.withColumn("_level", every).withColumns(_globe(F.col("_slon"), F.col("_slat"), F.col("_level")))
    full = pyramid.groupBy(*LEVELLED).agg(F.count(F.lit(1)).alias("_held")).filter(F.col("_held") >= k).drop("_held")
    tried = asked.withColumn("_level", every).withColumns(_globe(F.col("_lon"), F.col("_lat"), F.col("_level")))
    window = _search_window(F.col("_lon"), F.col("_lat"), F.col("_level"))
    tried = tried.filter(window["_columns"] <= MOST_COLUMNS)
    chosen = tried.join(full.withColumn("_full", F.lit(True)), LEVELLED, "left").groupBy(aid, "_lon", "_lat").agg(
        F.coalesce(F.max(F.when(F.col("_full"), F.col("_level"))), F.lit(0)).alias("_level"))
    chosen = materialise(chosen, "levels")  # both sides of the search read it
    ask = chosen.withColumns(_search_window(F.col("_lon"), F.col("_lat"), F.col("_level")))
    ask = ask.withColumn("_cx", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_columns") - 1))).withColumn("_cx", F.pmod("_cx", "_n"))
    ask = ask.withColumn("_cy", F.explode(F.sequence("_low", "_high"))).select(aid, "_lon", "_lat", *LEVELLED)
    used = chosen.agg(F.collect_set("_level").alias("_used"))
    held = attach_row(there, used).withColumn("_level", F.explode("_used")).drop("_used").withColumns(_globe(F.col("_slon"), F.col("_slat"), F.col("_level")))
    met = salted_join(ask, held, LEVELLED, [aid], hot_rows=hot_rows)
    met = met.withColumn("distance_km", geo.haversine_km(F.col("_lat"), F.col("_lon"), F.col("_slat"), F.col("_slon")))
    rank = F.row_number().over(Window.partitionBy(aid, "_lon", "_lat").orderBy("distance_km", "service_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select(aid, "rank", "service_id", "distance_km")


def nearest_station(areas: DataFrame, stations: DataFrame, *, area: tuple[str, str, str], station: tuple[str, str, str],
                    hot_rows: int | None = None) -> DataFrame:
    """Each area's nearest station and distance in km; ties by station id."""
    found = nearest_services(areas, stations, area=area, service=station, k=1, hot_rows=hot_rows)
    return found.select(area[0], F.col("service_id").alias("station_id"), "distance_km")


def hot_spots(areas: DataFrame, *, area_id: str, lon: str, lat: str, value: str, cell: float = 1.0, limit: float = 1.96) -> DataFrame:
    """(area id, neighbours, z, spot): the Getis-Ord statistic of every area with a place and a value.

    Neighbours are the areas of its own and the eight cells around, itself included, on a grid
    that closes around the globe (cell divides 360 into three or more).  z is how far their sum lies
    from what the overall mean and deviation lead to expect; a spot is `hot` from limit and `cold` from -limit.
    Cells send count and sum to their neighbours, so no pairs are formed.  z is null where
    all values are equal or all areas are neighbours.
    """
    n = round(360 / cell)
    if n < 3 or abs(n * cell - 360) > 1e-9:
        raise ValueError("cell must divide 360 degrees into three or more")
    known = areas.select(area_id, lon, lat, F.col(value).cast("double").alias("_v")).dropna(subset=[lon, lat, "_v"])
    placed = known.withColumns({"_cx": F.pmod(F.floor((F.col(lon) + 180) / cell), F.lit(n)), "_cy": F.floor((F.col(lat) + 90) / cell)})
    sums = placed.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_c"), F.sum("_v").alias("_s"))
    steps = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    halo = sums.withColumn("_d", F.explode(steps)).select(
        F.pmod(F.col("_cx") + F.col("_d.dx"), F.lit(n)).alias("_cx"), (F.col("_cy") + F.col("_d.dy")).alias("_cy"), "_c", "_s")
    halo = halo.groupBy(*CELL).agg(F.sum("_c").alias("neighbours"), F.sum("_s").alias("_sum"))
    whole = known.agg(F.count(F.lit(1)).alias("_n"), F.avg("_v").alias("_mean"), F.stddev_pop("_v").alias("_dev"))
    at = attach_row(placed.join(halo, CELL).drop("_v"), whole)
    m, all_ = F.col("neighbours"), F.col("_n")
    spread = F.col("_dev") * F.sqrt((all_ * m - m * m) / F.greatest(all_ - 1, F.lit(1)))
    z = F.when(spread > 0, (F.col("_sum") - F.col("_mean") * m) / spread)
    spot = F.when(z >= limit, "hot").when(z <= -limit, "cold").otherwise("none")
    return at.select(area_id, "neighbours", z.alias("z"), spot.alias("spot"))


def area_relations(areas: DataFrame, services: DataFrame, *, area_id: str, box: list[str], population: str,
                   service: tuple[str, str, str]) -> DataFrame:
    """Per area: number of other areas its box meets, services inside, and people
    per service inside (catchment)."""
    other = areas.select(F.col(area_id).alias("_o"), *[F.col(c).alias(f"o_{c}") for c in box])
    pairs = boxes_meeting(areas, other, a_id=area_id, b_id="_o", a_box=box, b_box=[f"o_{c}" for c in box])
    touching = pairs.filter(F.col(area_id) != F.col("_o")).groupBy(area_id).agg(F.count(F.lit(1)).alias("adjacent_areas"))
    inside = points_in_boxes(services, areas, point=service, box_id=area_id, box=box)
    held = inside.groupBy(area_id).agg(F.count(F.lit(1)).alias("services_inside"))
    out = areas.select(area_id, population).join(touching, area_id, "left").join(held, area_id, "left").na.fill(
        0, ["adjacent_areas", "services_inside"])
    return out.withColumn("catchment", F.when(F.col("services_inside") > 0, F.col(population) / F.col("services_inside")))
