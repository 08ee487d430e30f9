"""Spatial joins on a quadtree of cells, joins across the antimeridian, nearest neighbours by expanding rings.

A cell of level k is a square of side 2 ** k, so each cell lies in one cell of each level above and the tree needs no
root.  A box stands in the cells of the level that fits it (four at most), whatever its size, and in the cells above at those
levels only at which the other side has boxes, which one count of the levels tells.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import EARTH, boxes_touch, haversine
from .graph import cut

#: Level of the smallest cells, unless the caller names a side.
FINEST = -24
#: Boxes of the levels, widest first, whose cells are told to the other side: it climbs only into cells where they stand.
TOLD = 20_000
#: Rows of a cell beyond which the other side's rows of that cell are dealt out over several tasks.
CROWD = 100_000
#: Levels that a box may be put above its own, and pairs that may be looked at in vain for a row that need not climb.
RAISED, SPARE = 4, 8
#: Rows beyond which a table is not dealt out anew before its boxes are placed: it has tasks enough, and this would write it once more.
SPREAD = 4_000_000
#: Rows of one place that are handed on as one list, at most.
LISTED = 1_000

c = F.col


def level_of(side: Column, least: int = FINEST) -> Column:
    """The level whose cells are at least as wide as the side."""
    return F.greatest(F.ceil(F.log2(side)).cast("int"), F.lit(least))


def index(v: Column, level: Column) -> Column:
    """Which cell of a level holds a coordinate."""
    return F.floor(v / F.pow(F.lit(2.0), level)).cast("long")


def _fitted(df: DataFrame, least: int, grow: float) -> DataFrame:
    side = F.greatest(c("xmax") - c("xmin"), c("ymax") - c("ymin")) + 2 * grow
    return df.withColumn("__fit", level_of(side, least))


def _levels(df: DataFrame) -> tuple[dict[int, int], list]:
    """Rows at each level, as many numbers as there are levels, and the extent of them all."""
    rows = df.groupBy("__fit").agg(F.count("*"), F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).collect()
    rows = [r for r in rows if r[0] is not None]
    return {r[0]: r[1] for r in rows}, [f(r[i] for r in rows) for i, f in ((2, min), (3, min), (4, max), (5, max))] if rows else [0.0] * 4


def _raised(counts: dict[int, int], extent: list) -> dict[int, int]:
    """Which level the rows of each level are put at: the one above, where there are so few for its cells that pairs looked at in
    vain cost less than the rows that need not climb into another level."""
    area = (extent[2] - extent[0]) * (extent[3] - extent[1])
    to, top, held = {}, None, 0
    for k in sorted(counts, reverse=True):
        below = sum(n for j, n in counts.items() if j <= k)
        if top is not None and top - k <= RAISED and 4 * counts[k] * (held + counts[k]) * 4.0**top <= SPARE * below * area:
            held += counts[k]
        else:
            top, held = k, counts[k]
        to[k] = top
    return to


def _cells(df: DataFrame, grow: float) -> DataFrame:
    cells = lambda lo, hi: F.sequence(index(c(lo) - grow, c("__k")), index(c(hi) + grow, c("__k")))
    return df.withColumn("__cx", F.explode(cells("xmin", "xmax"))).withColumn("__cy", F.explode(cells("ymin", "ymax")))


def _told(df: DataFrame, levels: dict[int, int], grow: float, most: int = TOLD) -> tuple[list[int], DataFrame]:
    """The widest levels that hold at most ``most`` boxes in all, and the cells in which these stand."""
    few, n = [], 0
    for k in sorted(levels, reverse=True):
        n += levels[k]
        if n > most:
            break
        few.append(k)
    x = df.where(c("__fit").isin(few)).select("xmin", "ymin", "xmax", "ymax", c("__fit").alias("__k"))
    return few, _cells(x, grow).select("__k", "__cx", "__cy").distinct()


def _placed(df: DataFrame, own: list[int], others: list[int], above: int, grow: float, told: tuple[list[int], DataFrame], deal: bool = True) -> DataFrame:
    """One row for each cell in which a box stands: those of its own level for each tag of ``own``, and tagged ``above`` those of
    the levels of the other side over it, of ``told`` levels only cells that the other side has.  Of two boxes, that of the
    lower level climbs, so a pair has one tag."""
    at = lambda tag, k: F.struct(F.lit(tag).alias("tag"), k.cast("int").alias("k"))
    mine = F.array(*(at(tag, c("__fit")) for tag in own))
    climbs = F.transform(F.filter(F.array(*map(F.lit, others)).cast("array<int>"), lambda k: k > c("__fit")), lambda k: at(above, k))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a file of a few MB is one task, and many cells
    x = (df.repartition(parts) if deal else df).withColumn("__at", F.explode(F.concat(mine, climbs))).withColumns({"__tag": c("__at.tag"), "__k": c("__at.k"), "__own": c("__fit")})
    x = _cells(x, grow).drop("__at", "__fit")
    few, cells = told
    if not set(few) & set(others):
        return x.drop("__own")
    cells = cells.select(*(c(n).alias(f"{n}_") for n in ("__k", "__cx", "__cy")), F.lit(True).alias("__there"))
    x = x.join(F.broadcast(cells), [c("__k") == c("__k_"), c("__cx") == c("__cx_"), c("__cy") == c("__cy_")], "left")
    free = (c("__there")) | (c("__tag") != above) | ~c("__k").isin(few)
    free = free | (c("__k") == c("__own"))  # its own cells may have that tag as well
    return x.where(free).drop("__k_", "__cx_", "__cy_", "__there", "__own")


KEY = ["__tag", "__k", "__cx", "__cy"]


def _dealt(a: DataFrame, b: DataFrame, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a share: where the climbing side of a cell has more than ``crowd`` rows, these are dealt out over shares
    and the other side's rows of the cell go to each."""
    many = a.where("__tag = 1").select(*KEY).unionByName(b.where("__tag = 0").select(*KEY))
    shares = F.ceil(F.count("*") / crowd).cast("int")
    full = cut(many.groupBy(*KEY).agg(shares.alias("__shares")).where("__shares > 1"), "crowded")
    if not full.limit(1).count():
        return a.withColumn("__share", F.lit(0)), b.withColumn("__share", F.lit(0))

    def side(df: DataFrame, climbing: int) -> DataFrame:
        n = F.coalesce("__shares", F.lit(1))
        one = F.array(F.floor(F.rand(7) * n).cast("int"))
        every = F.sequence(F.lit(0), n - 1)
        return df.join(full, KEY, "left").withColumn("__share", F.explode(F.when(c("__tag") == climbing, one).otherwise(every))).drop("__shares")

    return side(a, 1), side(b, 0)


def cells_of_pairs(left: DataFrame, right: DataFrame, size: float = 0.0, grow: float = 0.0, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """Both sides placed in cells: any two boxes that meet share exactly one key at the lower corner of their common part."""
    least = math.floor(math.log2(size)) if size > 0 else FINEST
    alike = right is left and not grow
    a, b = _fitted(left, least, grow), _fitted(right, least, 0.0)
    na, ea = _levels(a)
    nb, eb = (na, ea) if alike else _levels(b)
    deal = [sum(n.values()) <= SPREAD for n in (na, nb)]
    extent = [f(p, q) for f, p, q in zip((min, min, max, max), ea, eb)] if na and nb else ea if na else eb
    to = _raised({k: na.get(k, 0) + nb.get(k, 0) for k in {*na, *nb}}, extent)
    if any(k != v for k, v in to.items()):
        place = F.create_map(*(F.lit(x) for kv in to.items() for x in kv))[c("__fit")]
        a, b = a.withColumn("__fit", place), b.withColumn("__fit", place)
        na, nb = ({v: sum(n[k] for k in n if to[k] == v) for v in {to[k] for k in n}} for n in (na, nb))
    told_a, told_b = _told(a, na, grow), _told(b, nb, 0.0)
    a = _placed(a, [0], [k for k in nb if any(j < k for j in na)], 1, grow, told_b, deal[0])
    if alike and len(na) == 1:
        b = a  # both sides are the same rows in the same cells, so Spark shuffles them once
    else:
        b = _placed(b, [0, 1] if na and min(na) < max(nb, default=FINEST) else [0], [k for k in na if any(j < k for j in nb)], 0, 0.0, told_a, deal[1])
    if max(sum(na.values()), sum(nb.values())) > crowd:
        return _dealt(a, b, crowd)
    return a.withColumn("__share", F.lit(0)), b.withColumn("__share", F.lit(0))


INNER = [*KEY, "__share"]


def grid_join(left: DataFrame, right: DataFrame, size: float = 0.0, exact: Column | None = None, grow: float = 0.0, how: str = "inner", crowd: int = CROWD) -> DataFrame:
    """Pairs (aliases a and b) whose boxes meet, left boxes grown by ``grow``, and for which ``exact`` holds.

    No cell is smaller than ``size``.  A box makes at most nine rows for each level of the other side (four, unless its
    side is within rounding of a cell's), so a world box among small ones costs no more than they do.  A pair that shares
    several cells is kept in the one that holds the lower corner of the common part, so no distinct is needed.  Crowded
    cells are dealt out.  Sides are always shuffled: what a table weighs says nothing of its cells.  The other modes (left, left_semi, left_anti) number the left rows, written once, so
    equal rows and null ids are rows of their own.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    if how != "inner":
        left = cut(left.withColumn("__row", F.monotonically_increasing_id()), "left")
    a, b = cells_of_pairs(left, right, size, grow, crowd)
    a, b = a.alias("a"), b.alias("b")
    on = reduce(lambda p, q: p & q, (c(f"a.{k}") == c(f"b.{k}") for k in INNER))
    near = (
        (c("a.xmin") - grow <= c("b.xmax")) & (c("a.xmax") + grow >= c("b.xmin")) & (c("a.ymin") - grow <= c("b.ymax")) & (c("a.ymax") + grow >= c("b.ymin"))
        if grow
        else boxes_touch("a", "b")
    )
    if exact is not None:
        near = near & exact
    if how in ("left_semi", "left_anti"):
        met = a.hint("merge").join(b.hint("merge"), on & near, "left_semi").select(c("a.__row").alias("__met")).distinct()
        return left.join(met, c("__row") == c("__met"), how).drop("__row")
    corner = lambda k: index(F.greatest(c(f"a.{k}min") - grow, c(f"b.{k}min")), c("a.__k"))
    pairs = a.hint("merge").join(b.hint("merge"), on & (c("a.__cx") == corner("x")) & (c("a.__cy") == corner("y")) & near)
    if how == "left":  # pairs stay where they are met; only the numbers of rows that met nothing move
        some = a.hint("merge").join(b.hint("merge"), on & near, "left_semi").select(c("a.__row").alias("__met")).distinct()
        alone = left.join(some, c("__row") == c("__met"), "left_anti")
        mine, theirs = [n for n in left.columns if n != "__row"], [(n, right.schema[n].dataType) for n in right.columns]
        both = lambda df, a_, b_: df.select(F.struct(*a_).alias("a"), F.struct(*b_).alias("b"))
        met = both(pairs, [c(f"a.{n}") for n in mine], [c(f"b.{n}") for n, _ in theirs])
        lone = both(alone, [c(n) for n in mine], [F.lit(None).cast(k).alias(n) for n, k in theirs])
        return met.unionByName(lone)
    return pairs


# ---- across the antimeridian


def wrapped(df: DataFrame, period: float = 360.0) -> DataFrame:
    """Boxes of longitudes as one or two boxes within (-180, 180): what sticks out on one side comes in on the other.
    Adds __piece (0: the box where it starts, 1: the rest) and the start and width it was cut from."""
    half = period / 2
    width = F.least(c("xmax") - c("xmin"), F.lit(period))
    start = c("xmin") - period * F.floor((c("xmin") + half) / period)
    x = df.withColumns({"__start": F.when(width >= period, F.lit(-half)).otherwise(start), "__width": width})
    end = c("__start") + c("__width")
    piece = lambda k, lo, hi: F.struct(F.lit(k).alias("piece"), lo.alias("lo"), hi.alias("hi"))
    first = piece(0, c("__start"), F.least(end, F.lit(half)))
    both = F.when(end >= half, F.array(first, piece(1, F.lit(-half), F.greatest(end - period, F.lit(-half))))).otherwise(F.array(first))
    x = x.withColumn("__of", F.explode(both))
    return x.withColumns({"__piece": c("__of.piece"), "xmin": c("__of.lo"), "xmax": c("__of.hi")}).drop("__of")


def wrapping_join(left: DataFrame, right: DataFrame, size: float = 0.0, exact: Column | None = None, period: float = 360.0, crowd: int = CROWD) -> DataFrame:
    """Pairs of boxes on a circle of longitudes, each once.  ``exact`` sees the boxes as they were cut.

    Two boxes can meet in several of their pieces: the starting pieces come first, and the others count only where those do
    not meet.  Both second pieces start at the antimeridian, where the first pieces meet already.
    """
    half = period / 2
    end = lambda t: F.least(c(f"{t}.__start") + c(f"{t}.__width"), F.lit(half))
    starts_meet = (c("a.__start") <= end("b")) & (end("a") >= c("b.__start"))
    # piece 1 of one with piece 0 of the other: both ways at once only if both reach round, and then the starts meet
    once = ((c("a.__piece") == 0) & (c("b.__piece") == 0)) | ((c("a.__piece") != c("b.__piece")) & ~starts_meet)
    a = wrapped(left, period)
    return grid_join(a, a if right is left else wrapped(right, period), size, once if exact is None else once & exact, crowd=crowd)


def _places(df: DataFrame, most: int) -> DataFrame:
    """One row for each place lon, lat with the other columns of its rows as the list __rows, written; a place of more than ``most``
    rows has several lists."""
    at = F.row_number().over(Window.partitionBy("lon", "lat").orderBy("lon"))
    x = df.where("lon is not null and lat is not null").select("lon", "lat", F.struct(*(n for n in df.columns if n not in ("lon", "lat"))).alias("__row"), F.floor((at - 1) / most).alias("__list"))
    return cut(x.groupBy("lon", "lat", "__list").agg(F.collect_list("__row").alias("__rows")).drop("__list"), "places")


def within_metres(left: DataFrame, right: DataFrame, reach: float, exact: Column | None = None, digits: int | None = None, most: int = LISTED) -> DataFrame:
    """Pairs (structs a and b of the columns but lon and lat, and metres, rounded to ``digits``) of points lon, lat that are at most ``reach`` metres
    apart on the sphere.

    The box around a left point is as wide as the circle is at its widest, and all round where the circle holds a pole;
    what leaves it over the antimeridian comes in on the other side.  Rows of one place are met as one, so that places are
    compared and measured once, however many rows they have; the pairs of their rows are only written out.
    """
    angle = min(reach / EARTH, math.pi) + 1e-9
    tall = math.degrees(angle)
    wide = F.degrees(F.asin(F.least(F.lit(1.0), F.lit(math.sin(min(angle, math.pi / 2))) / F.cos(F.radians("lat")))))
    wide = F.when(F.abs("lat") + tall >= 90, F.lit(180.0)).otherwise(wide)
    a = _places(left, most)
    b = a if right is left else _places(right, most)
    a = a.withColumns({"xmin": c("lon") - wide, "xmax": c("lon") + wide, "ymin": c("lat") - tall, "ymax": c("lat") + tall})
    b = b.withColumns({"xmin": c("lon"), "xmax": c("lon"), "ymin": c("lat"), "ymax": c("lat")})
    d = haversine(c("a.lon"), c("a.lat"), c("b.lon"), c("b.lat"))
    pairs = wrapping_join(a, b, exact=d <= reach).select(c("a.__rows").alias("__a"), c("b.__rows").alias("__b"), (d if digits is None else F.round(d, digits)).alias("metres"))
    pairs = pairs.select("__b", "metres", F.explode("__a").alias("a")).select("a", "metres", F.explode("__b").alias("b")).select("a", "b", "metres")
    return pairs if exact is None else pairs.where(exact)


# ---- nearest neighbours

#: Rows that a cell should hold where the search starts, at least.
FEW = 3
#: What rounding may take from a distance.
SLACK = 1e-8


def nearest(left: DataFrame, right: DataFrame, key: str, by: list[str] | None = None, exact: Column | None = None, digits: int = 9, few: int = FEW) -> DataFrame:
    """(key, nearest, distance) for each left row: the right row of equal ``by`` columns that is nearest in the plane, of those
    equal in ``digits`` decimals the one of least id; null where there is none, at whatever distance.

    ``left`` has ``key`` (unique), x, y; ``right`` has id, x, y.  Expanding rings: a row looks at its own cell.  If its best lies
    nearer than the cell's border, the row leaves; else it comes once more, with the cells that the circle of its best
    meets (nine at most, mostly two), or in a cell twice as wide where it has met nothing.  Cells as wide as the group are the
    last, and there the nine around hold all.  Rows start where a cell holds about ``few`` right rows: by the extent of the
    group, and by the count of the cell where that is more crowded.  So the pairs that are looked at and the rows that
    move grow with the rows, each round is written, and a round has an aggregate, not a window.
    ``exact`` restricts pairs of the aliases a and b.
    """
    by = by or []
    a, b = left.select(key, *by, "x", "y"), cut(right.select("id", *by, "x", "y").where("x is not null and y is not null"), "right")
    both = a.select(*by, "x", "y", F.lit(0).alias("n")).unionByName(b.select(*by, "x", "y", F.lit(1).alias("n")))
    extent = F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y"))
    groups = both.groupBy(*by).agg(F.sum("n").alias("n"), extent.alias("extent")).where("n > 0")
    start = F.ceil(F.log2(c("extent") * F.sqrt(few / c("n")))).cast("int")
    groups = cut(groups.select(*by, F.greatest(F.coalesce(start, F.lit(FINEST)), F.lit(FINEST)).alias("k"), F.coalesce(level_of(c("extent")), F.lit(FINEST)).alias("top")), "groups")
    same = lambda p, q: reduce(lambda s, t: s & t, (c(f"{p}.{k}") == c(f"{q}.{k}") for k in by), F.lit(True))
    placed = lambda d: d.alias("d").join(groups.alias("g"), same("d", "g")).select("d.*", "g.k", "g.top").withColumns({"cx": index(c("x"), c("k")), "cy": index(c("y"), c("k"))})
    full = placed(b).groupBy(*by, "cx", "cy").agg(F.count("*").alias("n")).where(c("n") > 4 * few)
    full = cut(full.withColumn("down", F.floor(F.log2(c("n") / few) / 2).cast("int")), "crowded")
    todo = placed(a.where("x is not null and y is not null")).alias("d")
    todo = todo.join(full.alias("f"), same("d", "f") & (c("d.cx") == c("f.cx")) & (c("d.cy") == c("f.cy")), "left")
    todo = cut(todo.select(*(f"d.{k}" for k in [key, *by, "x", "y", "top"]), F.greatest(c("d.k") - F.coalesce("f.down", F.lit(0)), F.lit(FINEST)).alias("k"), F.lit(None).cast("double").alias("reach")), "todo")
    done = []
    while levels := [r[0] for r in todo.select("k").distinct().collect()]:
        wide = F.when(c("k") >= c("top"), F.pow(F.lit(2.0), c("k"))).otherwise(F.coalesce("reach", F.lit(0.0)))
        around = lambda v: F.sequence(index(c(v) - wide, c("k")), index(c(v) + wide, c("k")))
        look = todo.withColumn("cx", F.explode(around("x"))).withColumn("cy", F.explode(around("y"))).alias("a")
        at = b.withColumn("k", F.explode(F.array(*map(F.lit, levels)))).withColumns({"cx": index(c("x"), c("k")), "cy": index(c("y"), c("k"))}).alias("b")
        dx, dy = c("b.x") - c("a.x"), c("b.y") - c("a.y")
        d = F.sqrt(dx * dx + dy * dy)
        on = same("a", "b") & reduce(lambda s, t: s & t, (c(f"a.{k}") == c(f"b.{k}") for k in ("k", "cx", "cy")))
        met = look.join(at, on if exact is None else on & exact).groupBy(c(f"a.{key}").alias("__key"))
        met = met.agg(F.min(F.struct(F.floor(d * 10.0**digits + 0.5).alias("r"), c("b.id").alias("id"), d.alias("d"))).alias("best"))
        x = todo.join(met, c(key) == c("__key"), "left").drop("__key")
        side = F.pow(F.lit(2.0), c("k"))
        into = lambda v: c(v) / side - F.floor(c(v) / side)
        sure = side * F.least(into("x"), 1 - into("x"), into("y"), 1 - into("y"))
        x = cut(x.withColumn("settled", (F.coalesce(c("best.d") + SLACK <= sure, F.lit(False))) | c("reach").isNotNull() | (c("k") >= c("top"))), "round")
        done.append(x.where("settled").select(key, c("best.id").alias("nearest"), c("best.d").alias("distance")))
        reach = c("best.d") + 2 * SLACK
        further = F.when(reach.isNull(), c("k") + 1).otherwise(F.greatest(c("k"), level_of(reach)))
        todo = x.where("not settled").select(key, *by, "x", "y", "top", F.least(further, F.greatest("top", c("k") + 1)).alias("k"), reach.alias("reach"))
    found = reduce(DataFrame.unionByName, done) if done else None
    every = left.select(key)
    if found is None:
        return every.select(key, F.lit(None).cast(right.schema["id"].dataType).alias("nearest"), F.lit(None).cast("double").alias("distance"))
    return every.alias("e").join(found.alias("f"), c(f"e.{key}") == c(f"f.{key}"), "left").select(f"e.{key}", "nearest", "distance")
