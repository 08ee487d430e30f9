"""Output layers: each a function of a catalog of feature tables, returning a DataFrame.

Feature tables have ``osm_id``, string columns in which a missing value is '' (or null), ``tags`` (map) and ``geometry``
(WKB, degrees).  A layer that reads another one asks the catalog for it.  Spatial predicates run as grid joins on boxes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import jts
from ..functions import tags as tg
from ..functions import text as tx
from ..functions.zoom import bucket
from ..operators import relational as rel
from ..operators import spatial
from ..operators.dissolve import in_cells, union_tree
from ..operators.graph import connected_components, cut

LAYERS: dict[str, Callable] = {}
c = F.col


class Catalog:
    """Tables by name, from a reader; layers by name, each built once."""

    def __init__(self, spark: SparkSession, reader: Callable[[str], DataFrame] | str, runway_surfaces: DataFrame | None = None):
        """``runway_surfaces``: the deployment's table of surface codes (spelling, code, is_pattern); without it, ordered rules."""
        jts.register(spark)
        self.spark, self._made, self.runway_surfaces = spark, {}, runway_surfaces
        self._read = (lambda name: spark.read.parquet(f"{reader}/{name}.parquet")) if isinstance(reader, str) else reader

    def __call__(self, name: str) -> DataFrame:
        return self._read(name)

    def layer(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = LAYERS[name](self)
        return self._made[name]


def layer(f):
    LAYERS[f.__name__] = f
    return f


# ---- pieces that many layers share

def blank(*names: str, trim: bool = False) -> list[Column]:
    """The columns with '' as null, under their own names."""
    return [tx.blank_to_null(c(n), trim).alias(n) for n in names]


def tag(key: str, name: str | None = None) -> Column:
    return tx.blank_to_null(c("tags")[key]).alias(name or key.replace(":", "_"))


def name(trim: bool = False) -> Column:
    return tx.name_of(c("name_en"), c("name"), trim=trim).alias("name")


def area() -> Column:
    """Mercator area, narrowed to float as thresholds expect."""
    return jts.area_mercator("geometry").cast("float").alias("area")


def length() -> Column:
    return jts.length_mercator("geometry").cast("float")


def inside() -> Column:
    return jts.point_on_surface("geometry").alias("geometry")


def fixed(g: Column | str = "geometry") -> Column:
    """Simplified by a millionth of a degree and valid."""
    return jts.make_valid(jts.simplify(g, 0.000001))


def dumped(df: DataFrame, g: Column | str = "geometry") -> DataFrame:
    return df.withColumn("geometry", F.explode(jts.dump(g)))


def union(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def true_or_null(n: str) -> Column:
    return F.when(c(n), True).alias(n)


def tagged_true(key: str, n: str) -> Column:
    """True for a tag that is set to anything but no; else null."""
    return F.when(~F.coalesce(tag(key), F.lit("no")).isin("no", "false", "0"), True).alias(n)


def keyed(df: DataFrame) -> DataFrame:
    """Adds a hash of the row; maps count by their sorted entries."""
    kind = dict(df.dtypes)
    return df.withColumn("__k", F.xxhash64(*(F.array_sort(F.map_entries(x)) if kind[x].startswith("map") else c(x) for x in df.columns)))


def met(left: DataFrame, right: DataFrame, flag: str, exact: Column | None = None, grow: float = 0.0, size: float = 1.0) -> DataFrame:
    """Left rows and whether any right row meets them."""
    left = keyed(left)
    boxed = jts.with_box(left.select("__k", "geometry"))
    hit = spatial.grid_join(boxed, jts.with_box(right.select("geometry")), size, exact if exact is not None else jts.intersects("a.geometry", "b.geometry"), grow, "left_semi").select("__k").distinct()
    return left.join(hit.withColumn(flag, F.lit(True)), "__k", "left").withColumn(flag, F.coalesce(c(flag), F.lit(False))).drop("__k")


# ---- roads and rails

# Kinds of road drawn, spellings mended, surfaces by what they hold.
ROADS = "bridleway bus_guideway corridor cycleway footway living_street motorway motorway_link path pedestrian primary primary_link raceway residential road secondary secondary_link service steps tertiary tertiary_link track trunk trunk_link unclassified".split()
ROAD_SPELLINGS = {"motoway": "motorway", "minor": "tertiary", "livingstreet": "living_street"}
NUMBERED = [f"{k}{s}" for k in ("motorway", "trunk", "primary", "secondary", "tertiary") for s in ("", "_link")]
PAVED = "asphalt asphal asfalt tarmac concrete cement cobblestone sett paving_stone brick block metal steel wood boardwalk chipseal tiles flagstone bitum interlock paver tartan unhewn_cobblestone pebblestone".split()
UNPAVED = "unpaved dirt gravel sand earth mud grass ground clay soil compacted fine_gravel ice snow shell rock stone".split()
PAVED_RULE = "(" + "|".join(PAVED) + r"|\bpaved\b)"
UNPAVED_RULE = "(" + "|".join(UNPAVED) + ")"
STATES = "AL AK AZ AR CA CO CT DC DE FL GA HI IA ID IL IN KS KY LA MA MD ME MI MN MO MS MT NC ND NE NH NJ NM NV NY OH OK OR PA RI SC SD TN TX UT VA VT WA WI WV WY".split()


def surface_of(s: Column) -> Column:
    low = F.lower(s)
    return (
        F.when(s.isNull() | (F.trim(s) == ""), "paved_unknown")
        .when(low.rlike(PAVED_RULE) | low.rlike("tar.*road"), "paved")
        .when(low.rlike(UNPAVED_RULE), "unpaved")
        .otherwise("unknown")
    )


def network_rank(n: Column) -> Column:
    interstate = n.isin("US:I", "US:interstate") | n.like("US:I:%")
    highway = n.isin("US:US", "US:us") | n.like("US:US:%")
    return F.when(interstate, 1).when(highway, 2).when(n.like("US:%"), 3).otherwise(4)


def route_type(rank: Column, network: Column, ref: Column, is_us: Column, multi: Column, in_usa: Column) -> Column:
    """Interstate, US or state highway by the relation's network, else by the reference; plain, business or other."""
    def kind(word: str, business: Column, other: Column) -> Column:
        return F.when(business, f"{word} Business").when(other, f"{word} Other").otherwise(word)

    interstate = kind("Interstate", ref.ilike("%Bus%"), ref.like("% % %"))
    highway = kind("US Hwy", ref.like("%Bus%"), ref.like("% % %"))
    state = kind("State Hwy", ref.like("__ %Bus%"), ref.like("__ % %"))
    said = (
        F.when(rank == 1, interstate).when(rank == 2, highway).when(rank == 3, state)
        .when(ref.rlike("^(" + "|".join(STATES) + ")"), state).when(ref.like("US %"), highway).when(ref.like("I %"), interstate).otherwise("Other")
    )
    return F.when(is_us & ~multi, said).when(in_usa | network.like("US:%"), "Other")


@layer
def road_line(cat: Catalog) -> DataFrame:
    r = cat("osm_highway_relation").where((c("route") == "road") & tx.blank_to_null(c("network"), True).isNotNull() & ~c("network").like("%:Historic"))
    r = rel.distinct_on(r, ["member"], [network_rank(c("network")), c("network"), c("ref")]).select(c("member").alias("__member"), c("network").alias("rel_network"))
    usa = dumped(cat("ne_10m_admin_0_countries").where("iso_a3 = 'USA'"), jts.make_valid("geometry")).select(F.explode(jts.subdivide("geometry", 256)).alias("geometry"))
    h = cat("osm_highway_linestring").where(~c("is_area"))
    state = tg.lifecycle_type(c("class"), c("subclass"), c("tags"), "highway")
    h = h.withColumn("lifecycle_type", state).where(~c("lifecycle_type").isin("proposed", "planned"))
    numbered = h.where((F.trim("ref") != "") & c("subclass").isin(NUMBERED)).select("id", "geometry")
    hit = met(numbered, usa, "in_usa").where("in_usa").select(c("id").alias("__id")).distinct()
    h = h.join(hit, c("id") == c("__id"), "left").join(r, c("osm_id") == c("__member"), "left")
    ref, in_usa = tx.blank_to_null(c("ref"), True), c("__id").isNotNull()
    multi = F.coalesce(tx.any_like(c("ref"), ["%:%", "%,%", "%;%"]), F.lit(False))
    is_us = in_usa | c("rel_network").like("US:%") | c("network").like("US:%") | ref.rlike("^(I |US |[A-Z]{2} )")
    subject = F.lower(tg.lifecycle_subject(c("class"), c("subclass"), c("tags"), "highway", F.lit("road")))
    mended = reduce(lambda w, kv: (F if w is None else w).when(subject == kv[0], kv[1]), ROAD_SPELLINGS.items(), None).otherwise(subject)
    brunnel = (
        F.when(c("is_tunnel"), F.when(c("is_bridge"), "tunnel;bridge").otherwise("tunnel")).when(c("is_bridge"), F.when(c("is_ford"), "bridge;ford").otherwise("bridge"))
        .when(c("is_ford"), "ford").when(tx.blank_to_null(c("destroyed_bridge"), True).isNotNull(), "bridge").when(tag("destroyed:tunnel").isNotNull(), "tunnel")
    )
    number = tx.blank_to_null(F.expr("trim(both ';' from regexp_replace(ref, '[^0-9]+', ';'))"))
    out = h.select(
        "osm_id", tx.to_int(jts.length_mercator("geometry")).alias("geom_len"), brunnel.alias("brunnel"),
        tx.name_of(c("bridge_name"), c("tunnel_name"), trim=True).alias("brunnel_name"), mended.alias("subclass"), name(), F.length("name").alias("name_len"),
        ref.alias("ref"), F.length("ref").alias("ref_len"), number.alias("ref_number"), F.length(number).alias("ref_number_len"), multi.alias("ref_multi"), "network", is_us.alias("is_us"),
        surface_of(c("surface")).alias("surface"), "lifecycle_type", route_type(network_rank(c("rel_network")), c("rel_network"), c("ref"), is_us, multi, in_usa).alias("route_type"),
        F.when(c("lanes").isin(*"12345"), c("lanes").try_cast("int")).alias("lane"), "layer", "level", "service", "access", "toll", "expressway", "bicycle", "foot", "horse", "is_oneway", "is_ramp", "geometry",
    )
    return out.where(c("geometry").isNotNull() & c("subclass").isin(*ROADS, ""))


@layer
def road_polygon(cat):
    paths = "pedestrian footway steps path cycleway bridleway corridor".split()
    h = cat("osm_highway_polygon").where(c("geometry").isNotNull() & (((c("class") == "highway") & c("subclass").isin(paths)) | ((c("class") == "public_transport") & (c("subclass") == "platform"))))
    return h.select("osm_id", name(), F.when(c("class") == "public_transport", "platform").otherwise(c("subclass")).alias("subclass"), area(), "geometry")


YARD_SIZES = [("%very%large%", "very_large"), ("%very%small%", "very_small"), ("%large%", "large"), ("%medium%", "medium"), ("%small%", "small")]


@layer
def yard_label(cat):
    def of(t: str, source: str, g: Column) -> DataFrame:
        size = reduce(lambda w, p: (F if w is None else w).when(c("yard_size").ilike(p[0]), p[1]), YARD_SIZES, None).otherwise(tx.blank_to_null(c("yard_size"), True))
        d = cat(t).where((c("subclass") == "yard") | (F.lower("service") == "yard"))
        return d.select("osm_id", F.lit(source).alias("source"), "subclass", *blank("operator", trim=True), name(True), *blank("ref", "service", "usage", trim=True), size.alias("yard_size"), *blank("yard_purpose", trim=True), g)

    return of("osm_transportation_polygon", "polygon", inside()).unionByName(of("osm_transportation_point", "point", c("geometry")))


def _alike(of: Column, words: list[str]) -> Column:
    return reduce(lambda w, x: (F if w is None else w).when(tx.similar(of, F.lit(x)), x), words, None)


def spelling(df: DataFrame, of: str, name: str, kind) -> DataFrame:
    """Adds a column worked out once for each distinct value of another: for what is costly a row, and has few values."""
    values = df.select(c(of).alias("__of")).distinct().select("__of", kind(c("__of")).alias(name))
    return df.join(values, c(of).eqNullSafe(c("__of")), "left").drop("__of")


def railway_service(said: Column) -> Column:
    said = F.lower(said)
    siding = tx.similar(said, F.lit("siding")) | tx.similar(said, F.lit("siting"))
    return F.when(siding, "siding").otherwise(_alike(said, ["spur", "crossover", "yard"]))


def railway_usage(said: Column) -> Column:
    low = F.lower(said)
    main = F.when(tx.similar(low, F.lit("main")) & (low != "maintenance"), "main")
    main = main.when(tx.similar(low, F.lit("tourism")) | tx.similar(low, F.lit("tourist")), "tourism").otherwise(tx.blank_to_null(said, True))
    return F.coalesce(_alike(low, ["siding", "spur", "crossover", "yard", "branch", "industrial"]), main)


def railway_normalized(r: DataFrame) -> DataFrame:
    """The rails with their normalised columns n_* beside the others; spellings are compared once for each value."""
    r = spelling(spelling(r, "service", "n_service", railway_service), "usage", "n_usage", railway_usage)
    gauge = c("gauge")
    powered = ~(c("electrified").isin("FIXME", "no", "NO", "unknown") | (c("electrified").isNull() & ~c("subclass").isin("tram", "monorail", "subway", "light_rail", "funicular")))
    return r.select(
        "*", tg.lifecycle_type(c("class"), c("subclass"), c("tags"), "railway").alias("n_lifecycle_type"),
        F.when(c("subclass").isin("narrow_gauge", "miniature"), "narrow").when(gauge.isNull() | gauge.isin("railway", "rail", "unknown", "no", "standard") | gauge.ilike("14%"), "standard")
        .when(gauge.isin("wide", "broad") | gauge.rlike(r"^(15|16|17|18|19|2\d{3})"), "broad").otherwise("narrow").alias("n_gauge"),
        F.when(powered, 1).otherwise(0).alias("n_electrified"),
        F.when(c("tracks").isin("1", "single", "tram", "monorail") | tx.blank_to_null(c("tracks"), True).isNull(), "single").otherwise("multiple").alias("n_tracks"),
    )


@layer
def rail_line(cat):
    r = railway_normalized(cat("osm_railway_linestring").where(~c("is_area")))
    r = r.where(~F.coalesce("n_lifecycle_type", F.lit("intact")).isin("abandoned", "proposed", "planned"))
    parts = [
        F.when(c("n_service").isNull(), "railway").otherwise("sidetrack"), F.when(c("n_lifecycle_type") == "intact", "intact").otherwise("not-intact"),
        F.when(c("n_gauge") == "narrow", "narrow").otherwise("broadstandard"), F.when(c("n_electrified") == 1, "electrified").otherwise("nonelectrified"),
        F.when(c("n_service").isNull(), F.when(c("n_tracks") == "single", "singletrack").otherwise("multipletracks")),
    ]
    return r.select(
        "osm_id", F.when(c("is_bridge"), "bridge").when(c("is_tunnel"), "tunnel").when(c("is_ford"), "ford").alias("brunnel"),
        tg.lifecycle_subject(c("class"), c("subclass"), c("tags"), "railway", F.lit("unknown")).alias("subclass"), name(True), *blank("ref", "network", "voltage", "frequency", "bridge_name", "tunnel_name", trim=True),
        *(c(f"n_{x}").alias(x) for x in ("service", "usage", "gauge", "electrified", "tracks", "lifecycle_type")), "layer", "level", "is_oneway", "is_ramp",
        F.when(c("n_lifecycle_type").isNotNull(), F.concat_ws("_", *parts)).alias("dps_type"), "geometry",
    )


@layer
def transportation_station_polygon(cat):
    t = cat("osm_transportation_polygon").where(c("subclass").isin("station", "bus_station", "ferry_terminal", "rest_area", "services", "platform"))
    return t.select("osm_id", "class", "subclass", name(), tag("platforms"), *blank("operator", "station", "service"), area(), "geometry")


@layer
def transportation_station_label(cat):
    return cat.layer("transportation_station_polygon").withColumn("geometry", inside())


@layer
def ferry_line(cat):
    return cat("osm_shipway_linestring").select("osm_id", "class", "subclass", name(), *blank("short_name", "shipway", "service", "usage"), "is_bridge", "is_tunnel", "is_ramp", "is_ford", "is_oneway", "layer", "geometry")


# ---- water

# Rules of water types in order; kinds of waters drawn.
WATER_RULES = [
    ("^bas", "basin"), ("bayou", "bayou"), ("can[ao]l", "canal"), ("lake", "lake"), ("pool", "pool"), ("pond", "pond"), ("res[eo]rvoir", "reservoir"), ("cove", "cove"), ("creek", "creek"),
    ("spring", "spring"), ("river", "river"), ("ditch", "ditch"), ("stream", "stream"), ("^est", "estuary"), ("fall", "falls"), ("^fj[oi]", "fjord"), ("^ha[rv]bou?r", "harbour"), ("lag[ou]", "lagoon"),
    ("ocean", "ocean"), ("^rapi", "rapids"), ("o[xs]bow", "oxbow"), ("^tidal", "tidal"), ("^waste", "wastewater"), ("^(yes)?$", "water"),
]
WATERWAYS = "canal ditch drain river stream pond lake reservoir basin wastewater weir rapids oxbow drystream tidal_channel artificial lagoon fishpond yes waterfall derelict_canal intermittent brook harbour drainage_channel connector sluice_gate lake;pond tidal sewer spillway construction pan riverbank water stream;river culvert underground_drain tunnel drainage_gutter sewage abandoned creek navigation seaway riverbed lake;reservoir razed pond;reservoir unclassified disused_canal sluice duct piscina glacial_lage seasonal old_river channel river;canal strait ocean".split()
WATERS = "artificial basin bay bayou brook canal cenote channel connector canoe_pass cove creek derelict_canal disused_canal ditch drain estuary falls fish_pass fishpond fjord glacial_lage guelta gulf harbour lagoon lake lake;pond lake;reservoir moat ocean old_river oxbow pan piscina pond pond;reservoir pool rapids reservoir river river;canal riverbank riverbed salt_pond sea sound spillway spring swimming_pool strait stream stream_pool stream;river tidal tidal_channel unclassified wastewater water waterfall yes".split()
FLOWING = "river canal stream ditch drain creek brook bayou rapids tidal estuary falls spillway channel canoe_pass fish_pass connector".split()
OPEN_SEA = "bay harbour sea strait".split()


def water_type(s: Column) -> Column:
    """Null stays null, '' is water, else the first rule that is found, else as it is."""
    return tx.first_match(s, WATER_RULES, s)


def water_surface(cat) -> DataFrame:
    w = cat("osm_water_polygon").where(~c("intermittent") & c("geometry").isNotNull()).withColumn("kind", water_type(c("subclass"))).where(c("kind").isin(WATERS))
    named = tag("water", "water_tag")
    return w.select("osm_id", name(), c("kind").alias("subclass"), F.when(named.isNotNull(), water_type(c("tags")["water"])).otherwise(c("kind")).alias("water_type"), "intermittent", area(), jts.simplify(jts.make_valid("geometry"), 0.000001).alias("geometry"))


@layer
def inland_water_intermittent_polygon(cat):
    w = cat("osm_water_polygon").where((c("intermittent") | c("subclass").isin("intermittent", "seasonal", "drystream")) & c("geometry").isNotNull())
    w = w.select("osm_id", name(), water_type(c("subclass")).alias("subclass"), area(), "intermittent", bucket(jts.area_sphere("geometry"), [(5, 5), (6, 6), (7, 7)], 8).alias("z_level"), fixed().alias("geometry"))
    return dumped(w)


@layer
def ocean_polygon(cat):
    far = dumped(cat("ne_50m_ocean").where(c("geometry").isNotNull() & ~jts.is_empty("geometry")).select("geometry")).select(F.lit("ocean").alias("subclass"), jts.make_valid("geometry").alias("geometry"), F.lit(0).alias("z_level"))
    near = dumped(cat("osm_ocean").where(c("geometry").isNotNull() & ~jts.is_empty("geometry")).select("geometry"), fixed(jts.make_valid("geometry"))).where(jts.dimension("geometry") == 2)
    near = near.select(F.lit("ocean").alias("subclass"), F.explode(jts.subdivide("geometry", 1024)).alias("geometry"), F.lit(1).alias("z_level"))
    return far.unionByName(near.withColumn("geometry", jts.make_valid("geometry")))


@layer
def water_polygon(cat):
    """Surfaces by level of their area, and touching surfaces merged for the last level: pairs, components, union."""
    w = water_surface(cat).where(~c("subclass").isin(OPEN_SEA)).select("osm_id", "water_type", "geometry")
    w = cut(w, "surfaces").where(c("geometry").isNotNull() & ~jts.is_empty("geometry"))  # written, else each later step would mend them again
    src = w.select("osm_id", jts.make_valid(jts.reduce_precision("geometry", 0.000001)).alias("geometry"))
    boxed = cut(jts.with_box(src), "snapped").where(~jts.is_empty("geometry"))
    src = boxed.select("osm_id", "geometry")
    pairs = spatial.grid_join(boxed, boxed, 1.0, (c("a.osm_id") < c("b.osm_id")) & jts.intersects("a.geometry", "b.geometry")).select(c("a.osm_id").alias("a"), c("b.osm_id").alias("b")).distinct()
    pairs = cut(pairs, "touching")  # read twice
    parts = connected_components(pairs.select(c("a").alias("id")).union(pairs.select("b")), pairs)
    merged = union_tree(src.join(parts, c("osm_id") == c("id")), ["component"], 0.000001)
    merged = dumped(merged, jts.make_valid("geometry")).where((jts.dimension("geometry") == 2) & ~jts.is_empty("geometry"))
    merged = merged.select(F.lit("water").alias("subclass"), "geometry", F.lit(12).alias("z_level"), F.lit(False).alias("capped"))
    z = bucket(jts.area_sphere("geometry"), [(k, k) for k in range(5, 12)], 12)
    own = w.withColumn("z_level", F.when(c("water_type").isin(FLOWING), F.greatest(z, F.lit(6))).otherwise(z)).join(parts.select(c("id").alias("__id")), c("osm_id") == c("__id"), "left")
    own = own.select(F.lit("water").alias("subclass"), F.explode(F.when(jts.npoints("geometry") > 1024, jts.subdivide("geometry", 1024)).otherwise(F.array("geometry"))).alias("geometry"), "z_level", c("__id").isNotNull().alias("capped"))
    own = dumped(own, jts.make_valid("geometry")).where((jts.dimension("geometry") == 2) & ~jts.is_empty("geometry"))
    lakes = dumped(cat("ne_50m_lakes").select("geometry"), jts.make_valid("geometry")).select(F.lit("water").alias("subclass"), "geometry", F.lit(0).alias("z_level"), F.lit(False).alias("capped"))
    return union(own, merged, lakes)


@layer
def water_line(cat):
    line = cat("osm_waterway_linestring")
    r = cat("osm_waterway_relation").where(c("role").isin("main_stream", "") & (jts.type_of("geometry") == "LineString") & ~jts.is_closed("geometry"))
    w = line.select(c("osm_id").alias("__member"), c("is_intermittent").alias("dry"))
    r = r.join(w, c("member") == c("__member"), "left").groupBy("osm_id", "name").agg(jts.union_all(F.collect_list("geometry")).alias("geometry"), F.bool_and(F.coalesce("dry", F.lit(False))).alias("dry"))
    of = lambda: [F.when(c("dry"), True).alias("intermittent")]
    long = r.withColumn("geom_len", length()).select(
        *blank("name"), *of(), F.lit("river").alias("subclass"), F.lit(None).cast("string").alias("brunnel"), F.lit(None).cast("boolean").alias("culvert"), "geom_len", "geometry",
        F.when(c("geom_len") >= 500000, 6).when(c("geom_len") >= 400000, 7).when(c("geom_len") >= 300000, 8).otherwise(9).alias("z_level"),
    )
    s = line.where(c("subclass").isin(WATERWAYS)).withColumns({"kind": water_type(c("subclass")), "dry": c("is_intermittent"), "m": jts.length_mercator("geometry")})
    brunnel = F.when(c("is_bridge").isNotNull() & c("is_tunnel").isNotNull(), F.when(c("is_bridge"), "bridge").when(c("is_tunnel"), "tunnel"))
    short = s.select(
        *blank("name"), *of(), c("kind").alias("subclass"), brunnel.alias("brunnel"), F.when(c("tunnel_type") == "culvert", True).alias("culvert"), c("m").cast("float").alias("geom_len"), "geometry",
        F.when(c("kind").isin("river", "canal"), 10).when((c("kind") == "stream") & (c("m") >= 10000), 11).when(c("kind").isin("stream", "drain", "ditch", "creek"), 12).otherwise(13).alias("z_level"),
    )
    return long.unionByName(short)


#: Side of the cells of the sea, in degrees.
BATHYMETRY_CELL = 5.0


@layer
def bathymetry_polygon(cat):
    """Depth bands without overlap: each depth with all deeper ones, less the next deeper; cell by cell, as they are cut up
    in the end anyway."""
    tables = [f"ne_10m_bathymetry_{k}_{d}" for k, d in zip("abcdefghijk", (10000, 9000, 8000, 7000, 6000, 5000, 4000, 3000, 2000, 1000, 200), strict=True)]
    d = reduce(DataFrame.unionByName, [cat(t).select(c("depth").cast("double").alias("depth"), "geometry") for t in tables]).where(c("geometry").isNotNull())
    d = in_cells(d.withColumn("geometry", jts.make_valid("geometry")), BATHYMETRY_CELL)
    d = d.groupBy("depth", "cx", "cy").agg(jts.union_all(F.collect_list("geometry")).alias("geometry"))
    # within a cell there is one row a depth at most; that of a depth is its own area and all deeper ones
    deeper = Window.partitionBy("cx", "cy").orderBy(c("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("geometry", jts.union_all(F.collect_list("geometry").over(deeper)))
    below = F.lead("geometry").over(Window.partitionBy("cx", "cy").orderBy("depth"))
    levels = F.broadcast(d.groupBy("depth").agg(F.lit(1)).select("depth", F.lead("depth").over(Window.orderBy("depth")).alias("depth_max")))  # eleven rows
    d = d.withColumn("below", below).join(levels, "depth")
    band = F.when(c("below").isNull(), c("geometry")).otherwise(jts.difference("geometry", "below"))
    d = d.select(c("depth").cast("int").alias("depth"), c("depth_max").cast("int").alias("depth_max"), F.explode(jts.subdivide(jts.polygons(jts.make_valid(band)), 1024)).alias("geometry"))
    return dumped(d).where(~jts.is_empty("geometry"))


@layer
def culvert_point(cat):
    return cat("osm_water_point").where((c("subclass") == "culvert") | (c("tunnel") == "culvert")).select("osm_id", name(), "subclass", "geometry")


@layer
def lock_line(cat):
    w = cat("osm_waterway_linestring").where(c("subclass").isin("lock_gate", "gate", "lock", "lock_basin", "locks"))
    return w.select("osm_id", "class", "subclass", F.when(c("is_intermittent"), True).alias("intermittent"), name(), *blank("lock", "lock_name"), "tags", "geometry")


@layer
def lock_label(cat):
    some = lambda n: tx.blank_to_null(c(n)).isNotNull()
    u = cat("osm_utility_point").where(c("subclass").isin("lock_gate", "gate", "lock_basin", "lock") | some("lock") | some("gate_category"))
    return u.select("osm_id", "class", "subclass", name(), *blank("operator", "seamark_name", "seamark_type", "service", "access", "lock", "gate_category"), "tags", "geometry")


# ---- land

PARKS = "District Regional aboriginal_lands bunker city_park community county_park dog_park fairway golf_course green national_park natural_area nature_reserve neighbourhood park pitch private_park protected_area recreation_ground regional special state_beach state_historic_park state_park".split()


@layer
def park_polygon(cat):
    leisure = F.when(c("leisure").isin("park", "nature_reserve", "golf_course", "dog_park", "recreation_ground", "garden"), c("leisure"))
    p = cat("osm_park_polygon").where(c("subclass").isin(PARKS)).select("osm_id", *blank("access", "class"), F.coalesce(leisure, tx.blank_to_null(c("subclass"))).alias("subclass"), *blank("iucn_level"), name(), *blank("protect_class"), area(), "geometry")
    l_ = cat("osm_landuse_polygon").where("subclass = 'pitch'").select("osm_id", *blank("access", "class", "subclass"), F.lit(None).cast("string").alias("iucn_level"), name(), F.lit(None).cast("string").alias("protect_class"), area(), "geometry")
    return p.unionByName(l_)


def _ports(cat) -> DataFrame:
    b = cat("osm_builtup_area").where(c("subclass").isin("port", "harbour") | ((c("subclass") == "industrial") & (c("industrial") == "port")))
    b = dumped(b.select("osm_id", name(), "class", "subclass", *blank("industrial", "port", "cargo", "access", "port_type"), area(), jts.polygons(jts.make_valid("geometry")).alias("geometry")))
    b = b.withColumn("area_part", jts.area_mercator("geometry").cast("float"))
    b = rel.numbered(b, [c("osm_id"), c("area").desc_nulls_first(), F.xxhash64("geometry")], "fid")
    b = b.withColumn("rank", (F.rank().over(Window.partitionBy("osm_id").orderBy(c("area_part").desc_nulls_first())) == 1).cast("int"))
    x = jts.with_box(b.select("fid", "area_part", "geometry"))
    x = spatial.grid_join(x, x, 0.5).where(c("a.fid") != c("b.fid"))
    larger = (c("b.area_part") > c("a.area_part")) | ((c("b.area_part") == c("a.area_part")) & (c("b.fid") < c("a.fid")))
    holds = larger & (jts.area(jts.intersection("a.geometry", "b.geometry")) >= 0.95 * jts.area("a.geometry"))
    flags = x.groupBy(c("a.fid").alias("__fid")).agg(F.max(jts.overlaps("b.geometry", "a.geometry").cast("int")).alias("overlap"), F.max(holds.cast("int")).alias("contained"))
    return b.join(flags, c("fid") == c("__fid"), "left").drop("__fid").withColumns({"overlap": F.coalesce("overlap", F.lit(0)), "contained": F.coalesce("contained", F.lit(0))})


@layer
def port_polygon(cat):
    return _ports(cat)


@layer
def port_label(cat):
    return cat.layer("port_polygon").withColumns({"rank": F.nullif("rank", F.lit(0)), "contained": F.nullif("contained", F.lit(0)), "geometry": inside()}).drop("fid")


@layer
def cemetery_polygon(cat):
    """Rank by name over all parts; those properly inside another are left out, so contained is always 0."""
    l_ = cat("osm_landuse_polygon").where(c("geometry").isNotNull() & (tx.any_ilike(c("subclass"), ["%cemetery%", "%graveyard%"]) | c("subclass").isin("grave_yard", "grave", "gravesite", "burial_ground")))
    l_ = dumped(l_.select("osm_id", name(), *blank("class", "subclass"), tag("religion"), tag("denomination"), tag("cemetery"), area(), "geometry"))
    merc = jts.area_mercator("geometry")
    l_ = l_.withColumns({"fid": F.xxhash64("osm_id", "geometry"), "area_part": merc.cast("float"), "rank": F.rank().over(Window.partitionBy("name").orderBy(merc.desc()))})
    x = jts.with_box(l_.select("fid", "geometry"))
    inner = spatial.grid_join(x, x, 0.5, (c("a.fid") != c("b.fid")) & jts.contains_properly("b.geometry", "a.geometry")).select(c("a.fid").alias("__fid")).distinct()
    return l_.join(inner, c("fid") == c("__fid"), "left_anti").withColumn("contained", F.lit(0))


@layer
def cemetery_label(cat):
    return cat.layer("cemetery_polygon").withColumn("geometry", inside())


@layer
def stadium_polygon(cat):
    return cat("osm_builtup_area").where(c("subclass").isin("sports_centre", "stadium")).select("osm_id", name(), "class", "subclass", area(), "geometry")


@layer
def stadium_label(cat):
    return cat.layer("stadium_polygon").withColumn("geometry", inside())


def _sport(df: DataFrame, own: tuple[str, ...], tagged: tuple[str, ...]) -> DataFrame:
    have = blank(*own) + [tag(k) for k in tagged]
    return df.select("osm_id", *blank("name", "name_en"), *have, *blank("access"), "class", "subclass", area(), "tags", "geometry")


@layer
def sports_ground(cat):
    park = _sport(cat("osm_park_polygon").where("subclass = 'pitch'"), ("landuse", "surface", "ownership", "owner", "operator"), ())
    return union(park, _sport(cat("osm_landuse_polygon").where("subclass = 'pitch'"), (), ("surface", "ownership", "owner", "operator")))


@layer
def golf_course(cat):
    p = cat("osm_park_polygon")
    return union(_sport(p.where("subclass = 'golf_course'"), ("landuse", "surface", "ownership", "owner", "operator"), ()), _sport(p.where(c("subclass").isin("bunker", "green", "fairway")), (), ()))


@layer
def glacier_polygon(cat):
    def of(df: DataFrame, source: str, named: Column) -> DataFrame:
        return dumped(df.where(c("geometry").isNotNull()).select(F.lit(source).alias("source"), named.alias("name"), fixed().alias("geometry")))

    ne = [of(cat(t), "ne", tx.blank_to_null(c("name"))) for t in ("ne_10m_antarctic_ice_shelves_polys", "ne_10m_glaciated_areas")]
    osm = of(cat("osm_landcover_polygon").where("subclass = 'glacier'"), "osm", tx.blank_to_null(c("tags")["name"], True))
    return union(*ne, osm, of(cat("osm_icesheet"), "osm", F.lit("antarctica_icesheet")))


@layer
def physical_labels(cat):
    p = cat("ne_physical_centerlines").where(tx.blank_to_null(c("name")).isNotNull())
    return p.select(name(), *blank("featurecla"), "scalerank", "min_label", "max_label", "geometry")


@layer
def pier_line(cat):
    return cat("osm_pier_linestring").where(c("geometry").isNotNull()).select("osm_id", *blank("name"), "class", "subclass", tagged_true("floating", "is_floating"), "geometry")


@layer
def pier_polygon(cat):
    return cat("osm_pier_polygon").where(c("geometry").isNotNull()).select("osm_id", *blank("name"), "class", "subclass", tagged_true("floating", "is_floating"), area(), "geometry")


# Classes of points of interest.
POI = {k: k for k in "hospital police fire_station school college townhall courthouse public_building diplomatic place_of_worship".split()} | {"kindergarten": "school", "university": "college"}


@layer
def poi_point(cat):
    kind = reduce(lambda w, kv: (F if w is None else w).when(c("subclass") == kv[0], kv[1]), POI.items(), None)
    of = lambda t, g: cat(t).select("osm_id", name(), kind.alias("class"), "subclass", *blank("religion"), g).where(c("class").isNotNull())
    return of("osm_poi_point", c("geometry")).unionByName(of("osm_poi_polygon", inside()))


@layer
def barrier_point(cat):
    return cat("osm_barrier_point").select("osm_id", "subclass", name(), "geometry")


@layer
def barrier_line(cat):
    return cat("osm_barrier_linestring").select("osm_id", "subclass", name(), "geometry")


@layer
def building_polygon(cat):
    return cat("osm_building_polygon").select("osm_id", name(), area(), *blank("building", "height", "levels"), "geometry")


# ---- infrastructure

# Power line kinds.
POWER_LINES = "line minor_line insulator transmission sub_station substation cable wire cable_submarine cable_overhead busbar bay power".split()


@layer
def pipeline_line(cat):
    u = cat("osm_utility_linestring").where((c("class").isin("man_made", "pipeline") & ~c("subclass").isin(POWER_LINES)) | c("seamark_type").isin("pipeline_overhead", "pipeline_submarine"))
    return u.select(
        "osm_id", "class", "subclass", *blank("name", "location", "usage", "substance", "diameter", "flow_direction", "operator", "seamark_type", "pipeline_submarine_category", "pipeline_submarine_product"),
        *blank("pipeline_overhead_category", "pipeline_overhead_product", "product", "content", "height"), "ele", *blank("operational_status", "condition"), "tags", "geometry",
    )


@layer
def powerline_line(cat):
    u = cat("osm_utility_linestring").select(
        "osm_id", F.when(c("class").like("%:power"), "power").otherwise(c("class")).alias("class"), tg.lifecycle_subject(c("class"), c("subclass"), c("tags"), "power", F.lit("line")).alias("subclass"), *blank("name"),
        F.when(c("seamark_type") == "cable_submarine", "underwater").otherwise(tx.blank_to_null(c("location"))).alias("location"), *blank("cable_overhead_category", "cable_submarine_category", "usage", "voltage", "operator", "cables", "wires"),
        tg.lifecycle_type(c("class"), c("subclass"), c("tags"), "power").alias("lifecycle_type"), "geometry",
    )
    over, under = c("cable_overhead_category"), c("cable_submarine_category")
    return u.where(c("subclass").isin(POWER_LINES) & (over.isNull() | ~over.isin("ferry", "mooring")) & (under.isNull() | (under != "ferry")) & ~c("lifecycle_type").isin("proposed", "planned"))


PLANT = "plant_source plant_method plant_storage plant_output generator_source generator_method generator_type generator_output generator_plant".split()


@layer
def power_station_polygon(cat):
    u = cat("osm_utility_polygon").where("class = 'power'")
    return u.select("osm_id", F.when(c("subclass") == "plant_part", "plant").otherwise(c("subclass")).alias("subclass"), name(), *blank("operator", *PLANT), area(), "geometry")


@layer
def power_station_label(cat):
    return cat.layer("power_station_polygon").drop("operator").withColumn("geometry", inside())


@layer
def pumping_station_polygon(cat):
    return cat("osm_utility_polygon").where("class <> 'power'").select("osm_id", "subclass", name(), *blank("operator", "substation", "substance", "pumping_station"), area(), "geometry")


@layer
def pumping_station_label(cat):
    return cat.layer("pumping_station_polygon").withColumn("geometry", inside())


def _energy(cat) -> DataFrame:
    like = lambda *words: reduce(lambda a, b: a | b, [tx.similar(c("name"), F.lit(w)) for w in words])
    sub, t = c("subclass"), c("tags")
    kind = (
        F.when(sub.isin("oil", "wellsite", "storage_tank") & like("terminal", "storage", "depot", "farm"), "oil_terminal")
        .when(sub.isin("oil", "wellsite", "storage_tank") & like("refinery", "facility", "plant"), "oil_refinery")
        .when(sub.isin("oil", "wellsite") & like("station"), "station")
        .when((sub == "wellsite") & like("area", "field"), "oilfield")
        .when((sub == "storage_tank") & (c("content") == "oil"), "oil_storage")
        .otherwise(sub)
    )
    substance = F.coalesce("substance", F.when(t["type"].ilike("%oil%"), t["type"]).otherwise(t["content"]))
    u = cat("osm_utility_polygon").where(
        sub.isin("oil", "wellsite", "oilfield", "oil_terminal", "oil_refinery", "refinery") | ((sub == "storage_tank") & c("content").isin("oil", "gas", "fuel"))
        | like("oil", "refinery", "terminal") | tx.similar(t["content"], F.lit("oil")) | tx.similar(t["type"], F.lit("oil"))
    )
    u = u.select("osm_id", "class", kind.alias("subclass"), name(), *blank("operator"), substance.alias("substance"), t["ref"].alias("ref"), t["access"].alias("access"), t["type"].alias("type"), area(), "geometry")
    ind = c("industrial")
    l_ = cat("osm_landuse_polygon").where(ind.isin("oil", "oilfield", "oil_refinery", "refinery", "oil_terminal", "wellsite"))
    l_ = l_.select("osm_id", "class", F.when(ind.isin("oil_refinery", "refinery"), "oil_refinery").when(ind == "oil_terminal", "oil_terminal").otherwise("oilfield").alias("subclass"), name(), tag("operator"), F.lit(None).cast("string").alias("substance"), t["ref"].alias("ref"), "access", t["type"].alias("type"), area(), "geometry")
    minor = sub.isin("oil", "wellsite") & c("name").isNull() & c("ref").isNull() & ((c("area") < 1e6) | ((c("area") < 2e6) & c("operator").isNull()))
    return u.unionByName(l_).where(~minor)


@layer
def energy_polygon(cat):
    return _energy(cat)


@layer
def energy_label(cat):
    e = cat.layer("energy_polygon").where(c("name").isNotNull() | c("ref").isNotNull() | ((c("area") > 5e6) & c("operator").isNotNull()))
    e = e.select("osm_id", "subclass", "name", "operator", "substance", "area", inside())
    m = cat("osm_utility_point").where("subclass = 'mineshaft'").select("osm_id", "subclass", name(), *blank("operator", "resource", "mineshaft_type"), true_or_null("disused"), "geometry")
    return union(e, m)


GRAIN = "grain crop silage wheat crops feed grit".split()


@layer
def grain_polygon(cat):
    u = cat("osm_utility_polygon").where((c("subclass") == "silo") & c("content").isin(GRAIN))
    return u.select("osm_id", "class", "subclass", name(), tx.blank_to_null(c("height").cast("string")).alias("height"), *blank("content"), area(), "tags", "geometry")


@layer
def grain_point(cat):
    u = cat("osm_utility_point").where((c("subclass") == "silo") & (c("content").isin("grain", "crop") | c("tags")["content"].isin(GRAIN)))
    u = u.select("osm_id", "class", "subclass", name(), tx.blank_to_null(c("height").cast("string")).alias("height"), F.coalesce(tx.blank_to_null(c("content")), tag("content")).alias("content"), F.lit(None).cast("float").alias("area"), "tags", "geometry")
    return u.unionByName(cat.layer("grain_polygon").withColumn("geometry", inside()))


# Utilities drawn as points, from points and from buildings.
UTILITY_POINTS = "oil_well petroleum_well antenna chimney communications_tower crane flare gasometer lighthouse mast obelisk offshore_platform pumping_station silo storage_tank stupa tower utility_pole water_tower windmill windpump generator pole portal substation light_major platform pylon gate".split()
UTILITY_BUILDINGS = "storage_tank oil_well petroleum_well offshore_platform lighthouse communications_tower tower mast antenna utility_pole pole water_tower substation transmission silo telescope lock_gate".split()
UTILITY_TAGS = ["substation", "pumping_station", "operator", *(x.replace("_", ":") for x in PLANT), "seamark:pylon:category", "seamark:platform:category", "seamark:production_area:category", "seamark:name", "seamark:platform:height"]
UTILITY_MORE = ["content", "substance", "capacity", "location", "access"]


def height_of(h: Column) -> Column:
    """The number of a height in metres, with a point; null where there is more than a number and an m."""
    h = F.trim(h.cast("string"))
    return F.when(h.rlike(r"(?i)^[0-9]+([.,][0-9]+)?\s*m?$"), F.replace(F.regexp_replace(h, "[^0-9.,]", ""), F.lit(","), F.lit(".")))


@layer
def utility_point(cat):
    u = cat("osm_utility_point")
    wind = met(u.where("generator_source = 'wind'").select("osm_id", "geometry"), cat("ne_10m_land").select(F.explode(jts.subdivide("geometry", 256)).alias("geometry")), "on").where("on").select(c("osm_id").alias("__osm_id")).distinct()
    u = u.where(c("subclass").isin(UTILITY_POINTS)).join(wind, c("osm_id") == c("__osm_id"), "left")
    shore = F.when(c("generator_source") == "wind", F.when(c("__osm_id").isNotNull(), "on").otherwise("off"))
    own = [k.replace(":", "_") for k in UTILITY_TAGS]
    u = u.select("osm_id", *blank("class", "subclass"), name(), *blank(*own, "tower_type", "tower_construction", "mast_type", "rotor_diameter", "service"), height_of(c("height")).alias("height"), *blank(*UTILITY_MORE), shore.alias("shore"), "geometry")
    b = cat("osm_building_polygon").where(c("man_made").isin(UTILITY_BUILDINGS))
    b = b.select(
        "osm_id", F.lit("man_made").alias("class"), c("man_made").alias("subclass"), name(), *(tag(k) for k in UTILITY_TAGS), *blank("tower_type", "tower_construction"), tag("mast:type"), tag("rotor:diameter"), tag("service"),
        height_of(c("height")).alias("height"), *(tag(k) for k in UTILITY_MORE), F.lit(None).cast("string").alias("shore"), inside(),
    )
    return u.unionByName(b)


@layer
def radar_label(cat):
    tagged = [tag(k) for k in ("military", "ele", "airmark", "radar", "description")]
    u = cat("osm_utility_point").where("tower_type = 'radar'").select("osm_id", "class", "subclass", name(), *blank("operator", "seamark_name", "tower_type", "tower_construction", "mast_type", "service"), tx.blank_to_null(c("height").cast("string")).alias("height"), *blank("access"), *tagged, "geometry")
    b = cat("osm_building_polygon").where("tower_type = 'radar'").select("osm_id", F.lit("man_made").alias("class"), F.lit("tower").alias("subclass"), name(), tag("operator"), tag("seamark:name"), *blank("tower_type", "tower_construction"), tag("mast:type"), tag("service"), *blank("height"), tag("access"), *tagged, inside())
    return u.unionByName(b)


@layer
def us_military_installations_polygon(cat):
    renamed = {"sitereportingcomponent": "component", "countryname": "country", "isjointbase": "jointbase", "siteoperationalstatus": "operstatus", "sitename": "sitename", "statenamecode": "state"}
    return cat("mirtalocations_a").select(area(), *(tx.blank_to_null(c(a)).alias(b) for a, b in renamed.items()), "geometry")


@layer
def us_military_installations_label(cat):
    one = cat.spark.range(1).select(F.lit(116500000.0).cast("float").alias("area"), F.lit("Cuba").alias("country"), F.lit("US Naval Base Guantanamo Bay").alias("sitename"), jts.point(-75.16, 19.9175).alias("geometry"))
    return union(cat.layer("us_military_installations_polygon").withColumn("geometry", inside()), one)


# ---- aeroways

# Runway surface codes, by what the lower-case text is or begins with, first match wins: in place of the table
# of spellings, which has over 200 entries and is a parameter.  The rules agree with it on its spellings; they also know
# spellings near those, which the table leaves as they are.
RUNWAY_RULES = [
    ("^alum", "ALUM-DECK"),
    ("asphalt", "ASP"),
    ("concrete", "CON"),
    ("bitum|^tar|^sealed", "BIT"),
    ("^(asp|asf|ashp|apsh|grooved asp|blacktop)", "ASP"),
    ("^(ug|unk.*)?$", "U"),
    ("^(unpaved|unpeved|not paved|unsealed)", "UNPAVED"),
    ("^wat", "WAT"),
    ("^wood", "WOOD"),
    ("^(tuef|turf|torf)$", "TURF"),
    ("^san", "SAN"),
    ("^bri$|brick$", "BRI"),
    ("^turf|^compacted (earth|sand)$|compactada|compacted schist|^graded|hardcore|rolled earth$|^grass over (hard )?gravel|^packed", "GRE"),
    ("^cla|^(brown|grey|red|black) |^rock/gravel/clay|^shal[ey]|^hard (clay|loam)", "CLA"),
    ("^cor|^(compacted|crushed) coral", "COR"),
    ("^crushed rock|^gra?v|^gvl|^pi[cç]|^(yellow|white|rocky) gravel|^paved/gravel", "GVL"),
    ("^dirt|^volcanic|^lakebed|^earth|^h?erba|^good grass|^gra?s|^graa|^gra?$|^ground|^sod|^soft|^soil|^natural soil|^loose gravel|^limestone|^hard (mud|sand)", "GRS"),
    ("^con|^c0n|^caliche|^cement", "CON"),
    ("^sno", "SNO"),
    ("^ice", "ICE"),
    ("^(com|cop)$", "COM"),
    ("^surface paved|^hard( surfaced)?$|^pav(ed|ement|ing)$|^per$", "PER"),
    ("^ter$|^treated|^trtd|^oil|^oli|^old asp|^mac", "MAC"),
    ("^mat|^met|^mtal|^steel|^pierced", "PSP"),
]
M2, FEET = 2500000, 3.28084


def _airports(cat) -> DataFrame:
    """Airports with runways, joined to mapped aerodromes by place, ICAO, IATA or name."""
    number = lambda n: tx.blank_to_null(c(n)).try_cast("float")
    a = cat("ourairports_airports").where(~jts.contains(_box(-2, -2, 2, 2), "geometry"))
    r = cat("ourairports_runways").select(
        "airport_ref", number("length_ft").alias("runway_length_ft"), number("width_ft").alias("runway_width_ft"), *(tx.blank_to_null(c(x)).alias(f"runway_{x}") for x in ("surface", "lighted", "closed", "le_ident", "he_ident")),
        number("le_heading_degt").alias("runway_le_heading"), number("he_heading_degt").alias("runway_he_heading"),
    )
    x = a.join(r, c("id") == c("airport_ref"), "left").drop("airport_ref").withColumnsRenamed({"id": "airport_id", "gps_code": "icao", "iata_code": "iata"}).withColumn("elevation_ft", number("elevation_ft"))
    field = cat("osm_aeroway_polygon").where("subclass = 'aerodrome'").select(c("osm_id").alias("osm_id_aerodrome"), area().alias("osm_aerodrome_area"), *(tx.blank_to_null(c(k)).alias(f"f_{k}") for k in ("iata", "icao", "name")), "geometry")
    way = cat("osm_aeroway_linestring").where("class = 'aeroway' and subclass = 'runway'").select(c("osm_id").alias("osm_id_runway"), length().alias("osm_runway_length"), tx.blank_to_null(c("surface")).alias("osm_runway_surface"), "geometry")
    on = spatial.grid_join(jts.with_box(field.select("osm_id_aerodrome", "geometry")), jts.with_box(way), 0.5, jts.intersects("a.geometry", "b.geometry")).select("a.osm_id_aerodrome", "b.osm_id_runway", "b.osm_runway_length", "b.osm_runway_surface").distinct()
    field = field.join(on, "osm_id_aerodrome", "left")
    cols = [c(k) for k in ("osm_id_aerodrome", "osm_id_runway", "osm_aerodrome_area", "osm_runway_length", "osm_runway_surface", "airport_id")]
    port = x.select("airport_id", "icao", "iata", "name").distinct()
    codes = rel.any_of_joins(field, port, [c("f_icao") == c("icao"), c("f_iata") == c("iata"), c("f_name") == c("name")], cols)
    near = spatial.grid_join(jts.with_box(field), jts.with_box(a.select(c("id").alias("airport_id"), "geometry")), 0.5, jts.intersects("a.geometry", "b.geometry")).select(*(f"a.{k}" for k in ("osm_id_aerodrome", "osm_id_runway", "osm_aerodrome_area", "osm_runway_length", "osm_runway_surface")), "b.airport_id")
    x = x.join(codes.unionByName(near).distinct(), "airport_id", "left")
    return x.withColumns({"runway_length_ft": F.coalesce("runway_length_ft", (c("osm_runway_length") * FEET).cast("float")), "runway_surface": F.coalesce("runway_surface", "osm_runway_surface")})


def _box(x1: float, y1: float, x2: float, y2: float) -> Column:
    return jts.from_wkt(F.lit(f"POLYGON(({x1} {y1},{x2} {y1},{x2} {y2},{x1} {y2},{x1} {y1}))"))


@layer
def airport_polygon(cat):
    return cat("osm_aeroway_polygon").select("osm_id", name(), *blank("aerodrome_type", "amenity"), "class", "subclass", *blank("ele", "iata", "icao", "military", "operator", "surface"), area(), "geometry")


@layer
def airport_label(cat):
    """The longest runway of each airport.  Counts run over the joined rows, so a runway can count more than once."""
    a, ft = _airports(cat), c("runway_length_ft")
    n = lambda cond: F.count_if(cond)
    k = a.groupBy(c("airport_id").alias("__id")).agg(n(ft > 4000).alias("long"), n(ft.between(1500, 4000)).alias("medium"), F.count("*").alias("n"))
    large = c("osm_aerodrome_area") >= M2
    several = (c("long") == c("n")) | ((c("n") > 1) & (((c("long") == 1) & (c("medium") >= 1)) | (c("medium") > 1)))
    category = F.when(large, 1).when(several, 2).when((c("n") >= 1) & (c("long") == 0) & (c("medium") == 1), 3).otherwise(4)
    a = a.join(k, c("airport_id") == c("__id"), "left").withColumns({"category": category, "rank": F.when(c("type") == "closed", 2).otherwise(1)})
    if cat.runway_surfaces is not None:
        a = rel.looked_up(a, "runway_surface", cat.runway_surfaces, "__code")
        a = a.withColumn("runway_surface", F.coalesce("__code", "runway_surface")).drop("__code")
    else:
        a = a.withColumn("runway_surface", F.coalesce(tx.first_match(F.lower("runway_surface"), RUNWAY_RULES, F.lit(None).cast("string")), "runway_surface"))
    a = rel.distinct_on(a, ["airport_id"], [F.coalesce("runway_length_ft", F.lit(-1)).desc(), c("runway_le_ident").asc_nulls_last(), c("osm_id_runway").asc_nulls_last()])
    return a.drop("__id", "long", "medium", "n").where(~c("type").isin("heliport") & ~tx.any_ilike(c("name"), ["%helicopter%", "%helipad%", "%heliport%"]))


@layer
def heliport_point(cat):
    a = cat("ourairports_airports").where(~jts.contains(_box(-2, -2, 2, 2), "geometry"))
    heli = tx.any_ilike(c("name"), ["%helicopter%", "%helipad%", "%heliport%"])
    a = a.withColumns({"hospital": F.when(tx.any_ilike(c("name"), ["%hospital%", "%clinic%", "%emergency%", "%medic%"]), "y").otherwise("n"), "type": F.when(heli & (c("type") == "closed"), "closed_heliport").when(heli & ~c("type").isin("closed", "heliport"), "heliport").otherwise(c("type"))})
    rank = F.when(c("type") == "heliport", F.when(c("hospital") == "y", 1).otherwise(2)).when(c("hospital") == "y", 3).otherwise(4)
    a = a.where(c("type").isin("heliport", "closed_heliport"))
    return a.select(c("ident").alias("airport_ident"), "type", "name", "hospital", rank.alias("rank"), tx.blank_to_null(c("elevation_ft")).try_cast("float").alias("elevation_ft"), "scheduled_service", c("gps_code").alias("icao"), c("iata_code").alias("iata"), "local_code", "geometry")


@layer
def runway_line(cat):
    w = cat("osm_aeroway_linestring").withColumn("lifecycle_type", tg.lifecycle_type(c("class"), c("subclass"), c("tags"), "aeroway")).where(~c("lifecycle_type").isin("proposed", "planned"))
    return w.select("osm_id", *blank("ref"), F.lit("aeroway").alias("class"), tg.lifecycle_subject(c("class"), c("subclass"), c("tags"), "aeroway", F.lit("unknown")).alias("subclass"), "lifecycle_type", *blank("icao", "iata", "surface", "width", "ele"), length().alias("length_m"), *blank("military", "name", "operator"), "geometry")


# ---- dams

# Dam kinds, and materials by hardness.
DAMS = ["dam", "weir", "sluice_gate", "flood_gate"]
HARD = "asphalt cement cobblestone concrete concrete:lanes concrete:plates dam metal metal_grid paved paving_stones pebblestone rock sett stepping_stones stone unhewn_cobblestone wood concrete_faced roller_compacted_concrete masonry arch".split()
LOOSE = "compacted dirt earth fine_gravel grass gravel ground mud sand unpaved earth_fill rock_fill embankment earthen".split()


def _dam_source(df: DataFrame) -> DataFrame:
    said = F.lower(F.coalesce(tag("surface"), tag("material"), tag("dam:type")))
    return keyed(df.where(c("subclass").isin(DAMS)).select(name(), c("subclass").alias("fclass"), F.when(said.isin(HARD), "hard").when(said.isin(LOOSE), "loose").alias("tag_surface"), "geometry"))


def _road_surface(cat, dams: DataFrame, least: Column) -> DataFrame:
    """The surface of the roads that run along for ``least`` of the dam's extent, by the longest share."""
    h = cat("osm_highway_linestring").where(tx.blank_to_null(c("surface")).isNotNull())
    kind = F.when(F.lower("surface").rlike(PAVED_RULE), "hard").when(F.lower("surface").rlike(UNPAVED_RULE), "loose")
    h = jts.with_box(h.select(kind.alias("bucket"), "geometry").where(c("bucket").isNotNull()))
    x = spatial.grid_join(jts.with_box(dams.where(c("tag_surface").isNull()).select("__k", c("along").alias("geometry"))), h, 0.2, jts.intersects("a.geometry", "b.geometry"))
    x = x.groupBy(c("a.__k").alias("__k"), "b.bucket").agg(F.sum(jts.length(jts.intersection("b.geometry", "a.geometry"))).alias("total"))
    x = dams.join(rel.distinct_on(x, ["__k"], [c("total").desc(), c("bucket")]), "__k", "left")
    road = F.when(c("total") >= least, c("bucket"))
    return x.withColumns({"surface": F.coalesce("tag_surface", road), "surface_src": F.when(c("tag_surface").isNotNull(), "tag").when(road.isNotNull(), "highway")})


@layer
def dam_polygon(cat):
    d = _dam_source(cat("osm_water_polygon")).withColumn("along", c("geometry"))
    return _road_surface(cat, d, 0.25 * jts.perimeter("geometry")).select("name", "fclass", "surface", "surface_src", area(), "geometry")


@layer
def dam_line(cat):
    d = _dam_source(cat("osm_waterway_linestring")).withColumn("length", jts.length("geometry"))
    x = spatial.grid_join(jts.with_box(d.select("__k", "geometry")), jts.with_box(cat.layer("dam_polygon").select("geometry")), 0.2, jts.intersects("a.geometry", "b.geometry"))
    cover = x.groupBy(c("a.__k").alias("__k")).agg(F.sum(jts.length(jts.intersection("a.geometry", "b.geometry"))).alias("covered"))
    d = d.join(cover, "__k", "left").where((c("length") == 0) | (F.coalesce("covered", F.lit(0.0)) / F.nullif("length", F.lit(0.0)) <= 0.6))
    d = d.withColumn("along", jts.buffer_metres("geometry", 20.0))
    return _road_surface(cat, d, 0.5 * c("length")).select("name", "fclass", "surface", "surface_src", "length", "geometry")


def _by_water(cat, df: DataFrame) -> DataFrame:
    w = cat("osm_water_polygon").where(~c("subclass").isin(DAMS))
    l_ = cat("osm_waterway_linestring").where(~c("subclass").isin(DAMS))
    x = met(met(df, w, "__in"), l_, "__near", jts.dwithin("a.geometry", "b.geometry", 0.005), grow=0.005)
    return x.withColumn("water_intersect", F.when(c("__in") | c("__near"), "Y").otherwise("N")).drop("__in", "__near")


@layer
def dam_label(cat):
    said = F.lower(c("tags")["surface"])
    p = cat("osm_water_point").where(c("subclass").isin(DAMS))
    pts = p.where(tx.blank_to_null(c("name")).isNotNull()).select(c("id").cast("long").alias("fid"), name(), c("subclass").alias("fclass"), F.when(said.isin("asphalt", "cement", "concrete", "rock", "stone", "wood"), "hard").when(said.isin("dirt", "earth", "grass", "gravel", "mud", "sand"), "loose").alias("surface"), "geometry")
    pts = met(met(_by_water(cat, pts), cat.layer("dam_polygon"), "__s"), cat.layer("dam_line"), "__c")
    pts = pts.withColumn("dam_srf_crv_intersect", F.when(c("__s") | c("__c"), "Y").otherwise("N")).drop("__s", "__c")
    of = lambda df, g: df.select(F.lit(None).cast("long").alias("fid"), "name", "fclass", "surface", "water_intersect", F.lit("Y").alias("dam_srf_crv_intersect"), g)
    areas = met(cat.layer("dam_polygon").where(c("name").isNotNull()), p, "__p").where(~c("__p")).drop("__p")
    areas = of(_by_water(cat, areas), inside())
    lines = met(cat.layer("dam_line").where(c("name").isNotNull()), pts, "__p").where(~c("__p")).drop("__p")
    lines = of(_by_water(cat, lines), jts.interpolate("geometry", 0.5).alias("geometry"))
    lines = met(lines, areas, "__a", jts.dwithin("a.geometry", "b.geometry", 0.0001), grow=0.0001).where(~c("__a")).drop("__a")
    return union(pts, areas, lines)
