"""Layers that dissolve and generalise, and the label layers that match against gazetteers.

Lookup tables of the catalog: ``nga_country_abbrev`` (adm0_prefix, nga_name, nga_abbrev) and ``adm0_line_supplements``
(cc1, cc2, country2, label) are parameters of the deployment, not part of the code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jts
from ..functions import text as tx
from ..functions.zoom import bucket, zres
from ..operators import relational as rel
from ..operators import spatial
from ..operators.dissolve import union_tree
from ..operators.graph import connected_components, cut
from .layers import _box, blank, c, dumped, fixed, inside, layer, name, union

WORLD = (-180, -85.0511, 180, 85.0511)

# ---- built-up areas

BUILT_LAND = "residential commercial retail industrial railway brownfield depot garages civic_admin construction education fairground institutional".split()
BUILT_AMENITY = "school university kindergarten college library".split()
#: Square metres on the ground of the smallest town drawn.
TOWN = 13.72e6


def _k(g: Column | str) -> Column:
    """Mercator metres per metre at a plane geometry."""
    y = F.get(jts.bbox(jts.point_on_surface(jts.from_3857(g))), F.lit(1))
    return 1 / F.cos(F.radians(y))


def builtup_opened(cat) -> DataFrame:
    """Towns by morphology: opened by 150 m, closed by 200 m with touching ones united, holes under a town filled, smoothed."""
    o = cat("overture_land_cover").where("subtype = 'urban' and min_zoom = 8").where(c("geometry").isNotNull())
    b = jts.bbox("geometry")
    o = o.where((F.abs(F.get(b, F.lit(1))) < 85) & (F.abs(F.get(b, F.lit(3))) < 85) & (jts.area_spheroid("geometry") >= 70686))
    o = o.select(jts.to_3857("geometry").alias("g")).withColumn("k", _k("g"))
    grown = jts.buffer(jts.buffer(jts.buffer("g", -150 * c("k"), 4), 150 * c("k"), 4), 200 * c("k"), 4)
    o = o.where(~jts.is_empty(jts.buffer("g", -150 * c("k"), 4))).select(grown.alias("geometry"))
    o = cut(o.withColumn("id", F.xxhash64("geometry")).dropDuplicates(["id"]), "grown")
    x = jts.with_box(o)
    pairs = spatial.grid_join(x, x, 50000.0, (c("a.id") < c("b.id")) & jts.intersects("a.geometry", "b.geometry")).select(c("a.id").alias("a"), c("b.id").alias("b")).distinct()
    parts = connected_components(o.select("id"), pairs)
    d = union_tree(o.join(parts, "id"), ["component"], 0.001).withColumn("k", _k("geometry"))
    d = dumped(d.select("k", jts.buffer("geometry", -200 * c("k"), 4).alias("geometry"))).where(jts.area("geometry") / (c("k") * c("k")) >= TOWN)
    holes = F.filter(F.slice(jts.dump_rings("geometry"), 2, 1000000), lambda r: F.call_function("ct_area", r) / (c("k") * c("k")) >= TOWN)
    d = d.withColumn("geometry", jts.polygon("geometry", holes))
    smooth = jts.simplify(jts.buffer(jts.buffer(jts.buffer("geometry", 150 * c("k"), 8), -300 * c("k"), 8), 150 * c("k"), 8), 50 * c("k"))
    d = dumped(d.select("k", smooth.alias("geometry"))).where((jts.type_of("geometry") == "Polygon") & (jts.area("geometry") / (c("k") * c("k")) >= TOWN))
    return d.select(F.lit("overture").alias("class"), F.lit("urban").alias("subclass"), jts.area("geometry").cast("float").alias("area"), jts.from_3857("geometry").alias("geometry"))


@layer
def builtup_polygon(cat):
    b = cat("osm_builtup_area").where(c("geometry").isNotNull() & (((c("class") == "landuse") & c("subclass").isin(BUILT_LAND)) | ((c("class") == "amenity") & c("subclass").isin(BUILT_AMENITY))))
    b = dumped(b.select(F.lit("osm").alias("class"), "subclass", jts.area_mercator("geometry").cast("float").alias("area"), fixed().alias("geometry")))
    return builtup_opened(cat).unionByName(b)


# ---- land cover

# Land covers drawn, by groups that share a zoom rule.
BARE = "bare_rock beach dune dune_system glacier sand scree shingle shoal".split()
WET = "bog fen mangrove marsh reedbed salt_flat saltmarsh string_bog swamp tidalflat unknown_wetland wet_meadow".split()
TREES = ["wood", "forest"]
OTHER_COVER = "fell flowerbed grass grassland heath meadow reef scrub tundra village_green allotments farm farmland orchard paddy rice plant_nursery vineyard".split()
WETLANDS = "mangrove bog marsh swamp fen saltmarsh reedbed wet_meadow tidalflat string_bog".split()
LEAVES = [("^broad", "broadleaved"), ("^con", "coniferous"), ("^dec", "deciduous"), ("^leaf", "leafless"), ("^mix", "mixed"), ("^needle", "needleleaved")]
KINDS = ["subclass", "leaf_type", "leaf_cycle", "intermittent"]
#: Side of the cells in which unions start, in plane metres.
CELL = 100_000.0


def landcover_source(cat) -> DataFrame:
    l_ = cat("osm_landcover_polygon").where(jts.type_of("geometry").isin("Polygon", "MultiPolygon"))
    leaf = tx.first_match(c("leaf_type"), LEAVES, F.lit(None).cast("string"))
    said = F.when(c("leaf_cycle").isin("deciduous", "semi_deciduous"), "deciduous").when(c("leaf_cycle").isin("evergreen", "semi_evergreen"), "evergreen").when(c("leaf_cycle").rlike("^m"), "mixed")
    implied = F.when(leaf.isin("coniferous", "needleleaved"), "evergreen").when(leaf.isin("deciduous", "broadleaved", "leafless"), "deciduous").when(leaf == "mixed", "mixed")
    wet = F.when(c("wetland").isin(WETLANDS), c("wetland")).when(c("wetland") == "saltern", "salt_flat").otherwise("unknown_wetland")
    l_ = l_.select(
        "osm_id", *blank("name", "name_en", trim=True), leaf.alias("leaf_type"), F.coalesce(said, implied).alias("leaf_cycle"), F.when(c("subclass") == "wetland", wet).otherwise(c("subclass")).alias("subclass"),
        F.when(c("is_seasonal") | c("is_intermittent"), True).alias("intermittent"), jts.npoints("geometry").alias("vertices"), jts.to_3857("geometry").alias("geometry"),
    ).withColumn("exact", jts.area("geometry"))
    drawn = c("subclass").isin(BARE + WET + TREES + OTHER_COVER)
    return l_.where(drawn & (c("subclass").isin("reef", "shoal", "flowerbed") | (c("exact") > zres(13) ** 2))).withColumn("area", c("exact").cast("float")).drop("exact")


def dissolve_touching(src: DataFrame, keys: list[str]) -> DataFrame:
    """Union within cells, then of the pieces that touch a piece of another cell, cluster by cluster, by a tree."""
    b = jts.bbox("geometry")
    mid = lambda i, j: F.floor((F.get(b, F.lit(i)) + F.get(b, F.lit(j))) / 2 / CELL).cast("int")
    one = union_tree(src.withColumns({"own_x": mid(0, 2), "own_y": mid(1, 3)}), [*keys, "own_x", "own_y"], 0.001)
    one = dumped(one).where(jts.dimension("geometry") == 2)
    one = cut(one.withColumn("id", F.xxhash64("geometry", *keys)), "pieces")
    x = jts.with_box(one)
    equal = reduce(lambda p, q: p & q, [c(f"a.{k}").eqNullSafe(c(f"b.{k}")) for k in keys])
    apart = (c("a.own_x") != c("b.own_x")) | (c("a.own_y") != c("b.own_y"))
    pairs = spatial.grid_join(x, x, 0.0, (c("a.id") < c("b.id")) & apart & equal & jts.intersects("a.geometry", "b.geometry")).select(c("a.id").alias("a"), c("b.id").alias("b")).distinct()
    pairs = cut(pairs, "touching")
    parts = connected_components(pairs.select(c("a").alias("id")).union(pairs.select("b")), pairs)
    joined = union_tree(one.join(parts, "id"), [*keys, "component"], 0.001)
    joined = dumped(joined).where(jts.dimension("geometry") == 2).select(*keys, "geometry")
    return one.join(parts, "id", "left_anti").select(*keys, "geometry").unionByName(joined)


@layer
def landcover_polygon(cat):
    """Ten levels: each simplified from the one below, then what the level unites is dissolved, the rest passes."""
    z = landcover_source(cat).select(*KINDS, "vertices", jts.make_valid("geometry").alias("geometry"))
    small_trees = c("subclass").isin(TREES) & (c("vertices") < 300)
    levels = []
    for level in range(13, 3, -1):
        if level < 13:
            z = z.where(jts.area("geometry") > zres(level - 1) ** 2).withColumn("geometry", jts.make_valid(jts.simplify_vw("geometry", zres(level) ** 2)))
        z = cut(z, f"level{level}")
        if level >= 10:
            united, passed = small_trees, ~small_trees
        elif level >= 8:
            united, passed = c("subclass").isin(TREES), ~c("subclass").isin(TREES)
        elif level == 7:
            united, passed = F.lit(True), None
        else:
            united, passed = c("subclass").isin(BARE + WET if level == 6 else BARE), None
        parts = [dissolve_touching(z.where(united & ~jts.is_empty("geometry")).select(*KINDS, jts.polygons("geometry").alias("geometry")), KINDS)]
        if passed is not None:
            parts.append(dumped(z.where(passed).select(*KINDS, jts.polygons("geometry").alias("geometry"))).where(jts.dimension("geometry") == 2))
        levels.append(union(*parts).withColumn("z_level", F.lit(level)))
    out = reduce(DataFrame.unionByName, levels).withColumn("geometry", jts.from_3857("geometry"))
    return out.withColumn("area", jts.area_spheroid("geometry").cast("float")).where("area > 1")


@layer
def landcover_label(cat):
    l_ = landcover_source(cat).where(c("name").isNotNull() | c("name_en").isNotNull())
    return l_.select("osm_id", name(), *KINDS, "area", bucket(c("area"), [(z, z) for z in range(4, 12)], 12).alias("z_level"), jts.point_on_surface(jts.from_3857("geometry")).alias("geometry"))


@layer
def landcover_small_polygon(cat):
    """Small-scale land cover less the towns, on levels 4 to 7; small holes are filled unless a town lies in them."""
    o = cat("overture_land_cover")
    towns = builtup_opened(cat).select("geometry")
    band = dumped(o.where("max_zoom <= 7 and subtype <> 'urban'").select(F.when(c("subtype") == "snow", "ice").otherwise(c("subtype")).alias("subclass"), jts.make_valid("geometry").alias("geometry"))).where(jts.type_of("geometry") == "Polygon")
    band = cut(band.withColumn("id", F.xxhash64("subclass", "geometry")).dropDuplicates(["id"]), "band")
    x = spatial.grid_join(jts.with_box(band), jts.with_box(towns), 1.0, jts.intersects("a.geometry", "b.geometry")).groupBy(c("a.id").alias("hit")).agg(jts.union_all(F.collect_list("b.geometry")).alias("town"))
    x = band.join(x, c("id") == c("hit"), "left").withColumn("geometry", F.when(c("town").isNull(), c("geometry")).otherwise(jts.difference("geometry", "town")))
    x = dumped(x.select("subclass", "geometry")).where(jts.type_of("geometry") == "Polygon")
    x = cut(x.withColumn("id", F.xxhash64("subclass", "geometry")).dropDuplicates(["id"]), "small")
    merc = lambda g: jts.area_mercator(jts.intersection(g, _box(*WORLD)))
    rings = x.select("id", F.posexplode(jts.dump_rings("geometry")).alias("ring_at", "geometry")).where("ring_at > 0").withColumns({"m": merc("geometry"), "ring_id": F.xxhash64("geometry")})
    built = union(o.where("max_zoom <= 7 and subtype = 'urban'").select("geometry"), towns)
    held = spatial.grid_join(jts.with_box(rings.select("ring_id", jts.point_on_surface("geometry").alias("geometry"))), jts.with_box(built), 1.0, jts.intersects("a.geometry", "b.geometry")).select(c("a.ring_id").alias("town_ring")).distinct()
    rings = rings.join(held, c("ring_id") == c("town_ring"), "left").groupBy(c("id").alias("of")).agg(F.collect_list(F.struct("geometry", "m", c("town_ring").isNotNull().alias("town"))).alias("rings"))
    x = x.withColumn("m", merc("geometry")).join(rings, c("id") == c("of"), "left")
    levels = [(z, (3 * zres(z)) ** 2) for z in range(4, 8)]
    x = rel.theta_levels(x, "m", levels).withColumn("least", reduce(lambda w, l_: (F if w is None else w).when(c("level") == l_[0], l_[1]), levels, None))
    kept = F.transform(F.filter(F.coalesce("rings", F.array().cast("array<struct<geometry:binary,m:double,town:boolean>>")), lambda r: r["town"] | (r["m"] >= c("least"))), lambda r: r["geometry"])
    return x.select("subclass", c("level").alias("z_level"), jts.polygon("geometry", kept).alias("geometry"))


# ---- names of waters

# Designation codes and their classes.
DESIGNATIONS = {
    "BAY": "bay(s)",
    "BGHT": "bight(s)",
    "BNK": "bank(s)",
    "BNKR": "stream bank",
    "BNKX": "section of bank",
    "BOG": "bog(s)",
    "BSND": "basin",
    "BSNP": "basin",
    "BSNU": "basin",
    "CAPG": "icecap",
    "CHN": "channel",
    "CHNL": "lake channel(s)",
    "CHNM": "marine channel",
    "CNFL": "confluence",
    "CNL": "canal",
    "CNLA": "aqueduct",
    "COVE": "cove(s)",
    "CRKT": "tidal creek(s)",
    "DOMG": "icecap dome",
    "DPRG": "icecap depression",
    "ESTY": "estuary",
    "FISH": "fishing area",
    "FJD": "fjord(s)",
    "FLLS": "waterfall(s)",
    "FLLSX": "section of waterfall(s)",
    "FLTM": "mud flat(s)",
    "FLTT": "tidal flat(s)",
    "GLCR": "glacier(s)",
    "GULF": "gulf",
    "GYSR": "geyser",
    "HBR": "harbor(s)",
    "HBRX": "section of harbor",
    "INLT": "inlet",
    "LBED": "lake bed(s)",
    "LGN": "lagoon(s)",
    "LGNX": "section of lagoon",
    "LK": "lake",
    "LKC": "crater lake(s)",
    "LKI": "intermittent lake(s)",
    "LKN": "salt lake(s)",
    "LKNI": "intermittent salt lake(s)",
    "LKO": "oxbow lake",
    "LKOI": "intermittent oxbow lake",
    "LKS": "lakes",
    "LKSB": "underground lake",
    "LKX": "section of lake",
    "MFGN": "salt evaporation ponds",
    "MGV": "mangrove swamp",
    "MOOR": "moor(s)",
    "MRSH": "marsh(es)",
    "MRSHN": "salt marsh",
    "NRWS": "narrows",
    "OCN": "ocean",
    "OVF": "overfalls",
    "PND": "pond(s)",
    "PNDI": "intermittent pond(s)",
    "PNDN": "salt pond(s)",
    "PNDNI": "intermittent salt pond(s)",
    "PNDSF": "fishponds",
    "POOL": "pool(s)",
    "POOLI": "intermittent pool",
    "RCH": "reach",
    "RDGG": "icecap ridge",
    "RDST": "roadstead",
    "RF": "reef(s)",
    "RFC": "coral reef(s)",
    "RFX": "section of reef",
    "RPDS": "rapids",
    "RSV": "reservoir(s)",
    "RSVI": "intermittent reservoir",
    "RSVT": "water tank",
    "RVN": "ravine(s)",
    "SBKH": "sabkha(s)",
    "SD": "sound",
    "SEA": "sea",
    "SHOL": "shoal(s)",
    "SPNG": "spring(s)",
    "SPNS": "sulphur spring(s)",
    "SPNT": "hot spring(s)",
    "STM": "stream(s)",
    "STMA": "anabranch",
    "STMB": "stream bend",
    "STMC": "canalized stream",
    "STMD": "distributary(-ies)",
    "STMH": "headwaters",
    "STMI": "intermittent stream",
    "STMIX": "section of intermittent stream",
    "STMM": "stream mouth(s)",
    "STMQ": "abandoned watercourse",
    "STMSB": "lost river",
    "STMX": "section of stream",
    "STRT": "strait",
    "SWMP": "swamp",
    "SYSI": "irrigation system",
    "TNLC": "canal tunnel",
    "WAD": "wadi(s)",
    "WADB": "wadi bend",
    "WADJ": "wadi junction",
    "WADM": "wadi mouth",
    "WADX": "section of wadi",
    "WHRL": "whirlpool",
    "WLL": "water well(s)",
    "WLLQ": "abandoned well",
    "WTLD": "wetland",
    "WTLDI": "intermittent wetland",
    "WTRH": "waterhole(s)",
}
USGS = {"Stream": "STM", "Reservoir": "RSV", "Lake": "LK", "Spring": "SPNG", "Canal": "CNL", "Bay": "BAY", "Swamp": "SWMP", "Basin": "BSND", "Channel": "CHN", "Gut": "NRWS", "Bend": "STMB", "Falls": "FLLS", "Rapids": "RPDS", "Glacier": "GLCR", "Arroyo": "WAD", "Sea": "SEA"}
MARINE = {"ocean": "OCN", "sea": "SEA", "bay": "BAY", "gulf": "GULF", "lake": "LK"}
LAKES = {"lake": "LK", "intermittent lake": "LKI", "reservoir": "RSV", "alkaline lake": "LK"}
#: Label points set by hand (ne_id: lon, lat; None: a point inside), and lowest zooms set by hand.
LABEL_AT = {1159115321: (20.0, 35.0), 1159115379: (-75.0, 15.0), 1159115461: (50.8, 42.0), 1159115597: (51.5, 27.0), 1159116395: (38.4, 65.7), 1159123979: (-110.81, 37.33), 1159123963: (-114.40, 36.15), 1159116479: None, 1159119119: None, 1159119141: None, 1159116815: None, 1159113185: None, 1159113081: None}
LABEL_FROM = {1159126643: 5.0, 1159126435: 5.0, 1159126693: 6.0, 1159126681: 6.0}


def _lookup(of: Column, pairs: dict, other=None) -> Column:
    """A literal map: one hash probe, however many entries."""
    m = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.coalesce(F.try_element_at(m, of), F.lit(other)) if other is not None else F.try_element_at(m, of)


@layer
def hydrographic_label(cat):
    none = lambda **k: [F.lit(None).cast(t).alias(n) for n, t in k.items()]
    ne_id = c("ne_id").cast("bigint")
    placed = {k: v for k, v in LABEL_AT.items() if v}
    at = jts.point(_lookup(ne_id, {k: v[0] for k, v in placed.items()}), _lookup(ne_id, {k: v[1] for k, v in placed.items()}))
    deep = jts.from_3857(jts.inscribed_circle(jts.to_3857(jts.intersection("geometry", _box(*WORLD)))))
    n = cat("ne_10m_geography_marine_polys").where(tx.blank_to_null(c("name")).isNotNull() & F.lower("featurecla").isin(*MARINE))
    n = n.select(F.when(c("name").ilike("Gulf of Mexico"), "Gulf of America").otherwise(c("name")).alias("name"), _lookup(F.lower("featurecla"), MARINE).alias("desig_cd"), *none(name_rank="string", display="string"), c("scalerank").cast("int").alias("scalerank"), c("min_label").cast("double").alias("min_label"), F.coalesce(at, F.when(ne_id.isin(*LABEL_AT) | (F.lower("featurecla") == "ocean"), jts.point_on_surface("geometry")).otherwise(deep)).alias("geometry"))
    k = cat("ne_10m_lakes").where(tx.blank_to_null(c("name")).isNotNull() & F.lower("featurecla").isin(*LAKES) & c("scalerank").isNotNull())
    k = k.select("name", _lookup(F.lower("featurecla"), LAKES).alias("desig_cd"), *none(name_rank="string", display="string"), c("scalerank").cast("int").alias("scalerank"), F.coalesce(_lookup(ne_id, LABEL_FROM), c("min_label").cast("double")).alias("min_label"), F.coalesce(at, F.when(ne_id.isin(*LABEL_AT), jts.point_on_surface("geometry")).otherwise(deep)).alias("geometry"))
    g = cat("nga_geonames_hydrographic").where(c("nt").isin("N", "C", "D"))
    kind = F.when(c("nt") == "C", 1).when(c("nt") == "N", 2).otherwise(3) + F.when(c("full_nm_nd").isNull(), 3).otherwise(0)
    g = rel.distinct_on(g, ["geometry"], [kind, c("full_nm_nd"), c("desig_cd")])
    g = g.select(c("full_nm_nd").alias("name"), "desig_cd", c("name_rank").cast("string").alias("name_rank"), c("display").cast("string").alias("display"), *none(scalerank="int", min_label="double"), "geometry")
    u = cat("usgs_domestic_names").where(c("feature_class").isin(*USGS) & (c("bgn_type") == "Official") & tx.blank_to_null(c("feature_name")).isNotNull() & ~jts.contains(_box(-2, -2, 2, 2), "geometry"))
    u = u.select(c("feature_name").alias("name"), _lookup(c("feature_class"), USGS).alias("desig_cd"), *none(name_rank="string", display="string", scalerank="int", min_label="double"), "geometry")
    known = n.select("name").union(k.select("name")).select(F.lower("name").alias("known")).distinct()
    rest = rel.anti(g.unionByName(u), known, F.lower("name") == c("known"))
    out = union(n, k, rest)
    return out.select(F.when(c("name").ilike("Lake Ontario"), "Lake America").otherwise(c("name")).alias("name"), "desig_cd", _lookup(c("desig_cd"), DESIGNATIONS).alias("class"), "name_rank", "display", "scalerank", "min_label", "geometry")


# ---- places

# Capitals set by hand, names of islands, a place left out.
PRIMARY, SECONDARY = [60715062, 266478791, 26576175, 50794342], [1776467369, 313764484, 315390382, 301351574, 4415037938, 1046100133, 2872238032, 235857686, 32675806, 26938845, 3275779630]
ISLANDS = {468798441: "Abu Musa", -2103185: "Etorofu", -2409701: "Kunashiri", -9687998: "Habomai"}
LEFT_OUT = 12350920517
SPELLINGS = [("ft. ", "fort "), ("st. ", "saint "), ("-e-", " ")]


def _capital(by_hand: bool) -> Column:
    tagged = F.when(c("capital") == "yes", 2).when(c("capital").isin("2", "3", "5", "6"), c("capital").try_cast("int")).when(c("capital") == "4", 3)
    if by_hand:
        tagged = F.when(c("osm_id").isin(PRIMARY), 2).when(c("osm_id").isin(SECONDARY), 1).otherwise(tagged)
    return F.when(F.coalesce(c("name_en") == "Taipei", F.lit(False)), F.lit(None).cast("int")).otherwise(tagged)


def _names(*cols: str) -> Column:
    return F.array_distinct(F.array_compact(F.array(*(F.lower(x) for x in cols))))


def _near_by_name(left: DataFrame, right: DataFrame, within: float) -> DataFrame:
    """Pairs of a key in common within a distance in degrees: an equi-join on exploded keys, then the distance."""
    a = left.select("osm_id", c("geometry").alias("ag"), F.explode("keys").alias("key"))
    b = right.withColumn("key", F.explode("keys")).drop("keys")
    return a.join(b, "key").where(jts.dwithin("ag", "geometry", within)).withColumn("far", jts.distance("ag", "geometry"))


@layer
def place_labels(cat):
    city = cat("osm_city_point")
    o = city.where(c("place").isin("city", "town") & (c("osm_id") != LEFT_OUT)).withColumn("cap", _capital(True))
    keyed = o.select("osm_id", "geometry", _names("name", "name_en").alias("keys"))
    g = cat("nga_geonames_populated_places")
    live = g.where(c("term_dt_f").isNull() | (c("term_dt_f") == "")).select("ufi", "geometry", _names("full_nm_nd").alias("keys"))
    ufi = rel.distinct_on(_near_by_name(keyed, live, 0.5), ["osm_id"], [c("far"), c("ufi")]).select("osm_id", "ufi")
    code = reduce(lambda w, kv: (F if w is None else w).when(c("desig_cd") == kv[1], kv[0]), enumerate(["PPLC", "PPLCD", "PPL", "PPLA", "PPLA2", "PPLA3"]), None).otherwise(9)
    best = g.where((c("name_rank").cast("string") == "1") & c("nt").isin("C", "N")).select("ufi", "desig_cd", "nt", "full_nm_nd", "display")
    best = rel.distinct_on(ufi.join(best, "ufi"), ["osm_id"], [F.when(c("nt") == "C", 1).otherwise(2), code, c("full_nm_nd"), c("display")])
    best = best.select(c("osm_id").alias("g_id"), "desig_cd", tx.blank_to_null(F.split_part("display", F.lit(","), F.lit(-1))).try_cast("int").alias("display_max"), F.when(c("nt") == "C", tx.blank_to_null(c("full_nm_nd"))).alias("bgn_name"))
    n = cat("ne_10m_populated_places")
    low = F.lower("nameascii")
    before_comma = lambda v: F.split_part(v, F.lit(","), F.lit(1))
    loose = [*(F.replace(low, F.lit(p), F.lit(q)) for p, q in SPELLINGS), before_comma(F.lower("name")), before_comma(low)]
    n = n.select("rank_max", "pop_max", "geometry", _names("name", "nameascii").alias("exact"), F.array_distinct(F.array_compact(F.array(F.lower("name"), low, *loose))).alias("keys"))
    m = _near_by_name(keyed, n, 0.1)
    m = rel.distinct_on(m, ["osm_id"], [F.when(F.array_contains("exact", c("key")), 0).otherwise(1), c("rank_max").desc_nulls_first(), c("far"), c("pop_max").desc_nulls_last()]).select(c("osm_id").alias("n_id"), "rank_max", "pop_max")
    o = o.join(best, c("osm_id") == c("g_id"), "left").join(m, c("osm_id") == c("n_id"), "left")
    own, is_city, top = tx.name_of(c("name_en"), c("name")), c("place") == "city", c("rank_max")
    other = ~c("name_en").ilike("Irvine")
    rank = (
        F.when((c("name_en") == "Taipei") | (top >= 14) | ((c("desig_cd") == "PPLC") & (top >= 13)), 1)
        .when((top == 13) | (c("desig_cd") == "PPLC") | (c("capital") == "yes") | (c("cap") == 2) | c("name_en").ilike("Brussels"), 2)
        .when((c("capital") == "3") & (top >= 11), 3)
        .when((top == 12) & (c("pop_max") >= 3000000) & other, 2).when((top == 12) & (c("pop_max") >= 1500000) & other, 3).when(top == 12, 4)
        .when(top.isin(10, 11), F.when(is_city | (c("pop_max") >= 400000), 5).otherwise(6)).when(top.isin(8, 9), 6).when(top.isin(6, 7), 7).when(top == 5, 8)
        .when(c("display_max") >= 7, F.when(is_city, 8).otherwise(9)).when(c("display_max") >= 5, F.when(is_city, 8).otherwise(10))
    )
    role = F.when(c("cap") == 2, "primary").when(c("cap") == 1, "secondary").alias("capital_role")
    renamed = F.when(c("bgn_name").isNotNull() & (F.lower("bgn_name") != F.lower(F.coalesce(own, F.lit("")))), c("bgn_name")).otherwise(own)
    cities = o.select("osm_id", renamed.alias("name"), c("place").alias("class"), F.when(is_city, 1).otherwise(2).alias("class_rank"), c("cap").alias("capital"), role, F.coalesce(rank, F.when(is_city, 8).otherwise(10)).alias("rank"), "geometry")
    s = city.where(c("place").isin("village", "hamlet", "suburb", "neighbourhood")).withColumn("cap", _capital(False))
    small = s.select("osm_id", name(), c("place").alias("class"), _lookup(c("place"), {"village": 3, "suburb": 4, "neighbourhood": 5, "hamlet": 6}).alias("class_rank"), c("cap").alias("capital"), role, F.lit(11).alias("rank"), "geometry")
    shape = cat("osm_island_polygon").where(tx.blank_to_null(c("name")).isNotNull())
    m2 = jts.area_spheroid("geometry")
    rank = reduce(lambda w, kv: (F if w is None else w).when(m2 >= kv[1], kv[0]), enumerate([1e12, 1e11, 8e9, 1e9, 1e8, 1e7], 1), None).otherwise(7)
    isles = shape.select("osm_id", F.coalesce(_lookup(c("osm_id"), ISLANDS), tx.name_of(c("name_en"), c("name"))).alias("name"), F.lit("island").alias("class"), rank.alias("rank"), jts.point_on_surface(jts.make_valid("geometry")).alias("geometry"))
    p = cat("osm_island_point").where(tx.blank_to_null(c("name")).isNotNull())
    # equal keys only of the same kind: name with name, English name with English name
    tell = lambda d: d.withColumn("keys", F.array_compact(F.array(F.concat(F.lit("n:"), F.lower("name")), F.concat(F.lit("e:"), F.lower(tx.blank_to_null(c("name_en")))))))
    same = _near_by_name(tell(p), tell(shape.select("name", "name_en", "geometry")), 0.1).select(c("osm_id").alias("drawn")).distinct()
    spots = rel.anti(p, same, c("osm_id") == c("drawn")).select("osm_id", name(), F.lit("island").alias("class"), F.lit(7).alias("rank"), "geometry")
    groups = cat("ne_10m_geography_regions_polys").where((c("featurecla") == "Island group") & tx.blank_to_null(c("name")).isNotNull())
    groups = groups.select(name(), F.lit("island_group").alias("class"), (c("scalerank") + 1).cast("int").alias("rank"), jts.point_on_surface(jts.make_valid("geometry")).alias("geometry"))
    return union(cities, small, isles, spots, groups)


# ---- borders

# Country remarks in capitals; kinds of country entries, departments shown as such.
REMARKS = [("(Fr.)", "(FR.)"), ("(Nor.)", "(NOR.)"), ("(Aust.)", "(AUST.)"), ("(Den.)", "(DEN.)"), ("(Neth.)", "(NETH.)"), ("(Port.)", "(PORT.)"), ("(Sp.)", "(SP.)"), ("(Fin.)", "(FIN.)"), ("(Jam.)", "(JAM.)"), ("(Ven.)", "(VEN.)"), ("(UK)", "(U.K.)"), ("(USA)", "(U.S.)"), ("(NZ)", "(N.Z.)"), ("(SA)", "(S. AFR.)")]
COUNTRY_CODES = ["PCLI", "PCLD", "PCLF", "PCLS", "PCL", "PCLIX"]
DEPARTMENTS = ["GLP", "GUF", "MTQ", "MYT", "REU"]


@layer
def adm0_line(cat):
    """Lines whose pair of countries is in the reference boundaries, in either order, or that are listed."""
    f = cat("fieldmaps_adm0_lines").withColumn("__id", F.xxhash64("cc1", "cc2", "country1", "country2", "label", "geometry")).withColumns({"lo": F.least("cc1", "cc2"), "hi": F.greatest("cc1", "cc2")})
    pair = cat("dos_lsib").select(*rel.unordered_pair("cc1", "cc2")).distinct()
    told = cat("adm0_line_supplements").select("cc1", "cc2", "country2", "label").distinct()
    keep = f.join(pair, ["lo", "hi"], "left_semi").select("__id").union(f.join(told, ["cc1", "cc2", "country2", "label"], "left_semi").select("__id")).distinct()
    return f.join(keep, "__id", "left_semi").select(*blank("cc1", "cc2", "country1", "country2", "label", "notes"), "rank", *blank("status"), "geometry")


def _drawn(cat, df: DataFrame, iso: str = "iso_2") -> DataFrame:
    """Without countries that have border lines of which none is drawn."""
    both = lambda d: d.select(F.explode(F.array("cc1", "cc2")).alias("cc")).distinct()
    hidden = both(cat("fieldmaps_adm0_lines")).join(both(cat.layer("adm0_line")), "cc", "left_anti")
    return df.join(hidden, c(iso) == c("cc"), "left_anti")


@layer
def adm0_label(cat):
    r = cat("nga_geonames_administrative_regions").where(c("name_rank").cast("string") == "1")
    s = r.where(c("desig_cd").isin(COUNTRY_CODES) & (c("term_dt_f").isNull() | (c("term_dt_f") == "")) & (c("cc_ft") != "ATF"))
    s = rel.distinct_on(s, ["cc_ft"], [F.when(c("desig_cd") == "PCLI", 1).when(c("desig_cd") == "PCLD", 2).otherwise(3), F.when(c("nt") == "C", 1).when(c("nt") == "N", 2).otherwise(3), c("full_nm_nd")]).select(c("cc_ft").alias("s_cc"), c("full_nm_nd").alias("short"))
    iso = F.left("adm0_id", F.lit(3))
    a = cat("fieldmaps_adm0_points").where(c("geometry").isNotNull()).withColumn("iso_3", iso).where(~c("iso_3").isin("XKK", "XAC"))
    a = _drawn(cat, a)
    g = r.select(c("full_nm_nd").alias("g_name"), c("cc_ft").alias("g_cc"), c("name_rank").alias("gns_name_rank"), c("desig_cd").alias("g_code"))
    n = cat("ne_10m_admin_0_countries").select(*(c(x).alias(f"n_{x}") for x in ("abbrev", "formal_en", "name", "name_en", "name_long")))
    nga = cat("nga_country_abbrev").select(c("adm0_prefix"), "nga_name", "nga_abbrev")
    poly = cat("fieldmaps_adm0_polygon").select(c("adm0_id").alias("p_id"), jts.area_mercator("geometry").cast("float").alias("area"))
    x = a.join(poly, c("adm0_id") == c("p_id"), "left").join(s, c("iso_3") == c("s_cc"), "left").join(g, (c("g_name") == c("adm0_name1")) & (c("g_cc") == c("iso_3")), "left").join(n, c("n_name") == c("adm0_name1"), "left")
    x = x.join(nga, (c("adm0_prefix") == c("iso_3")) & (F.substring("adm0_id", 4, 1) == "-"), "left")
    special = lambda other: tx.replace_all(F.when(c("iso_3") == "XAB", "Abyei Area").otherwise(other), REMARKS)
    tail = F.regexp_substr(tx.replace_all(c("adm0_name"), REMARKS), F.lit(r"\([A-Z][A-Z. ]+\)$"))
    return x.select(
        "adm0_id", "iso_3", "iso_2", special(tx.blank_to_null(c("adm0_name"))).alias("adm0_name"), *blank("adm0_name1"), F.when(c("iso_3").isin(DEPARTMENTS), 98).otherwise(c("status_cd")).alias("status_cd"), *blank("status_nm"),
        special(F.coalesce("short", tx.blank_to_null(c("adm0_name1")))).alias("gns_short_name"), tx.blank_to_null(c("g_name")).alias("gns_full_name"), "gns_name_rank", tx.blank_to_null(c("g_code")).alias("gns_desig_cd"),
        *(tx.blank_to_null(c(f"n_{k}")).alias(f"ne_{k}") for k in ("abbrev", "formal_en", "name", "name_en", "name_long")), "nga_name", "nga_abbrev",
        F.when(c("nga_abbrev").isNotNull(), F.concat("nga_abbrev", F.coalesce(F.concat(F.lit(" "), tail), F.lit("")))).alias("nga_short_name"), "area", "geometry",
    )


def _lines(cat, table: str, *names: str) -> DataFrame:
    return _drawn(cat, cat(table).where(c("iso_2").isNotNull())).select("iso_2", "iso_3", *blank(*names), "status_cd", "geometry")


def _labels(cat, table: str, k: str) -> DataFrame:
    return _drawn(cat, cat(table).where(c("geometry").isNotNull())).select(f"{k}_id", *blank(f"{k}_name", f"{k}_name1"), "iso_3", *blank("src_lang", "src_lang1"), "geometry")


@layer
def adm1_line(cat):
    return _lines(cat, "fieldmaps_adm1_lines", "adm0_name")


@layer
def adm1_label(cat):
    return _labels(cat, "fieldmaps_adm1_points", "adm1")


@layer
def adm2_line(cat):
    return _lines(cat, "fieldmaps_adm2_lines", "adm0_name", "adm1_name")


@layer
def adm2_label(cat):
    return _labels(cat, "fieldmaps_adm2_points", "adm2")


def border_coincidence(cat, within: float = 100.0, step: float = 500.0) -> DataFrame:
    """Share of points, one every ``step`` metres, of each line that lie within ``within`` metres of a reference line."""
    f = cat("fieldmaps_adm0_lines").where("cc1 = 'Q2' or cc2 = 'Q2'").withColumn("id", F.xxhash64("cc1", "cc2", "country2", "label"))
    pts = f.select("id", F.posexplode(jts.dump_points(jts.segmentize_metres("geometry", step))).alias("at", "geometry")).withColumn("pt", F.xxhash64("id", "at"))
    near = spatial.grid_join(jts.with_box(pts.select("pt", "geometry")), jts.with_box(cat("dos_lsib").select("geometry")), 0.5, jts.dwithin_metres("a.geometry", "b.geometry", within), 0.02, "left_semi").select(c("pt").alias("hit")).distinct()
    x = pts.join(near, c("pt") == c("hit"), "left").groupBy("id").agg(F.round(100.0 * F.count("hit") / F.count("*"), 1).alias("pct"))
    return f.select("id", "cc1", "cc2", "country2", "label").join(x, "id")


_ = (Window, inside)
