"""Layers over feature tables that are made from all events by rules, each with its SQL.

A rule is an expression that both engines read; a feature table is its columns, its tags and a shape by the table's
name: a line of ``WIDTH`` degrees along the parallel, a box as wide and ``HEIGHT`` high, or a point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jts
from ..functions import text as tx
from ..functions.zoom import zres
from ..operators.graph import cut
from . import layers_land
from .catalogue import LAT, LON, query
from .layers import NUMBERED, PARKS, PAVED_RULE, POI, POWER_LINES, ROADS, RUNWAY_RULES, STATES, UNPAVED_RULE, WATER_RULES, Catalog
from .shapes import BELT, MEAN, ring

c = F.col
WIDTH, HEIGHT = 0.05, 0.04


def pick(*values: str, by: int = 1) -> str:
    return f"case event_id * {by} % {len(values)} " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(values)) + " end"


def flag(of: int, at: int = 0) -> str:
    return f"event_id % {of} = {at}"


NAMES = {"name": "case when event_id % 3 = 0 then '' else concat('N', cast(event_id % 50 as string)) end", "name_en": "case when event_id % 5 = 0 then concat('E', cast(event_id % 40 as string)) else '' end"}
#: Columns and tags of the feature tables by rule.
TABLES: dict[str, tuple[dict[str, str], dict[str, str]]] = {
    "osm_highway_linestring": (
        NAMES | {
            "class": "'highway'", "subclass": pick("motorway", "primary", "minor", "construction", "proposed", "track", "cafe", "secondary_link", "steps"), "ref": pick("I 95", "US 1", "", "XY 7;8", "NY 17 Bus", "A 7", by=7), "network": pick("", "US:CA", "", "e-road", by=3),
            "surface": pick("asphalt", "gravel", "", "lava", " Paved ", "tar sealed road", "unpaved"), "lanes": pick("1", "2", "", "9", "two"), "is_area": flag(11), "is_bridge": flag(3), "is_tunnel": flag(4), "is_ford": flag(5),
        },
        {"construction": pick("primary", "yes", "", by=2), "disused": pick("yes", "no", "", "", by=3)},
    ),
    "osm_highway_relation": ({"member": "event_id", "route": "'road'", "network": pick("US:I", "US:NY", "", "e-road", "US:I:Historic", by=3), "ref": "'1'"}, {}),
    "osm_highway_polygon": (NAMES | {"class": pick("highway", "public_transport", "leisure"), "subclass": pick("platform", "footway", "steps", "park", by=3)}, {}),
    "osm_railway_linestring": (
        NAMES | {
            "class": pick("railway", "railway", "abandoned:railway", "railway"), "subclass": pick("rail", "tram", "disused", "proposed", "narrow_gauge", "razed"), "is_area": flag(13), "is_bridge": flag(4), "is_tunnel": flag(6), "is_ford": flag(9), "gauge": pick("1435", "1520", "narrow", "standard", "1000", by=3),
            "electrified": pick("contact_line", "no", "yes", "unknown"), "tracks": pick("1", "2", "", "single"), "ref": pick("R1", "", " R2 "),
        },
        {"disused": pick("rail", "yes", "", by=5)},
    ),
    "osm_shipway_linestring": (NAMES | {"class": "'shipway'", "subclass": pick("ferry", "route"), "short_name": pick("", "F"), "shipway": pick("ferry", "")}, {}),
    "osm_pier_linestring": (NAMES | {"class": "'man_made'", "subclass": pick("pier", "breakwater", "groyne")}, {"floating": pick("yes", "no", "", "FALSE", "0")}),
    "osm_pier_polygon": (NAMES | {"class": "'man_made'", "subclass": pick("pier", "breakwater", "groyne")}, {"floating": pick("yes", "no", "")}),
    "osm_barrier_linestring": (NAMES | {"subclass": pick("wall", "fence", "hedge")}, {}),
    "osm_barrier_point": (NAMES | {"subclass": pick("gate", "bollard")}, {}),
    "osm_building_polygon": (NAMES | {"building": pick("yes", "house", ""), "height": pick("", "12", "8 m"), "levels": pick("", "3")}, {}),
    "osm_poi_point": (NAMES | {"subclass": pick("hospital", "cafe", "kindergarten", "university", "police", "zoo"), "religion": pick("", "x")}, {}),
    "osm_poi_polygon": (NAMES | {"subclass": pick("school", "shop", "townhall"), "religion": "''"}, {}),
    "osm_water_point": (NAMES | {"subclass": pick("culvert", "spring", "dam"), "tunnel": pick("", "culvert", "yes", "", by=3)}, {}),
    "osm_waterway_linestring": (NAMES | {"class": "'waterway'", "subclass": pick("lock_gate", "river", "lock", "stream"), "is_intermittent": flag(3), "lock": pick("yes", ""), "lock_name": pick("", "L")}, {}),
    "osm_park_polygon": (NAMES | {"access": pick("", "private"), "class": "'leisure'", "subclass": pick("park", "nature_reserve", "zoo", "pitch", ""), "leisure": pick("park", "", "stadium", "garden"), "iucn_level": pick("", "II"), "protect_class": pick("", "2")}, {}),
    "osm_landuse_polygon": (NAMES | {"access": "''", "class": pick("landuse", ""), "subclass": pick("pitch", "cemetery", "farm")}, {}),
    "osm_utility_linestring": (NAMES | {"class": pick("man_made", "pipeline", "power"), "subclass": pick("pipeline", "line", "goods_conveyor", "cable"), "seamark_type": pick("", "", "pipeline_submarine", "cable_submarine", ""), "location": pick("", "underground"), "substance": pick("gas", "", "oil")}, {}),
    "osm_utility_polygon": (NAMES | {"class": pick("power", "man_made"), "subclass": pick("plant", "plant_part", "substation", "pumping_station"), "operator": pick("", "Op"), "substance": pick("gas", ""), "substation": pick("", "yes"), "pumping_station": pick("", "water")}, {}),
    "osm_transportation_polygon": (NAMES | {"class": pick("railway", "public_transport"), "subclass": pick("station", "platform", "yard", "halt", "ferry_terminal"), "operator": pick("", "DB"), "station": pick("", "subway"), "service": pick("", "yard", "siding"), "yard_size": pick("Very Large yard", "small", "", "huge", "MEDIUM", by=3)}, {"platforms": pick("", "4")}),
    "osm_transportation_point": (NAMES | {"class": "'railway'", "subclass": pick("yard", "station"), "service": pick("", "yard"), "yard_size": pick("large", "very small", "")}, {}),
    "osm_aeroway_polygon": (NAMES | {"class": "'aeroway'", "subclass": pick("aerodrome", "apron"), "iata": pick("", "ABC"), "icao": pick("", "EDDX"), "surface": pick("asphalt", "")}, {}),
    "osm_aeroway_linestring": ({"class": pick("aeroway", "disused:aeroway", "aeroway"), "subclass": pick("runway", "taxiway", "construction", "planned"), "ref": pick("07/25", ""), "name": "''", "surface": pick("asphalt", "")}, {"construction": pick("runway", "yes", by=3)}),
    "osm_water_polygon": (NAMES | {"subclass": pick("lake", "intermittent", "Oxbow lake", "wadi", "seasonal", "", "canal river"), "intermittent": flag(3)}, {}),
    "ourairports_airports": ({"ident": "concat('X', cast(event_id as string))", "type": pick("small_airport", "heliport", "closed", "large_airport", "medium_airport"), "name": pick("City", "Royal Helipad", "Field", "Heliport X", "Base", "Strip", "Port"), "elevation_ft": pick("12", "", "x")}, {}),
    "ne_physical_centerlines": ({"name": NAMES["name"], "name_en": NAMES["name_en"], "featurecla": pick("Range", ""), "scalerank": "cast(event_id % 5 as int)", "min_label": "cast(event_id % 7 as double)", "max_label": "cast(event_id % 7 + 3 as double)"}, {}),
}
#: Text columns that layers read and rules leave empty.
EMPTY = """access aerodrome_type aeroway amenity bicycle bridge_name brand cables content condition destroyed_bridge diameter ele electrified expressway flow_direction foot frequency gauge horse iata icao is_oneway is_ramp layer level location
military network operational_status operator pipeline_overhead_category pipeline_overhead_product pipeline_submarine_category pipeline_submarine_product product ref resource route seamark_type service shipway short_name source surface toll tracks tunnel_name usage voltage width
yard_purpose generator_source generator_method generator_output generator_type generator_plant plant_source plant_method plant_output plant_type plant_storage height station substation substance pumping_station start_date rotor_diameter manufacturer is_bridge is_ford is_tunnel""".split()

AIRPORTS = "gps_code iata_code local_code continent iso_country iso_region municipality scheduled_service".split()


def table_of(t, name: str) -> DataFrame:
    columns, tags = TABLES[name]
    x = t("events").selectExpr("event_id", f"{LON} as lon", f"{LAT} as lat", *(f"{e} as `{n}`" for n, e in columns.items()), *(f"{e} as `tag:{k}`" for k, e in tags.items()))
    tag_map = F.create_map(*(y for k in tags for y in (F.lit(k), c(f"`tag:{k}`")))) if tags else F.create_map().cast("map<string,string>")
    shape = ring(c("lon"), c("lat"), F.lit(WIDTH), F.lit(HEIGHT))
    if name.endswith("linestring") or name == "ne_physical_centerlines":
        shape = F.concat(F.lit("LINESTRING("), F.concat_ws(" ", "lon", "lat"), F.lit(","), F.concat_ws(" ", (c("lon") + WIDTH).cast("string"), "lat"), F.lit(")"))
    elif name.endswith("point"):
        shape = F.concat(F.lit("POINT("), F.concat_ws(" ", "lon", "lat"), F.lit(")"))
    x = x.withColumn("tags", tag_map).drop(*(f"tag:{k}" for k in tags))
    rest = [F.lit("").alias(n) for n in (AIRPORTS if name.startswith("ourairports") else EMPTY) if n not in columns]
    return x.select(c("event_id").alias("id"), c("event_id").alias("osm_id"), *columns, "tags", *rest, jts.from_wkt(shape).alias("geometry"))


#: Two runways for every other airport, one for the rest.
RUNWAYS = [
    ("true", {"airport_ref": "event_id", "length_ft": pick("5000", "3000", "", "900", "4000", by=3), "surface": pick("ASPH-G", "TURF-F", "tarmac", "", "Lava", "Gravel/Turf"), "le_ident": "'07'"}),
    ("event_id % 2 = 0", {"airport_ref": "event_id", "length_ft": pick("1600", "4100", "12", by=5), "surface": pick("CON", "Grass over gravel", "brick"), "le_ident": "'18'"}),
]


def runways_sql() -> str:
    return " union all ".join("select " + ", ".join(f'{e} as "{n}"' for n, e in columns.items()) + f" from events where {cond}" for cond, columns in RUNWAYS)


def runways(t) -> DataFrame:
    parts = [t("events").where(cond).selectExpr(*(f"{e} as `{n}`" for n, e in columns.items())) for cond, columns in RUNWAYS]
    rest = [F.lit("").alias(n) for n in ("width_ft", "lighted", "closed", "he_ident", "le_heading_degt", "he_heading_degt")]
    return parts[0].unionByName(parts[1]).select("*", *rest)


#: One country box, for roads in the United States.
USA = (-125.0, 25.0, -65.0, 50.0)


def catalog(t, none: tuple[str, ...] = ()) -> Catalog:
    """Feature tables by rule; those of ``none`` are empty."""
    spark = t("events").sparkSession

    def read(name: str) -> DataFrame:
        if name == "ne_10m_admin_0_countries":
            x1, y1, x2, y2 = USA
            return spark.range(1).select(F.lit("USA").alias("iso_a3"), jts.from_wkt(F.lit(f"POLYGON(({x1} {y1},{x2} {y1},{x2} {y2},{x1} {y2},{x1} {y1}))")).alias("geometry"))
        if name == "ourairports_runways":
            return runways(t)
        if name in none:
            return table_of(t, name).where("false")
        x = table_of(t, name)
        return cut(x, "features") if len(TABLES[name][0]) > 8 else x  # else its rules are copied into each use

    return Catalog(spark, read)


def rows_of(name: str) -> str:
    columns, tags = TABLES[name]
    return f"select event_id as id, event_id as osm_id, {LON} as lon, {LAT} as lat, " + ", ".join([f'{e} as "{n}"' for n, e in columns.items()] + [f'{e} as "tag_{k}"' for k, e in tags.items()]) + " from events"


NAME, TRIMMED = "coalesce(nullif(name_en, ''), nullif(name, '')) as name", "coalesce(nullif(trim(name_en), ''), nullif(trim(name), '')) as name"
R = 6378137.0
MERC = lambda y: f"ln(tan(pi() / 4 + radians({y}) / 2))"
AREA = f"round((radians({WIDTH}) * {R} * {R} * ({MERC(f'lat + {HEIGHT}')} - {MERC('lat')}))::float::double / 1e6, 2) as area"
blank = lambda *names: ", ".join(f"nullif({n}, '') as {n}" for n in names)
listed = lambda xs: ", ".join(f"'{x}'" for x in xs)
LIVES = listed("construction proposed planned disused abandoned destroyed demolished razed removed".split())


def life(base: str, tag: str = "''") -> str:
    """The state of a feature: prefix of the class, then the value, then a bare tag ``disused``."""
    return (
        f"coalesce(case when split_part(lower(class), ':', 2) = '{base}' and split_part(lower(class), ':', 1) in ({LIVES}) then split_part(lower(class), ':', 1) end,"
        f" case when lower(trim(subclass)) in ({LIVES}) then lower(trim(subclass)) end, case when lower(trim({tag})) not in ('', 'no') then 'disused' end, 'intact')"
    )


def subject(base: str, fallback: str, told: str) -> str:
    """What the feature is; ``told``: the tag of the state's own name, where the table has one."""
    return (
        f"case when split_part(lower(class), ':', 2) = '{base}' and split_part(lower(class), ':', 1) in ({LIVES}) then lower(trim(subclass))"
        f" when lower(trim(subclass)) in ({LIVES}) then coalesce({told}, '{fallback}') else subclass end"
    )


def said(state: str, tag: str) -> str:
    return f"case when lower(trim(subclass)) = '{state}' then nullif(nullif(lower(trim({tag})), ''), 'yes') end"


def put(name: str, columns: list[str], sql: str, area: bool = False, none: tuple[str, ...] = ()) -> None:
    def f(t) -> DataFrame:
        x = catalog(t, none).layer(name)
        return x.select(*columns, *([F.round(c("area").cast("double") / 1e6, 2).alias("area")] if area else []))

    query(sql, f"layer_{name}")(f)


put("barrier_line", ["osm_id", "subclass", "name"], f"select osm_id, subclass, {NAME} from ({rows_of('osm_barrier_linestring')})")
put("barrier_point", ["osm_id", "subclass", "name"], f"select osm_id, subclass, {NAME} from ({rows_of('osm_barrier_point')})")
FLOATING = "case when coalesce(nullif(tag_floating, ''), 'no') not in ('no', 'false', '0') then true end as is_floating"
put("pier_line", ["osm_id", "name", "class", "subclass", "is_floating"], f"select osm_id, {blank('name')}, class, subclass, {FLOATING} from ({rows_of('osm_pier_linestring')})")
put("pier_polygon", ["osm_id", "name", "class", "subclass", "is_floating"], f"select osm_id, {blank('name')}, class, subclass, {FLOATING}, {AREA} from ({rows_of('osm_pier_polygon')})", area=True)
put("ferry_line", ["osm_id", "class", "subclass", "name", "short_name", "shipway"], f"select osm_id, class, subclass, {NAME}, {blank('short_name', 'shipway')} from ({rows_of('osm_shipway_linestring')})")
put("building_polygon", ["osm_id", "name", "building", "height", "levels"], f"select osm_id, {NAME}, {blank('building', 'height', 'levels')}, {AREA} from ({rows_of('osm_building_polygon')})", area=True)
KIND = "case subclass " + " ".join(f"when '{a}' then '{b}'" for a, b in POI.items()) + " end"
put("poi_point", ["osm_id", "name", "class", "subclass", "religion"], " union all ".join(f"select osm_id, {NAME}, {KIND} as class, subclass, {blank('religion')} from ({rows_of(n)}) where {KIND} is not null" for n in ("osm_poi_point", "osm_poi_polygon")))
put("culvert_point", ["osm_id", "name", "subclass"], f"select osm_id, {NAME}, subclass from ({rows_of('osm_water_point')}) where subclass = 'culvert' or tunnel = 'culvert'")
put("lock_line", ["osm_id", "class", "subclass", "intermittent", "name", "lock", "lock_name"], f"select osm_id, class, subclass, case when is_intermittent then true end as intermittent, {NAME}, {blank('lock', 'lock_name')} from ({rows_of('osm_waterway_linestring')}) where subclass in ('lock_gate', 'gate', 'lock', 'lock_basin', 'locks')")
put("road_polygon", ["osm_id", "name", "subclass"], f"select osm_id, {NAME}, case when class = 'public_transport' then 'platform' else subclass end as subclass, {AREA} from ({rows_of('osm_highway_polygon')}) where (class = 'highway' and subclass in ('pedestrian', 'footway', 'steps', 'path', 'cycleway', 'bridleway', 'corridor')) or (class = 'public_transport' and subclass = 'platform')", area=True)
put("park_polygon", ["osm_id", "access", "class", "subclass", "iucn_level", "name", "protect_class"], f"""
select osm_id, {blank('access', 'class')}, coalesce(case when leisure in ('park', 'nature_reserve', 'golf_course', 'dog_park', 'recreation_ground', 'garden') then leisure end, nullif(subclass, '')) as subclass, {blank('iucn_level')}, {NAME}, {blank('protect_class')}, {AREA}
from ({rows_of('osm_park_polygon')}) where subclass in ({listed(PARKS)})
union all select osm_id, {blank('access', 'class', 'subclass')}, null, {NAME}, null, {AREA} from ({rows_of('osm_landuse_polygon')}) where subclass = 'pitch'""", area=True)
put("power_station_polygon", ["osm_id", "subclass", "name", "operator"], f"select osm_id, case when subclass = 'plant_part' then 'plant' else subclass end as subclass, {NAME}, {blank('operator')}, {AREA} from ({rows_of('osm_utility_polygon')}) where class = 'power'", area=True)
put("pumping_station_polygon", ["osm_id", "subclass", "name", "operator", "substation", "substance", "pumping_station"], f"select osm_id, subclass, {NAME}, {blank('operator', 'substation', 'substance', 'pumping_station')}, {AREA} from ({rows_of('osm_utility_polygon')}) where class <> 'power'", area=True)
put("pipeline_line", ["osm_id", "class", "subclass", "name", "location", "substance", "seamark_type"], f"select osm_id, class, subclass, {blank('name', 'location', 'substance', 'seamark_type')} from ({rows_of('osm_utility_linestring')}) where (class in ('man_made', 'pipeline') and subclass not in ({listed(POWER_LINES)})) or seamark_type in ('pipeline_overhead', 'pipeline_submarine')")
STATIONS = "station bus_station ferry_terminal rest_area services platform".split()
put("transportation_station_polygon", ["osm_id", "class", "subclass", "name", "platforms", "operator", "station", "service"], f"select osm_id, class, subclass, {NAME}, nullif(tag_platforms, '') as platforms, {blank('operator', 'station', 'service')}, {AREA} from ({rows_of('osm_transportation_polygon')}) where subclass in ({listed(STATIONS)})", area=True)
SIZE = "case when yard_size ilike '%very%large%' then 'very_large' when yard_size ilike '%very%small%' then 'very_small' when yard_size ilike '%large%' then 'large' when yard_size ilike '%medium%' then 'medium' when yard_size ilike '%small%' then 'small' else nullif(trim(yard_size), '') end as yard_size"
put("yard_label", ["osm_id", "source", "subclass", "name", "service", "yard_size"], " union all ".join(f"select osm_id, '{kind}' as source, subclass, {TRIMMED}, nullif(trim(service), '') as service, {SIZE} from ({rows_of('osm_transportation_' + kind)}) where subclass = 'yard' or lower(service) = 'yard'" for kind in ("polygon", "point")))
put("airport_polygon", ["osm_id", "name", "class", "subclass", "iata", "icao", "surface"], f"select osm_id, {NAME}, class, subclass, {blank('iata', 'icao', 'surface')}, {AREA} from ({rows_of('osm_aeroway_polygon')})", area=True)
put("physical_labels", ["name", "featurecla", "scalerank", "min_label", "max_label"], f"select {NAME}, {blank('featurecla')}, scalerank, min_label, max_label from ({rows_of('ne_physical_centerlines')}) where nullif(name, '') is not null")
put("runway_line", ["osm_id", "ref", "class", "subclass", "lifecycle_type", "surface"], f"select osm_id, {blank('ref')}, 'aeroway' as class, {subject('aeroway', 'unknown', said('construction', 'tag_construction'))} as subclass, {life('aeroway')} as lifecycle_type, {blank('surface')} from ({rows_of('osm_aeroway_linestring')}) where {life('aeroway')} not in ('proposed', 'planned')")

GAUGE = "case when subclass in ('narrow_gauge', 'miniature') then 'narrow' when gauge in ('railway', 'rail', 'unknown', 'no', 'standard') or gauge like '14%' then 'standard' when gauge in ('wide', 'broad') or regexp_matches(gauge, '^(15|16|17|18|19|2[0-9]{3})') then 'broad' else 'narrow' end"
RAIL = f"""
with r as (select *, {life('railway', 'tag_disused')} as life, {GAUGE} as g, electrified in ('FIXME', 'no', 'NO', 'unknown') as off, tracks in ('1', 'single', 'tram', 'monorail') or trim(tracks) = '' as one from ({rows_of('osm_railway_linestring')}) where not is_area)
select osm_id, case when is_bridge then 'bridge' when is_tunnel then 'tunnel' when is_ford then 'ford' end as brunnel, {subject('railway', 'unknown', said('disused', 'tag_disused'))} as subclass, {TRIMMED}, nullif(trim(ref), '') as ref,
  g as gauge, case when off then 0 else 1 end::int as electrified, case when one then 'single' else 'multiple' end as tracks, life as lifecycle_type,
  'railway_' || case when life = 'intact' then 'intact' else 'not-intact' end || '_' || case when g = 'narrow' then 'narrow' else 'broadstandard' end || '_' || case when off then 'nonelectrified' else 'electrified' end || '_' || case when one then 'singletrack' else 'multipletracks' end as dps_type
from r where life not in ('abandoned', 'proposed', 'planned')"""
put("rail_line", ["osm_id", "brunnel", "subclass", "name", "ref", "gauge", "electrified", "tracks", "lifecycle_type", "dps_type"], RAIL)

REF, MULTI = "nullif(trim(ref), '')", "coalesce(ref like '%:%' or ref like '%,%' or ref like '%;%', false)"
X1, Y1, X2, Y2 = USA
ROAD_KIND = lambda word, business, other: f"case when {business} then '{word} Business' when {other} then '{word} Other' else '{word}' end"
INTERSTATE, HIGHWAY, STATE = ROAD_KIND("Interstate", "ref ilike '%Bus%'", "ref like '% % %'"), ROAD_KIND("US Hwy", "ref like '%Bus%'", "ref like '% % %'"), ROAD_KIND("State Hwy", "ref like '__ %Bus%'", "ref like '__ % %'")
ROAD = f"""
with m as (select id as member, network as rel from ({rows_of('osm_highway_relation')}) where nullif(trim(network), '') is not null and network not like '%:Historic'),
h as (select *, {life('highway', 'tag_disused')} as life, {subject('highway', 'road', said('construction', 'tag_construction'))} as subject,
  trim(ref) <> '' and subclass in ({listed(NUMBERED)}) and lat between {Y1} and {Y2} and lon <= {X2} and lon + {WIDTH} >= {X1} as in_usa from ({rows_of('osm_highway_linestring')}) left join m on member = id where not is_area),
u as (select *, in_usa or rel like 'US:%' or network like 'US:%' or regexp_matches({REF}, '^(I |US |[A-Z]{{2}} )') as is_us, {MULTI} as multi, nullif(trim(regexp_replace(ref, '[^0-9]+', ';', 'g'), ';'), '') as number,
  case lower(subject) when 'motoway' then 'motorway' when 'minor' then 'tertiary' when 'livingstreet' then 'living_street' else lower(subject) end as kind,
  case when rel in ('US:I', 'US:interstate') or rel like 'US:I:%' then 1 when rel in ('US:US', 'US:us') or rel like 'US:US:%' then 2 when rel like 'US:%' then 3 else 4 end as rank from h)
select osm_id, case when is_tunnel then case when is_bridge then 'tunnel;bridge' else 'tunnel' end when is_bridge then case when is_ford then 'bridge;ford' else 'bridge' end when is_ford then 'ford' end as brunnel,
  kind as subclass, {NAME}, {REF} as ref, number as ref_number, multi as ref_multi, is_us,
  case when trim(surface) = '' then 'paved_unknown' when regexp_matches(lower(surface), '{PAVED_RULE}') or regexp_matches(lower(surface), 'tar.*road') then 'paved' when regexp_matches(lower(surface), '{UNPAVED_RULE}') then 'unpaved' else 'unknown' end as surface,
  life as lifecycle_type, case when is_us and not multi then case when rank = 1 then {INTERSTATE} when rank = 2 then {HIGHWAY} when rank = 3 then {STATE} when regexp_matches(ref, '^({"|".join(STATES)})') then {STATE} when ref like 'US %' then {HIGHWAY} when ref like 'I %' then {INTERSTATE} else 'Other' end
    when in_usa or rel like 'US:%' then 'Other' end as route_type, case when lanes in ('1', '2', '3', '4', '5') then lanes::int end as lane
from u where life not in ('proposed', 'planned') and kind in ({listed([*ROADS, ''])})"""
put("road_line", ["osm_id", "brunnel", "subclass", "name", "ref", "ref_number", "ref_multi", "is_us", "surface", "lifecycle_type", "route_type", "lane"], ROAD)

WATER = f"""
with w as (select *, case {' '.join(f"when regexp_matches(subclass, '{p}') then '{v}'" for p, v in WATER_RULES)} else subclass end as kind,
  abs({BELT(f'lat + {HEIGHT}')} - {BELT('lat')}) * {MEAN} * {MEAN} as ground from (select *, {WIDTH} as w from ({rows_of('osm_water_polygon')})) where intermittent or subclass in ('intermittent', 'seasonal', 'drystream'))
select osm_id, {NAME}, kind as subclass, intermittent, case when ground >= {zres(5) ** 2!r} then 5 when ground >= {zres(6) ** 2!r} then 6 when ground >= {zres(7) ** 2!r} then 7 else 8 end::int as z_level, {AREA} from w"""
put("inland_water_intermittent_polygon", ["osm_id", "name", "subclass", "intermittent", "z_level"], WATER, area=True)

SURFACE = "case " + " ".join(f"when regexp_matches(lower(s), '{p}') then '{v}'" for p, v in RUNWAY_RULES) + " else s end"
AIRPORT = f"""
with a as (select * from ({rows_of('ourairports_airports')}) where not (lon > -2 and lon < 2 and lat > -2 and lat < 2)),
j as (select a.id, type, name, try_cast(nullif(elevation_ft, '') as float) as elevation_ft, try_cast(nullif(length_ft, '') as float) as ft, nullif(surface, '') as s, nullif(le_ident, '') as le from a left join ({runways_sql()}) on airport_ref = a.id),
k as (select id, count(*) filter (where ft > 4000) as long, count(*) filter (where ft between 1500 and 4000) as medium, count(*) as n from j group by id),
b as (select j.*, case when long = n or (n > 1 and ((long = 1 and medium >= 1) or medium > 1)) then 2 when n >= 1 and long = 0 and medium = 1 then 3 else 4 end::int as category, case when type = 'closed' then 2 else 1 end::int as rank
  from j join k using (id) qualify row_number() over (partition by id order by coalesce(ft, -1) desc, le nulls last) = 1)
select id as airport_id, type, name, elevation_ft, ft as runway_length_ft, {SURFACE} as runway_surface, category, rank from b
where type <> 'heliport' and name not ilike '%helicopter%' and name not ilike '%helipad%' and name not ilike '%heliport%'"""
put("airport_label", ["airport_id", "type", "name", "elevation_ft", "runway_length_ft", "runway_surface", "category", "rank"], AIRPORT, none=("osm_aeroway_polygon", "osm_aeroway_linestring"))


MARKS = f"concat(n_name, case n_nationkey % {len(layers_land.REMARKS) + 1} " + " ".join(f"when {i} then ' {a}'" for i, (a, _) in enumerate(layers_land.REMARKS)) + " else ' (Malvinas)' end)"


@query("select n_nationkey, " + "replace(" * len(layers_land.REMARKS) + MARKS + "".join(f", '{a}', '{b}')" for a, b in layers_land.REMARKS) + " as name from nation")
def country_remarks(t):
    return t("nation").selectExpr("n_nationkey", f"{MARKS} as name").select("n_nationkey", tx.replace_all(c("name"), layers_land.REMARKS).alias("name"))
