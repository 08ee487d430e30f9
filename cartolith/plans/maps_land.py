"""Layers with dissolves, containment, labels and border lists, each over tables made from all events, with SQL whose values
are written out here and not taken from the layers.

A table is its columns by expressions that both engines read, and a box: ``x``, ``y``, ``w`` and ``h`` of the lower left corner and
the sides.  Points are the lower left corner, lines go along the lower side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jts
from ..operators.graph import cut
from .catalogue import LAT, LON, query
from .layers import Catalog
from .maps import EMPTY, NAMES, pick
from .shapes import BELT, MEAN, ring

c = F.col
PLACED = {"x": LON, "y": LAT, "w": "0.05", "h": "0.04"}


class Made:
    """Rows made from events: columns, tags, a kind of shape and where it lies."""

    def __init__(self, columns: dict[str, str], shape: str = "box", tags: dict[str, str] | None = None, where: str = "true", **place: str):
        self.columns, self.shape, self.tags, self.where, self.place = columns, shape, tags or {}, where, PLACED | place

    def table(self, t) -> DataFrame:
        names = self.columns | {f"tag:{k}": e for k, e in self.tags.items()}
        x = t("events").where(self.where).selectExpr("event_id", *(f"cast({e} as double) as `at_{k}`" for k, e in self.place.items()), *(f"{e} as `{n}`" for n, e in names.items()))
        at = lambda i: F.concat_ws(" ", (c("at_x") + i * c("at_w")).cast("string"), c("at_y").cast("string"))
        wkt = {
            "box": ring(c("at_x"), c("at_y"), c("at_w"), c("at_h")),
            "point": F.concat(F.lit("POINT("), at(0), F.lit(")")),
            "line": F.concat(F.lit("LINESTRING("), at(0), F.lit(","), at(1), F.lit(")")),
        }[self.shape]
        tags = F.create_map(*(y for k in self.tags for y in (F.lit(k), c(f"`tag:{k}`")))) if self.tags else F.create_map().cast("map<string,string>")
        rest = [F.lit("").alias(n) for n in EMPTY + MORE if n not in self.columns]
        return x.select(c("event_id").alias("id"), c("event_id").alias("osm_id"), *self.columns, tags.alias("tags"), *rest, jts.from_wkt(wkt).alias("geometry"))

    def rows(self) -> str:
        named = self.columns | {f"tag_{k}": e for k, e in self.tags.items()}
        return "(select event_id as id, event_id as osm_id, " + ", ".join([f'({e})::double as "at_{k}"' for k, e in self.place.items()] + [f'{e} as "{n}"' for n, e in named.items()]) + f" from events where {self.where})"


#: Text columns that these layers read and rules leave empty.
MORE = "industrial port cargo port_type seamark_name gate lock gate_category tower_type tower_construction mast_type man_made mineshaft_type landuse ownership owner leisure".split()


def catalog(t, tables: dict[str, Made]) -> Catalog:
    spark = t("events").sparkSession

    def read(name: str) -> DataFrame:
        return cut(tables[name].table(t), "made")

    return Catalog(spark, read)


def put(name: str, tables: dict[str, Made], columns: list[str], sql: str, finish=None) -> None:
    def f(t) -> DataFrame:
        x = catalog(t, tables).layer(name)
        x = finish(x) if finish else x
        return x.select(*columns)

    query(sql, f"layer_{name}")(f)


def middle(x: DataFrame) -> DataFrame:
    """Adds px and py of a point geometry, and the area in square kilometres where there is one."""
    b = jts.bbox("geometry")
    x = x.withColumns({"px": F.round(F.get(b, F.lit(0)), 6) + 0.0, "py": F.round(F.get(b, F.lit(1)), 6) + 0.0})
    return x.withColumn("area", F.round(c("area").cast("double") / 1e6, 2)) if "area" in x.columns else x


def measured(x: DataFrame) -> DataFrame:
    return x.withColumn("area", F.round(c("area").cast("double") / 1e6, 2))


R = 6378137.0
MERC = lambda y: f"ln(tan(pi() / 4 + radians({y}) / 2))"
KM2 = f"round((radians(at_w) * {R} * {R} * ({MERC('at_y + at_h')} - {MERC('at_y')}))::float::double / 1e6, 2) as area"
CENTRE = "round(at_x + at_w / 2, 6) + 0.0 as px, round(at_y + at_h / 2, 6) + 0.0 as py"
NAME = "coalesce(nullif(name_en, ''), nullif(name, '')) as name"
blank = lambda *names: ", ".join(f"nullif({n}, '') as {n}" for n in names)

# ---- labels: a point on the surface of each polygon

STATION = {"osm_transportation_polygon": Made(NAMES | {"class": pick("railway", "public_transport"), "subclass": pick("station", "platform", "yard", "halt", "services"), "operator": pick("", "DB"), "station": pick("", "subway")}, tags={"platforms": pick("", "2", by=3)})}
put("transportation_station_label", STATION, ["osm_id", "class", "subclass", "name", "platforms", "operator", "station", "area", "px", "py"],
    f"select osm_id, class, subclass, {NAME}, nullif(tag_platforms, '') as platforms, {blank('operator', 'station')}, {KM2}, {CENTRE} from {STATION['osm_transportation_polygon'].rows()} where subclass in ('station', 'platform', 'services')", middle)

POWER = {"osm_utility_polygon": Made(NAMES | {"class": pick("power", "man_made"), "subclass": pick("plant", "plant_part", "substation", "pumping_station"), "operator": pick("", "Op"), "plant_source": pick("", "coal", "wind"), "substation": pick("", "yes"), "substance": pick("gas", "")})}
put("power_station_label", POWER, ["osm_id", "subclass", "name", "plant_source", "area", "px", "py"],
    f"select osm_id, case when subclass = 'plant_part' then 'plant' else subclass end as subclass, {NAME}, {blank('plant_source')}, {KM2}, {CENTRE} from {POWER['osm_utility_polygon'].rows()} where class = 'power'", middle)
put("pumping_station_label", POWER, ["osm_id", "subclass", "name", "operator", "substation", "substance", "area", "px", "py"],
    f"select osm_id, subclass, {NAME}, {blank('operator', 'substation', 'substance')}, {KM2}, {CENTRE} from {POWER['osm_utility_polygon'].rows()} where class <> 'power'", middle)

BUILT = {"osm_builtup_area": Made(NAMES | {"class": pick("leisure", "landuse", "amenity"), "subclass": pick("stadium", "sports_centre", "residential", "port")}, h="0.02 + (event_id % 3) / 100.0")}
for _name, _columns, _finish in (("stadium_polygon", [], measured), ("stadium_label", ["px", "py"], middle)):
    put(_name, BUILT, ["osm_id", "name", "class", "subclass", "area", *_columns],
        f"select osm_id, {NAME}, class, subclass, {KM2}{', ' + CENTRE if _columns else ''} from {BUILT['osm_builtup_area'].rows()} where subclass in ('stadium', 'sports_centre')", _finish)

LOCKS = {"osm_utility_point": Made(NAMES | {"class": pick("waterway", "man_made"), "subclass": pick("lock_gate", "crane", "lock", "mast", "gate"), "lock": pick("", "", "yes"), "operator": pick("", "WSA"), "tower_type": pick("", "radar", "bell"), "tower_construction": pick("", "lattice")}, "point", tags={"radar": pick("", "weather"), "military": pick("yes", "")})}
put("lock_label", LOCKS, ["osm_id", "class", "subclass", "name", "operator", "lock", "px", "py"],
    f"select osm_id, class, subclass, {NAME}, {blank('operator', 'lock')}, round(at_x, 6) + 0.0 as px, round(at_y, 6) + 0.0 as py from {LOCKS['osm_utility_point'].rows()} where subclass in ('lock_gate', 'gate', 'lock') or lock = 'yes'", middle)

RADAR = LOCKS | {"osm_building_polygon": Made(NAMES | {"tower_type": pick("radar", "", "cooling"), "height": pick("", "12")}, tags={"operator": pick("", "DFS", by=3), "radar": pick("x", "")})}
put("radar_label", RADAR, ["osm_id", "class", "subclass", "name", "operator", "tower_type", "tower_construction", "height", "radar", "px", "py"], f"""
select osm_id, class, subclass, {NAME}, {blank('operator', 'tower_type', 'tower_construction')}, null as height, nullif(tag_radar, '') as radar, round(at_x, 6) + 0.0 as px, round(at_y, 6) + 0.0 as py from {RADAR['osm_utility_point'].rows()} where tower_type = 'radar'
union all select osm_id, 'man_made', 'tower', {NAME}, nullif(tag_operator, ''), tower_type, null, nullif(height, ''), nullif(tag_radar, ''), {CENTRE.replace(' as px', '').replace(' as py', '')} from {RADAR['osm_building_polygon'].rows()} where tower_type = 'radar'""", middle)  # fmt: skip

SILO = {
    "osm_utility_polygon": Made(NAMES | {"class": "'man_made'", "subclass": pick("silo", "silo", "storage_tank"), "content": pick("grain", "feed", "water", "", "silage"), "height": pick("", "30")}),
    "osm_utility_point": Made(NAMES | {"class": "'man_made'", "subclass": pick("silo", "mast"), "content": pick("grain", "crop", "feed", ""), "height": pick("7", "")}, "point", tags={"content": pick("", "wheat", "salt", by=5)}),
}
_KEPT = "('grain', 'crop', 'silage', 'wheat', 'crops', 'feed', 'grit')"
_SILO = f"select osm_id, class, subclass, {NAME}, {blank('height', 'content')}, {{rest}} from {SILO['osm_utility_polygon'].rows()} where subclass = 'silo' and content in {_KEPT}"
put("grain_polygon", SILO, ["osm_id", "class", "subclass", "name", "height", "content", "area"], _SILO.format(rest=KM2), measured)
put("grain_point", SILO, ["osm_id", "class", "subclass", "name", "height", "content", "px", "py"], f"""
select osm_id, class, subclass, {NAME}, nullif(height, '') as height, coalesce(nullif(content, ''), nullif(tag_content, '')) as content, round(at_x, 6) + 0.0 as px, round(at_y, 6) + 0.0 as py
from {SILO['osm_utility_point'].rows()} where subclass = 'silo' and (content in ('grain', 'crop') or tag_content in {_KEPT})
union all {_SILO.format(rest=CENTRE)}""", middle)  # fmt: skip

PITCH = {
    "osm_park_polygon": Made(NAMES | {"class": "'leisure'", "subclass": pick("pitch", "golf_course", "green", "park", "bunker"), "surface": pick("grass", ""), "operator": pick("", "Club"), "access": pick("", "private")}),
    "osm_landuse_polygon": Made(NAMES | {"class": "'landuse'", "subclass": pick("pitch", "farm"), "access": "''"}, tags={"surface": pick("", "clay", by=3), "operator": pick("", "City")}),
}
put("sports_ground", PITCH, ["osm_id", "name", "surface", "operator", "access", "class", "subclass", "area"], f"""
select osm_id, {blank('name', 'surface', 'operator', 'access')}, class, subclass, {KM2} from {PITCH['osm_park_polygon'].rows()} where subclass = 'pitch'
union all select osm_id, {blank('name')}, nullif(tag_surface, ''), nullif(tag_operator, ''), null, class, subclass, {KM2} from {PITCH['osm_landuse_polygon'].rows()} where subclass = 'pitch'""", measured)  # fmt: skip
put("golf_course", PITCH, ["osm_id", "name", "surface", "operator", "access", "class", "subclass", "area"], f"""
select osm_id, {blank('name')}, case when subclass = 'golf_course' then nullif(surface, '') end as surface, case when subclass = 'golf_course' then nullif(operator, '') end as operator, {blank('access')}, class, subclass, {KM2}
from {PITCH['osm_park_polygon'].rows()} where subclass in ('golf_course', 'bunker', 'green')""", measured)  # fmt: skip

WIRES = {"osm_utility_linestring": Made(NAMES | {"class": pick("power", "construction:power", "man_made"), "subclass": pick("line", "minor_line", "cable", "pipeline", "proposed", by=7), "voltage": pick("", "110000"), "location": pick("", "overhead"), "seamark_type": pick("", "", "cable_submarine", by=5), "cable_overhead_category": pick("", "", "", "ferry", by=3), "cable_submarine_category": "''", "wires": "''"}, "line")}
put("powerline_line", WIRES, ["osm_id", "class", "subclass", "name", "location", "voltage", "lifecycle_type"], f"""
select osm_id, case when class like '%:power' then 'power' else class end as class, subclass, {blank('name')},
  case when seamark_type = 'cable_submarine' then 'underwater' else nullif(location, '') end as location, {blank('voltage')},
  case when class = 'construction:power' then 'construction' else 'intact' end as lifecycle_type
from {WIRES['osm_utility_linestring'].rows()}
where subclass in ('line', 'minor_line', 'cable') and cable_overhead_category <> 'ferry'""")

BASES = {"mirtalocations_a": Made({"sitereportingcomponent": pick("usa", "usn", ""), "countryname": pick("United States", "Cuba"), "isjointbase": pick("", "yes"), "siteoperationalstatus": pick("act", ""), "sitename": "concat('Fort ', cast(event_id as string))", "statenamecode": pick("TX", "", "AK")})}
_BASE = f"select {', '.join(f'''nullif({a}, '') as {b}''' for a, b in (('sitereportingcomponent', 'component'), ('countryname', 'country'), ('isjointbase', 'jointbase'), ('siteoperationalstatus', 'operstatus'), ('sitename', 'sitename'), ('statenamecode', 'state')))}, {KM2}"
_BASES = ["component", "country", "jointbase", "operstatus", "sitename", "state", "area"]
put("us_military_installations_polygon", BASES, _BASES, f"{_BASE} from {BASES['mirtalocations_a'].rows()}", measured)
put("us_military_installations_label", BASES, [*_BASES, "px", "py"], f"{_BASE}, {CENTRE} from {BASES['mirtalocations_a'].rows()} union all select null, 'Cuba', null, null, 'US Naval Base Guantanamo Bay', null, 116.5, -75.16, 19.9175", middle)

FIELDS = {"ourairports_airports": Made({"ident": "concat('X', cast(event_id as string))", "type": pick("small_airport", "heliport", "closed", "large_airport"), "name": pick("City", "Royal Helipad", "Field Hospital Heliport", "Clinic Helipad", "Base", by=3), "elevation_ft": pick("12", "", "x"), **dict.fromkeys("gps_code iata_code local_code scheduled_service".split(), "''")}, "point")}
put("heliport_point", FIELDS, ["airport_ident", "type", "name", "hospital", "rank", "elevation_ft", "px", "py"], f"""
with a as (select *, name ilike '%helipad%' or name ilike '%heliport%' as heli, case when name ilike '%hospital%' or name ilike '%clinic%' then 'y' else 'n' end as hospital from {FIELDS['ourairports_airports'].rows()} where not (at_x > -2 and at_x < 2 and at_y > -2 and at_y < 2)),
b as (select *, case when heli and type = 'closed' then 'closed_heliport' when heli then 'heliport' else type end as kind from a)
select ident as airport_ident, kind as type, name, hospital, case when kind = 'heliport' then case when hospital = 'y' then 1 else 2 end when hospital = 'y' then 3 else 4 end::int as rank,
  try_cast(nullif(elevation_ft, '') as float) as elevation_ft, round(at_x, 6) + 0.0 as px, round(at_y, 6) + 0.0 as py from b where kind in ('heliport', 'closed_heliport')""", middle)  # fmt: skip

ICE = {n: Made({"name": pick("", "Shelf")}, where=f"event_id % 4 = {k}", w="0.5") for k, n in enumerate(("ne_10m_antarctic_ice_shelves_polys", "ne_10m_glaciated_areas", "osm_icesheet"))}
ICE["osm_landcover_polygon"] = Made({"subclass": pick("glacier", "wood")}, tags={"name": pick("", " Aletsch ", "  ", by=3)}, w="0.2")
put("glacier_polygon", ICE, ["source", "name", "ground"], " union all ".join(
    f"select '{source}' as source, {named} as name, round(at_w * at_h, 6) as ground from {ICE[n].rows()}{where}" for n, source, named, where in (
        ("ne_10m_antarctic_ice_shelves_polys", "ne", "nullif(name, '')", ""), ("ne_10m_glaciated_areas", "ne", "nullif(name, '')", ""), ("osm_landcover_polygon", "osm", "nullif(trim(tag_name), '')", " where subclass = 'glacier'"), ("osm_icesheet", "osm", "'antarctica_icesheet'", ""))),
    lambda x: x.withColumn("ground", F.round(jts.area("geometry"), 6)))

SEA = {"ne_50m_ocean": Made({"kind": "'far'"}, where="event_id % 5 = 0", w="1.5", h="1.25"), "osm_ocean": Made({"kind": "'near'"}, w="0.5", h="0.25")}
put("ocean_polygon", SEA, ["subclass", "z_level", "ground"], f"select 'ocean' as subclass, 0::int as z_level, round(at_w * at_h, 6) as ground from {SEA['ne_50m_ocean'].rows()} union all select 'ocean', 1, round(at_w * at_h, 6) from {SEA['osm_ocean'].rows()}", lambda x: x.withColumn("ground", F.round(jts.area("geometry"), 6)))

# ---- containment: three boxes inside each other, and apart from the next three

NEST = {
    "x": "cast(floor(event_id / 3) as bigint) % 600 * 0.5 - 150.0 + event_id % 3 * 0.05", "y": "cast(floor(event_id / 1800) as bigint) * 0.5 - 80.0 + event_id % 3 * 0.05",
    "w": "0.4 - event_id % 3 * 0.1", "h": "0.4 - event_id % 3 * 0.1",
}
GRAVES = {"osm_landuse_polygon": Made(NAMES | {"class": "'landuse'", "subclass": pick("cemetery", "Old Graveyard", "grave_yard", "farm", by=1)}, tags={"religion": pick("", "none")}, **NEST)}
_IN = "exists (select 1 from k b where b.id // 3 = a.id // 3 and b.id < a.id)"
_GRAVE = f"with k as (select * from {GRAVES['osm_landuse_polygon'].rows()} where subclass <> 'farm') select osm_id, {NAME}, class, subclass, nullif(tag_religion, '') as religion, 0::int as contained, {KM2}"
put("cemetery_polygon", GRAVES, ["osm_id", "name", "class", "subclass", "religion", "contained", "area"], f"{_GRAVE} from k a where not {_IN}", measured)
put("cemetery_label", GRAVES, ["osm_id", "name", "class", "subclass", "religion", "contained", "area", "px", "py"], f"{_GRAVE}, {CENTRE} from k a where not {_IN}", middle)

#: Neighbours in a row of boxes of which every second is small and lies inside the one before, or reaches half over its side.
QUAYS = {"osm_builtup_area": Made(NAMES | {"class": "'landuse'", "subclass": pick("port", "port", "harbour", "harbour", "industrial", "industrial"), "industrial": pick("", "", "", "", "port", "")},
    x="cast(floor(event_id / 2) as bigint) % 600 * 0.5625 - 170.0 + event_id % 2 * (0.1 + cast(floor(event_id / 2) as bigint) % 2 * 0.2)", y="cast(floor(event_id / 1200) as bigint) * 0.5 - 80.0 + event_id % 2 * 0.1", w="0.4 - event_id % 2 * 0.2", h="0.4 - event_id % 2 * 0.2")}
_QUAY = f"""
with k as (select * from {QUAYS['osm_builtup_area'].rows()} where subclass in ('port', 'harbour') or (subclass = 'industrial' and industrial = 'port')),
f as (select a.*, coalesce(max((b.id // 2 % 2 = 1)::int), 0) as overlap, coalesce(max((a.id % 2 = 1 and b.id // 2 % 2 = 0)::int), 0) as contained from k a left join k b on a.id // 2 = b.id // 2 and a.id <> b.id group by all)
"""
put("port_polygon", QUAYS, ["osm_id", "name", "class", "subclass", "industrial", "rank", "overlap", "contained", "area"], f"{_QUAY} select osm_id, {NAME}, class, subclass, nullif(industrial, '') as industrial, 1::int as rank, overlap::int as overlap, contained::int as contained, {KM2} from f", measured)
put("port_label", QUAYS, ["osm_id", "name", "subclass", "rank", "overlap", "contained", "px", "py"], f"{_QUAY} select osm_id, {NAME}, subclass, 1::int as rank, overlap::int as overlap, nullif(contained, 0)::int as contained, {CENTRE} from f", middle)

# ---- dissolves

#: Chains of ten places, of which the first eight touch side by side and the last two lie apart.
LAKES = {"osm_water_polygon": Made(NAMES | {"subclass": pick("lake", "lake", "pond", "reservoir"), "intermittent": "false"}, tags={"water": "''"},
    x="cast(floor(event_id / 10) as bigint) % 200 * 1.5 - 150.0 + (event_id % 10) * 0.0625 + case when event_id % 10 > 7 then 0.125 * (event_id % 10 - 7) else 0.0 end", y="cast(floor(event_id / 2000) as bigint) * 1.0 - 60.0", w="0.0625", h="0.03125 * (1 + event_id % 3)"),
    "ne_50m_lakes": Made({"name": "''"}, where="event_id % 100 = 0", w="2.0", h="1.0")}
ZOOM_AREA = lambda z: repr((2 * 3.141592653589793 * R / 256 / 2**z) ** 2)
put("water_polygon", LAKES, ["subclass", "z_level", "capped", "n", "ground"], f"""
with k as (select *, at_w as w, at_y as lat from {LAKES['osm_water_polygon'].rows()}),
o as (select *, abs({BELT('at_y + at_h')} - {BELT('at_y')}) * {MEAN} * {MEAN} as m2 from k),
u as (
  select case {' '.join(f"when m2 >= {ZOOM_AREA(z)} then {z}" for z in range(5, 12))} else 12 end as z_level, id % 10 < 8 and (id % 10 > 0 or id + 1 <= (select max(id) from k)) as capped, at_w * at_h as ground from o
  union all select 12, false, sum(at_w * at_h) from k where id % 10 < 8 group by id // 10 having count(*) > 1
  union all select 0, false, at_w * at_h from {LAKES['ne_50m_lakes'].rows()})
select 'water' as subclass, z_level::int as z_level, capped, count(*)::bigint as n, round(sum(ground), 6) as ground from u group by all""",
    lambda x: x.groupBy("subclass", "z_level", "capped").agg(F.count("*").cast("long").alias("n"), F.round(F.sum(jts.area("geometry")), 6).alias("ground")))

_DEPTHS = (200, 1000, 2000, 3000, 4000, 5000, 6000, 7000, 8000, 9000, 10000)
BASINS = {f"ne_10m_bathymetry_{k}_{d}": Made({"depth": str(d)}, where=f"event_id % 11 = {_DEPTHS.index(d)}",
    x=f"cast(floor(event_id / 11) as bigint) % 170 * 2.0 - 170.0 + {_DEPTHS.index(d)} * 0.0625", y=f"cast(floor(event_id / 1870) as bigint) * 2.0 - 80.0 + {_DEPTHS.index(d)} * 0.0625", w=f"1.5 - {_DEPTHS.index(d)} * 0.125", h=f"1.5 - {_DEPTHS.index(d)} * 0.125")
    for k, d in zip("kjihgfedcba", _DEPTHS, strict=True)}
put("bathymetry_polygon", BASINS, ["depth", "depth_max", "ground"], f"""
with k as ({' union all '.join(f'select id // 11 as basin, depth, at_w * at_h as ground from {m.rows()}' for m in BASINS.values())}),
b as (select depth, ground - coalesce(lead(ground) over (partition by basin order by depth), 0) as band from k),
s as (select depth, round(sum(band), 6) as ground from b group by depth)
select depth::int as depth, (lead(depth) over (order by depth))::int as depth_max, ground from s""",
    lambda x: x.groupBy("depth", "depth_max").agg(F.round(F.sum(jts.area("geometry")), 6).alias("ground")))

# ---- borders

BORDER = {
    "fieldmaps_adm0_lines": Made({"cc1": "concat('A', cast(event_id % 7 as string))", "cc2": "concat('A', cast(event_id * 3 % 11 as string))", "country1": pick("", "One"), "country2": pick("Two", "Three", ""), "label": pick("", "disputed", by=3), "notes": "''", "rank": "cast(event_id % 3 as int)", "status": pick("", "x")}, "line"),
    "dos_lsib": Made({"cc1": "concat('A', cast(event_id % 5 as string))", "cc2": "concat('A', cast(event_id % 4 as string))"}, "line", where="event_id % 3 = 0"),
    "adm0_line_supplements": Made({"cc1": "'A6'", "cc2": "concat('A', cast(event_id % 11 as string))", "country2": "'Three'", "label": "'disputed'"}, "line", where="event_id < 40"),
    "fieldmaps_adm1_lines": Made({"iso_2": "concat('A', cast(event_id % 13 as string))", "iso_3": pick("AAA", "BBB"), "adm0_name": pick("", "Land"), "status_cd": "cast(event_id % 4 as int)"}, "line"),
    "fieldmaps_adm1_points": Made({"adm1_id": "concat('P', cast(event_id as string))", "adm1_name": pick("", "North"), "adm1_name1": pick("N", ""), "iso_2": "concat('A', cast(event_id % 13 as string))", "iso_3": pick("AAA", "BBB"), "src_lang": pick("", "en"), "src_lang1": "''"}, "point"),
}
BORDER |= {"fieldmaps_adm2_lines": Made(BORDER["fieldmaps_adm1_lines"].columns | {"adm1_name": pick("S", "")}, "line"), "fieldmaps_adm2_points": Made({k.replace("adm1", "adm2"): v for k, v in BORDER["fieldmaps_adm1_points"].columns.items()}, "point")}
_DRAWN = f"""
with f as (select * from {BORDER['fieldmaps_adm0_lines'].rows()}), p as (select distinct least(cc1, cc2) as lo, greatest(cc1, cc2) as hi from {BORDER['dos_lsib'].rows()}), s as (select distinct cc1, cc2, country2, label from {BORDER['adm0_line_supplements'].rows()}),
drawn as (select * from f where exists (select 1 from p where lo = least(f.cc1, f.cc2) and hi = greatest(f.cc1, f.cc2)) or exists (select 1 from s where s.cc1 = f.cc1 and s.cc2 = f.cc2 and s.country2 = f.country2 and s.label = f.label)),
hidden as (select cc from (select cc1 as cc from f union select cc2 from f) except select cc from (select cc1 as cc from drawn union select cc2 from drawn))
"""
put("adm0_line", BORDER, ["cc1", "cc2", "country1", "country2", "label", "rank", "status", "px", "py"], f"{_DRAWN} select {blank('cc1', 'cc2', 'country1', 'country2', 'label')}, rank, {blank('status')}, round(at_x, 6) + 0.0 as px, round(at_y, 6) + 0.0 as py from drawn", middle)
for _k, _more in ((1, []), (2, ["adm1_name"])):
    put(f"adm{_k}_line", BORDER, ["iso_2", "iso_3", "adm0_name", *_more, "status_cd", "px", "py"], f"{_DRAWN} select iso_2, iso_3, {blank('adm0_name', *_more)}, status_cd, round(at_x, 6) + 0.0 as px, round(at_y, 6) + 0.0 as py from {BORDER[f'fieldmaps_adm{_k}_lines'].rows()} where iso_2 not in (select cc from hidden)", middle)
    put(f"adm{_k}_label", BORDER, [f"adm{_k}_id", f"adm{_k}_name", f"adm{_k}_name1", "iso_3", "src_lang", "px", "py"], f"{_DRAWN} select adm{_k}_id, {blank(f'adm{_k}_name', f'adm{_k}_name1')}, iso_3, {blank('src_lang')}, round(at_x, 6) + 0.0 as px, round(at_y, 6) + 0.0 as py from {BORDER[f'fieldmaps_adm{_k}_points'].rows()} where iso_2 not in (select cc from hidden)", middle)
