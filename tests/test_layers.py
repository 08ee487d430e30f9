"""Layers over small feature tables whose schemas come from FIXTURES.md."""

import os
import re

import pytest
from pyspark.sql import functions as F

from cartolith.functions import jts
from cartolith.plans import layers_land  # noqa: F401
from cartolith.plans.layers import LAYERS, Catalog

KINDS = {"id": "bigint", "member_id": "bigint", "bool": "boolean", "integer": "int", "direction": "int", "wayzorder": "int", "area": "float", "hstore_tags": "map<string,string>", "geometry": "string", "validated_geometry": "string"}
AUX = {
    "ne_10m_admin_0_countries": "iso_a3 string, name string, name_en string, name_long string, abbrev string, formal_en string",
    "ne_10m_land": "name string", "ne_50m_lakes": "name string", "ne_50m_ocean": "name string", "osm_ocean": "name string", "osm_icesheet": "name string",
    "ne_10m_antarctic_ice_shelves_polys": "name string", "ne_10m_glaciated_areas": "name string", "overture_land_cover": "subtype string, min_zoom int, max_zoom int",
    "ne_physical_centerlines": "name string, name_en string, featurecla string, scalerank int, min_label double, max_label double",
    "mirtalocations_a": "sitereportingcomponent string, countryname string, isjointbase string, siteoperationalstatus string, sitename string, statenamecode string",
    "ourairports_airports": "id bigint, ident string, type string, name string, elevation_ft string, continent string, iso_country string, iso_region string, municipality string, scheduled_service string, gps_code string, iata_code string, local_code string",
    "ourairports_runways": "airport_ref bigint, length_ft string, width_ft string, surface string, lighted string, closed string, le_ident string, le_heading_degt string, he_ident string, he_heading_degt string",
    "ne_10m_geography_marine_polys": "ne_id bigint, name string, featurecla string, scalerank int, min_label double", "ne_10m_lakes": "ne_id bigint, name string, featurecla string, scalerank int, min_label double",
    "nga_geonames_hydrographic": "full_nm_nd string, desig_cd string, name_rank int, display string, nt string", "usgs_domestic_names": "feature_name string, feature_class string, bgn_type string",
    "nga_geonames_populated_places": "ufi bigint, full_nm_nd string, desig_cd string, name_rank int, nt string, display string, term_dt_f string", "ne_10m_populated_places": "name string, nameascii string, rank_max int, pop_max bigint",
    "ne_10m_geography_regions_polys": "name string, name_en string, featurecla string, scalerank int", "dos_lsib": "cc1 string, cc2 string", "adm0_line_supplements": "cc1 string, cc2 string, country2 string, label string",
    "fieldmaps_adm0_lines": "cc1 string, cc2 string, country1 string, country2 string, label string, notes string, rank int, status string", "fieldmaps_adm0_points": "adm0_id string, iso_2 string, adm0_name string, adm0_name1 string, status_cd int, status_nm string",
    "fieldmaps_adm0_polygon": "adm0_id string", "nga_geonames_administrative_regions": "full_nm_nd string, cc_ft string, desig_cd string, name_rank int, nt string, term_dt_f string", "nga_country_abbrev": "adm0_prefix string, nga_name string, nga_abbrev string",
    "fieldmaps_adm1_lines": "iso_2 string, iso_3 string, adm0_name string, status_cd int", "fieldmaps_adm2_lines": "iso_2 string, iso_3 string, adm0_name string, adm1_name string, status_cd int",
    "fieldmaps_adm1_points": "adm1_id string, adm1_name string, adm1_name1 string, iso_2 string, iso_3 string, src_lang string, src_lang1 string", "fieldmaps_adm2_points": "adm2_id string, adm2_name string, adm2_name1 string, iso_2 string, iso_3 string, src_lang string, src_lang1 string",
} | {f"ne_10m_bathymetry_{k}_{d}": "depth int" for k, d in zip("abcdefghijk", (10000, 9000, 8000, 7000, 6000, 5000, 4000, 3000, 2000, 1000, 200))}


def box(x, y, w=0.01, h=None):
    h = w if h is None else h
    return f"POLYGON(({x} {y},{x + w} {y},{x + w} {y + h},{x} {y + h},{x} {y}))"


def schemas():
    path = os.path.join(os.path.dirname(__file__), "..", "FIXTURES.md")
    out = {}
    for line in open(path):
        m = re.match(r"\| (\w+) \| [^|]*\.yml[^|]*\| (\w+) \| (.*) \|$", line)
        if m:
            cols = [re.match(r"(\w+):(\w+)", x).groups() for x in m[3].split(", ")]
            cols = [("id", "id"), *[x for x in cols if x[0] != "id"]] + ([] if any(x[0] == "geometry" for x in cols) else [("geometry", "geometry")])
            out[f"osm_{m[1]}"] = ", ".join(f"`{n}` {KINDS.get(k, 'string')}" for n, k in cols)
    return out | {k: f"{v}, geometry string" for k, v in AUX.items()}


ROWS = {
    "osm_highway_linestring": [
        dict(id=1, osm_id=1, **{"class": "highway"}, subclass="motorway", name="Main", name_en="", ref="I 95", is_area=False, is_bridge=True, is_ford=False, is_tunnel=False, surface="asphalt", lanes="2", geometry="LINESTRING(-99.9 40, -99.8 40.1)"),
        dict(id=2, osm_id=2, **{"class": "highway"}, subclass="construction", construction="primary", tags={"construction": "primary"}, is_area=False, ref="US 1;US 2", geometry="LINESTRING(10 50, 10.1 50)"),
        dict(id=3, osm_id=3, **{"class": "highway"}, subclass="proposed", is_area=False, geometry="LINESTRING(10 50, 10.1 50)"),
        dict(id=4, osm_id=4, **{"class": "highway"}, subclass="minor", tags={"disused": "yes"}, is_area=False, surface="gravel", geometry="LINESTRING(5 5, 5.02 5)"),
    ],
    "osm_highway_relation": [dict(osm_id=-1, member=1, network="US:I", ref="95", route="road"), dict(osm_id=-2, member=1, network="US:US", ref="1", route="road")],
    "osm_highway_polygon": [dict(osm_id=5, **{"class": "public_transport"}, subclass="platform", geometry=box(0, 0))],
    "osm_railway_linestring": [
        dict(osm_id=7, **{"class": "railway"}, subclass="rail", is_area=False, gauge="1435", electrified="contact_line", tracks="2", service="siting", geometry="LINESTRING(0 0,1 1)"),
        dict(osm_id=8, **{"class": "railway"}, subclass="abandoned", is_area=False, geometry="LINESTRING(0 0,1 1)"),
    ],
    "osm_transportation_polygon": [dict(osm_id=9, **{"class": "railway"}, subclass="yard", yard_size="Very Large yard", geometry=box(0, 0)), dict(osm_id=10, **{"class": "railway"}, subclass="station", name="S", geometry=box(1, 0))],
    "osm_water_polygon": [
        dict(osm_id=11, subclass="lake", intermittent=False, geometry=box(0, 0, 1)), dict(osm_id=12, subclass="river", intermittent=False, geometry=box(1, 0, 1)), dict(osm_id=13, subclass="", intermittent=False, geometry=box(5, 5, 0.1)),
        dict(osm_id=14, subclass="pond", intermittent=True, geometry=box(8, 8, 0.1)), dict(osm_id=15, subclass="dam", name="D", intermittent=False, geometry=box(5, 5, 0.01)),
    ],
    "osm_waterway_linestring": [dict(osm_id=16, subclass="stream", is_bridge=False, is_tunnel=True, is_intermittent=True, tunnel_type="culvert", geometry="LINESTRING(5 5, 5.2 5)"), dict(osm_id=17, subclass="weir", name="W", geometry="LINESTRING(9 9, 9.01 9)")],
    "osm_waterway_relation": [dict(osm_id=-3, member=16, role="", name="R", geometry="LINESTRING(0 0, 5 0)"), dict(osm_id=-3, member=18, role="main_stream", name="R", geometry="LINESTRING(5 0, 5 1)")],
    "osm_water_point": [dict(id=19, osm_id=19, subclass="dam", name="Dam", geometry="POINT(5.005 5.005)"), dict(id=20, osm_id=20, subclass="culvert", geometry="POINT(0 0)")],
    "osm_builtup_area": [dict(osm_id=21, **{"class": "landuse"}, subclass="port", geometry=box(0, 0, 1)), dict(osm_id=22, **{"class": "landuse"}, subclass="harbour", geometry=box(0.1, 0.1, 0.2)), dict(osm_id=23, subclass="stadium", geometry=box(3, 3))],
    "osm_landuse_polygon": [dict(osm_id=24, subclass="cemetery", name="C", geometry=box(0, 0, 0.1)), dict(osm_id=25, subclass="Old cemetery", name="C", geometry=box(0.02, 0.02, 0.01)), dict(osm_id=26, subclass="pitch", geometry=box(2, 2))],
    "osm_utility_point": [dict(osm_id=27, **{"class": "power"}, subclass="generator", generator_source="wind", geometry="POINT(1 1)"), dict(osm_id=28, subclass="generator", generator_source="wind", geometry="POINT(50 50)"), dict(osm_id=29, subclass="mineshaft", disused=True, tower_type="radar", geometry="POINT(2 2)")],
    "osm_building_polygon": [dict(osm_id=30, man_made="tower", height="12,5 m", geometry=box(0, 0)), dict(osm_id=31, man_made="mast", height="about 3", geometry=box(0, 0))],
    "osm_utility_polygon": [dict(osm_id=32, **{"class": "power"}, subclass="plant_part", geometry=box(0, 0)), dict(osm_id=33, **{"class": "man_made"}, subclass="wellsite", name="oil field", geometry=box(0, 0)), dict(osm_id=34, **{"class": "man_made"}, subclass="oil", geometry=box(0, 0, 0.001))],
    "osm_utility_linestring": [dict(osm_id=35, **{"class": "disused:power"}, subclass="line", geometry="LINESTRING(0 0,1 1)"), dict(osm_id=36, **{"class": "man_made"}, subclass="pipeline", geometry="LINESTRING(0 0,1 1)")],
    "osm_aeroway_polygon": [dict(osm_id=37, **{"class": "aeroway"}, subclass="aerodrome", icao="EDDX", geometry=box(20, 20, 0.05))],
    "osm_aeroway_linestring": [dict(osm_id=38, **{"class": "aeroway"}, subclass="runway", surface="asphalt", geometry="LINESTRING(20.01 20.01, 20.04 20.01)")],
    "osm_poi_point": [dict(osm_id=39, subclass="kindergarten", geometry="POINT(0 0)"), dict(osm_id=40, subclass="cafe", geometry="POINT(0 0)")],
    "ne_10m_admin_0_countries": [dict(iso_a3="USA", geometry=box(-125, 25, 60, 25))],
    "ne_10m_land": [dict(geometry=box(0, 0, 10))],
    "ourairports_airports": [dict(id=1, ident="EDDX", type="small_airport", name="X", gps_code="EDDX", elevation_ft="12", geometry="POINT(20.02 20.02)"), dict(id=2, ident="H", type="small_airport", name="City Hospital Helipad", geometry="POINT(30 30)"), dict(id=3, ident="Z", type="heliport", name="Null", geometry="POINT(0 0)")],
    "ourairports_runways": [dict(airport_ref=1, length_ft="5000", surface="ASPH-CONC-F"), dict(airport_ref=1, length_ft="", surface="")],
    "ne_10m_bathymetry_k_200": [dict(depth=200, geometry=box(0, 0, 4))], "ne_10m_bathymetry_j_1000": [dict(depth=1000, geometry=box(1, 1, 2))], "ne_10m_bathymetry_h_3000": [dict(depth=3000, geometry=box(1.5, 1.5, 2))],
    "overture_land_cover": [dict(subtype="urban", min_zoom=8, max_zoom=13, geometry=box(10, 48, 0.1)), dict(subtype="urban", min_zoom=8, max_zoom=13, geometry=box(10.101, 48, 0.1)), dict(subtype="forest", min_zoom=0, max_zoom=7, geometry=box(0, 40, 3)), dict(subtype="urban", min_zoom=8, max_zoom=13, geometry=box(15, 48, 0.005))],
    "osm_landcover_polygon": [dict(osm_id=41, subclass="wood", leaf_type="needleleaved", geometry=box(0, 40, 0.3)), dict(osm_id=42, subclass="wood", leaf_type="coniferous", geometry=box(0.3, 40, 0.3)), dict(osm_id=43, subclass="wetland", wetland="bog", is_seasonal=True, geometry=box(1, 41, 0.2)), dict(osm_id=44, subclass="glacier", tags={"name": " G "}, geometry=box(5, 60, 0.3))],
    "ne_10m_geography_marine_polys": [dict(ne_id=1, name="Gulf of Mexico", featurecla="gulf", scalerank=1, min_label=2.0, geometry=box(-95, 20, 10)), dict(ne_id=1159115321, name="Med", featurecla="Sea", geometry=box(0, 30, 20))],
    "ne_10m_lakes": [dict(ne_id=1159126643, name="Lake Ontario", featurecla="Lake", scalerank=2, min_label=1.0, geometry=box(-79, 43, 1))],
    "nga_geonames_hydrographic": [dict(full_nm_nd="lake ontario", desig_cd="LK", nt="N", geometry="POINT(-78 43)"), dict(full_nm_nd="Brook", desig_cd="STM", nt="N", geometry="POINT(3 3)"), dict(full_nm_nd="Bach", desig_cd="STM", nt="C", geometry="POINT(3 3)")],
    "usgs_domestic_names": [dict(feature_name="Big Bend", feature_class="Bend", bgn_type="Official", geometry="POINT(-90 40)"), dict(feature_name="X", feature_class="Bend", bgn_type="Variant", geometry="POINT(-90 40)")],
    "osm_city_point": [dict(osm_id=50, name="Bern", place="city", capital="yes", geometry="POINT(7.4 46.9)"), dict(osm_id=51, name="Saint Paul", place="town", geometry="POINT(-93 45)"), dict(osm_id=52, name="Dorf", place="village", capital="4", geometry="POINT(1 1)")],
    "nga_geonames_populated_places": [dict(ufi=1, full_nm_nd="Bern", desig_cd="PPLC", name_rank=1, nt="N", display="1,2,7", geometry="POINT(7.41 46.91)"), dict(ufi=1, full_nm_nd="Berne", desig_cd="PPLC", name_rank=1, nt="C", display="1,5", geometry="POINT(7.41 46.91)")],
    "ne_10m_populated_places": [dict(name="St. Paul", nameascii="St. Paul", rank_max=11, pop_max=300000, geometry="POINT(-93.01 45)"), dict(name="St. Paul", nameascii="St. Paul", rank_max=13, pop_max=9, geometry="POINT(10 45)")],
    "osm_island_polygon": [dict(osm_id=60, name="Isla", geometry=box(30, 30, 0.1))], "osm_island_point": [dict(osm_id=61, name="isla", geometry="POINT(30.15 30.05)"), dict(osm_id=62, name="Other", geometry="POINT(30.15 30.05)")],
    "fieldmaps_adm0_lines": [dict(cc1="A", cc2="B", country2="b", label="x", geometry="LINESTRING(0 0,1 0)"), dict(cc1="C", cc2="D", country2="d", label="y", geometry="LINESTRING(0 1,1 1)"), dict(cc1="Q2", cc2="E", country2="e", label="z", geometry="LINESTRING(0 2,1 2)")],
    "dos_lsib": [dict(cc1="B", cc2="A", geometry="LINESTRING(0 0,1 0)"), dict(cc1="F", cc2="G", geometry="LINESTRING(0 2,0.5 2)")], "adm0_line_supplements": [dict(cc1="Q2", cc2="E", country2="e", label="z")],
    "fieldmaps_adm0_points": [dict(adm0_id="AAA-1", iso_2="A", adm0_name="Isle (Fr.)", adm0_name1="Alpha", geometry="POINT(0 0)"), dict(adm0_id="CCC-1", iso_2="C", adm0_name="C", geometry="POINT(0 0)"), dict(adm0_id="GLP", iso_2="Z", adm0_name="G", status_cd=1, geometry="POINT(0 0)")],
    "nga_country_abbrev": [dict(adm0_prefix="AAA", nga_abbrev="A.")], "fieldmaps_adm1_lines": [dict(iso_2="C", geometry="LINESTRING(0 0,1 1)"), dict(iso_2="Z", geometry="LINESTRING(0 0,1 1)")],
}


@pytest.fixture(scope="module")
def cat(spark):
    kinds = schemas()

    def read(name):
        schema = kinds[name]
        cols = [x.strip().split(" ")[0].strip("`") for x in re.sub(r"<[^>]*>", "", schema).split(", ")]
        rows = [tuple(r.get(k, {} if k == "tags" else None) for k in cols) for r in ROWS.get(name, [])]
        return spark.createDataFrame(rows, schema).withColumn("geometry", jts.from_wkt("geometry"))

    return Catalog(spark, read)


def rows(cat, name):
    return [r.asDict() for r in cat.layer(name).collect()]


@pytest.mark.parametrize("name", sorted(LAYERS))
def test_runs(cat, name):
    d = cat.layer(name)
    assert "geometry" in d.columns
    for r in d.collect():  # every column is computed, which a count would leave out
        assert r["geometry"] is None or len(r["geometry"]) > 4


def test_rows_that_differ_in_tags_only(spark):
    from cartolith.plans.layers import keyed

    d = spark.createDataFrame([(1, {"a": "x", "b": "y"}), (1, {"b": "y", "a": "x"}), (1, {"a": "z"}), (1, None)], "id int, tags map<string,string>")
    assert len({r["__k"] for r in keyed(d).collect()}) == 3


#: Spellings of runway surfaces by code.
SURFACES = {
    "ALUM-DECK": ["ALUMINUM", "alum-deck"],
    "ASP": ["asp", "ASPH-GRVL-F", "Asfalto", "Ashpalt", "APSH", "ASP/TURF", "Grooved ASP", "Turf/Asphalt", "Blacktop on granite", "crushed rock and asphalt", "Grass/Asphalt Insert 1968X59 Feet"],
    "CON": ["CON/ASP", "conc", "C0N", "Caliche", "cement", "Turf/Concrete", "Grass/Helipads Concrete", "CONC-TURF-G"],
    "BIT": ["tarmac", "Tar - lights 5 clicks on 124.8", "Tarred", "sealed", "Sealed, grooved.", "BITUM", "Volcanic ash impregnated with bitumen"],
    "U": ["UG", "UNK", "UNKNOWN", "Unknown ? Aço(steel)", ""],
    "UNPAVED": ["UnPaved", "Unpeved runway", "Not paved", "unsealed"],
    "WAT": ["WAT", "WATER-E"],
    "WOOD": ["Wood"],
    "TURF": ["TURF", "tURF", "Tuef", "Torf"],
    "SAN": ["SAN", "Sandy gravel with clay", "SAN (Piçarra)", "SAND, TIDAL"],
    "BRI": ["BRI", "Ceramic Brick"],
    "GRE": ["TURF-F", "Turf/Grass", "Turf / Snow", "TURF/GRAVEL/CL", "Turf, soft during spring thaw", "compacted earth", "Compacted sand", "Zahorra compactada", "Graded Hardcore", "GRASS/HARDCORE", "Grass/rolled earth", "Grass over hard gravel", "Paved/Compacted schist", "packed dirt", "PACKED GRAVEL"],
    "CLA": ["CLA", "Brown gravel", "Grey silt clay", "Red clay", "Black silt", "Rock/Gravel/Clay", "Shale/Clay", "Shaly Clay", "Hard loam", "CLAY/GRAVEL/TU"],
    "COR": ["COR", "Coral grass", "Compacted coral and sand", "Crushed coral"],
    "GVL": ["GRAV", "GRV/MAICILLO", "GRVL-DIRT-P", "GVL", "PIC", "PIÇ", "Piçarra Gravel", "CRUSHED ROCK", "White gravel", "Rocky gravel", "Paved/Gravel", "GRAVEL / CINDERS / CRUSHED ROCK / CORAL/SHELLS / SLAG"],
    "GRS": ["dirt?", "DIRT(Caliche)", "Volcanic ash/soil", "lakebed", "EARTH/TURF", "Erba", "Herba (grass)", "GOOD GRASS", "GR", "gra", "Gras", "GRAAS", "GRASS OR EARTH NOT GRADED OR ROLLED", "Grassed brown silt loam", "Grassnow taxiway only!!", "GRS/GVL", "ground", "SOD", "Soft Gravel", "Soil, rough gravel", "NATURAL SOIL, GRASS / SOD", "LOOSE GRAVEL", "Limestone/Grass", "Hard mud", "Hard Sand"],
    "SNO": ["Snow/Ice"],
    "ICE": ["Ice - frozen lake"],
    "COM": ["COM", "COP"],
    "PER": ["Surface paved", "hard", "Hard Surfaced", "PAVED", "Pavement", "paving", "PER"],
    "MAC": ["TER", "TREATED SAND", "TRTD-DIRT-F", "OIL&CHIP-T-G", "OILED GRAVEL/T", "Oilgravel", "OLD ASP", "Oligravel/GRVL", "MAC"],
    "PSP": ["Mats", "MET/CON", "MTAL", "STEEL-CONC", "PIERCED STEEL PLANKING / LANDING MATS / MEMBRANES"],
}


def test_runway_surfaces(spark):
    from cartolith.functions import text as tx
    from cartolith.plans.layers import RUNWAY_RULES

    said = [(x, code) for code, xs in SURFACES.items() for x in xs] + [("Lava", None), ("compost", None)]
    d = spark.createDataFrame(said, "x string, code string").withColumn("got", tx.first_match(F.lower("x"), RUNWAY_RULES, F.lit(None).cast("string")))
    assert [tuple(r) for r in d.collect() if r["got"] != r["code"]] == []


def test_runway_surfaces_by_table(spark):
    """With a table, only what it lists is recoded: patterns first, then exact spellings."""
    from cartolith.operators import relational as rel

    table = spark.createDataFrame([("ALUM%", "ALUM-DECK", True), ("%asphalt%", "ASP", True), ("TURF-F", "GRE", False), ("Turf", "TURF", False), ("asphalt?", "no", False)], "spelling string, code string, is_pattern boolean")
    said = [("Aluminium", "ALUM-DECK"), ("old ASPHALT", "ASP"), ("asphalt?", "ASP"), ("TURF-F", "GRE"), ("Turf", "TURF"), ("turf", None), ("Turf over sand", None), (None, None), ("Turf", "TURF")]
    got = rel.looked_up(spark.createDataFrame(said, "s string, want string"), "s", table, "code")
    assert sorted((str(r["s"]), str(r["code"])) for r in got.collect()) == sorted((str(a), str(b)) for a, b in said)


def test_roads(cat):
    r = {x["osm_id"]: x for x in rows(cat, "road_line")}
    assert set(r) == {1, 2, 4}
    assert r[1]["route_type"] == "Interstate" and r[1]["is_us"] and r[1]["brunnel"] == "bridge" and r[1]["surface"] == "paved" and r[1]["ref_number"] == "95" and r[1]["lane"] == 2
    assert r[2]["subclass"] == "primary" and r[2]["lifecycle_type"] == "construction" and r[2]["ref_multi"] and r[2]["route_type"] is None
    assert r[4]["subclass"] == "tertiary" and r[4]["lifecycle_type"] == "disused" and r[4]["surface"] == "unpaved"
    assert rows(cat, "road_polygon")[0]["subclass"] == "platform"


def test_rails(cat):
    r = rows(cat, "rail_line")
    assert [x["osm_id"] for x in r] == [7]
    assert r[0]["service"] == "siding" and r[0]["dps_type"] == "sidetrack_intact_broadstandard_electrified" and r[0]["tracks"] == "multiple"
    assert rows(cat, "yard_label")[0]["yard_size"] == "very_large"


def test_water(cat):
    w = rows(cat, "water_polygon")
    assert sum(x["capped"] for x in w) == 2 and {x["z_level"] for x in w if x["capped"]} == {5, 6}
    merged = [x for x in w if not x["capped"] and x["z_level"] == 12]
    assert len(merged) >= 1
    line = {x["subclass"]: x for x in rows(cat, "water_line")}
    assert line["river"]["z_level"] == 6 and line["river"]["intermittent"] is None
    assert line["stream"]["z_level"] == 11 and line["stream"]["brunnel"] == "tunnel" and line["stream"]["culvert"]
    assert len(rows(cat, "inland_water_intermittent_polygon")) == 1


def test_bathymetry_bands_are_disjoint(cat):
    d = cat.layer("bathymetry_polygon").groupBy("depth", "depth_max").agg(F.sum(jts.area("geometry")).alias("a"))
    got = {(r["depth"], r["depth_max"]): round(r["a"], 6) for r in d.collect()}
    assert set(got) == {(200, 1000), (1000, 3000), (3000, None)}
    assert got[3000, None] == 4 and abs(sum(got.values()) - 16) < 1e-6


def test_ports_and_cemeteries(cat):
    p = {x["osm_id"]: x for x in rows(cat, "port_label")}
    assert p[22]["contained"] == 1 and p[21]["contained"] is None and p[21]["rank"] == 1
    assert [x["osm_id"] for x in rows(cat, "cemetery_polygon")] == [24]


def test_points(cat):
    u = {x["osm_id"]: x for x in rows(cat, "utility_point")}
    assert u[27]["shore"] == "on" and u[28]["shore"] == "off" and u[30]["height"] == "12.5" and u[31]["height"] is None
    assert [(x["osm_id"], x["class"]) for x in rows(cat, "poi_point")] == [(39, "school")]
    assert {x["osm_id"] for x in rows(cat, "energy_polygon")} == {33} and rows(cat, "power_station_polygon")[0]["subclass"] == "plant"
    assert [(x["osm_id"], x["lifecycle_type"], x["subclass"]) for x in rows(cat, "powerline_line")] == [(35, "disused", "line")]


def test_airports(cat):
    a = rows(cat, "airport_label")
    assert [x["airport_id"] for x in a] == [1] and a[0]["runway_surface"] == "ASP" and a[0]["runway_length_ft"] > 5000 and a[0]["category"] == 1
    h = rows(cat, "heliport_point")
    assert [(x["airport_ident"], x["type"], x["rank"]) for x in h] == [("H", "heliport", 1)]


def test_dams(cat):
    d = rows(cat, "dam_label")
    assert {(x["name"], x["water_intersect"]) for x in d} == {("Dam", "Y"), ("W", "N")}


def test_builtup_and_cover(cat):
    b = [x for x in rows(cat, "builtup_polygon") if x["class"] == "overture"]
    assert len(b) == 1 and b[0]["area"] > 1e8
    z = cat.layer("landcover_polygon").groupBy("z_level", "subclass").agg(F.count("*").alias("n"), F.sum("area").alias("a")).collect()
    got = {(r["z_level"], r["subclass"]): r["n"] for r in z}
    assert got[13, "wood"] == 2 and got[13, "bog"] == 1 and got[4, "glacier"] == 1 and (5, "wood") not in got and set(range(4, 14)) == {k for k, _ in got}
    assert {x["z_level"] for x in rows(cat, "landcover_small_polygon")} == {4, 5, 6, 7}


def test_landcover_unites_neighbours_of_one_kind(cat, spark):
    d = spark.createDataFrame([("a", box(0, 0, 60000)), ("a", box(60000, 0, 60000)), ("b", box(120000, 0, 60000)), ("a", box(500000, 0, 10))], "k string, w string").withColumn("geometry", jts.from_wkt("w")).select("k", "geometry")
    got = layers_land.dissolve_touching(d, ["k"]).withColumn("m", jts.area("geometry")).collect()
    assert sorted((r["k"], round(r["m"])) for r in got) == [("a", 100), ("a", 2 * 60000**2), ("b", 60000**2)]


def test_names(cat):
    h = {x["name"]: x for x in rows(cat, "hydrographic_label")}
    assert set(h) == {"Gulf of America", "Med", "Lake America", "Bach", "Big Bend"} and h["Lake America"]["min_label"] == 5.0 and h["Big Bend"]["class"] == "stream bend"
    p = {x["osm_id"]: x for x in rows(cat, "place_labels")}
    assert set(p) == {50, 51, 52, 60, 62} and p[50]["name"] == "Berne" and p[50]["rank"] == 2 and p[50]["capital_role"] == "primary" and p[51]["rank"] == 6 and p[52]["capital"] == 3


def test_borders(cat):
    assert {(x["cc1"], x["cc2"]) for x in rows(cat, "adm0_line")} == {("A", "B"), ("Q2", "E")}
    a = {x["iso_3"]: x for x in rows(cat, "adm0_label")}
    assert set(a) == {"AAA", "GLP"} and a["AAA"]["adm0_name"] == "Isle (FR.)" and a["AAA"]["nga_short_name"] == "A. (FR.)" and a["GLP"]["status_cd"] == 98
    assert [x["iso_2"] for x in rows(cat, "adm1_line")] == ["Z"]
    pct = {r["cc2"]: r["pct"] for r in layers_land.border_coincidence(cat).collect()}
    assert 49 < pct["E"] < 52


def test_water_is_mended_once(cat):
    """Surfaces are written when they are mended and snapped: no later step holds the calls again."""
    plan = cat.layer("water_polygon")._jdf.queryExecution().optimizedPlan().toString()
    assert "ct_reduce_precision(" not in plan and "ct_simplify(" not in plan
