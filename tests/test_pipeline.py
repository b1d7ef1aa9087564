"""Provider files to a filed master table, on small fixtures."""

import pytest
from pyspark.sql import functions as F

from vasculum.operators import geo
from vasculum.operators.experts import expert_matches, integrate_expert
from vasculum.operators.groups import materialise
from vasculum.plans.cleaner import check_coordinates, clean_columns, clean_expert, clean_records, standardise_names
from vasculum.plans.filer import integrate, integrate_small_expert
from vasculum.plans.finisher import finish
from vasculum.schema import MASTER_COLUMNS, RAW_COLUMNS, SOURCES
from vasculum.sources.readers import conform_master, read_expert, read_source
from vasculum.sources.tables import (
    Ledger, append_quarantine, apply_corrections, read_master_csv, read_set, read_store, run_stamp, versions, write_csv, write_store,
)

GBIF = {
    "basisOfRecord": "PRESERVED_SPECIMEN", "occurrenceStatus": "PRESENT", "scientificName": "Annona alba", "genus": "Annona",
    "species": "Annona alba", "countryCode": "GA", "locality": "Makokou", "decimalLatitude": "0.5", "decimalLongitude": "12.5",
    "recordedBy": "J. Doe & A. Roe", "recordNumber": "SJ 12A", "day": "3", "month": "5", "year": "1998", "identifiedBy": "Roe, A.",
    "dateIdentified": "2011-05-03T00:00:00", "institutionCode": "MO", "collectionCode": "x", "catalogNumber": "123",
    "references": "", "bibliographicCitation": "cited", "unused": "z",
}


def write(path, separator, rows):
    columns = list(rows[0])
    lines = [separator.join(columns)] + [separator.join(str(r[c]) for c in columns) for r in rows]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def countries(spark):
    return spark.createDataFrame([("Gabon", "GA", "GAB", "Gabon")], "alias string, iso2 string, iso3 string, name_short string")


def areas(spark):
    ring = [(8.1, -4.2), (15.3, -4.1), (15.2, 3.9), (8.3, 3.8)]
    rows = [("GAB", 0, i, x, y) for i, (x, y) in enumerate(ring)]
    return geo.area_cells(spark.createDataFrame(rows, "iso3 string, ring int, seq int, lon double, lat double"), ["iso3"])


def backbone(spark):
    rows = [
        (1, "Annona", "alba", False, "Annona alba", "L.", 2, 1800, ["Gabon"]),
        (2, "Annona", "nigra", True, "Annona nigra", "Mill.", None, 1810, ["Gabon", "Congo"]),
    ]
    return spark.createDataFrame(
        rows, "id long, genus string, epithet string, accepted boolean, name string, author string, accepted_id long, pub_year int, native_to array<string>"
    )


def botanists(spark):
    rows = [(1, "Doe, John", 1950, None, "Africa", "w"), (2, "Doe, Kim", 1960, None, None, None)]
    return spark.createDataFrame(rows, "link_id long, name string, dobirth int, dodeath int, geo_col string, wiki_url string")


def test_every_provider_reads(spark, tmp_path):
    for name, spec in SOURCES.items():
        row = {c: "1" for c in [*spec.columns, *spec.require]} | spec.require
        path = write(tmp_path / f"{name}.csv", spec.separator, [row, row | {list(spec.columns)[0]: "2"}])
        typed, bad = clean_columns(read_source(spark, path, name), name)
        assert typed.columns[: len(RAW_COLUMNS)] == RAW_COLUMNS
        assert typed.count() + bad.count() == 2
        assert {r.source_id for r in typed.collect()} == {spec.source_id}
    with pytest.raises(ValueError):
        read_source(spark, path, "unknown")


def test_herbonautes_dates_and_coordinates(spark, tmp_path):
    row = {c: "" for c in SOURCES["P"].columns} | {
        "specimen...code": "P1", "collector...collector": "Doe, J.", "collect_number...number": "12 34 56",
        "collect_date...collect_date": "03/05/1998-07/05/1998", "geo...position": "1.5, 12.25",
    }
    typed, _ = clean_columns(read_source(spark, write(tmp_path / "p.csv", ";", [row]), "P"), "P")
    (r,) = typed.collect()
    assert (r.col_day, r.col_month, r.col_year, r.ddlat, r.ddlong, r.colnum, r.det_year) == (3, 5, 1998, 1.5, 12.25, "12 34 56", None)


def gbif_file(spark, tmp_path):
    rows = [
        GBIF,
        GBIF | {"catalogNumber": "K0007", "dateIdentified": "2015-01-01", "species": "Annona nigra"},
        GBIF | {"catalogNumber": "", "recordNumber": "99"},
        GBIF | {"recordedBy": "Forest Research Institute (FRI)", "catalogNumber": "55"},
        GBIF | {"basisOfRecord": "HUMAN_OBSERVATION"},
        GBIF | {"catalogNumber": "77", "institutionCode": "AAU"},
        GBIF | {"catalogNumber": "88", "recordNumber": "", "decimalLatitude": "", "countryCode": ""},
    ]
    return read_source(spark, write(tmp_path / "gbif.txt", "\t", rows), "GBIF")


def test_cleaning_run(spark, tmp_path):
    done = clean_records(
        gbif_file(spark, tmp_path), "GBIF", botanists(spark), countries(spark), areas(spark), backbone(spark)
    )
    rows = {r.barcode: r for r in done.clean.collect()}
    merged = rows["K0007, MO123"]
    assert (merged.recorded_by, merged.recby_regex if "recby_regex" in merged else None) == ("Doe, John", "Doe, J") or merged.recorded_by == "Doe, J"
    assert (merged.accepted_name, merged.status, merged.country_iso3) == ("Annona nigra", "ACCEPTED", "GAB")
    assert merged.link == "cited - cited"
    assert rows["MO88"].status == "SYNONYM" and rows["MO88"].accepted_name == "Annona nigra"
    assert set(rows) == {"K0007, MO123", "MO88"}
    assert done.quarantine["no_barcode"].count() == 1
    assert [r.to_check for r in done.quarantine["names_to_check"].collect()] == ["recby_problem"]


def test_corrections_go_back(spark, tmp_path):
    typed, _ = clean_columns(gbif_file(spark, tmp_path), "GBIF")
    _, to_check = standardise_names(typed)
    fixes = to_check.select("record_id").withColumns({"recorded_by": F.lit("Fri, F"), "det_by": F.lit(None).cast("string")})
    fixed, left = apply_corrections(to_check, fixes, ["recorded_by", "det_by"])
    assert [r.recorded_by for r in fixed.collect()] == ["Fri, F"] and left.count() == 0


def test_filing_and_store(spark, tmp_path):
    cleaned = clean_records(gbif_file(spark, tmp_path), "GBIF", None, countries(spark), areas(spark), backbone(spark)).clean
    near = geo.point_cells(
        spark.createDataFrame([("capitals", 0.4, 9.4, 1000.0)], "kind string, lat double, lon double, radius double"), ["kind"]
    )
    coast = geo.coast_cells(spark.createDataFrame([(8.0, -4.0, 8.0, 4.0)], "lon1 double, lat1 double, lon2 double, lat2 double"))
    checked = conform_master(check_coordinates(cleaned, areas(spark), near, coast), ["record_id"])
    empty = checked.limit(0)
    root, stamp = str(tmp_path / "store"), run_stamp("me", "2024-01-01_00-00-00")
    assert read_store(spark, root) is None
    filed = integrate({"master": empty, "indet": empty, "coord": empty}, checked, ["record_id"], stamp)
    write_store({t: filed.table(t) for t in ("master", "indet", "coord")}, root, "v1")
    again = integrate(read_store(spark, root), checked, ["record_id"], stamp)
    write_store({t: again.table(t) for t in ("master", "indet", "coord")}, root, "v2")
    assert versions(spark, root) == ["v1", "v2"]
    # Filing the same records again changes nothing.
    first, second = read_store(spark, root, "v1"), read_store(spark, root)
    for name in ("master", "indet", "coord"):
        a, b = first[name].drop("record_id"), second[name].drop("record_id")
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert second["master"].count() == 1
    assert {r.modified for r in second["master"].collect()} == {"me_2024-01-01_00-00-00"}
    quarantine = str(tmp_path / "quarantine")
    append_quarantine(filed.no_barcode, quarantine, stamp)
    append_quarantine(again.no_barcode, quarantine, stamp)
    write_csv(second["master"].select(MASTER_COLUMNS), str(tmp_path / "csv"), -9999)
    back = read_master_csv(spark, str(tmp_path / "csv"))
    assert sorted(map(str, back.collect())) == sorted(map(str, second["master"].select(MASTER_COLUMNS).collect()))


def small_master(spark):
    rows = [
        (1, "Doe, J", "12", "K1", "Annona alba", 1.0, "SJ"), (2, "Doe, J", "13", None, "Annona alba", 1.0, None),
        (3, "Doe, J", "14", "K3", None, 1.0, None), (4, "Doe, J", "15", "K4", "Annona nigra", None, None), (5, None, None, "K5", "Annona alba", 2.0, None),
        (6, "Roe, A", "7", "K6", "Annona alba", 1.0, None), (7, "Roe, A", "7", "K7", "Annona alba", 9.0, None),
    ]
    schema = "record_id long, recorded_by string, colnum string, barcode string, accepted_name string, ddlat double, prefix string"
    return conform_master(spark.createDataFrame(rows, schema).withColumn("ddlong", F.col("ddlat")), ["record_id"])


def test_a_filing_run_commits_everything_or_nothing(spark, tmp_path):
    root, stamp = str(tmp_path / "store"), run_stamp("me", "2024-01-01_00-00-00")
    master = small_master(spark)
    empty = master.limit(0)
    filed = integrate({"master": empty, "indet": empty, "coord": empty}, master, ["record_id"], stamp)
    counts = filed.commit(root, "v2")
    assert counts == {"master": 1, "indet": 1, "coord": 1, "quarantine": 1, "no_barcode": 1, "scattered": 2}
    assert all(same for *_, same in filed.ledger.counts())
    assert {r.record_id for r in read_set(spark, root, "scattered").collect()} == {6, 7}
    assert [r.record_id for r in read_set(spark, root, "no_barcode").collect()] == [2]
    assert {t: d.count() for t, d in read_store(spark, root).items()} == {"master": 1, "indet": 1, "coord": 1}

    # A run that breaks off before its manifest leaves nothing that is read, and can be repeated.
    def broken(counts):
        raise RuntimeError("broken off")

    tables = read_store(spark, root)
    with pytest.raises(RuntimeError):
        write_store(tables, root, "a1", broken)
    assert versions(spark, root) == ["v2"]
    write_store(tables, root, "a1")
    # Order is that of the manifests, not of names.
    assert versions(spark, root) == ["v2", "a1"] and read_store(spark, root, "v2")["master"].count() == 1
    with pytest.raises(ValueError):
        read_set(spark, root, "unknown")
    with pytest.raises(ValueError):
        read_store(spark, root, "v9")


def test_lost_and_doubled_rows_stop_a_run(spark, tmp_path):
    df = spark.range(10)
    ledger = Ledger()
    whole = ledger.before("split", df)
    for part in (ledger.after("split", whole.filter("id < 4")), ledger.after("split", whole.filter("id > 4"))):
        part.write.format("noop").mode("overwrite").save()
    assert ledger.counts() == [("split", 10, 9, False)]
    with pytest.raises(ValueError, match="split: 10 rows before, 9 after"):
        ledger.require()


def test_sets_of_one_run_do_not_replace_each_other(spark, tmp_path):
    path, stamp = str(tmp_path / "quarantine"), run_stamp("me", "2024-01-01_00-00-00")
    append_quarantine(spark.range(2), path, stamp, "numbered")
    append_quarantine(spark.range(2, 3), path, stamp, "unnumbered")
    append_quarantine(spark.range(2), path, stamp, "numbered")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2]


def test_expert_patches_a_master_record_without_barcode(spark):
    master = small_master(spark).filter("record_id in (2, 6)").withColumn("accepted_name", F.lit("old"))
    rows = [(10, "Doe, J", "13", None, "new", "Roe, A", 2020), (11, "Poe, B", "1", None, "other", "Roe, A", 2020), (12, "Roe, A", "99", "K6", "coded", "Roe, A", 2021)]
    schema = "record_id long, recorded_by string, colnum string, barcode string, accepted_name string, det_by string, det_year int"
    expert = spark.createDataFrame(rows, schema).withColumns({c: F.lit(None).cast("string") for c in ("prefix", "sufix", "source_id", "status", "expert_det", "ipni_no")})
    out = {(r.recorded_by, r.colnum): r for r in integrate_expert(master, expert, ["record_id"]).collect()}
    assert out["Doe, J", "13"].accepted_name == "new" and out["Doe, J", "13"].expert_det == "EXP" and out["Doe, J", "13"].barcode is None
    assert ("Poe, B", "1") in out
    matches = {r.record_id: (r.matched_by, r.m_record_id) for r in expert_matches(master, expert.withColumn("accepted_name", F.nullif("accepted_name", F.lit("other"))), ["record_id"]).collect()}
    assert matches == {10: ("number", 2), 11: ("refused", None), 12: ("barcode", 6)}


def test_small_expert_file(spark, tmp_path):
    row = {
        "ddlat": "0.6", "ddlong": "12.6", "locality": "", "country": "Gabon", "recorded_by": "Doe, J.", "colnum_full": "SJ 12A",
        "det_by": "Roe, A.", "det_date": "2020/1/2", "barcode": "", "accepted_name": "Annona nova", "col_year": "1998", "col_month": "5", "col_day": "3",
    }
    path = write(tmp_path / "exp.csv", ";", [row, row | {"recorded_by": "???"}])
    good, bad = read_expert(spark, path)
    assert bad.count() == 1
    expert = clean_expert(good, None, backbone(spark), countries(spark), areas(spark))
    (e,) = expert.collect()
    assert (e.barcode, e.colnum, e.det_year, e.country_iso3) == ("Roe_det_1", "12", 2020, "GAB")
    cleaned = clean_records(gbif_file(spark, tmp_path), "GBIF", None, countries(spark), None, backbone(spark)).clean
    master = conform_master(cleaned, ["record_id"])
    filed = integrate_small_expert({"master": master}, expert, ["record_id"]).routed
    named = [r for r in filed.collect() if r.accepted_name == "Annona nova"]
    assert len(named) == 1
    (n,) = named
    assert (n.expert_det, n.status, n.ddlat, n.det_by) == ("EXP", "ACCEPTED", 0.6, "Roe, A")
    assert set(n.barcode.split(", ")) == {"K0007", "MO123", "Roe_det_1"}
    assert n.source_id.endswith("specialist")


def test_country_of_points_by_brute_force(spark):
    """Concave areas, against plain ray casting."""
    import random

    rng = random.Random(5)
    rings = {
        "AAA": [(-5.21, -4.13), (6.37, -3.71), (7.93, 5.57), (0.31, 1.17), (-4.77, 6.03)],
        "BBB": [(8.11, -2.23), (12.71, -1.93), (9.87, 8.49)],
    }
    rows = [(k, 0, i, x, y) for k, ring in rings.items() for i, (x, y) in enumerate(ring)]
    cells = geo.area_cells(spark.createDataFrame(rows, "iso3 string, ring int, seq int, lon double, lat double"), ["iso3"])
    points = [(i, rng.uniform(-6, 9), rng.uniform(-7, 14)) for i in range(800)]
    df = spark.createDataFrame(points + [(-1, None, 1.0)], "id int, ddlat double, ddlong double")

    def inside(ring, x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1):
                odd = not odd
        return odd

    got = {r.id: r.land for r in geo.locate(df, cells, {"iso3": "land"}).collect()}
    for i, y, x in points:
        hits = [k for k, ring in rings.items() if inside(ring, x, y)]
        assert got[i] == (min(hits) if hits else None)
    assert got[-1] is None


def test_coast_over_the_date_line(spark):
    cells = geo.coast_cells(spark.createDataFrame([(179.9, 0.0, -179.9, 0.0)], "lon1 double, lat1 double, lon2 double, lat2 double"))
    df = spark.createDataFrame([(1, 0.02, 179.97), (2, 0.02, -179.97), (3, 0.2, 0.0)], "id int, ddlat double, ddlong double")
    got = {r.id: r for r in geo.nearest_coast(df, cells).collect()}
    assert abs(got[1].coast_distance - 2224) < 5 and abs(got[2].coast_distance - 2224) < 5
    assert abs(got[2].coast_lon + 179.97) < 1e-6 and got[3].coast_distance is None


def test_nearest_place_by_brute_force(spark):
    """Dense, sparse and far places, over the date line and near a pole, whatever ring they are found in."""
    import math
    import random

    rng = random.Random(11)
    places = [(rng.uniform(0, 0.3), rng.uniform(0, 0.3), f"dense {i:03}") for i in range(80)]
    places += [(rng.uniform(-60, 60), rng.uniform(-180, 180), f"sparse {i:03}") for i in range(40)] + [(0.1, 179.95, "line"), (-80.0, 10.0, "pole")]
    points = [(i, rng.uniform(-0.2, 0.6), rng.uniform(-0.2, 0.6)) for i in range(120)]
    points += [(200 + i, rng.uniform(-60, 60), rng.uniform(-179, 179)) for i in range(120)] + [(400, 0.2, -179.9), (401, -80.1, 10.4), (402, -80.1, 10.4)]

    def metres(a, b, c, d):
        a, c = math.radians(a), math.radians(c)
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * geo.EARTH_RADIUS * math.asin(math.sqrt(min(h, 1)))

    want = {}
    for i, lat, lon in points:
        d, label = min((metres(lat, lon, la, lo), label) for la, lo, label in places)
        want[i] = (label, round(d, 3)) if d <= 600_000 else (None, None)
    df = spark.createDataFrame(points + [(-1, None, 1.0), (-2, None, None)], "id int, ddlat double, ddlong double")
    frame = spark.createDataFrame(places, "lat double, lon double, label string")
    got = {r.id: (r.place, r.place_distance and round(r.place_distance, 3)) for r in geo.nearest_place(df, frame, {"label": "place"}, 600_000.0, size=4.0).collect()}
    assert got.pop(-1) == got.pop(-2) == (None, None) and got == want
    assert sum(label is None for label, _ in want.values()) > 5


def test_final_cleaning_with_corrections(spark):
    rows = [
        (1, "Doe, J", "12", "K0012, 0012, K0", "Annona alba", "NY, New York"), (2, "Doe, J", "12", "771", "Annona alba", None),
        (3, None, "5", "99", None, "Some Herbarium"), (4, "Roe, A", "1", None, None, "MO"),
    ]
    df = spark.createDataFrame(rows, "record_id long, recorded_by string, colnum string, barcode string, accepted_name string, herbarium_code string")
    df = conform_master(df, ["record_id"])
    done = finish(df, ["record_id"])
    assert {r.record_id for r in done.to_check.collect()} == {2, 3}
    clean = {r.record_id: (r.barcode, r.herbarium_code) for r in done.clean.collect()}
    assert clean == {1: ("K0012, 771", None), 3: ("99", None), 4: (None, "MO")}
    by_hand = spark.createDataFrame([(2, "P771"), (3, None)], "record_id long, barcode string")
    again = finish(df, ["record_id"], by_hand)
    assert {r.record_id: r.barcode for r in again.clean.collect()} == {1: "K0012, P771", 3: "99", 4: None}
    assert {r.record_id for r in again.to_check.collect()} == {3}


def test_coast_and_flags_are_searched_once_for_each_coordinate(spark):
    """Many records at few coordinates meet segments as rows, one row a distinct coordinate; records keep their own values."""
    segments = [(10.0 + 0.02 * i, 0.01 * i, 10.0 + 0.02 * i, 0.01 * i + 0.015) for i in range(6)]
    cells = materialise(geo.coast_cells(spark.createDataFrame(segments, "lon1 double, lat1 double, lon2 double, lat2 double"), 5_000.0))
    spots = [(10.01, 0.005), (10.047, 0.03), (9.98, 0.0), (12.0, 1.0), (None, 1.0), (None, None)]
    df = spark.range(300).select(
        "id", F.element_at(F.array(*[F.lit(x).cast("double") for x, _ in spots]), (F.col("id") % 6 + 1).cast("int")).alias("ddlong"),
        F.element_at(F.array(*[F.lit(y).cast("double") for _, y in spots]), (F.col("id") % 6 + 1).cast("int")).alias("ddlat"),
    )
    found = geo.nearest_coast(df, cells, 5_000.0)
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r.id: r for r in found.collect()}
    assert len(got) == 300 and found.columns == ["id", "ddlong", "ddlat", "coast_distance", "coast_lat", "coast_lon"]
    for i, row in got.items():
        x, y = spots[i % 6]
        if x is None or x > 11:
            assert row.coast_distance is None and row.coast_lat is None and row.coast_lon is None
            continue
        # The segments run north, so the nearest point of one is on its own meridian.
        near = [(((a - x) ** 2 + (min(max(y, s), n) - y) ** 2) ** 0.5, min(max(y, s), n), a) for a, s, _, n in segments]
        distance, lat, lon = min(near)
        assert row.coast_distance == pytest.approx(distance * geo.METRES_PER_DEGREE, rel=1e-3)
        assert (row.coast_lat, row.coast_lon) == (pytest.approx(lat, abs=1e-6), pytest.approx(lon, abs=1e-6))
