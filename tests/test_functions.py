from pyspark.sql import functions as F

from vasculum.functions import barcodes as B, names as N, numbers as O, values as V


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_collection_numbers(spark):
    rows = [("1234",), ("SJ 12A",), ("PPI 12-345",), ("SR_12",), ("10/2011",), ("12 34 56",), ("12-3-4b",), ("s.n.",)]
    gbif, p = O.split_colnum(F.col("n"), "GBIF"), O.split_colnum(F.col("n"), "P")
    got = one(spark, rows, "n string", gbif["prefix"], gbif["sufix"], gbif["colnum"], p["colnum"])
    assert got == [
        (None, None, "1234", "1234"), ("SJ", "A", "12", "12"), ("PPI", None, "12-345", "12-345"),
        ("SR", "SR_12", "12", "12"), (None, None, "10/2011", "10/2011"), (None, None, "12", "12 34 56"),
        (None, "b", "12-3-4", "12-3-4"), ("s", None, None, None),
    ]


def test_gbif_barcodes(spark):
    rows = [("K000123456", "K"), ("K-000123", "K"), ("12345", "MO"), ("12345", "Missouri Bot"),
            ("ABC-DE-0001", None), ("P 00/12", "P"), ("K0", "K"), (None, "K"), ("123", "PLANT")]
    got = one(spark, rows, "b string, i string", B.gbif_barcode(F.col("b"), F.col("i")))
    assert [g[0] for g in got] == [
        "K000123456", "K-000123", "MO12345", "12345", "ABC-DE-0001", "P00/12", None, None, "TAIF123",
    ]


def test_collector_names(spark):
    expected = {
        "Meade, C.": "Meade, C", "Meade, Chris": "Meade, C", "Meade C": "Meade, C", "Chris Meade": "Meade, C",
        "C. Meade": "Meade, C", "Doe, J.K.L.": "Doe, JKL", "Doe, J. & Roe, A.": "Doe, J", "de Wilde, WJ": None,
        "Doe, John K. L.": None, "Wilde, W. J. de": "Wilde, WJ de", "W. J. de Wilde": "Wilde, WJ de",
        "Müller, Élodie": "Müller, É", "Doe, A. B. C. D.": "Doe, ABCD", "": None,
    }
    rows = [(k,) for k in expected]
    got = one(spark, rows, "n string", F.col("n"), N.standardise_name(N.first_collector(F.col("n"))))
    assert dict(got) == expected
    assert one(spark, [(None,)], "n string", N.standardise_name(F.col("n"))) == [(None,)]


def test_dates_and_cells(spark):
    d = V.day_month_year(F.col("a"), "c")
    i = V.iso_date(F.col("b"), "d")
    rows = [("03/05/1998-07/05/1998", "2011-05-03T00:00:00"), (None, None)]
    assert one(spark, rows, "a string, b string", *d.values(), *i.values()) == [(3, 5, 1998, 2011, 5, 3), (None,) * 6]
    cells = [("A1, B2, A1, <NA>", "Doe, J / Doe, J", "u1 - u2 - u1")]
    assert one(
        spark, cells, "a string, b string, c string",
        V.dedup_cell(F.col("a"), ", "), V.dedup_cell(F.col("b"), " / "), V.dedup_cell(F.col("c"), " - "),
    ) == [("A1, B2", "Doe, J", "u1 - u2")]


def test_barcode_cells(spark):
    rows = [("K000123, 123, 99", ), ("K0, 7", )]
    got = one(spark, rows, "c string", B.tidy_barcode_cell(F.col("c")), B.has_bare_number(F.col("c")))
    assert got == [("K000123, 99", True), ("7", True)]


def test_indel_ratio(spark):
    rows = [("kitten", "sitting"), ("abc", "abc"), ("", "")]
    got = [round(r[0], 4) for r in one(spark, rows, "a string, b string", N.indel_ratio("a", "b"))]
    assert got == [61.5385, 100.0, 100.0]


def test_record_ids_of_equal_rows(spark, monkeypatch):
    from vasculum.sources import readers

    monkeypatch.setattr(readers, "COPIES", 7)
    rows = [("a", None)] * 40 + [(None, "a")] * 7 + [("a", ""), ("", "a"), ("1:a", None), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "x string, y string")
    ids = readers.number_copies(df, F.lit("s")).collect()
    assert sorted(map(str, rows)) == sorted(str((r.x, r.y)) for r in ids)
    assert len({r.record_id for r in ids}) == len(rows)
    assert len({r.record_id.split("-")[0] for r in ids}) == len(set(rows))
    again = readers.number_copies(df.repartition(5), F.lit("s")).collect()
    assert sorted(r.record_id for r in again) == sorted(r.record_id for r in ids)
    assert readers.number_copies(df.limit(0), F.lit("s")).count() == 0
