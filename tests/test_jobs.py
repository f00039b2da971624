import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from streetloom.operators import errors, geocode, objects, pairs
from streetloom.plans import pack, report, validate
from streetloom.schemas import GEOCODING_FIELDS, PAIR_COLUMNS, RECORD_SCHEMA, TARGET_COLUMNS, TRIPLE_SCHEMA
from streetloom.sources import files

PLACE = "place_id long, name string, house_number string, road string, postcode string, locality string, region string, country string, country_code string"


def test_lookup_equals_brute_force(spark):
    rng = random.Random(2)

    def word(options):
        return rng.choice([*options, None])

    places = [
        (i, word(["Cafe", "Bar"]), word(["1", "2"]), word(["Main", "Oak"]), word(["100", "200"]),
         word(["Town", "City"]), word(["East", "West"]), *rng.choice([("Landia", "la"), ("Other", "ot"), (None, None)]))
        for i in range(150)
    ]
    queries = [
        (i, word(["cafe", "BAR"]), rng.choice(["Main 1", "Oak 2", "main", "Oak 3", None]), word(["Town", "CITY"]),
         word(["100", "300"]), word(["LA", "Landia", "Nowhere"]), word(["east"]))
        for i in range(400)
    ]

    def low(x):
        return x.lower() if x else None

    def best(q):
        _, name, street, city, code, country, state = q
        road, _, house = (street or "").partition(" ")
        asked = {
            "name": low(name), "road": low(road) or None, "house_number": house or None, "postcode": code,
            "locality": low(city), "region": low(state),
        }
        where = ["postcode"], ["locality", "region"], ["locality"]
        what = (
            ["name", "road", "house_number"], ["name", "road"], ["road", "house_number"], ["road"], ["name"], [],
        )
        for level, (fields, bare) in enumerate((w + x, not w) for w in what for x in where):
            if any(asked[f] is None for f in fields):
                continue
            hits = [
                p[0] for p in places
                if all(low(dict(zip(PLACE_NAMES, p))[f]) == asked[f] for f in fields)
                and not (bare and (p[1] or p[2] or p[3]))
                and (country is None or low(country) in (low(p[7]), low(p[8])))
            ]
            if hits:
                return level, min(hits)
        return None, None

    asked = spark.createDataFrame(
        queries, "n int, name string, street string, city string, postalcode string, country string, state string"
    )
    got = geocode.geocode(asked, spark.createDataFrame(places, PLACE)).collect()
    assert len(got) == len(queries)
    assert {r["n"]: (r["match_level"], r["place_id"]) for r in got} == {q[0]: best(q) for q in queries}


PLACE_NAMES = [part.split()[0] for part in PLACE.split(", ")]


def test_stored_index_gives_the_same_answers(spark, tmp_path):
    places = spark.createDataFrame([(1, "A", "1", "Main", "100", "Town", "East", "Landia", "la")], PLACE)
    asked = spark.createDataFrame([("A", "Main 1", "Town", None, "la", None)], "name string, street string, city string, postalcode string, country string, state string")
    geocode.place_index(places).write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    for kwargs in ({}, {"index": index}, {"stage": str(tmp_path / "stage")}):
        row = geocode.geocode(asked, places, **kwargs).first()
        assert (row["place_id"], row["match_level"]) == (1, 2)


DOC = {
    "@graph": [
        {
            "@type": "Store",
            "name": "",
            "legalName": "Kaffee & Co",
            "address": {
                "@type": "PostalAddress",
                "streetAddress": ["Main 1", None, ""],
                "addressLocality": "Town",
                "postalCode": 100,
                "addressCountry": {"@type": "Country", "name": "LA"},
            },
            "branch": {"name": "Empty", "address": {"@type": "PostalAddress"}},
        }
    ]
}


@pytest.fixture
def record_files(tmp_path):
    record = {"data": DOC, "crawl_metadata": {"url": "http://u", "warc_rec_id": "r", "warc_date": "d"}}
    path = tmp_path / "seg" / "00001.json.gz"
    path.parent.mkdir()
    with gzip.open(path, "wt", encoding="utf-8") as f:
        json.dump([record, {"data": [1, {"address": "text"}], "crawl_metadata": {}}], f, indent=2)
    return tmp_path


def test_arrays_of_records_to_dataset(spark, record_files, tmp_path):
    places = spark.createDataFrame([(7, "Kaffee Co", "1", "Main", "100", "Town", "East", "Landia", "la")], PLACE)
    records = files.read_records(spark, str(record_files / "seg"), RECORD_SCHEMA, arrays=True)
    triples = validate.validate_triples(records, places)
    assert triples.count() == 2
    out = str(tmp_path / "triples")
    files.write_records(triples, out)
    stored = files.read_records(spark, out, TRIPLE_SCHEMA)
    packed = pairs.pack_pairs(stored).collect()
    assert [r.asDict() for r in packed] == [
        dict(zip([*PAIR_COLUMNS, *TARGET_COLUMNS], [
            "Kaffee & Co", "Main", "1", "Town", "100", None, "LA", "la",
            "Kaffee Co", "Main", "1", "Town", "100", "East", "Landia", "la",
        ]))
    ]


def test_requests(spark):
    df = spark.createDataFrame([(json.dumps(DOC),)], "t string").select(F.parse_json("t").alias("data"))
    normal = objects.normalised_query(objects.address_query(objects.address_objects(df)))
    got = sorted(r["request"] for r in objects.query_params(normal).collect())
    fixed = "format=geocodejson&limit=1&addressdetails=1&namedetails=1&extratags=1&amenity="
    assert got == [fixed + "Empty", fixed + "Kaffee+%26+Co&street=Main+1&city=Town&country=LA&postalcode=100"]


def triple(name, street, city, answer):
    return (
        answer and {"properties": {"geocoding": dict(zip(GEOCODING_FIELDS, answer))}},
        {"name": name, "street": street, "city": city, "postalcode": None, "country": "de", "state": ""},
    )


TRIPLES = "osm struct<properties: struct<geocoding: struct<name: string, street: string, housenumber: string, city: string, state: string, country: string, postcode: string, country_code: string>>>, address_query struct<name: string, street: string, city: string, postalcode: string, country: string, state: string>"
FULL = ("N", "Main", "1", "Town", "S", "C", "9", "cc")


def test_blank_text_counts_as_present(spark):
    rows = [
        triple("a", "", "", FULL),  # a blank city is kept
        triple("b", "", None, FULL),  # a blank street has no road, so nothing is left
        triple("c", "Main 1", "x", None),  # no answer
    ]
    got = pairs.pack_pairs(spark.createDataFrame(rows, TRIPLES)).collect()
    assert [(r["name"], r["street"], r["state"], r["countrycode"]) for r in got] == [("a", None, "", "de")]


def test_job_writes_aligned_csv_files(spark, tmp_path):
    rows = [triple("a", "main 1", "x", FULL), triple("a", "MAIN 1", "x", FULL), triple("b", "q", "x", FULL[:2] + (None,) + FULL[3:])]
    df = spark.createDataFrame(rows, TRIPLES).withColumn("section", F.lit("s1"))
    out = str(tmp_path / "packed")
    pack.run(spark, df, out)
    assert files.read_sections(spark, f"{out}/sections").count() == 2
    values = files.read_csv(spark, f"{out}/values", PAIR_COLUMNS)
    targets = files.read_csv(spark, f"{out}/targets", PAIR_COLUMNS)
    both = errors.pair_join(values, targets, PAIR_COLUMNS).collect()
    assert [(r["row_id"], r["street"], r["state"], r["postalcode"], r["true_street"]) for r in both] == [
        (0, "Main", "", None, "Main")
    ]


def test_no_rows_keep_the_schema(spark):
    empty = spark.createDataFrame([], TRIPLES)
    assert pack.pack_dataset(empty).columns == [*PAIR_COLUMNS, *TARGET_COLUMNS]
    assert pack.pack_dataset(empty).count() == 0


def test_outside_csv_is_numbered_in_file_order(spark, tmp_path):
    path = tmp_path / "values.csv"
    path.write_text("a,b\n" + "".join(f'{i},"x ""{i}"""\n' for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = files.read_outside_csv(spark, str(path), ["a", "b"])
        rows = df.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 20_000
    assert all(r["row_id"] == int(r["a"]) for r in rows)
    assert rows[0]["b"].startswith('x "')


def test_cell_updates_file(spark, tmp_path):
    path = tmp_path / "cells.json"
    path.write_text(json.dumps([{"row": 1, "col": 2, "value": "a"}, {"row": 1, "col": 2, "value": None}], indent=1))
    got = files.read_cell_updates(spark, str(path)).orderBy("ord").collect()
    assert [tuple(r) for r in got] == [(0, 1, 2, "a"), (1, 1, 2, None)]


def test_csv_keeps_null_blank_and_odd_text(spark, tmp_path):
    rows = [(0, None, ""), (1, " a ", 'q"q'), (2, "a,b", "x\\y"), (3, "l1\nl2", "\\"), (4, "\\n\r\n\\N", "\\N"), (5, "\\s\n", "\n")]
    df = spark.createDataFrame(rows, "row_id long, a string, b string")
    files.write_csv(df, str(tmp_path / "t"))
    got = files.read_csv(spark, str(tmp_path / "t"), ["a", "b"]).orderBy("row_id").collect()
    assert [tuple(r) for r in got] == rows


def test_shares_of_classes_sum_to_one(spark):
    rows = [(i, f"v{i}", f"V{i % 3}") for i in range(9)]
    df = spark.createDataFrame(rows, "row_id long, a string, b string")
    both = errors.pair_join(df.selectExpr("row_id", "a as x"), df.selectExpr("row_id", "b as x"), ["x"])
    classes = errors.cell_errors(both)
    assert abs(sum(r["share"] for r in errors.error_type_totals(classes).collect()) - 1) < 1e-12
    row = errors.error_matrix(classes, ["x"]).first()
    assert abs(sum(v for k, v in row.asDict().items() if k.endswith("share")) - 1) < 1e-12
    accuracy = errors.cell_accuracy(both).first()
    assert accuracy["total_cells"] == 9


def test_reports(spark):
    truth = spark.createDataFrame([(0, "Main Street", "x"), (1, "Oak", None)], "row_id long, road string, city string")
    dirty = spark.createDataFrame([(0, "Main St", "X"), (1, None, None)], "row_id long, road string, city string")
    tables = report.error_report(dirty, truth, ["road", "city"])
    matrix = {r["column_name"]: r for r in tables["matrix"].collect()}
    assert list(matrix) == ["road", "city"]
    assert (matrix["road"]["synonym"], matrix["road"]["missing"], matrix["road"]["synonym share"]) == (1, 1, 0.5)
    assert (matrix["city"]["capitalization"], matrix["city"]["match"]) == (1, 1)
    # a null on both sides matches, but is not a correct cell
    assert tables["accuracy"].first()["correct_cells"] == 0
    assert {r["column"]: r["match"] for r in tables["fields"].collect()} == {"road": 0, "city": 1}
    updates = spark.createDataFrame([(0, 0, 0, "Main Street"), (1, 1, 0, "Elm")], "ord long, row long, col int, value string")
    line = report.update_report(dirty, truth, updates, "d", "t", ["road", "city"]).first()
    assert (line["dataset"], line["tool"], line["precision"], line["recall"]) == ("d", "t", 0.5, 0.5)
    assert line["edr"] == 0.25


def test_blank_as_null(spark):
    rows = [triple("a", "Main 1", " ", FULL), triple("a", "Main 1", None, FULL)]
    df = spark.createDataFrame(rows, TRIPLES)
    assert pack.pack_dataset(df).count() == 2
    got = pack.pack_dataset(df, blank_as_null=True).collect()
    assert [(r["name"], r["city"], r["target_city"]) for r in got] == [("a", None, "Town")]
