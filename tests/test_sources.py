from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException, ArithmeticException, NumberFormatException
from pyspark.sql import functions as F
from samples import RUN_AT, source_trips

from tripmart.schemas import RAW_TRIPS, RAW_ZONES
from tripmart.sinks import write_csv_files
from tripmart.sources import MalformedRow, bronze_trips, bronze_zones, read_csv_files, read_trip_files, read_zone_files


def write_csv(directory, text):
    path = directory / "zones.csv"
    path.write_text(text)
    return str(path)


def test_trip_files_become_declared_columns(spark, tmp_path):
    source_trips(spark, {"passenger_count": float("nan"), "fare_amount": 10.123456789, "tip_amount": float("nan")}).coalesce(
        1
    ).write.parquet(str(tmp_path / "trips"))
    bronze = bronze_trips(read_trip_files(spark, str(tmp_path / "trips")), RUN_AT)
    assert [(field.name, field.dataType) for field in bronze.schema] == list(RAW_TRIPS.columns)
    row = bronze.first()
    assert row["passenger_count"] is None and row["tip_amount"] is None
    assert row["fare_amount"] == Decimal("10.123457")
    assert row["vendor_id"] == 1 and row["pulocation_id"] == 1 and row["airport_fee"] == 0
    assert row["source_file"].startswith("part-") and row["source_file"].endswith(".parquet")
    assert row["loaded_at"] == RUN_AT


def test_integer_columns_stored_as_floats_are_read(spark):
    source = source_trips(spark, {}, {"PULocationID": None}).selectExpr(
        "* except (PULocationID, payment_type)", "cast(PULocationID as double) PULocationID",
        "cast(payment_type as double) payment_type", "'f' source_file",
    )
    rows = bronze_trips(source, RUN_AT).select("pulocation_id", "payment_type").collect()
    assert sorted(rows, key=str) == [(1, 1.0), (None, 1.0)]


def test_missing_source_column_fails_and_extra_ones_are_ignored(spark):
    source = source_trips(spark, {}).selectExpr("*", "'f' source_file", "1 extra_column")
    assert bronze_trips(source, RUN_AT).columns == RAW_TRIPS.column_names
    with pytest.raises(AnalysisException):
        bronze_trips(source.drop("total_amount"), RUN_AT)


def test_amount_out_of_range_stops_the_load(spark):
    source = source_trips(spark, {"fare_amount": 1e13}).selectExpr("*", "'f' source_file")
    with pytest.raises(ArithmeticException):
        bronze_trips(source, RUN_AT).collect()


def test_only_needed_columns_are_scanned(spark, tmp_path):
    source_trips(spark, {}).write.parquet(str(tmp_path / "trips"))
    bronze = bronze_trips(read_trip_files(spark, str(tmp_path / "trips")), RUN_AT)
    plan = bronze.select("fare_amount", "source_file")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<fare_amount:double>" in plan


def test_zone_text_is_kept_and_columns_found_by_name(spark, tmp_path):
    path = write_csv(tmp_path, 'Zone,LocationID,Borough,service_zone,note\nN/A,7,N/A,,x\n"Park, ""Old""",8,South,B,y\n')
    bronze = bronze_zones(read_zone_files(spark, path), RUN_AT)
    assert [(field.name, field.dataType) for field in bronze.schema] == list(RAW_ZONES.columns)
    assert [tuple(row)[:5] for row in bronze.orderBy("locationid").collect()] == [
        (7, "N/A", "N/A", None, "zones.csv"),
        (8, "South", 'Park, "Old"', "B", "zones.csv"),
    ]


def test_zone_id_that_is_no_number_fails(spark, tmp_path):
    path = write_csv(tmp_path, "LocationID,Borough,Zone,service_zone\nx,a,b,c\n")
    with pytest.raises(NumberFormatException):
        bronze_zones(read_zone_files(spark, path), RUN_AT).collect()


def monthly_files(spark, tmp_path, first, second):
    for name, frame in (("a", first), ("b", second)):
        frame.coalesce(1).write.parquet(str(tmp_path / name))
    return str(tmp_path / "a"), str(tmp_path / "b")


@pytest.mark.parametrize("turned", [False, True])
def test_a_column_missing_from_any_file_raises_with_its_name(spark, tmp_path, turned):
    whole, short = source_trips(spark, {}), source_trips(spark, {"fare_amount": 7.0}).drop("cbd_congestion_fee")
    paths = monthly_files(spark, tmp_path, *((short, whole) if turned else (whole, short)))
    with pytest.raises(ValueError, match=rf"/{'a' if turned else 'b'}/part-.* has no column cbd_congestion_fee"):
        read_trip_files(spark, *paths)
    for order in (paths, paths[::-1]):
        rows = bronze_trips(read_trip_files(spark, *order, missing_as_null=("cbd_congestion_fee",)), RUN_AT).collect()
        assert {(float(r["fare_amount"]), r["cbd_congestion_fee"]) for r in rows} == {(10.0, Decimal(0)), (7.0, None)}


def test_files_with_other_types_and_cases_load_together(spark, tmp_path):
    other = source_trips(spark, {"passenger_count": 3.0, "Airport_fee": 1.25}).selectExpr(
        "* except (passenger_count, Airport_fee, PULocationID)", "cast(passenger_count as bigint) passenger_count",
        "Airport_fee as airport_fee", "cast(PULocationID as bigint) PULocationID",
    )
    paths = monthly_files(spark, tmp_path, source_trips(spark, {"passenger_count": float("nan")}), other)
    rows = bronze_trips(read_trip_files(spark, *paths), RUN_AT).orderBy("airport_fee").collect()
    assert [(r["passenger_count"], float(r["airport_fee"]), r["pulocation_id"]) for r in rows] == [(None, 0.0, 1), (3.0, 1.25, 1)]
    alike = bronze_trips(read_trip_files(spark, paths[0], one_schema=True), RUN_AT)
    assert alike.columns == RAW_TRIPS.column_names and alike.count() == 1


@pytest.mark.parametrize("names", [("2024-01.parquet", "2024-02.pq", "2024-03.PQ.zstd"), ("1.pq", "2.pq", "3.pq")])
def test_files_of_any_name_load_from_a_mixed_schema(spark, tmp_path, names):
    whole = source_trips(spark, {"fare_amount": 1.0})
    other = source_trips(spark, {"fare_amount": 2.0}).withColumn("PULocationID", F.col("PULocationID").cast("bigint"))
    short = source_trips(spark, {"fare_amount": 3.0}).drop("cbd_congestion_fee")
    (tmp_path / "trips").mkdir()
    for k, (name, frame) in enumerate(zip(names, (whole, other, short), strict=True)):
        frame.coalesce(1).write.parquet(str(tmp_path / str(k)))
        part = next((tmp_path / str(k)).glob("part-*"))
        for to in (name, f"_{name}", f".{name}"):  # those that Spark hides are not read
            (tmp_path / "trips" / to).write_bytes(part.read_bytes())
    folder = str(tmp_path / "trips")
    with pytest.raises(ValueError, match=f"/{names[2]} has no column cbd_congestion_fee"):
        read_trip_files(spark, folder)
    rows = bronze_trips(read_trip_files(spark, folder, missing_as_null=("cbd_congestion_fee",)), RUN_AT).collect()
    assert sorted(float(r["fare_amount"]) for r in rows) == [1.0, 2.0, 3.0]


HEADER = "LocationID,Borough,Zone,service_zone\n"


def zone_rows(spark, directory, text):
    read = read_zone_files(spark, write_csv(directory, HEADER + text))
    return [tuple(row)[:4] for row in read.collect()]


def test_quoted_cells_hold_line_breaks_commas_and_quotes(spark, tmp_path):
    text = '1,Q,"two\nlines",x\n2,B,"a, b","say ""so"""\n3,"","\n\n",\n4,N/A," kept ",z'
    assert zone_rows(spark, tmp_path, text) == [
        ("1", "Q", "two\nlines", "x"), ("2", "B", "a, b", 'say "so"'), ("3", None, "\n\n", None), ("4", "N/A", " kept ", "z"),
    ]


def test_lines_may_end_as_in_dos(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_bytes((HEADER + '1,Q,"two, lines",x\n2,B,plain,y\n').replace("\n", "\r\n").encode())
    rows = [tuple(row)[:4] for row in read_zone_files(spark, str(path)).collect()]
    assert rows == [("1", "Q", "two, lines", "x"), ("2", "B", "plain", "y")]


def test_short_rows_are_filled_up_on_purpose(spark, tmp_path):
    assert zone_rows(spark, tmp_path, '1,B\n2\n3,"x, ""y",\n') == [
        ("1", "B", None, None), ("2", None, None, None), ("3", 'x, "y', None, None)]


@pytest.mark.parametrize(("text", "line"), [
    ("1,B,plain,y,EXTRA\n", 2), ('1,B,"a\nb\nc",y\n2,B,p,q\n3,B,plain,"x",\n', 6), ('1,a,b,c\n2,"open,a,b\n3,a,b,c\n', 3),
    ('1,B\n2,"x, y",b,c,"d, e"\n', 3),
])
def test_a_malformed_row_stops_the_load_and_is_named(spark, tmp_path, text, line):
    with pytest.raises(MalformedRow, match=rf"zones.csv, line {line}:"):
        zone_rows(spark, tmp_path, text)


def test_files_of_differing_headers_are_refused(spark, tmp_path):
    for name, header in (("a", "LocationID,Borough"), ("b", "Borough,LocationID")):
        (tmp_path / f"{name}.csv").write_text(f"{header}\n1,x\n")
    with pytest.raises(Exception, match="CSV header"):
        read_zone_files(spark, str(tmp_path)).collect()


def test_whole_documents_survive_a_round_trip(spark, tmp_path):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    awkward = spark.createDataFrame([(-1, 'x,"y"\r\nz\\" \n', None), (-2, None, "en")], documents.schema)
    written = documents.unionByName(awkward)
    write_csv_files(written, f"{tmp_path}/csv")
    read = read_csv_files(spark, f"{tmp_path}/csv").withColumn("doc_id", F.col("doc_id").cast("long"))
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, written.collect()))
