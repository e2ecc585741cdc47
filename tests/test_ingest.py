import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.operators.difference import already_stored
from cohortflow.schemas import RAW_SCHEMAS, SUMMARY_SCHEMA
from cohortflow.sources import loader
from cohortflow.sources.csv_files import read_csv, records_span_lines, typed_by_name
from cohortflow.sources.loader import KeyViolation, load_file, load_folder
from cohortflow.sources.tables import create_all


def put(folder, name, text):
    path = folder / name
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def test_headers_are_cleaned_and_values_stay_text(spark, tmp_path):
    path = put(tmp_path, "c.csv", "﻿ CODE , Description\n0042,Gout\n01234,\"a \"\"b\"\", c\"\n,\n")
    df = read_csv(spark, path)
    assert df.columns == ["code", "description"]
    assert rows(df) == [("0042", "Gout"), ("01234", 'a "b", c'), (None, None)]


def test_short_lines_are_filled_and_long_lines_stop(spark, tmp_path):
    short = put(tmp_path, "short.csv", "A,B,C\n1,2\n1,2,3\n")
    assert rows(read_csv(spark, short)) == [("1", "2", "3"), ("1", "2", None)]
    quoted = put(tmp_path, "quoted.csv", 'A,B,C\n1,"x,y,z"\n')
    assert rows(read_csv(spark, quoted)) == [("1", "x,y,z", None)]
    for name, line in (("1.csv", "1,2,3,4"), ("2.csv", "1,2,3,"), ("3.csv", "1,2,3,,5"), ("4.csv", '1,"2,3",4,5')):
        path = put(tmp_path, name, f"A,B,C\n1,2,3\n{line}\n")
        with pytest.raises(Exception, match="more fields"):
            read_csv(spark, path).collect()


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = put(tmp_path, "m.csv", 'A,B\n1,"two\nlines"\n2,x\n')
    assert rows(read_csv(spark, path, multiline=True)) == [("1", "two\nlines"), ("2", "x")]


@pytest.mark.parametrize("place", range(3))
def test_a_cut_record_is_read_whole_by_default(spark, tmp_path, place):
    cells = ["1", "b", "c"]
    cells[place] = '"one, ""two""\nthree"'
    path = put(tmp_path, "m.csv", "A,B,C\n" + ",".join(cells) + "\n2,y,z\n")
    want = ["1", "b", "c"]
    want[place] = 'one, "two"\nthree'
    assert records_span_lines(spark, path)
    assert rows(read_csv(spark, path)) == sorted([tuple(want), ("2", "y", "z")])


def test_one_line_records_still_split(spark, tmp_path):
    path = put(tmp_path, "s.csv", "A,B\n" + '1,"x ""y"" z"\n' * 20_000)
    assert not records_span_lines(spark, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        assert read_csv(spark, path).rdd.getNumPartitions() > 4
        assert read_csv(spark, path, multiline=True).rdd.getNumPartitions() == 1
        assert read_csv(spark, path).count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_digits_that_do_not_fit_stop_a_load(spark, databases, tmp_path):
    fits = put(tmp_path, "f.csv", "ID,HEALTHCARE_EXPENSES\np1,10.123456\n")
    load_file(spark, fits, "patients")
    assert rows(spark.table("raw.patients"), "healthcare_expenses") == [(Decimal("10.123456"),)]
    with pytest.raises(Exception, match="more than 10 places"):
        load_file(spark, put(tmp_path, "n.csv", "ID,HEALTHCARE_EXPENSES\np2,0.12345678901\n"), "patients")


def test_a_small_batch_does_not_move_stored_keys(spark, databases, tmp_path):
    spark.range(2_000_000).select(F.md5(F.col("id").cast("string")).alias("id")).write.parquet(f"{tmp_path}/stored")
    spark.createDataFrame([("k5",), ("new",)], "id string").write.parquet(f"{tmp_path}/batch")
    stored, batch = spark.read.parquet(f"{tmp_path}/stored"), spark.read.parquet(f"{tmp_path}/batch")
    plan = already_stored(stored, batch, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_a_folder_of_files_is_one_source_and_headers_must_agree(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    put(folder, "1.csv", "A,B\n1,2\n")
    put(folder, "2.csv", "A,B\n3,4\n")
    assert rows(read_csv(spark, str(folder))) == [("1", "2"), ("3", "4")]
    put(folder, "3.csv", "B,A\n5,6\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(folder)).collect()


def test_repeated_and_unknown_columns_are_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="twice"):
        read_csv(spark, put(tmp_path, "t.csv", "code, CODE \n1,2\n"))
    with pytest.raises(ValueError, match="no header"):
        read_csv(spark, put(tmp_path, "e.csv", ""))
    df = read_csv(spark, put(tmp_path, "u.csv", "CODE,COLOUR\n1,2\n"))
    with pytest.raises(ValueError, match="colour"):
        typed_by_name(df, RAW_SCHEMAS["conditions"])


def test_typed_by_name(spark, tmp_path):
    lines = ["Id,BIRTHDATE,ZIP,LAT,HEALTHCARE_EXPENSES,FIRST", "a,2000-02-29,01234,42.3527,10.5,NA", 'b,,,,,""', ""]
    path = put(tmp_path, "p.csv", "\n".join(lines))
    df = typed_by_name(read_csv(spark, path), RAW_SCHEMAS["patients"])
    assert df.schema.simpleString() == RAW_SCHEMAS["patients"].simpleString()
    got = rows(df, "id", "birthdate", "zip", "lat", "healthcare_expenses", "first", "ssn")
    assert got == [
        ("a", dt.date(2000, 2, 29), "01234", Decimal("42.3527"), Decimal("10.5"), "NA", None),
        ("b", None, None, None, None, None, None),
    ]
    assert df.where("loaded_at is null").count() == 0
    wider = typed_by_name(read_csv(spark, path), RAW_SCHEMAS["patients"], na_tokens=("", "NA"))
    assert rows(wider, "first") == [(None,), (None,)]


def test_text_that_does_not_fit_its_type_stops(spark, tmp_path):
    path = put(tmp_path, "p.csv", "ID,BIRTHDATE\na,yesterday\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typed_by_name(read_csv(spark, path), RAW_SCHEMAS["patients"]).collect()


def test_zone_suffix_is_dropped(spark, tmp_path):
    path = put(tmp_path, "e.csv", "Id,START\ne,2020-01-02T03:04:05Z\n")
    df = typed_by_name(read_csv(spark, path), RAW_SCHEMAS["encounters"])
    assert rows(df, "start") == [(dt.datetime(2020, 1, 2, 3, 4, 5),)]


def test_tables_are_created_once(spark, databases):
    for name, schema in RAW_SCHEMAS.items():
        assert spark.table(f"raw.{name}").schema.simpleString() == schema.simpleString()
    assert spark.table("analytics.triage_summaries").columns == SUMMARY_SCHEMA.fieldNames()
    spark.sql("insert into raw.conditions (code) values ('1')")
    create_all(spark)
    assert spark.table("raw.conditions").count() == 1


def test_unkeyed_load_inserts_all_rows_each_time(spark, databases, tmp_path):
    path = put(tmp_path, "conditions.csv", "CODE,DESCRIPTION\n0042,Gout\n0043,Migraine\n")
    for total in (2, 4):
        result = load_file(spark, path, "conditions")
        assert (result.read, result.skipped, result.inserted) == (2, 0, 2)
        assert spark.table("raw.conditions").count() == total
    assert rows(spark.table("raw.conditions"), "code", "description")[0] == ("0042", "Gout")


def test_keyed_load_drops_stored_ids(spark, databases, tmp_path):
    load_file(spark, put(tmp_path, "1.csv", "id,FIRST,LAST\nk1,Ines,Okafor\n"), "patients")
    result = load_file(
        spark, put(tmp_path, "2.csv", "id,FIRST,LAST\nk1,Other,Text\nk1,More,Text\nk2,Tomas,Lind\n"), "patients"
    )
    assert (result.read, result.skipped, result.inserted) == (3, 2, 1)
    assert rows(spark.table("raw.patients"), "id", "first") == [("k1", "Ines"), ("k2", "Tomas")]


def test_nothing_new_writes_nothing(spark, databases, tmp_path, monkeypatch):
    path = put(tmp_path, "p.csv", "id,FIRST,LAST\nk1,Ines,Okafor\n")
    load_file(spark, path, "patients")
    monkeypatch.setattr(loader, "append", lambda *a: pytest.fail("wrote"))
    assert load_file(spark, path, "patients").inserted == 0
    assert load_file(spark, put(tmp_path, "none.csv", "id,FIRST\n"), "patients").inserted == 0


def test_an_empty_file_adds_nothing(spark, databases, tmp_path):
    result = load_file(spark, put(tmp_path, "c.csv", "CODE\n"), "conditions")
    assert (result.read, result.inserted) == (0, 0) and spark.table("raw.conditions").count() == 0


@pytest.mark.parametrize("body", ["a,1\na,2\n", ",1\nb,2\n"])
def test_bad_keys_stop_before_any_write(spark, databases, tmp_path, body):
    path = put(tmp_path, "p.csv", "ID,FIRST\nok,x\n" + body)
    with pytest.raises(KeyViolation):
        load_file(spark, path, "patients")
    assert spark.table("raw.patients").count() == 0


def test_key_column_must_be_there(spark, databases, tmp_path):
    with pytest.raises(ValueError, match="key column"):
        load_file(spark, put(tmp_path, "p.csv", "FIRST\nx\n"), "patients")


def test_folder_load_reports_missing_files_and_total(spark, databases, tmp_path):
    assert load_folder(spark, str(tmp_path)).total == 0
    put(tmp_path, "conditions.csv", "CODE,DESCRIPTION\n0042,Gout\n0043,Migraine\n")
    put(tmp_path, "encounters.csv", "Id,START,PATIENT\ne1,2020-01-01,p1\n")
    report = load_folder(spark, str(tmp_path))
    assert report.total == 3
    assert report.missing == ["patients.csv", "observations.csv", "medications.csv"]
    assert [t.table for t in report.tables] == ["raw.encounters", "raw.conditions"]
    again = load_folder(spark, str(tmp_path))
    assert [t.inserted for t in again.tables] == [0, 2]


def test_an_error_leaves_earlier_tables_loaded(spark, databases, tmp_path):
    put(tmp_path, "patients.csv", "Id\np1\n")
    put(tmp_path, "encounters.csv", "Id,START\ne1,not a time\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_folder(spark, str(tmp_path))
    assert spark.table("raw.patients").count() == 1
    assert spark.table("raw.encounters").count() == 0


def test_decimals_of_fewer_places_are_cast_without_a_look_at_their_text(spark):
    schema = T.StructType([T.StructField("a", T.DecimalType(28, 10))])
    fits = typed_by_name(spark.sql("select cast(1.125 as decimal(18,3)) a"), schema, na_tokens=())
    assert "rlike" not in fits._jdf.queryExecution().analyzed().toString().lower()
    assert [str(r.a) for r in fits.collect()] == ["1.1250000000"]
    with pytest.raises(Exception, match="more than 10 places"):
        typed_by_name(spark.sql("select cast('0.00000000001' as decimal(20,11)) a"), schema, na_tokens=()).collect()
