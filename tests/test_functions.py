from datetime import datetime
from decimal import Decimal
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    base_name, clean_label, dataset_of, display_name, int_round, json_record, parse_timestamp,
    partition_value, split_name, surrogate_key, to_zip, varchar, word_case,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("given, wanted", [
    ("mogi-guacu d'oeste", "Mogi-Guacu D'Oeste"),
    ("santa barbara (sp)", "Santa Barbara (Sp)"),
    ("SÃO PAULO", "São Paulo"),
    ("4o. centenario", "4o. Centenario"),
    ("ßig  two", "ßig  Two"),
    ("", ""),
    (None, None),
])
def test_word_case(spark, given, wanted):
    assert one(spark, word_case(F.lit(given).cast("string"))) == wanted


def test_display_name(spark):
    assert one(spark, display_name(F.lit("home_appliances_2"))) == "Home Appliances 2"


def test_clean_label(spark):
    assert one(spark, clean_label(F.lit("  Delivered "))) == "delivered"


def test_varchar_cuts(spark):
    assert one(spark, varchar(F.lit("x" * 40), 32)) == "x" * 32


@pytest.mark.parametrize("given, wanted", [("2.5", 3), ("3.5", 4), ("-2.5", -3), ("2.4", 2), (None, None)])
def test_int_round_takes_halves_away_from_zero(spark, given, wanted):
    assert one(spark, int_round(F.lit(given).cast("decimal(10,2)"))) == wanted


def test_zip(spark):
    assert one(spark, to_zip(F.lit("01037"))) == Decimal(1037)
    for bad in ("123456", "abc"):
        with pytest.raises(Exception, match="NUMERIC|CAST_INVALID"):
            one(spark, to_zip(F.lit(bad)))


def test_surrogate_key(spark):
    key = one(spark, surrogate_key(F.lit(None).cast("string"), F.lit("y")))
    assert key == md5(b"_dbt_utils_surrogate_key_null_-y").hexdigest()
    assert one(spark, surrogate_key(F.lit("a"), F.lit(2))) == md5(b"a-2").hexdigest()


def test_parse_timestamp(spark):
    assert one(spark, parse_timestamp(F.lit("2024-01-02 03:04:05"))) == datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, parse_timestamp(F.lit("NaT"))) is None


def test_paths(spark):
    path = F.lit("lake/t=a/snapshot_date=2026-08-24/geo_latest.parquet")
    assert one(spark, base_name(path)) == "geo_latest.parquet"
    assert one(spark, partition_value(path, "snapshot_date")) == "2026-08-24"
    assert one(spark, partition_value(path, "date")) is None
    parts = one(spark, split_name(path))
    assert (parts["directory"], parts["name"], parts["extension"]) == (
        "lake/t=a/snapshot_date=2026-08-24", "geo_latest", "parquet")
    assert one(spark, dataset_of(path)).endswith("geo_latest.parquet")
    assert one(spark, dataset_of(F.lit("lake/geo_latest.parquet/part-0001.parquet"))) == "lake/geo_latest.parquet"


def test_json_record(rows):
    df = rows("a int, b double, t timestamp_ntz", (1, float("nan"), datetime(2024, 1, 2)), (2, 1.5, None))
    assert [r[0] for r in df.select(json_record(df)).collect()] == [
        '{"a":1,"b":null,"t":"2024-01-02 00:00:00"}', '{"a":2,"b":1.5,"t":null}']
