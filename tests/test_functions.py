import time
from datetime import date, datetime
from decimal import Decimal
from hashlib import md5

from pyspark.sql import functions as F

from usageledger.functions import columns as c
from usageledger.functions.nested import flatten


def one(spark, column, **values):
    """Evaluate a column over one row of typed literals."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def test_tidy_strips_spaces_only_unless_asked(spark):
    assert one(spark, c.tidy("t"), t="  MiXed ") == "mixed"
    assert one(spark, c.tidy("t", upper=True), t=" eur") == "EUR"
    assert one(spark, c.tidy("t"), t="\tA\n") == "\ta\n"
    assert one(spark, c.tidy("t", any_whitespace=True), t="\t A\n") == "a"


def test_money(spark):
    assert one(spark, c.cents_to_units("t"), t="14900") == Decimal("149.000000")
    assert one(spark, c.cents_to_units("t"), t="14900.5") == Decimal("149.005000")
    assert one(spark, c.cents_to_units("t"), t="n/a") is None
    for huge in ("9999999999999", "99999999999999999999"):
        one(spark, c.annualised(c.cents_to_units("t")), t=huge)  # NULL or a number, never the end of the job
    assert one(spark, c.annualised(c.cents_to_units("t")), t="4999") == Decimal("599.880000")


def test_epochs(spark):
    assert one(spark, c.seconds_to_timestamp("t").cast("string"), t=1673740800) == "2023-01-15 00:00:00"
    assert one(spark, c.seconds_to_timestamp("t"), t=0) is None
    assert one(spark, c.seconds_to_timestamp("t", zero_means_unset=False).cast("string"), t=0) == "1970-01-01 00:00:00"
    assert one(spark, c.seconds_to_timestamp("t"), t="soon") is None
    # exactly midnight UTC belongs to the new day
    assert one(spark, c.millis_to_date("t"), t=1730419200000) == date(2024, 11, 1)
    assert one(spark, c.millis_to_date("t"), t=1730419199999) == date(2024, 10, 31)


def test_whole_days_are_not_midnights(spark):
    stamps = spark.sql("select timestamp'2024-01-01 23:00:00' a, timestamp'2024-01-02 01:00:00' b")
    assert stamps.select(c.whole_units_between("DAY", "a", "b")).first()[0] == 0
    assert stamps.select(c.whole_units_between("HOUR", "a", "b")).first()[0] == 2


def test_relative_gap(spark):
    assert one(spark, c.relative_gap("a", "b"), a=8.0, b=10.0) == 0.2
    assert one(spark, c.relative_gap("a", "b"), a=8.0, b=0.0) is None


def test_keys(spark):
    assert one(spark, c.surrogate_key("a"), a="sub_1") == md5(b"sub_1").hexdigest()
    row = spark.sql("select 'x' a, cast(null as string) b, '' d")
    with_null, with_blank = row.select(c.surrogate_key("a", "b"), c.surrogate_key("a", "d")).first()
    assert with_null == md5(b"x-_dbt_utils_surrogate_key_null_").hexdigest()
    assert with_blank == md5(b"x-").hexdigest()
    stamped = spark.sql("select 'acc_1' k, timestamp'2024-09-01 10:00:00' u")
    assert stamped.select(c.version_key("k", "u")).first()[0] == md5(b"acc_1|2024-09-01 10:00:00").hexdigest()


def test_bands_and_labels(spark):
    floors = [(500, "high"), (100, "mid")]
    got = [one(spark, c.banded(F.col("n"), floors, "low"), n=n) for n in (500, 499, 100, 99, -1)]
    assert got == ["high", "mid", "mid", "low", "low"]
    ceilings = [(90, "a"), (180, "b")]
    assert [one(spark, c.capped(F.col("n"), ceilings, "z"), n=n) for n in (90, 91, 180, 181)] == ["a", "b", "b", "z"]
    labels = {"year": "Annual"}
    assert one(spark, c.labelled("t", labels, "Other"), t="year") == "Annual"
    assert one(spark, c.labelled("t", labels, "Other"), t="day") == "Other"
    assert spark.sql("select cast(null as string) t").select(c.labelled("t", labels, "Other")).first()[0] == "Other"


def test_text_parts(spark):
    assert one(spark, c.last_segment("t"), t="model.shop.stg") == "stg"
    assert one(spark, c.last_segment("t"), t="plain") == "plain"
    assert one(spark, c.blank_to_null("t"), t="") is None
    stamp = spark.sql("select timestamp'2024-01-05 07:08:09' t")
    assert stamp.select(c.hour_path("t", "raw/events/")).first()[0] == "raw/events/2024/01/05/07"
    assert stamp.select(c.month_of("t")).first()[0] == date(2024, 1, 1)


def test_flatten_names_and_collisions(spark):
    nested = spark.sql(
        "select 1 as a_b, named_struct('b', 2, 'c', named_struct('d', 3)) as a, "
        "array(named_struct('q', 1)) as items, map('k', 1) as tags"
    )
    flat = flatten(nested)
    assert flat.columns == ["a_b", "a_b_2", "a_c_d", "items", "tags"]
    assert flat.first().asDict() == {
        "a_b": 1, "a_b_2": 2, "a_c_d": 3, "items": '[{"q":1}]', "tags": '{"k":1}'
    }


def test_flatten_keeps_dotted_names(spark):
    flat = flatten(spark.sql("select named_struct('x.y', 5) as `o.p`"))
    assert flat.columns == ["o.p_x.y"]
    assert flat.first()[0] == 5


def test_a_datetime_without_zone_is_utc_on_any_machine(spark, monkeypatch):
    try:
        monkeypatch.setenv("TZ", "America/New_York")
        time.tzset()
        got = spark.range(1).select(c.moment(datetime(2024, 1, 1, 12)).cast("string")).first()[0]
    finally:
        monkeypatch.undo()
        time.tzset()
    assert got == "2024-01-01 12:00:00"
