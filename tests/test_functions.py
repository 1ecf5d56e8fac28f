import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, templates, text, version


def one(spark, *columns, **values):
    names = list(values)
    row = spark.range(1).select(*[F.lit(values[n]).alias(n) for n in names]) if names else spark.range(1)
    return row.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_versions_order_step_and_differ(spark):
    a, b = version.version(1, 10, 0), version.version(1, 9, 9)
    gap = version.version_difference(version.version(2, 1, 5), version.version(1, 3, 5))
    row = one(
        spark, a > b, version.format_version(a),
        version.format_version(version.next_version(b, 0)), version.format_version(version.next_version(b, 1)),
        version.format_version(version.next_version(b, 2)), gap,
        version.format_version(version.apply_difference(version.version(1, 1, 1), F.struct(
            F.lit(0).alias("interface"), F.lit(2).alias("quality"), F.lit(3).alias("revision")))),
    )
    assert list(row)[:5] == [True, "1.10.0", "2.0.0", "1.10.0", "1.9.10"]
    assert tuple(row[5]) == (1, -2, 0)
    assert row[6] == "1.2.0"


@pytest.mark.parametrize("given, expected, error", [
    ("1.2.3", "1.2.3", None), ("0.1.0", None, "interface starts at 1"), ("1.2", None, "malformed"),
    ("1.2.x", None, "malformed"), ("01.2.3", "1.2.3", None), (None, None, "malformed"),
])
def test_parse_version(spark, given, expected, error):
    value = F.lit(given).cast("string")
    row = one(spark, version.format_version(version.parse_version(value)), version.version_error(value))
    assert tuple(row) == (expected, error)


def test_version_in_names(spark):
    def found(name):
        return tuple(one(spark, version.format_version(version.extract_version(F.lit(name))),
                         version.extract_base(F.lit(name))))

    assert found("sat_cam_20130202_v1.10.0.dat") == ("1.10.0", "sat_cam_20130202_")
    assert found("sat_cam_20130202_v1.f.0.dat") == (None, None)
    assert found("sat_cam_20130202_v1.0.dat") == (None, None)


def test_days_in_names(spark):
    def found(name):
        return tuple(one(spark, dates.extract_day(F.lit(name)), dates.extract_month(F.lit(name))))

    assert found("cam_20130214_v1.0.0.dat") == (dt.date(2013, 2, 14), dt.date(2013, 2, 1))
    assert found("cam_20130231_v1.0.0.dat") == (None, dt.date(2013, 2, 1))
    assert found("cam_19520201_v1.0.0.dat") == (None, None)
    assert found("cam_20510201_v1.0.0.dat") == (None, None)
    assert found("cam_2013_v1.0.0.dat") == (None, None)
    # The first run decides, even when a later one would be a date.
    assert found("cam_20130231_20130301.dat")[0] is None


def test_date_helpers(spark):
    row = one(
        spark, dates.valid_day(F.lit("20120229")), dates.valid_day(F.lit("20120230")),
        dates.parse_month_end(F.lit("201202")), dates.parse_day(F.lit("2012-02-30")),
        dates.whole_seconds(F.expr("TIMESTAMP_NTZ '1969-12-31 23:59:58.5'")),
        dates.whole_seconds(F.expr("TIMESTAMP_NTZ '2010-01-01 23:59:59.6'")),
        dates.as_moment(F.lit(dt.date(2013, 1, 2)), end=True),
        dates.days_between(F.lit(dt.date(2013, 1, 30)), F.lit(dt.date(2013, 2, 1))),
        dates.days_between(F.lit(dt.date(2013, 1, 30)), F.lit(dt.date(2013, 1, 1))),
    )
    assert list(row)[:6] == [True, False, dt.date(2012, 2, 29), None, -1, 1262390399]
    assert row[6] == dt.datetime(2013, 1, 2, 23, 59, 59, 999999)
    assert row[7] == [dt.date(2013, 1, 30), dt.date(2013, 1, 31), dt.date(2013, 2, 1)]
    assert row[8] == []


def test_keywords(spark):
    row = one(
        spark, text.keyword_map(F.lit("foo=bar baz=qux foo=again x=1=2")), text.keyword_map(F.lit("a=1 stop b=2")),
        text.keyword_map(F.lit("")),
        text.merge_keywords(F.array(text.keyword_map(F.lit("a=1 b=2")), text.keyword_map(F.lit("b=3")))),
        text.is_true(F.lit("Yes")), text.is_true(F.lit("TRUE")), text.none_if(F.lit("None")), text.none_if(F.lit("x")),
    )
    assert row[0] == {"foo": "again", "baz": "qux", "x": "1"}
    assert row[1] == {"a": "1"} and row[2] == {}
    assert row[3] == {"a": "1", "b": "3"}
    assert list(row)[4:] == [True, False, None, "x"]


def test_globs():
    assert re.match(text.glob_pattern("a*.d?t"), "abc.dat")
    assert not re.match(text.glob_pattern("a*.d?t"), "abcxdat")
    assert re.match(text.glob_pattern("v[!0-2].[ab]"), "v3.a")
    assert not re.match(text.glob_pattern("v[!0-2].[ab]"), "v1.a")
    assert re.match(text.glob_pattern("a+b(1)"), "a+b(1)")


def test_fill_and_patterns(spark):
    moment = F.expr("TIMESTAMP_NTZ '2010-01-02 03:44:59.123456'")
    fields = templates.date_fields(moment)
    filled = templates.fill(F.lit("{Y}/{m}/{d} {j}|{b}|{y}|{H}{M}{S}.{MILLI}{MICRO} {DATE} {other}"), fields)
    row = one(
        spark, filled, templates.to_pattern(F.lit("x{MILLI}{j:03d}{d}_{nnn}_{own}"), {"d": F.lit("89")}),
        templates.to_pattern(F.lit("cam_{mday}_v{VERSION}.dat")),
        templates.fill_literal("{n:04d}-{w}", {"n": F.lit(7), "w": F.lit("z")}),
        templates.literal_prefix(F.lit("cam_{Y}.dat")), templates.literal_prefix(F.lit("ab*c")),
        templates.literal_prefix(F.lit("a|b")),
    )
    assert row[0] == "2010/01/02 002|Jan|10|034459.123456 20100102 {other}"
    assert row[1] == r"x(\d{3})([0-3]\d\d)89_(\d\d\d)_.*"
    assert row[2] == r"cam_(-?\d+)_v(\d+\.\d+\.\d+).dat"
    assert list(row)[3:] == ["0007-z", "cam_", "a", ""]
    with pytest.raises(KeyError):
        templates.fill_literal("{missing}", {})


def test_path_substitution(spark):
    args = (F.lit(dt.date(2012, 4, 12)), F.expr("TIMESTAMP_NTZ '2012-04-12 01:02:03'"), F.lit("3.2.1"),
            {"SPACECRAFT": F.lit("sat-a")})
    cases = {
        "{Y}{m}{d}": "20120412", "{DATE}": "20120412", "{Y}{b}{d}": "2012Apr12", "{y}{j}": "12103",
        "{VERSION}": "3.2.1", "{H}{M}{S}": "010203", "{SPACECRAFT}/{xxx}": "sat-a/{xxx}",
    }
    row = one(spark, *[templates.substitute_path(F.lit(p), *args) for p in cases])
    assert list(row) == list(cases.values())


def test_name_substitution_repeats(spark):
    names = {"PRODUCT": F.lit("cam_{INSTRUMENT}"), "INSTRUMENT": F.lit("radio"), "LEVEL": F.lit(1.0)}
    row = one(spark, templates.substitute_names(F.lit("{PRODUCT} l{LEVEL} {MISSION}"), names))
    assert row[0] == "cam_radio l1.0 {MISSION}"
