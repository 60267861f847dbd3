import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from moodline.functions import casts

TS_CASES = [
    ("2026-03-01T10:05:00Z", dt.datetime(2026, 3, 1, 10, 5)),
    ("2026-03-01 10:05:00", dt.datetime(2026, 3, 1, 10, 5)),
    ("2026-03-01T10:05:00.123456", dt.datetime(2026, 3, 1, 10, 5, 0, 123456)),
    ("2026-03-01T12:05:00+02:00", dt.datetime(2026, 3, 1, 10, 5)),
    ("2026-03-01", dt.datetime(2026, 3, 1)),
    (" 2026-03-01 10:05:00 ", dt.datetime(2026, 3, 1, 10, 5)),
    ("2026-3-1 1:2:3", dt.datetime(2026, 3, 1, 1, 2, 3)),
    ("20260301", dt.datetime(2026, 3, 1)),
    ("20260301T100500", dt.datetime(2026, 3, 1, 10, 5)),
    ("2024", None), ("2024-01", None), ("10:00:00", None), ("invalid-ts", None),
    ("2026-03-01t10:05:00z", None), ("", None), (None, None),
]


def test_safe_timestamp(spark):
    df = spark.createDataFrame([(s,) for s, _ in TS_CASES], "s string")
    got = [r[0] for r in df.select(casts.safe_timestamp("s")).collect()]
    assert got == [e for _, e in TS_CASES]


@pytest.mark.parametrize("text,expected", [
    ("1.5", 1.5), (" -2 ", -2.0), ("1e3", 1000.0), ("1d", None), ("1f", None),
    ("1_000", None), ("abc", None), ("", None), (".5", 0.5)])
def test_safe_double(spark, text, expected):
    assert spark.range(1).select(casts.safe_double(F.lit(text))).first()[0] == expected


def test_safe_bool_and_least_strict(spark):
    vals = ["true", " FALSE ", "yes", "1", "t", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r[0] for r in df.select(casts.safe_bool("v")).collect()] == [True, False, None, None, None, None]
    r = spark.createDataFrame([(None,), (-0.5,), (0.5,)], "x double").select(casts.least_strict("x", 0.0)).collect()
    assert [x[0] for x in r] == [None, -0.5, 0.0]


def test_blank_to_keeps_whitespace(spark):
    df = spark.createDataFrame([("",), (" ",), (None,), ("x",)], "v string")
    assert [r[0] for r in df.select(casts.blank_to("v", "unknown")).collect()] == ["unknown", " ", "unknown", "x"]


def test_sql_and_column_builds_agree(spark):
    df = spark.createDataFrame([(s,) for s, _ in TS_CASES] + [("1d",), ("1.5",), (" -2 ",)], "s string")
    rows = df.select(casts.safe_timestamp("s").alias("a"), casts.safe_timestamp(F.col("s")).alias("b"),
                     casts.safe_double("s").alias("c"), casts.safe_double(F.col("s")).alias("d")).collect()
    assert all(r.a == r.b and r.c == r.d for r in rows)


# The formats that the source tries after the ISO forms.
FORMATS = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%S.%f")


def _python(text):
    """The instant in microseconds as Python's own parser reads it, else None."""
    found = None
    try:
        found = dt.datetime.fromisoformat(text.strip().replace("Z", "+00:00"))
    except ValueError:
        for form in FORMATS:
            try:
                found = dt.datetime.strptime(text, form)
                break
            except ValueError:
                pass
    if found is None:
        return None
    zone = dt.timezone.utc
    found = found.replace(tzinfo=zone) if found.tzinfo is None else found
    at = (found - dt.datetime(1970, 1, 1, tzinfo=zone)) // dt.timedelta(microseconds=1)
    return at if dt.datetime(1, 1, 1) <= dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=at) else None


def test_timestamps_as_python_reads_them(spark):
    dates = ("2024-02-01", "20240201", "2024-W05-3", "2024W053", "2024-W05", "2024W05", "2024-W53-1", "2020-W53-7", "2024-W00-1",
             "2024-02-30", "0000-01-01", "2024-2-1", "2024-02", "2024-W05-8", "0001-01-03", "9999-12-30", "24-02-01")
    seps = ("", "T", " ", "X", "t", "-", "\u00e9", "  ", "1", "Z")
    times = ("", "10", "10:05", "10:05:07", "10:05:07.5", "10:05:07,123456789", "1005", "100507", "100507.25", "10:0507", "1005:07",
             "24:00", "25:00", "10:60", "10:05:60", "10.5", "10:05.5", "1:2:3", "1:2:3.5", "10:05:")
    zones = ("", "Z", " Z", "+02:00", "-0530", "+05:30:15", "+05:30:15.123456", "+23:59", "+24:00", "-00:00", "+1", "+01", "X+01:00",
             "+05:99", " -01", "z", "+01:00x")
    texts = {"".join(p) for p in itertools.product(dates, seps, times, zones)}
    texts |= {" 2024-02-01 10:00:00 ", "\t2024-02-01\n", " 2024-02-01T10:00\u3000", "2024-2-1 1:2:3 ", " 2024-2-1 1:2:3", "2024-2-1\t1:2:3",
              "2024-2-1   1:2:3", "2024-12-31T5:6:7.1", "", "abc", "2024-W05-10:00", "2024-W05-1010:00", "2024W0531000", "2024W05310",
              "2024W05T10", "2024W053T10:00Z"}
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "s string").repartition(8)
    got = {r.s: r.t for r in df.select("s", F.unix_micros(casts.safe_timestamp("s")).alias("t")).collect()}
    assert [(t, _python(t), got[t]) for t in sorted(texts) if _python(t) != got[t]] == []
