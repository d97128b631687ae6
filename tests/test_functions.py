import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from feria.functions import (flag, floor_days, mean_round, money, normalize_text, pct,
                             ratio_round, strip_ws, to_ts, upper_strip, year_month)


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_floor_days_is_floor_not_truncation(spark):
    df = spark.createDataFrame(
        [(ts("2020-01-01 12:00"), ts("2020-01-02 00:00")),   # 12 h early -> -1
         (ts("2020-01-02 05:00"), ts("2020-01-02 00:00")),   # 5 h late -> 0
         (ts("2020-01-03 05:00"), ts("2020-01-02 00:00")),   # 29 h late -> 1
         (None, ts("2020-01-02 00:00"))],
        "delivered timestamp_ntz, estimate timestamp_ntz")
    got = [r[0] for r in df.select(floor_days("delivered", "estimate")).collect()]
    assert got == [-1, 0, 1, None]


def test_to_ts_tolerant_and_year_month_null(spark):
    df = spark.createDataFrame([("2018-11-03 10:00:00",), ("not a date",), (None,)], "t string")
    out = df.select(to_ts(df, "t").alias("t")).select(year_month("t").alias("ym"))
    assert [r.ym for r in out.collect()] == ["2018-11", None, None]


def test_flag_counts_null_as_zero(spark):
    df = spark.createDataFrame([("delivered",), (None,), ("canceled",)], "s string")
    got = [r[0] for r in df.select(flag(F.col("s") == "delivered")).collect()]
    assert got == [1, 0, 0]


def test_pct_half_up_and_zero_divisor(spark):
    df = spark.createDataFrame([(1, 800), (1, 0), (2, 3)], "a int, b int")
    got = [r[0] for r in df.select(pct("a", "b", 2)).collect()]
    assert got == [0.13, None, 66.67]


def test_ratio_round_negative_half_away(spark):
    df = spark.createDataFrame([(-1, 8), (1005, 1000)], "a int, b int")
    assert [r[0] for r in df.select(ratio_round("a", "b", 2)).collect()] == [-0.13, 1.01]


def test_mean_round_exact(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "x int")
    assert df.agg(mean_round("x", 1)).first()[0] == 1.7


def test_money_rounds_cents_half_up(spark):
    df = spark.createDataFrame([(0.615,), (12.3,), (0.0,)], "x double")
    got = [r[0] for r in df.select(money("x")).collect()]
    assert got == [Decimal("0.62"), Decimal("12.30"), Decimal("0.00")]


def test_normalize_text_matches_python_definition(spark):
    import re
    import unicodedata

    def ref(s):
        if s is None:
            return None
        s = s.lower().strip()
        s = unicodedata.normalize("NFKD", s)
        s = "".join(c for c in s if not unicodedata.combining(c))
        return re.sub(r"\s+", " ", s)

    samples = [" São  Paulo ", "\tRIO de Janeiro\n", "ﬁnal ｆｕｌｌ", None, "",
               "Goiânia", "ascii only  text", " em　space\x1f", "Ñandú"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(normalize_text("s")).collect()]
    assert got == [ref(s) for s in samples]


def test_strip_ws_unicode_and_upper_strip(spark):
    df = spark.createDataFrame([(" sp \t",)], "s string")
    r = df.select(strip_ws("s").alias("a"), upper_strip("s").alias("b")).first()
    assert (r.a, r.b) == ("sp", "SP")


def test_normalize_text_property(spark):
    """Random Unicode text (accents, ligatures, every white-space kind):
    Spark result equals the Python definition exactly."""
    import random
    import re
    import unicodedata

    from feria.functions.text import WS_CHARS

    def ref(s):
        s = s.lower().strip()
        s = unicodedata.normalize("NFKD", s)
        s = "".join(c for c in s if not unicodedata.combining(c))
        return re.sub(r"\s+", " ", s)

    rnd = random.Random(11)
    alphabet = (list("abcXYZ019 .,-'") + list(WS_CHARS) + list("áÉçÑøßŁĳﬁｆ①²Ǻ̧")
                + [chr(c) for c in range(0x300, 0x310)])
    samples = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25)))
               for _ in range(400)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = dict(df.select("i", normalize_text("s")).collect())
    bad = [(samples[i], got[i], ref(samples[i])) for i in range(len(samples))
           if got[i] != ref(samples[i])]
    assert not bad, bad[:3]
