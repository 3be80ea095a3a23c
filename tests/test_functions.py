import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom import fixed_values
from paneloom.functions import dates, numbers, similarity, text


def values(spark, rows, schema, column):
    frame = spark.createDataFrame(rows, schema)
    return [r[0] for r in frame.select(column).collect()]


def lcs(a, b):
    row = [0] * (len(a) + 1)
    for c in b:
        corner = 0
        for j, x in enumerate(a, 1):
            above = row[j]
            row[j] = corner + 1 if x == c else max(row[j], row[j - 1])
            corner = above
    return row[-1]


def test_month_spellings(spark):
    rows = [("July",), ("jul",), ("JUL",), (" 3 ",), ("03",), ("3.0000",), ("13",), ("x",), (None,), ("may",)]
    got = values(spark, rows, "m string", dates.month_number(F.col("m")))
    assert got == [7, 7, 7, 3, 3, 3, None, None, None, 5]


def test_date_from_parts(spark):
    rows = [("23.000", "July", "1976.000"), ("30", "2", "1999"), (None, "2", "1999"), ("29", "feb", "2000"), ("x", "1", "2")]
    got = values(spark, rows, "d string, m string, y string", dates.date_from_parts(F.col("d"), F.col("m"), F.col("y")))
    assert got == [datetime.date(1976, 7, 23), None, None, datetime.date(2000, 2, 29), None]


def test_packed_dates(spark):
    rows = [("032589",), ("32589",), ("3589",), ("123134",), ("123135",), ("023099",), ("1999-12-31",), ("Mar 5, 1990",), ("7",), (None,)]
    d = datetime.date
    got = values(spark, rows, "t string", dates.packed_date(F.col("t")))
    assert got == [
        d(1989, 3, 25), d(1989, 3, 25), d(1989, 3, 5), d(2034, 12, 31), d(1935, 12, 31),
        None, d(1999, 12, 31), d(1990, 3, 5), None, None,
    ]


def test_age_counts_whole_years_of_365_days(spark):
    rows = [("1990-09-06", 2012), ("1990-09-07", 2012), (None, 2012), ("1990-09-07", 1990)]
    age = dates.age_at(F.col("b").cast("date"), F.col("s"), fixed_values.SEASON_OPENERS)
    assert values(spark, rows, "b string, s int", age) == [22, 22, None, None]


def test_clean_name_keeps_the_order_of_removals(spark):
    rows = [("A.J. Green III",), ("Bob Smith II",), ("Carl IV",), (None,)]
    assert values(spark, rows, "n string", text.clean_name(F.col("n"))) == ["AJ GreenI", "Bob Smith", "Carl", None]
    longest = text.clean_name(F.col("n"), longest_first=True)
    assert values(spark, rows, "n string", longest) == ["AJ Green", "Bob Smith", "Carl", None]


def test_canonical_entity(spark):
    rows = [("San Francisco 49ers",), ("free_agents",), ("Washington Football Team",), ("new_york_jets ",), ("London Foxes",), (None,)]
    column = text.canonical_entity(F.col("t"), fixed_values.TEAM_ALIASES, fixed_values.TEAM_CODES)
    assert values(spark, rows, "t string", column) == ["SF", "FREEAGENT", "WAS", "NYJ", "Foxes", None]


def test_keys(spark):
    frame = spark.createDataFrame(
        [("Jo Doe", "1990-01-02", "QB"), ("Jo Doe", None, "QB"), (None, None, "QB")], "n string, b string, g string"
    )
    birth = text.name_birth_key(F.col("n"), F.col("b").cast("date"), F.col("g"))
    assert [r[0] for r in frame.select(birth).collect()] == ["JODOE_19900102", "JODOE_QB", None]
    short = text.short_birth_key(F.lit("Jonathan"), F.lit("Featherstone"), F.lit("1990-01-02").cast("date"))
    assert frame.select(short).first()[0] == "featherJon121990"
    assert frame.select(text.joined_key(F.lit(2020), F.lit(3), F.lit("A"))).first()[0] == "2020_3_A"


def test_numbers(spark):
    rows = [("87",), ("87.0",), ("n/a",), ("",), ("NaN",), (None,)]
    assert values(spark, rows, "v string", numbers.to_whole(F.col("v"))) == [87, 87, None, None, None, None]
    bands = numbers.band(F.col("v"), fixed_values.RATING_BANDS, fixed_values.RATING_BAND_BELOW)
    assert values(spark, [(80,), (79,), (60,), (59,)], "v int", bands) == ["high", "mid", "mid", "low"]


def test_clipped_rating_of_a_perfect_and_an_empty_game(spark):
    parts = [(F.col(a), F.col(b), *rest) for a, b, *rest in fixed_values.PASSING_RATING]
    rating = numbers.clipped_rating(parts, fixed_values.PASSING_RATING_CEILING, fixed_values.PASSING_RATING_DIVISOR)
    schema = "completions int, attempts int, passing_yards int, passing_tds int, interceptions int"
    got = values(spark, [(10, 10, 200, 3, 0), (0, 0, 0, 0, 0)], schema, rating)
    assert got[0] == pytest.approx(158.3333333)
    assert got[1] is None


def test_passing_numbers_are_rounded_as_published(spark):
    rng = random.Random(5)
    names = [name for name, *_ in fixed_values.PASSING_SCORE]
    rows = [tuple(float(rng.randrange(400)) for _ in names) for _ in range(300)]
    schema = ", ".join(f"{n} double" for n in names)
    parts = [(F.col(a), F.col(b), *rest) for a, b, *rest in fixed_values.PASSING_RATING]
    rating = numbers.clipped_rating(parts, fixed_values.PASSING_RATING_CEILING, fixed_values.PASSING_RATING_DIVISOR)
    got = values(spark, rows, schema, F.struct(numbers.weighted_sum(fixed_values.PASSING_SCORE), rating))
    for (att, cmp, yds, td, ints, sacks, carries, r_yds, r_td), (score, rate) in zip(rows, got, strict=True):
        assert score == -2.2 * att + 3.7 * cmp + yds / 5 + 11.3 * td - 14.1 * ints - 8 * sacks - 1.1 * carries + 0.6 * r_yds + 15.9 * r_td
        if att:
            parts = [(cmp / att - 0.3) * 5, (yds / att - 3) * 0.25, td / att * 20, 2.375 - ints / att * 25]
            a, b, c, d = (min(max(p, 0), 2.375) for p in parts)
            assert rate == (a + b + c + d) / 6 * 100


def test_common_lengths_of_all_sizes():
    rng = random.Random(3)
    make = lambda n: "".join(rng.choice("abcéß漢😀 ") for _ in range(n))
    sizes = (0, 1, 5, 20, 63, 64, 65, 130, 300)
    pairs = [(make(n), make(m)) for n in sizes for m in sizes]
    left, right = (np.array(side, dtype=object) for side in zip(*pairs))
    assert list(similarity.common_lengths(left, right)) == [lcs(a, b) for a, b in pairs]


def test_ratio(spark):
    rows = [("abcdef", "abxdf"), ("", ""), (None, "a"), ("same", "same")]
    got = values(spark, rows, "a string, b string", similarity.text_ratio(F.col("a"), F.col("b")))
    assert got == [pytest.approx(800 / 11), None, None, 100.0]


def test_token_sort(spark):
    rows = [("  smith   John ",), ("a",), (None,)]
    assert values(spark, rows, "n string", text.token_sort(F.col("n"))) == ["John smith", "a", None]
