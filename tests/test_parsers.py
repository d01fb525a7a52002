import pytest
from conftest import values
from pyspark.sql import functions as F

from motorlake.functions import listing as L
from motorlake.functions.sql import register_functions
from motorlake.functions.text import contains_like, strip
from motorlake.operators.features import clean_numeric

TITLES = [
    ("2015 Toyota Camry SE, 2.5L", (2015, "Toyota", "Camry SE", "2.5L")),
    ("2015 Toyota", (2015, "Toyota", "", "")),
    ("Trailer", (0, "Other", "Trailer", "")),
    ("New BMW X5", (0, "BMW", "X5", "")),
    ("2015  Toyota Camry", (2015, "", "Toyota Camry", "")),
    (", foo", (0, "Other", ", foo", "")),
    ("", (0, "Other", "", "")),
    ("2010 VW Golf, 1.4, diesel", (2010, "VW", "Golf", "1.4")),
    ("N/A", (0, "Other", "N/A", "")),
    (" 2015 Kia Rio ", (2015, "Kia", "Rio", "")),
    ("\u00a02015 Kia Rio\u2003,\u30001.6\u00a0", (2015, "Kia", "Rio", "1.6")),
    ("99999999999 Kia Rio", (0, "Kia", "Rio", "")),
    ("-2015 Kia Rio", (0, "Kia", "Rio", "")),
    (None, (0, "Other", None, "")),
]

PRICES = [
    ("$12,500", 12500.0, "USD", 12500.0),
    ("4,900,000 ֏", 4900000.0, "AMD", 12098.7654),
    ("€10,000", 10000.0, "EUR", 10752.6882),
    ("915,000 ₽", 915000.0, "RUB", 10000.0),
    ("700 AMD", 700.0, "AMD", 1.7284),
    ("N/A", 0.0, "USD", 0.0),
    ("", 0.0, "USD", 0.0),
    (None, 0.0, "USD", 0.0),
    ("Price on request", 0.0, "USD", 0.0),
    ("֏", 0.0, "USD", 0.0),
    ("5 N/A ֏", 0.0, "USD", 0.0),
    ("1 500 000 ֏", 1.0, "AMD", 0.0025),
    ("12.50 $", 12.0, "USD", 12.0),
    ("$100 ֏", 100.0, "AMD", 0.2469),
    ("€5 ₽", 5.0, "EUR", 5.3763),
    ("5 A,MD", 5.0, "AMD", 0.0123),
]

MILEAGES = [
    ("Yerevan, 120,000 km, Gasoline", 120000),
    ("50 miles", 80),
    ("100,000 MILES", 160934),
    ("100 mi", 160),
    ("10 min walk", 16),
    ("12km / 9 miles", 12),
    ("7 km", 7),
    ("Abovyan, Electric", 0),
    ("abc", 0),
    ("", 0),
    (None, 0),
    (", km", 0),
]

FUELS = [
    ("Yerevan, Gasoline", "diesel,gasoline", True),
    ("Yerevan, Gasoline", "", True),
    ("", "Diesel", False),
    (None, "Diesel", False),
    ("", "Diesel,", False),
    ("Yerevan, Hybrid", "Diesel, Hybrid", True),
    ("Hybrid", "Diesel, Hybrid", False),
    ("Hybrid", "Diesel,", True),
]


def test_title(spark):
    got = values(spark, L.parse_title, [t for t, _ in TITLES])
    assert [tuple(g) for g in got] == [want for _, want in TITLES]


def test_price(spark):
    texts = [p[0] for p in PRICES]
    assert values(spark, L.price_value, texts) == [p[1] for p in PRICES]
    assert values(spark, L.price_currency, texts) == [p[2] for p in PRICES]
    assert [round(u, 4) for u in values(spark, L.price_usd, texts)] == [p[3] for p in PRICES]


def test_price_without_rate_fails_only_when_used(spark):
    rates = {"EUR": 0.9}
    assert values(spark, lambda x: L.price_usd(x, rates), ["€9", "$5"]) == [10.0, 5.0]
    with pytest.raises(Exception, match="no exchange rate for AMD"):
        values(spark, lambda x: L.price_usd(x, rates), ["9 AMD"])


def test_mileage(spark):
    texts = [t for t, _ in MILEAGES]
    assert values(spark, L.mileage_km, texts) == [km for _, km in MILEAGES]


def test_sql_functions_agree_with_columns(spark):
    register_functions(spark)
    texts = [t for t, _ in MILEAGES]
    assert values(spark, lambda x: F.call_function("get_km", x), texts) == [k for _, k in MILEAGES]
    prices = [p[0] for p in PRICES]
    assert values(spark, lambda x: F.call_function("price_currency", x), prices) == [p[2] for p in PRICES]
    usd = values(spark, lambda x: F.call_function("get_price_usd", x, F.lit(2.0)), prices)
    assert usd == [p[1] / 2 for p in PRICES]
    for text, wanted, passes in FUELS:
        call = F.call_function("check_fuel", F.lit(text), F.lit(wanted))
        assert spark.range(1).select(call).first()[0] is passes


@pytest.mark.parametrize("text,wanted,passes", FUELS)
def test_fuel_filter(spark, text, wanted, passes):
    assert values(spark, lambda x: L.fuel_matches(x, wanted), [text]) == [passes]


def test_fuel_label_and_place(spark):
    labels = values(spark, L.fuel_label, ["Yerevan, Diesel, Hybrid", "gasoline", "x LPG"])
    assert labels == ["Diesel", "Other", "LPG"]
    places = values(spark, L.location, ["Yerevan, 5 km", "120,000 km", "N/A", None])
    assert places == ["Yerevan", "120", "N/A", None]
    assert values(spark, L.mileage_label, [120000, 0], "bigint") == ["120,000 km", "0 km"]


def test_strip_knows_every_blank(spark):
    blanks = "".join(chr(i) for i in range(0x3100) if chr(i).isspace())
    assert values(spark, strip, [blanks + "a b" + blanks, blanks, None]) == ["a b", "", None]


@pytest.mark.parametrize(
    "text,wanted,passes",
    [
        ("2015 BMW X5", "bmw", True),
        ("2015 BMW X5", "b_w", True),
        ("2015 BMW X5", "2%x", True),
        ("Öl", "öl", False),
        ("öl", "öL", True),
        ("a\\b", "a\\b", True),
        ("ab", "a\\b", False),
        ("100%", "0\\%", False),
        ("\u212a", "k", False),
        (None, "a", None),
    ],
)
def test_like_folds_ascii_only_and_has_no_escape(spark, text, wanted, passes):
    assert values(spark, lambda x: contains_like(x, wanted), [text]) == [passes]


def test_clean_numeric(spark):
    cases = {
        "150 hp": 150.0, "3.0 L": 3.0, "120 000 կմ": 120000.0, '17"': 17.0, "5.": 5.0, ".5": 0.5,
        "-7": 7.0, "1e5": 15.0, "3.0 լ.": None, "1.2.3": None, ".": None, "": None, "٣٤": None, "12٣": None,
    }
    assert values(spark, clean_numeric, [*cases, None]) == [*cases.values(), None]


def test_markup_scraps(spark):
    hrefs = ["/en/item/123?ld_src=2", "/item/9", "/category/23", "https://h/en/item/7/item/8", "/item/?x"]
    assert values(spark, L.item_id, hrefs) == ["123", "9", None, "7", ""]
    assert values(spark, L.offer_currency, ["$ 12,500", "", None]) == ["$", "", "?"]
    rows = spark.createDataFrame(
        [(0, "//a/b.jpg", "z"), (1, "", "x.png"), (2, None, None), (3, None, "//c"), (4, "", "")],
        "i int, a string, b string",
    )
    got = rows.select("i", L.image_url(F.col("a"), F.col("b")).alias("u")).orderBy("i").collect()
    assert [r.u for r in got] == ["https://a/b.jpg", "x.png", "N/A", "https://c", "N/A"]


def test_money_text(spark):
    prices = values(spark, lambda x: L.format_price(x, F.lit("USD")), [0.5, 1.5, 2.5, 1234567.0], "double")
    assert prices == ["$1", "$2", "$3", "$1,234,567"]
    assert values(spark, lambda x: L.format_price(x, F.lit("AMD")), [1000.0], "double") == ["AMD\u00a01,000"]
    assert values(spark, L.format_estimate, [0.5, 1.5, 2.5, 1234.4], "double") == ["$0", "$2", "$2", "$1,234"]


def test_convert(spark):
    rows = spark.createDataFrame(
        [(100.0, 0.5, 4.0), (None, 1.0, 1.0), (0.0, 2.0, 3.0), (10.0, None, 2.0), (10.0, 0.0, None)],
        "a double, f double, t double",
    )
    got = rows.select(L.convert(F.col("a"), F.col("f"), F.col("t"))).collect()
    assert [r[0] for r in got] == [800.0, 0.0, 0.0, 20.0, 10.0]
    bounds = rows.select(L.bound_to_usd(F.col("a"), F.col("f"))).collect()
    assert [r[0] for r in bounds] == [200.0, None, None, 10.0, 10.0]


def test_sql_functions_agree_with_the_columns(spark):
    """Both spellings of the price, mileage and fuel rules, over the same texts."""
    from motorlake.functions import sql

    sql.register_functions(spark)
    texts = [
        "Yerevan, 12,000 km, Diesel", "1 mi", "5,5 MILES", "٣٤ km", ", km", "km", "12 kmh, 7 mi", "7 000 km", "7\u00a0km",
        "99999999999999999999 km", "$1,234", "12 500 ֏", "€ 7", "RUB 5 USD 6", "AMD", "N/A 5", "", None, "1.5 km", "Electric, LPG",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(
        F.expr("get_km(t)") == L.mileage_km(F.col("t")),
        F.expr("price_currency(t)").eqNullSafe(L.price_currency(F.col("t"))),
        F.expr("get_price_usd(t, 2D)").eqNullSafe(L.price_value(F.col("t")) / 2),
        F.expr("check_fuel(t, 'diesel, lpg')").eqNullSafe(F.coalesce(L.fuel_matches(F.col("t"), "diesel, lpg"), F.lit(False))),
    )
    assert all(all(r) for r in got.collect())
