"""Column expressions that read the raw listing texts.

All of them are built-in Catalyst expressions, so a search over raw items runs inside
one whole-stage-codegen span with no Python worker.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake.functions.text import BLANK_CLASS, strip, to_number

# How a mileage and the digits of a price are written.
MILEAGE = rf"(?i)([\p{{Nd}},]+){BLANK_CLASS}*(km|miles|mi)"
PRICE_DIGITS = r"(\p{Nd}+)"


# ---------------------------------------------------------------- price

def _without_commas(p_text: Column) -> Column:
    return F.replace(p_text, F.lit(","), F.lit(""))


def _stated_price(p_text: Column) -> Column:
    """First run of digits as a number; null when the text states no price."""
    digits = F.regexp_extract(_without_commas(p_text), PRICE_DIGITS, 1)
    return F.when(~p_text.contains(K.MISSING_TEXT), to_number(digits))


def price_value(p_text: Column) -> Column:
    return F.coalesce(_stated_price(p_text), F.lit(0.0))


def _by_mark(p_text: Column, result) -> Column:
    """CASE over the currency marks in their order, ``result(code)`` for the first hit."""
    clean = _without_commas(p_text)
    chain = F
    for code, (symbol, letters) in K.CURRENCY_MARKS:
        chain = chain.when(p_text.contains(symbol) | clean.contains(letters), result(code))
    return chain.otherwise(result(K.DEFAULT_CURRENCY))


def price_currency(p_text: Column) -> Column:
    marked = _by_mark(p_text, F.lit)
    return F.when(_stated_price(p_text).isNull(), K.DEFAULT_CURRENCY).otherwise(marked)


def _rate(code: str, rates: Mapping[str, float]) -> Column:
    """The rate as a literal. A code without one fails the job when a row uses it."""
    if code == K.DEFAULT_CURRENCY:
        return F.lit(1.0)
    if code in rates:
        return F.lit(float(rates[code]))
    return F.raise_error(F.lit(f"no exchange rate for {code}")).cast("double")


def rate_of(currency: Column, rates: Mapping[str, float]) -> Column:
    """Rate of a parsed currency as a CASE over literals.

    Only the four codes ``price_currency`` can return occur, so the expression has a
    fixed size and needs no join.
    """
    chain = F
    for code, _ in K.CURRENCY_MARKS:
        chain = chain.when(currency == code, _rate(code, rates))
    return chain.otherwise(_rate(K.DEFAULT_CURRENCY, rates))


def price_usd(p_text: Column, rates: Mapping[str, float] = K.DEFAULT_RATES) -> Column:
    """Price in dollars; 0 when none is stated, as 0 stays 0 at any rate.

    Kept small on purpose: filters repeat this expression.
    """
    priced = _stated_price(p_text) / _by_mark(p_text, lambda code: _rate(code, rates))
    return F.coalesce(priced, F.lit(0.0))


# ---------------------------------------------------------------- mileage, fuel, place

def mileage_km(at_text: Column) -> Column:
    """Kilometres as a whole number; 0 when the text states none."""
    number = to_number(F.replace(F.regexp_extract(at_text, MILEAGE, 1), F.lit(","), F.lit("")))
    miles = F.lower(F.regexp_extract(at_text, MILEAGE, 2)) != "km"
    unit = F.when(miles, K.MILE_IN_KM).otherwise(1.0)
    return F.coalesce((number * unit).try_cast("bigint"), F.lit(0).cast("bigint"))


def mileage_label(km: Column) -> Column:
    return F.concat(F.format_number(km, 0), F.lit(" km"))


def fuel_label(at_text: Column) -> Column:
    chain = F.when(at_text.contains(K.FUELS[0]), K.FUELS[0])
    for fuel in K.FUELS[1:]:
        chain = chain.when(at_text.contains(fuel), fuel)
    return chain.otherwise("Other")


def location(at_text: Column) -> Column:
    return strip(F.substring_index(at_text, ",", 1))


def fuel_matches(at_text: Column, wanted: str) -> Column:
    """Any element of the comma list occurs in the text, whatever its case."""
    if not wanted:
        return F.lit(True)
    text = F.lower(at_text)
    hit = F.lit(False)
    for fuel in wanted.split(","):
        hit = hit | text.contains(fuel.lower())
    return F.coalesce((at_text != "") & hit, F.lit(False))


# ---------------------------------------------------------------- title

def parse_title(l_text: Column) -> Column:
    """Struct (year, make, model, spec) of a title such as ``2015 Kia Rio, 1.6``."""
    parts = F.split(l_text, ",")
    words = F.split(strip(F.get(parts, F.lit(0))), " ")
    first = F.get(words, F.lit(0))
    named = F.coalesce(F.size(words) >= 2, F.lit(False))
    year = F.when(named & first.rlike(r"^\p{Nd}+\z"), to_number(first, "int"))
    rest = F.array_join(F.slice(words, 3, F.greatest(F.size(words), F.lit(1))), " ")
    # Never null, and plainly so: a join on the make then adds no null filter that would
    # keep two uses of the same counts from sharing one shuffle.
    make = F.coalesce(F.when(named, F.get(words, F.lit(1))), F.lit(K.UNKNOWN_MAKE))
    return F.struct(
        F.coalesce(year, F.lit(0)).alias("year"),
        make.alias("make"),
        F.when(named, rest).otherwise(l_text).alias("model"),
        F.when(named, F.coalesce(strip(F.get(parts, F.lit(1))), F.lit("")))
        .otherwise("")
        .alias("spec"),
    )


# ---------------------------------------------------------------- money out

def convert(amount: Column, rate_from: Column, rate_to: Column) -> Column:
    """Amount between two currencies; an absent or zero rate counts as 1."""
    one = F.lit(1.0)
    source = F.coalesce(F.nullif(rate_from, F.lit(0.0)), one)
    target = F.coalesce(F.nullif(rate_to, F.lit(0.0)), one)
    return F.coalesce(amount / source * target, F.lit(0.0))


def format_price(amount: Column, currency: Column) -> Column:
    """Whole currency units, halves away from zero, thousands separated."""
    prefix = F.coalesce(
        F.create_map(*[F.lit(x) for pair in K.CURRENCY_PREFIX.items() for x in pair])[currency],
        F.concat(currency, F.lit("\u00a0")),
    )
    sign = F.when(amount < 0, "-").otherwise("")
    return F.concat(sign, prefix, F.format_number(F.round(F.abs(amount)), 0))


def format_estimate(amount: Column) -> Column:
    """Whole dollars, halves to even."""
    return F.concat(F.lit("$"), F.format_number(amount, 0))


def bound_to_usd(bound: Column, rate: Column) -> Column:
    """A price bound typed in some currency as dollars; empty or 0 means no bound."""
    return F.nullif(bound, F.lit(0.0)) / F.coalesce(F.nullif(rate, F.lit(0.0)), F.lit(1.0))


def log_price(price: Column) -> Column:
    return F.log1p(price)


def exp_price(log_value: Column) -> Column:
    return F.expm1(log_value)


# ---------------------------------------------------------------- markup scraps

def item_id(href: Column) -> Column:
    """Text after the first ``/item/`` up to the next one, cut at ``?``; else null."""
    tail = F.get(F.split(href, "/item/"), F.lit(1))
    return F.substring_index(tail, "?", 1)


def image_url(data_original: Column, src: Column) -> Column:
    raw = F.coalesce(F.nullif(data_original, F.lit("")), F.nullif(src, F.lit("")))
    full = F.when(raw.startswith("//"), F.concat(F.lit("https:"), raw)).otherwise(raw)
    return F.coalesce(full, F.lit(K.MISSING_TEXT))


def offer_currency(price_text: Column) -> Column:
    """Up to the first space; ``?`` when the card shows no price."""
    return F.coalesce(F.substring_index(price_text, " ", 1), F.lit(K.UNKNOWN_CURRENCY))


def detail_link(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key)
