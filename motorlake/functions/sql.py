"""The three search functions under their SQL names.

They are SQL functions, so Catalyst inlines their bodies: no Python worker runs and the
filters stay visible to the optimizer.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from motorlake import constants as K
from motorlake.functions.listing import MILEAGE, PRICE_DIGITS
from motorlake.functions.text import OTHER_DIGITS, OTHER_DIGITS_AS_ASCII


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _to_number(digits: str) -> str:
    latin = f"translate({digits}, {_quoted(OTHER_DIGITS)}, {_quoted(OTHER_DIGITS_AS_ASCII)})"
    return f"coalesce(try_cast({digits} as double), try_cast({latin} as double))"


def _get_km() -> str:
    number = _to_number(f"replace(regexp_extract(at_text, {_quoted(MILEAGE)}, 1), ',', '')")
    unit = f"lower(regexp_extract(at_text, {_quoted(MILEAGE)}, 2))"
    return f"coalesce(try_cast(if({unit} <> 'km', {number} * {K.MILE_IN_KM}D, {number}) as bigint), 0L)"


_CLEAN = "replace(p_text, ',', '')"


def _stated_price() -> str:
    digits = f"regexp_extract({_CLEAN}, {_quoted(PRICE_DIGITS)}, 1)"
    return f"if(contains(p_text, {_quoted(K.MISSING_TEXT)}), null, {_to_number(digits)})"


def _currency() -> str:
    whens = " ".join(
        "when " + " or ".join(f"contains({_CLEAN}, {_quoted(m)})" for m in marks) + f" then {_quoted(code)}"
        for code, marks in K.CURRENCY_MARKS
    )
    default = _quoted(K.DEFAULT_CURRENCY)
    return f"case when {_stated_price()} is null then {default} {whens} else {default} end"


STATEMENTS = {
    "get_km": f"(at_text STRING) RETURNS BIGINT RETURN {_get_km()}",
    "check_fuel": (
        "(at_text STRING, wanted STRING) RETURNS BOOLEAN RETURN "
        "coalesce(wanted, '') = '' or (coalesce(at_text, '') <> '' and "
        "exists(split(wanted, ','), f -> contains(lower(at_text), lower(f))))"
    ),
    "price_currency": f"(p_text STRING) RETURNS STRING RETURN {_currency()}",
    "get_price_usd": f"(p_text STRING, rate DOUBLE) RETURNS DOUBLE RETURN coalesce({_stated_price()}, 0D) / rate",
}


def register_functions(spark: SparkSession) -> None:
    """Create ``get_km``, ``check_fuel``, ``get_price_usd`` and ``price_currency``."""
    for name, body in STATEMENTS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
