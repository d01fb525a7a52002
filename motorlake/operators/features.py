"""Wide car table to feature table, and score requests to the same features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorlake import constants as K
from motorlake.functions import listing as L
from motorlake.operators.search import junk_price_filter
from motorlake.sources.tables import missing_to_null


def rename_features(cars: DataFrame, with_target: bool = True) -> DataFrame:
    """Site names to feature names; names that do not occur are ignored."""
    names = {**K.CAR_FEATURES, **K.ATTRIBUTE_FEATURES}
    if not with_target:
        names = {old: new for old, new in names.items() if old not in ("id", "price")}
    return cars.withColumnsRenamed(names)


def drop_id(rows: DataFrame) -> DataFrame:
    return rows.drop("id")


def clean_numeric(text: Column) -> Column:
    """Digits and dots of a text as a number; null when that is not one number.

    Signs and exponents are dropped with everything else, so ``-7`` is 7. Digits of other
    scripts stay in the text and make it null.
    """
    return F.regexp_replace(text.cast("string"), r"[^\p{Nd}.]+", "").try_cast("double")


def clean_all_numerics(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: clean_numeric(F.col(c)) for c in K.CLEANED_NUMERICS})


def car_age(year: Column, reference_year: int = K.REFERENCE_YEAR) -> Column:
    return (F.lit(reference_year) - year).cast("double")


def _as_text(rows: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(rows.schema[name].dataType, T.BooleanType):
        column = column.cast("int")
    return column.cast("string")


def normalize_categoricals(rows: DataFrame) -> DataFrame:
    """Missing and empty categories become one word; text of blanks stays as it is."""
    def clean(name: str) -> Column:
        text = _as_text(rows, name)
        gone = text.isNull() | text.isin("nan", "NaN", "")
        return F.when(gone, K.UNKNOWN_CATEGORY).otherwise(text)

    return rows.withColumns({c: clean(c) for c in K.CATEGORICALS})


def impute_numeric(rows: DataFrame) -> DataFrame:
    return rows.fillna(K.UNKNOWN_NUMBER, subset=list(K.IMPUTED_NUMERICS))


def _with_all_features(rows: DataFrame) -> DataFrame:
    """Attributes no car of this table has become null columns."""
    absent = [c for c in K.ATTRIBUTE_FEATURES.values() if c not in rows.columns]
    return rows.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else rows


def build_training_set(unified: DataFrame) -> DataFrame:
    """id, the features in model order, Price and Log_Price, for plausible prices.

    Map-only: every step is an expression, and the price bounds reach the scan. The id
    stays beside the features, for a split that does not depend on row order. Cells that
    spell "missing" count as missing whether or not the rows went through a text file.
    """
    named = missing_to_null(_with_all_features(rename_features(unified)))
    priced = junk_price_filter(named.withColumn("Price", F.col("Price").try_cast("double")), "Price")
    typed = clean_all_numerics(priced).withColumns(
        {
            "Year": F.col("Year").try_cast("int"),
            "Electric_Motor_Count": F.col("Electric_Motor_Count").try_cast("double"),
            "Log_Price": L.log_price(F.col("Price")),
        }
    )
    aged = typed.withColumn("Car_Age", car_age(F.col("Year")))
    ready = impute_numeric(normalize_categoricals(aged))
    return ready.select("id", *K.FEATURE_ORDER, "Price", "Log_Price")


# ---------------------------------------------------------------- score requests

def validate_score_input(requests: DataFrame) -> DataFrame:
    """Adds ``problems``, the request fields out of bounds; an empty array means fine."""
    def outside(name: str) -> Column:
        low, high = K.REQUEST_BOUNDS[name]
        inside = F.col(name) >= low
        if high is not None:
            inside = inside & (F.col(name) <= high)
        return F.when(~F.coalesce(inside, F.lit(False)), name)

    checks = [outside(name) for name in K.REQUEST_BOUNDS]
    for name, allowed in (("cylinders", K.REQUEST_CYLINDERS), ("steering", K.REQUEST_STEERING)):
        known = F.coalesce(F.col(name).isin(*allowed), F.lit(False))
        checks.append(F.when(~known, name))
    return requests.withColumn("problems", F.array_compact(F.array(*checks)))


def split_score_input(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = validate_score_input(requests)
    fine = F.size("problems") == 0
    return checked.where(fine).drop("problems"), checked.where(~fine)


def score_rows(requests: DataFrame, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """Requests as feature rows in model order, through the same cleaning as training."""
    def positive(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.when(value > 0, value).otherwise(K.UNKNOWN_NUMBER)

    def number(name: str) -> Column:
        return F.col(name).cast("double")

    wheels = F.coalesce(clean_numeric(F.col("wheel_size")), F.lit(K.UNKNOWN_NUMBER))
    cylinders = F.coalesce(F.col("cylinders").try_cast("double"), F.lit(K.UNKNOWN_NUMBER))
    features = {
        "Make": F.col("make"),
        "Model": F.col("model"),
        "Taxed": F.when(F.col("taxed") == "Yes", "1").otherwise("0"),
        "Year": F.col("year"),
        "Wheel_Size": wheels,
        "Color": F.col("color"),
        "Door_Count": F.lit(K.DEFAULT_DOORS),
        "Body_Type": F.col("body"),
        "Range_Km": positive("range"),
        "Horsepower": number("hp"),
        "Steering": F.col("steering"),
        "Battery_Capacity": positive("battery"),
        "Cylinders": cylinders,
        "Trim": F.col("trim"),
        "Fuel_Type": F.col("fuel"),
        "Engine_Volume": number("engine"),
        "Interior_Color": F.col("interior"),
        "Mileage": number("mileage"),
        "Condition": F.col("condition"),
        "Transmission": F.col("transmission"),
        "Drive_Type": F.col("drive"),
        "Electric_Motor_Count": F.lit(K.DEFAULT_MOTORS),
        "Car_Age": car_age(F.col("year")),
    }
    row = requests.select(*keep, *[features[name].alias(name) for name in K.FEATURE_ORDER])
    return normalize_categoricals(row)
