"""Registered queries: wide table, features, price model."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake.functions import listing as L
from motorlake.operators import features, model, unify
from motorlake.plans import adapters
from motorlake.plans.registry import query, with_tables
from motorlake.session import new_folder
from motorlake.sources import tables

SETTINGS = model.TrainingSettings()

_ATTRIBUTES = {
    "Horsepower": "Ձիաուժը",
    "Mileage": "Վազքը",
    "Fuel_Type": "Շարժիչը",
    "Engine_Volume": "Շարժիչի ծավալը",
    "Color": "Գույնը",
    "Cylinders": "Մխոցների քանակը",
    "Condition": "Վիճակը",
}
_PIVOT = ", ".join(
    f"max(case when attribute = '{source}' then value end) as \"{name}\"" for name, source in _ATTRIBUTES.items()
)


def _names(quoted: bool = True) -> str:
    return ", ".join(f'"{n}"' if quoted else n for n in _ATTRIBUTES)


_CARS = "cars.id, cars.brand, cars.model, cars.price, cars.taxed, cars.year"
_MORE = {"pivoted": f"select car_id, {_PIVOT} from firsts group by car_id"}
_MORE["wide"] = f"select {_CARS}, {_names()} from cars left join pivoted on car_id = cars.id"


def _clean(column: str) -> str:
    return f"try_cast(regexp_replace({column}, '[^0-9.]+', '', 'g') as double)"


def _category(column: str) -> str:
    return f"case when {column} is null or {column} in ('nan', 'NaN', '') then 'Unknown' else {column} end"


def _feature(name: str) -> str:
    fixed = {
        "Make": _category("brand"),
        "Model": _category("model"),
        "Taxed": "cast(cast(taxed as int) as varchar)",
        "Year": "year",
        "Car_Age": "cast(2025 - year as double)",
        "Electric_Motor_Count": "cast(null as double)",
    }
    if name in fixed:
        return fixed[name]
    if name in K.CATEGORICALS:
        return _category(f'"{name}"') if name in _ATTRIBUTES else "'Unknown'"
    return f'coalesce({_clean(chr(34) + name + chr(34))}, -1)' if name in _ATTRIBUTES else "cast(-1 as double)"


_MORE["features"] = (
    "select id, "
    + ", ".join(f'{_feature(n)} as "{n}"' for n in K.FEATURE_ORDER)
    + ', price as "Price", ln(1 + price) as "Log_Price" from wide where price > 2000 and price < 80000'
)
_IS_TEST = "substr(md5(concat(id, '|42')), 1, 8) < '33333333'"
_MORE["train"] = f"select *, ascii(substr(md5(concat(id, '|42')), 9, 1)) % 5 as fold from features where not {_IS_TEST}"
_MORE["test"] = f"select * from features where {_IS_TEST}"


def _sql(body: str, last: str = "test", **more: str) -> str:
    """``body`` behind the shared model tables up to ``last``."""
    keep = {}
    for name, text in _MORE.items():
        keep[name] = text
        if name == last:
            break
    return with_tables("cars firsts", body, **keep, **more)


# ---------------------------------------------------------------- wide table

@query("pivot_tags", _sql(f"select car_id, {_names()} from pivoted", "pivoted"))
def pivot_tags(spark, sf):
    wide = unify.pivot_tags(adapters.tags(spark, sf), list(_ATTRIBUTES.values()))
    return wide.withColumnsRenamed({source: name for name, source in _ATTRIBUTES.items()})


@query("pivot_tags_inferred", _sql(f"select car_id, {_names()} from pivoted", "pivoted"))
def pivot_tags_inferred(spark, sf):
    tags = adapters.tags(spark, sf)
    wide = unify.pivot_tags(tags, unify.attribute_names(tags))
    return wide.withColumnsRenamed({source: name for name, source in _ATTRIBUTES.items()})


@query("unify_left_join", _sql(f"select id, brand, model, price, taxed, year, {_names()} from wide", "wide"))
def unify_left_join(spark, sf):
    wide = adapters.unified(spark, sf)
    renamed = wide.withColumnsRenamed({source: name for name, source in _ATTRIBUTES.items()})
    return renamed.select("id", "brand", "model", "price", "taxed", "year", *_ATTRIBUTES)


@query(
    "tags_fk_check",
    with_tables(
        "cars tags_raw",
        "select car_id, count(*) as n_tags from tags_raw where car_id not in "
        "(select id from cars where price >= 50000) group by car_id",
    ),
)
def tags_fk_check(spark, sf):
    return unify.tags_fk_check(adapters.tags(spark, sf), adapters.cars(spark, sf).where("price >= 50000"))


# ---------------------------------------------------------------- features

@query(
    "rename_features",
    _sql('select id, brand as "Make", model as "Model", price as "Price", taxed as "Taxed", year as "Year", '
         f"{_names()} from wide", "wide"),
)
def rename_features(spark, sf):
    named = features.rename_features(adapters.unified(spark, sf))
    return named.select("id", "Make", "Model", "Price", "Taxed", "Year", *_ATTRIBUTES)


@query("drop_id", with_tables("cars", 'select brand as "Make", model as "Model", price as "Price", year as "Year" from cars'))
def drop_id(spark, sf):
    rows = features.rename_features(adapters.cars(spark, sf).select("id", "brand", "model", "price", "year"))
    return features.drop_id(rows)


@query("clean_numeric", with_tables("tags_raw", f"select car_id, attribute, value, {_clean('value')} as number from tags_raw"))
def clean_numeric(spark, sf):
    number = features.clean_numeric(F.col("value"))
    return adapters.tags(spark, sf).select("car_id", "attribute", "value", number.alias("number"))


@query(
    "clean_all_numerics",
    _sql("select id, " + ", ".join(
        (_clean(f'"{n}"') if n in _ATTRIBUTES else "cast(null as double)") + f' as "{n}"' for n in K.CLEANED_NUMERICS
    ) + " from wide", "wide"),
)
def clean_all_numerics(spark, sf):
    named = features.rename_features(adapters.unified(spark, sf))
    return features.clean_all_numerics(named).select("id", *K.CLEANED_NUMERICS)


@query("car_age", with_tables("cars", "select id, cast(2025 - year as double) as age from cars"))
def car_age(spark, sf):
    return adapters.cars(spark, sf).select("id", features.car_age(F.col("year")).alias("age"))


@query(
    "normalize_categoricals",
    _sql("select id, " + ", ".join(f'{_feature(n)} as "{n}"' for n in K.CATEGORICALS) + " from wide", "wide"),
)
def normalize_categoricals(spark, sf):
    named = features.rename_features(adapters.unified(spark, sf))
    return features.normalize_categoricals(named).select("id", *K.CATEGORICALS)


@query(
    "impute_numeric",
    _sql("select id, " + ", ".join(f'{_feature(n)} as "{n}"' for n in K.IMPUTED_NUMERICS) + " from wide", "wide"),
)
def impute_numeric(spark, sf):
    named = features.clean_all_numerics(features.rename_features(adapters.unified(spark, sf)))
    aged = named.withColumn("Car_Age", features.car_age(F.col("Year")))
    return features.impute_numeric(aged).select("id", *K.IMPUTED_NUMERICS)


@query(
    "build_training_set",
    _sql("select id, " + ", ".join(f'"{n}"' for n in K.FEATURE_ORDER)
         + ', "Price", round("Log_Price", 6) as "Log_Price" from features', "features"),
)
def build_training_set(spark, sf):
    return adapters.training_set(spark, sf).withColumn("Log_Price", F.round("Log_Price", 6))


_REQUESTS = """
  select cast(o_orderkey as varchar(20)) as id, o_orderpriority as make,
    concat('M', cast(o_custkey % 20 as varchar(20))) as model,
    cast(1985 + o_orderkey % 45 as int) as year, cast(o_orderkey % 200000 - 5 as bigint) as mileage,
    o_orderstatus as condition, case o_orderkey % 4 when 0 then 'Diesel' when 1 then '' else 'Gasoline' end as fuel,
    'Auto' as transmission, 'FWD' as drive, cast(o_orderkey % 100 as double) / 10 as engine,
    cast(40 + o_custkey % 1000 as bigint) as hp,
    case o_orderkey % 6 when 0 then '4' when 1 then '6' when 2 then '8' when 3 then '12' when 4 then '5' else 'Unknown' end as cylinders,
    'Sedan' as body, cast(null as varchar(10)) as color, case o_orderkey % 7 when 0 then 'Middle' when 1 then 'Right' else 'Left' end as steering,
    case o_orderkey % 2 when 0 then 'Yes' else 'No' end as taxed, 'Base' as trim, 'Black' as interior,
    cast(o_orderkey % 160 as bigint) as battery, cast(o_orderkey % 1100 as bigint) as range,
    case o_orderkey % 3 when 0 then '17' when 1 then '18"' else 'big' end as wheel_size
  from {orders}
"""


def _requests(spark, sf):
    return spark.sql(_REQUESTS, orders=tables.spread_scan(adapters.table(spark, sf, "orders")))


_REQUEST_FEATURES = {
    "Make": "make", "Model": "model", "Taxed": "case when taxed = 'Yes' then '1' else '0' end", "Year": "year",
    "Wheel_Size": "case wheel_size when '17' then cast(17 as double) when '18\"' then cast(18 as double) else cast(-1 as double) end",
    "Color": "'Unknown'", "Door_Count": "cast(4 as double)", "Body_Type": "body",
    "Range_Km": "case when range > 0 then cast(range as double) else -1 end",
    "Horsepower": "cast(hp as double)", "Steering": "steering",
    "Battery_Capacity": "case when battery > 0 then cast(battery as double) else -1 end",
    "Cylinders": "coalesce(try_cast(cylinders as double), -1)", "Trim": "r.trim",
    "Fuel_Type": "case when fuel = '' then 'Unknown' else fuel end", "Engine_Volume": "engine",
    "Interior_Color": "interior", "Mileage": "cast(mileage as double)", "Condition": "condition",
    "Transmission": "transmission", "Drive_Type": "drive", "Electric_Motor_Count": "cast(0 as double)",
    "Car_Age": "cast(2025 - year as double)",
}


@query(
    "score_row_defaults",
    with_tables(
        "",
        "select id, " + ", ".join(f'{_REQUEST_FEATURES[n]} as "{n}"' for n in K.FEATURE_ORDER) + " from r",
        r=_REQUESTS.format(orders="orders"),
    ),
)
def score_row_defaults(spark, sf):
    return features.score_rows(_requests(spark, sf))


_PROBLEMS = {
    "year": "year between 1990 and 2026", "mileage": "mileage >= 0", "engine": "engine between 0 and 8",
    "hp": "hp between 50 and 1000", "battery": "battery between 0 and 150", "range": "range between 0 and 1000",
    "cylinders": "cylinders in ('4', '6', '8', '12', 'Unknown')", "steering": "steering in ('Left', 'Right')",
}


@query(
    "validate_score_input",
    with_tables(
        "",
        "select id, concat_ws(',', " + ", ".join(
            f"case when not ({test}) then '{name}' end" for name, test in _PROBLEMS.items()
        ) + ") as problems from r",
        r=_REQUESTS.format(orders="orders"),
    ),
)
def validate_score_input(spark, sf):
    checked = features.validate_score_input(_requests(spark, sf))
    return checked.select("id", F.concat_ws(",", "problems").alias("problems"))


# ---------------------------------------------------------------- model

@query("train_test_split", _sql(f"select id, case when {_IS_TEST} then 'test' else 'train' end as part from features", "features"))
def train_test_split(spark, sf):
    train, test = model.train_test_split(adapters.training_set(spark, sf))
    return train.select("id", F.lit("train").alias("part")).unionByName(
        test.select("id", F.lit("test").alias("part"))
    )


_ENC = ", ".join(
    f'(coalesce({c}.s - {c}.sf, 0) + 10 * prior) / (coalesce({c}.n - {c}.nf, 0) + 10) as raw_{c}' for c in K.CATEGORICALS
)


def _stat(column: str) -> str:
    return (
        f'(select t."{column}" as category, t.fold, sum(t.n) as nf, sum(t.s) as sf, '
        f'any_value(a.n) as n, any_value(a.s) as s from '
        f'(select "{column}", fold, count(*) as n, sum("Log_Price") as s from train group by 1, 2) t '
        f'join (select "{column}", count(*) as n, sum("Log_Price") as s from train group by 1) a '
        f'on a."{column}" = t."{column}" group by 1, 2) {column}'
    )


@query(
    "encode_categoricals",
    _sql(
        "select id, " + ", ".join(f'round(raw_{c}, 4) as "{c}_enc"' for c in K.CATEGORICALS) + " from encoded",
        "train",
        encoded=f'select train.id, {_ENC} from train cross join (select avg("Log_Price") as prior from train) p '
        + " ".join(f'left join {_stat(c)} on {c}.category = train."{c}" and {c}.fold = train.fold' for c in K.CATEGORICALS),
    ),
)
def encode_categoricals(spark, sf):
    train, _ = _stored_training_set(spark, sf)
    path = new_folder(spark, "encoder")
    model.save_encoder(train, path)
    encoded = model.encode_categoricals(train, path, out_of_fold=True)
    return encoded.select("id", *[F.round(c, 4).alias(c) for c in model.ENCODED])


def _stored_training_set(spark, sf):
    """Training rows are read many times by the trainer: written once, then scanned."""
    rows = tables.materialise(adapters.training_set(spark, sf), new_folder(spark, "training-set"))
    return model.train_test_split(rows)


def _fit(spark, sf):
    train, test = _stored_training_set(spark, sf)
    path = new_folder(spark, "price-model")
    return model.train_price_model(train, path, SETTINGS), path, train, test


_fits: dict[tuple[str, str], tuple] = {}


def _fitted(spark, sf):
    """One model per session and data folder, for the queries that only use it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _fits:
        _fits[key] = _fit(spark, sf)
    return _fits[key]


# SQL cannot grow trees; it states what must hold of them: rows, a training error that falls
# with every round and ends below that of group means, and prices that are prices.

@query(
    "train_price_model",
    "select cast(i as int) as iter, true as falls, true as below_groups "
    f"from range({SETTINGS.rounds}) t(i)",
)
def train_price_model(spark, sf):
    fitted, path, train, _ = _fit(spark, sf)
    curve = model.training_curve(fitted, path, train, out_of_fold=True)
    groups = model.rmse_log(model.group_mean_model(train, train)).scalar()
    before = F.lag("RMSE").over(Window.orderBy("iter"))
    return curve.select(
        "iter",
        (F.col("RMSE") <= F.coalesce(before, F.col("RMSE")) + 1e-9).alias("falls"),
        ((F.col("iter") < SETTINGS.rounds - 1) | (F.col("RMSE") < groups)).alias("below_groups"),
    )


def _priced(scored):
    """Whether every row has a finite positive price and its text."""
    price = F.col("prediction")
    real = price.isNotNull() & ~F.isnan(price) & (price > 0) & (price < float("inf"))
    return model.price_estimates(scored).select("id", (real & (F.length("estimate") > 0)).alias("priced"))


@query("predict_price", _sql("select id, true as priced from test"))
def predict_price(spark, sf):
    fitted, path, _, test = _fitted(spark, sf)
    return _priced(model.predict_price(test, path, fitted))


@query(
    "score_requests",
    with_tables(
        "",
        "select id, true as priced from r where " + " and ".join(f"({test})" for test in _PROBLEMS.values()),
        r=_REQUESTS.format(orders="orders"),
    ),
)
def score_requests(spark, sf):
    fitted, path, _, _ = _fitted(spark, sf)
    good, _ = features.split_score_input(_requests(spark, sf))
    return _priced(model.predict_price(features.score_rows(good), path, fitted))


# What the model says, beside the facts above. SQL has no counterpart.

@query("price_predictions")
def price_predictions(spark, sf):
    fitted, path, _, test = _fitted(spark, sf)
    return model.price_estimates(model.predict_price(test, path, fitted))


@query("request_estimates")
def request_estimates(spark, sf):
    fitted, path, _, _ = _fitted(spark, sf)
    good, _ = features.split_score_input(_requests(spark, sf))
    return model.price_estimates(model.predict_price(features.score_rows(good), path, fitted))


_HALF = "cast(id as bigint) % 2"


@query(
    "model_save_load",
    _sql(
        "select id, round(m, 4) as log_prediction from test join (select "
        f'{_HALF} as half, avg("Log_Price" + {_HALF}) as m from train group by 1) g on half = {_HALF}'
    ),
)
def model_save_load(spark, sf):
    """One split of one feature with two values: the stored and loaded tree must give the
    mean of each half."""
    train, test = _stored_training_set(spark, sf)
    half = F.expr(_HALF)

    def plain(rows):
        flat = {c: F.lit("Unknown") for c in K.CATEGORICALS} | {c: F.lit(0) for c in model.NUMERICS}
        return rows.withColumns(flat | {"Car_Age": half.cast("double"), "Log_Price": F.col("Log_Price") + half})

    path = new_folder(spark, "one-split")
    model.train_price_model(plain(train), path, model.TrainingSettings(depth=1, rounds=1))
    loaded = model.predict_price(plain(test), path)
    return loaded.select("id", F.round("log_prediction", 4).alias("log_prediction"))


_BY_GROUP = """
  select test.id, test."Price", test."Log_Price", coalesce(g.m, (select avg("Log_Price") from train)) as log_prediction
  from test left join (select "Make", "Year", avg("Log_Price") as m from train group by 1, 2) g
    on g."Make" = test."Make" and g."Year" = test."Year"
"""


def _group_predictions(spark, sf):
    train, test = model.train_test_split(adapters.training_set(spark, sf))
    return model.group_mean_model(train, test)


@query(
    "baseline_group_model",
    _sql("select id, round(log_prediction, 4) as log_prediction, round(exp(log_prediction) - 1, 1) as prediction from p", p=_BY_GROUP),
)
def baseline_group_model(spark, sf):
    rows = _group_predictions(spark, sf)
    money = L.exp_price(F.col("log_prediction"))
    return rows.select(
        "id", F.round("log_prediction", 4).alias("log_prediction"), F.round(money, 1).alias("prediction")
    )


@query(
    "evaluate_mae_r2",
    _sql(
        'select round(avg(abs("Price" - y)), 2) as mae, round(1 - sum(("Price" - y) * ("Price" - y)) / '
        '(select sum(("Price" - m) * ("Price" - m)) from p, (select avg("Price") as m from p) a), 4) as r2 '
        "from (select *, exp(log_prediction) - 1 as y from p) q",
        p=_BY_GROUP,
    ),
)
def evaluate_mae_r2(spark, sf):
    rows = _group_predictions(spark, sf).withColumn("prediction", L.exp_price(F.col("log_prediction")))
    return model.evaluate_mae_r2(rows).select(F.round("mae", 2).alias("mae"), F.round("r2", 4).alias("r2"))


@query(
    "rmse_log",
    _sql('select round(sqrt(avg(power("Log_Price" - log_prediction, 2))), 4) as rmse from p', p=_BY_GROUP),
)
def rmse_log(spark, sf):
    return model.rmse_log(_group_predictions(spark, sf)).select(F.round("rmse", 4).alias("rmse"))


# Error of ever finer group means, written and read back as a training log.
_LEVELS = ((), ("Make",), ("Make", "Model"), ("Make", "Model", "Condition"))


def _level_sql(i: int, keys: tuple[str, ...]) -> str:
    overall = '(select avg("Log_Price") from train)'
    if not keys:
        joined, mean = "", overall
    else:
        names = ", ".join(f'"{k}"' for k in keys)
        on = " and ".join(f'g."{k}" = test."{k}"' for k in keys)
        joined = f'left join (select {names}, avg("Log_Price") as m from train group by {names}) g on {on}'
        mean = f"coalesce(g.m, {overall})"
    return (
        f'select {i} as iter, round(sqrt(avg(power(test."Log_Price" - {mean}, 2))), 4) as "RMSE" from test {joined}'
    )


_CURVE = " union all ".join(_level_sql(i, keys) for i, keys in enumerate(_LEVELS))


def _curve(spark, sf):
    train, test = _stored_training_set(spark, sf)
    curve = None
    for i, keys in enumerate(_LEVELS):
        error = model.rmse_log(model.group_mean_model(train, test, keys))
        one = error.select(F.lit(i).alias("iter"), F.round("rmse", 4).alias("RMSE"))
        curve = one if curve is None else curve.unionByName(one)
    path = new_folder(spark, "learning-curve")
    tables.write_tsv(curve, path)
    return tables.learning_curve(spark, path)


@query("learning_curve", _sql(_CURVE))
def learning_curve(spark, sf):
    return _curve(spark, sf)


@query(
    "best_iteration",
    _sql('select iter as best_iter, "RMSE" as best_rmse from c order by "RMSE", iter limit 1', c=_CURVE),
)
def best_iteration(spark, sf):
    return tables.best_iteration(_curve(spark, sf))
