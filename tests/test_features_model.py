import math
import random

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from motorlake import constants as K
from motorlake import schemas
from motorlake.operators import features, model, unify
from motorlake.plans import adapters, registry
from motorlake.sources import tables


def tag_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "car_id string, attribute string, value string, seq long")


def test_pivot_takes_the_first_non_null(spark):
    tags = tag_rows(
        spark, ("1", "a", None, 1), ("1", "a", "y", 3), ("1", "a", "x", 2), ("1", "b", "", 4), ("2", "a", None, 5),
        (None, "a", "n", 6), ("3", None, "n", 7),
    )
    wide = unify.pivot_tags(tags, unify.attribute_names(tags))
    assert wide.columns == ["car_id", "a", "b"]
    assert [tuple(r) for r in wide.collect()] == [("1", "x", "")]
    assert unify.pivot_tags(tags, ["b", "z"]).columns == ["car_id", "b", "z"]
    back = sorted(tuple(r) for r in unify.unpivot_tags(wide).collect())
    assert back == [("1", "a", "x"), ("1", "b", "")]
    unordered = tag_rows(spark, ("1", "a", "alone", None), ("2", "a", "no", None), ("2", "a", "yes", 5))
    assert {tuple(r) for r in unify.pivot_tags(unordered, ["a"]).collect()} == {("1", "alone"), ("2", "yes")}


def test_pivot_shuffles_once_and_combines_first(spark, sf):
    plan = plan_of(unify.pivot_tags(adapters.tags(spark, sf), list(K.ATTRIBUTE_FEATURES)))
    assert plan.count("hashpartitioning") == 1 and "partial_min" in plan


def test_pivot_round_trip(spark, sf):
    first = adapters.first_tags(spark, sf).where("value IS NOT NULL")
    wide = unify.pivot_tags(adapters.tags(spark, sf), list(K.ATTRIBUTE_FEATURES))
    back = unify.unpivot_tags(wide)
    want = first.select("car_id", "attribute", "value")
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_left_join_and_clash(spark):
    cars = spark.createDataFrame([("1", "Kia"), ("2", "BMW")], "id string, brand string")
    for name in ("brand", "Brand"):
        wide = unify.pivot_tags(tag_rows(spark, ("1", name, "x", 1), ("9", name, "y", 2)), [name])
        got = unify.unify_left_join(cars, wide)
        assert got.columns == ["id", "brand", f"tag_{name}"]
        assert sorted(tuple(r) for r in got.select("*").collect()) == [("1", "Kia", "x"), ("2", "BMW", None)]
    orphans = unify.tags_fk_check(tag_rows(spark, ("9", "a", "y", 1), ("9", "b", "y", 2), ("1", "a", "z", 3)), cars)
    assert [tuple(r) for r in orphans.collect()] == [("9", 2)]


def test_bucketed_tables_unify_without_a_shuffle(spark, sf, tmp_path):
    cars, tags = adapters.cars(spark, sf), adapters.first_tags(spark, sf)
    try:
        tables.write_bucketed(cars, "b_cars", "id", 4, str(tmp_path / "cars"))
        tables.write_bucketed(tags, "b_tags", "car_id", 4, str(tmp_path / "tags"))
        names = list(K.ATTRIBUTE_FEATURES)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        unified = unify.unify(spark.table("b_cars"), spark.table("b_tags"), names)
        assert "Exchange" not in plan_of(unified)
        want = unify.unify(cars, tags, names)
        assert unified.exceptAll(want).count() == 0 and unified.count() == want.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS b_cars")
        spark.sql("DROP TABLE IF EXISTS b_tags")


def test_tsv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame(
        [("1", ' 17" ', "a\tb"), ("2", "N/A", None), ("3", "", "null"), ("4", "x 'y'", "Null")], "id string, a string, b string"
    )
    path = str(tmp_path / "t")
    tables.write_tsv(rows, path)
    got = tables.read_tsv(spark, path, schemas.all_strings(["id", "a", "b"]))
    assert sorted(tuple(r) for r in got.collect()) == [
        ("1", ' 17" ', "a\tb"), ("2", None, None), ("3", None, None), ("4", "x 'y'", "Null"),
    ]
    with pytest.raises(Exception, match="header|schema"):
        tables.read_tsv(spark, path, schemas.all_strings(["id", "b", "a"])).collect()


def test_training_set_is_the_same_through_the_tsv(spark, sf, tmp_path):
    unified = adapters.unified(spark, sf).withColumn(
        "Գույնը", F.expr("case cast(id as int) % 4 when 0 then 'None' when 1 then 'N/A' when 2 then '' else 'red' end")
    )
    path = str(tmp_path / "combined")
    tables.export_training_tsv(unified, path)
    back = tables.read_tsv(spark, path, schemas.all_strings(unify.TRAINING_COLUMNS))
    direct, through = features.build_training_set(unified), features.build_training_set(back)
    assert through.columns == ["id", *K.FEATURE_ORDER, "Price", "Log_Price"]
    assert direct.exceptAll(through).count() == 0 and through.exceptAll(direct).count() == 0
    assert {r[0] for r in direct.select("Color").distinct().collect()} == {"Unknown", "red"}


def test_junk_price_bounds(spark):
    rows = spark.createDataFrame([(2000.0,), (2000.01,), (79999.99,), (80000.0,), (None,)], "price double")
    from motorlake.operators.search import junk_price_filter

    assert [r[0] for r in junk_price_filter(rows).collect()] == [2000.01, 79999.99]


def test_categories(spark):
    rows = spark.range(1).select(*[F.lit("x").alias(c) for c in K.CATEGORICALS])
    for text, want in ((None, "Unknown"), ("nan", "Unknown"), ("NaN", "Unknown"), ("", "Unknown"), (" ", " ")):
        got = features.normalize_categoricals(rows.withColumn("Color", F.lit(text).cast("string"))).first()
        assert got["Color"] == want
    flags = features.normalize_categoricals(rows.withColumn("Taxed", F.lit(True)))
    assert flags.first()["Taxed"] == "1"


def test_price_bounds_of_training_reach_the_scan(spark, sf):
    cars = adapters.cars(spark, sf)
    plan = plan_of(features.build_training_set(cars))
    assert "GreaterThan(o_totalprice,2000.0)" in plan


def test_split_is_stable_and_near_its_share(spark):
    ids = spark.range(20000).select(F.col("id").cast("string").alias("id"))
    train, test = model.train_test_split(ids)
    share = test.count() / 20000
    assert abs(share - 0.2) < 0.01 and train.count() + test.count() == 20000
    assert test.exceptAll(model.train_test_split(ids.repartition(7))[1]).count() == 0
    folds = ids.groupBy(model.fold_of(F.col("id"))).count().collect()
    assert len(folds) == model.FOLDS


def feature_rows(spark, n=400):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        row = {c: rng.choice("ab") for c in K.CATEGORICALS}
        row["Make"] = "hot" if rng.random() < 0.4 else f"m{rng.randrange(5)}"
        row.update({c: float(rng.randrange(100)) for c in model.NUMERICS})
        row["Year"] = None if i % 50 == 0 else 2000 + rng.randrange(20)
        base = 8 + (1.0 if row["Make"] == "hot" else 0.0) + 0.05 * ((row["Year"] or 2000) - 2000)
        row.update(id=str(i), Log_Price=base, Price=math.expm1(base))
        rows.append(row)
    kinds = {c: "string" for c in K.CATEGORICALS} | {c: "double" for c in model.NUMERICS}
    kinds.update(Year="int", id="string", Log_Price="double", Price="double")
    names = list(kinds)
    frame = spark.createDataFrame([tuple(r[c] for c in names) for r in rows], ", ".join(f"{c} {k}" for c, k in kinds.items()))
    return frame, rows


def test_encoding_against_brute_force(spark, tmp_path):
    frame, rows = feature_rows(spark)
    path = str(tmp_path / "enc")
    model.save_encoder(frame, path)
    assert plan_of(model.encode_categoricals(frame, path, True)).count("+- BroadcastHashJoin") > 0
    folds = dict(frame.select("id", model.fold_of(F.col("id")).alias("f")).collect())
    prior = sum(r["Log_Price"] for r in rows) / len(rows)
    for out_of_fold in (True, False):
        got = {r["id"]: r for r in model.encode_categoricals(frame, path, out_of_fold).collect()}
        for r in rows:
            for c in ("Make", "Trim"):
                peers = [
                    o["Log_Price"] for o in rows
                    if o[c] == r[c] and not (out_of_fold and folds[o["id"]] == folds[r["id"]])
                ]
                want = (sum(peers) + model.SMOOTHING * prior) / (len(peers) + model.SMOOTHING)
                assert got[r["id"]][f"{c}_enc"] == pytest.approx(want)
    unseen = frame.withColumn("Make", F.lit("never"))
    assert "NestedLoopJoin" not in plan_of(model.encode_categoricals(unseen, path, False))
    assert model.encode_categoricals(unseen, path, False).first()["Make_enc"] == pytest.approx(prior)


def test_an_encoding_reads_what_it_needs(spark, tmp_path):
    frame, _ = feature_rows(spark)
    frame.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    model.save_encoder(stored, str(tmp_path / "enc"))
    one = model.encode_categoricals(stored, str(tmp_path / "enc"), True, ["Make"]).select("id", "Make_enc")
    plan = plan_of(one)
    assert "Wheel_Size" not in plan and plan.count("+- BroadcastHashJoin") == 1


def test_trees_learn_save_and_score(spark, tmp_path):
    frame, _ = feature_rows(spark)
    train, test = model.train_test_split(frame)
    path = str(tmp_path / "model")
    settings = model.TrainingSettings(depth=4, rate=0.3, rounds=8)
    fitted = model.train_price_model(train, path, settings)
    scored = model.predict_price(test, path, fitted)
    by_trees = model.rmse_log(scored).first()["rmse"]
    by_mean = model.rmse_log(model.group_mean_model(train, test, ())).first()["rmse"]
    assert by_trees < by_mean / 2
    again = model.predict_price(test, path).select("id", F.col("prediction").alias("p2"))
    assert scored.join(again, "id").where("abs(prediction - p2) > 1e-9").count() == 0
    quality = model.evaluate_mae_r2(scored).first()
    pairs = [(r["Price"], r["prediction"]) for r in scored.collect()]
    mean = sum(p for p, _ in pairs) / len(pairs)
    assert quality["mae"] == pytest.approx(sum(abs(p - q) for p, q in pairs) / len(pairs))
    assert quality["r2"] == pytest.approx(1 - sum((p - q) ** 2 for p, q in pairs) / sum((p - mean) ** 2 for p, _ in pairs))
    curve = model.training_curve(fitted, path, train).orderBy("iter").collect()
    assert len(curve) == 8 and curve[-1]["RMSE"] < curve[0]["RMSE"]


def test_registered_model_is_whole_and_shows_its_prices(spark, sf):
    from motorlake.plans import model_queries as registered

    assert registered.SETTINGS == model.TrainingSettings() and registered.SETTINGS.rounds == 100
    fitted, *_ = registered._fitted(spark, sf)
    assert fitted.stages[1].getNumTrees == 100
    for facts, shown in (("predict_price", "price_predictions"), ("score_requests", "request_estimates")):
        rows = registry.QUERIES[shown](spark, sf)
        assert rows.columns == ["id", "prediction", "estimate"]
        assert rows.where("prediction > 0 and estimate <> ''").count() == registry.QUERIES[facts](spark, sf).where("priced").count()


def test_learning_curve_file(spark, tmp_path):
    path = str(tmp_path / "curve")
    rows = spark.createDataFrame([(0, 0.28), (1, 0.25), (2, 0.29), (3, 0.25)], "iter int, RMSE double")
    tables.write_tsv(rows, path)
    assert tuple(tables.best_iteration(tables.learning_curve(spark, path)).first()) == (1, 0.25)


REQUEST = {
    "id": "1", "make": "Kia", "model": "Rio", "year": 2015, "mileage": 5, "condition": "", "fuel": "nan",
    "transmission": "A", "drive": "F", "engine": 1.6, "hp": 100, "cylinders": "Unknown", "body": "S", "color": "c",
    "steering": "Left", "taxed": "Yes", "trim": "Base", "interior": "i", "battery": 0, "range": 10, "wheel_size": '17"',
}


def requests(spark, **changes):
    row = {**REQUEST, **changes}
    kinds = {"year": "int", "mileage": "long", "engine": "double", "hp": "long", "battery": "long", "range": "long"}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in row))


def test_score_rows(spark):
    row = features.score_rows(requests(spark)).first().asDict()
    assert list(row) == ["id", *K.FEATURE_ORDER]
    assert row["Wheel_Size"] == 17.0 and row["Taxed"] == "1" and row["Cylinders"] == -1.0
    assert row["Battery_Capacity"] == -1.0 and row["Range_Km"] == 10.0 and row["Car_Age"] == 10.0
    assert row["Condition"] == "Unknown" and row["Fuel_Type"] == "Unknown"
    assert row["Door_Count"] == 4.0 and row["Electric_Motor_Count"] == 0.0
    assert features.score_rows(requests(spark, taxed="No", cylinders="6")).first()["Cylinders"] == 6.0


@pytest.mark.parametrize(
    "change,problems",
    [
        ({}, []),
        ({"year": 1989}, ["year"]),
        ({"year": None}, ["year"]),
        ({"mileage": -1, "hp": 1001}, ["mileage", "hp"]),
        ({"cylinders": "5", "steering": "left"}, ["cylinders", "steering"]),
        ({"battery": 151, "range": 1001, "engine": 8.1}, ["engine", "battery", "range"]),
    ],
)
def test_request_bounds(spark, change, problems):
    assert features.validate_score_input(requests(spark, **change)).first()["problems"] == problems
    good, bad = features.split_score_input(requests(spark, **change))
    assert (good.count(), bad.count()) == ((0, 1) if problems else (1, 0))


def test_car_age(spark):
    assert values(spark, features.car_age, [2015, None], "int") == [10.0, None]


def test_trainer_input_is_even_whatever_the_files_are(spark, tmp_path, monkeypatch):
    """One large file beside many small ones: a part per core, none much larger than the rest."""
    monkeypatch.setattr(model, "PART_ROWS", 100)
    path = str(tmp_path / "input")
    spark.range(9_000).coalesce(1).write.parquet(path)
    spark.range(9_000, 10_000).repartition(30).write.mode("append").parquet(path)
    dealt = model.trainer_input(spark.read.parquet(path))
    sizes = [len(part) for part in dealt.rdd.glom().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism
    assert sum(sizes) == 10_000 and max(sizes) <= 1.1 * min(sizes)
    monkeypatch.setattr(model, "LARGEST_PART", 500)
    assert model.trainer_input(spark.read.parquet(path)).rdd.getNumPartitions() == 20


def test_scored_requests_take_every_core(spark, sf):
    from motorlake.plans import model_queries

    # One small file is one split; scoring, not reading, takes the time.
    requests = model_queries._requests(spark, sf)
    assert requests.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
