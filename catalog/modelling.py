"""Feature preparation and regression."""

from pyspark.sql import functions as F

from brightloom.operators import models as M, prepare as P
from brightloom.plans.rentals import Experiment, run_experiment, select_model

from . import entry
from .projection import HOLES, holes

NUMBERS = ["value", "user_id", "weight"]


@entry("m01_impute_median", f"""
    WITH h AS ({HOLES}), m AS (SELECT median(value) AS a, median(user_id) AS b, median(weight) AS c FROM h)
    SELECT event_id, event_type, coalesce(value, a) AS value, coalesce(user_id, b) AS user_id, coalesce(weight, c) AS weight FROM h, m""")
def _(t):
    return P.impute_median(holes(t), NUMBERS)


KINDS = "SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN event_type END AS kind, CASE WHEN event_id % 8 <> 0 THEN user_id % 3 * 2.0::DOUBLE END AS third FROM events"


def kinds(t):
    key = F.col("event_id")
    return t.events.select("event_id", F.when(key % 9 != 0, F.col("event_type")).alias("kind"),
                           F.when(key % 8 != 0, F.col("user_id") % 3 * 2.0).alias("third"))


@entry("m02_impute_mode", f"""
    WITH k AS ({KINDS}) SELECT event_id,
      coalesce(kind, (SELECT kind FROM k WHERE kind IS NOT NULL GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1)) AS kind,
      coalesce(third, (SELECT third FROM k WHERE third IS NOT NULL GROUP BY third ORDER BY count(*) DESC, third LIMIT 1)) AS third FROM k""")
def _(t):
    return P.impute_mode(P.impute_mode(kinds(t), "kind"), "third")


TYPES = ["click", "error", "purchase", "signup", "view"]


@entry("m03_one_hot", "SELECT event_id, " + ", ".join(
    f"CASE WHEN kind = '{k}' THEN 1 ELSE 0 END AS kind_{k}" for k in TYPES) + f" FROM ({KINDS})")
def _(t):
    return P.one_hot(kinds(t).drop("third"), "kind")


@entry("m04_preprocess", f"""
    WITH h AS ({HOLES}), m AS (SELECT median(value) AS mv, median(weight) AS mw FROM h),
    f AS (SELECT event_id, event_type, user_id, coalesce(value, mv) AS value, coalesce(weight, mw) AS weight FROM h, m)
    SELECT event_id, user_id, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) AS value, weight, """ + ", ".join(
    f"CASE WHEN event_type = '{k}' THEN 1 ELSE 0 END AS event_type_{k}" for k in TYPES) + " FROM f")
def _(t):
    spec = P.Preprocessing(median=["value", "weight"], standard=["value"], onehot={"event_type": None})
    return P.preprocess(holes(t), spec).withColumn("value", F.round("value", 6))


@entry("m05_standard_scale", f"""
    SELECT event_id, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) AS value,
           round((weight - avg(weight) OVER ()) / stddev_pop(weight) OVER (), 6) AS weight FROM ({HOLES})""")
def _(t):
    scaled = P.standard_scale(holes(t), ["value", "weight"])
    return scaled.select("event_id", F.round("value", 6).alias("value"), F.round("weight", 6).alias("weight"))


@entry("m06_robust_scale", f"""
    WITH h AS ({HOLES}), q AS (SELECT quantile_cont(value, 0.25) AS a, median(value) AS b, quantile_cont(value, 0.75) AS c FROM h)
    SELECT event_id, round((value - b) / (c - a), 6) AS value FROM h, q""")
def _(t):
    scaled = P.robust_scale(holes(t), ["value"])
    return scaled.select("event_id", F.round("value", 6).alias("value"))


# Hourly table in the shape of the rental data: one row per hour of events.
LEVELS = ["clear", "mist", "rain"]
HOURLY = """
    SELECT *, CASE WHEN hour_no % 97 = 0 THEN NULL WHEN cnt % 4 = 0 THEN 'mist' WHEN cnt % 4 = 1 THEN 'rain' ELSE 'clear' END AS weathersit,
      CASE WHEN hour_no % 89 <> 0 THEN round(total / 1000, 6) END AS windspeed FROM (
      SELECT CAST(ts AS DATE) AS dteday, CAST(hour(ts) AS INTEGER) AS hr, CAST((day(ts) - 1) * 24 + hour(ts) AS INTEGER) AS hour_no, count(*) AS cnt,
        round(avg(value) FILTER (event_type = 'view'), 6) AS temp, round(avg(value) FILTER (event_type = 'click'), 6) AS atemp,
        round(avg(value) FILTER (event_type = 'error'), 6) AS hum, round(sum(value) FILTER (event_type = 'purchase'), 6) AS total
      FROM events GROUP BY ALL)"""


def hourly(t):
    kind = F.col("event_type")
    mean = lambda k: F.round(F.avg(F.when(kind == k, F.col("value"))), 6)
    base = (t.events.withColumns({"dteday": F.to_date("ts"), "hr": F.hour("ts")})
            .groupBy("dteday", "hr")
            .agg(F.count(F.lit(1)).alias("cnt"), mean("view").alias("temp"), mean("click").alias("atemp"),
                 mean("error").alias("hum"), F.round(F.sum(F.when(kind == "purchase", F.col("value"))), 6).alias("total"))
            .withColumn("hour_no", (F.dayofmonth("dteday") - 1) * 24 + F.col("hr")))
    weather = (F.when(F.col("cnt") % 4 == 0, "mist").when(F.col("cnt") % 4 == 1, "rain").otherwise("clear"))
    return base.withColumns({
        "weathersit": F.when(F.col("hour_no") % 97 != 0, weather),
        "windspeed": F.when(F.col("hour_no") % 89 != 0, F.round(F.col("total") / 1000, 6))})


def daylight_bounds(t):
    """First and last hour with a sign-up, per day."""
    return (t.events.where("event_type = 'signup'").groupBy(F.to_date("ts").alias("Date"))
            .agg(F.min(F.hour("ts")).alias("Sunrise"), F.max(F.hour("ts")).alias("Sunset")))


def rental_features(t):
    def build(df):
        return P.calendar_features(df, "dteday", "hr", daylight_bounds(t), "Date", "Sunrise", "Sunset",
                                   "temp", "atemp", "weathersit", LEVELS, "windspeed", drop=["total"])
    return build


@entry("m07_calendar_features", f"""
    WITH b AS (SELECT CAST(ts AS DATE) AS day, min(hour(ts)) AS lo, max(hour(ts)) AS hi FROM events WHERE event_type = 'signup' GROUP BY 1)
    SELECT hr, hour_no, cnt, temp, hum, windspeed, CAST(year(dteday) AS INTEGER) AS year, CAST(quarter(dteday) AS INTEGER) AS quarter,
      CAST(month(dteday) AS INTEGER) AS month, CAST(isodow(dteday) - 1 AS INTEGER) AS dayofweek,
      CASE WHEN hr BETWEEN lo AND hi THEN 1 ELSE 0 END AS daylight,
      (CASE weathersit WHEN 'clear' THEN 1 WHEN 'mist' THEN 2 WHEN 'rain' THEN 3 ELSE 0 END) * (CASE WHEN windspeed >= 0.25 THEN 1 ELSE 0 END) AS wind_influence,
      {', '.join(f"CASE WHEN weathersit = '{v}' THEN 1 ELSE 0 END AS weathersit_{v}" for v in LEVELS)},
      CASE WHEN month(dteday) IN (12, 1, 2) THEN 1 ELSE 0 END AS season_winter, CASE WHEN month(dteday) IN (3, 4, 5) THEN 1 ELSE 0 END AS season_spring,
      CASE WHEN month(dteday) IN (6, 7, 8) THEN 1 ELSE 0 END AS season_summer, CASE WHEN month(dteday) IN (9, 10, 11) THEN 1 ELSE 0 END AS season_autumn,
      CASE WHEN temp - atemp >= 0 THEN 1 ELSE 0 END AS feeling_feels_warmer, CASE WHEN temp - atemp >= 0 THEN 0 ELSE 1 END AS feeling_feels_colder
    FROM ({HOURLY}) LEFT JOIN b ON dteday = day""")
def _(t):
    return rental_features(t)(hourly(t))


# Line items with a price that depends on other columns, for the linear models.
def priced(t):
    q, d, x = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    price = F.col("l_extendedprice") + q * 1500 - d * 40000
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
                             price.alias("price"), q.alias("quantity"), d.alias("discount"), x.alias("tax"),
                             (q * 2 + d * 100).alias("blend"), (q * d).alias("saving"))


KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
FEATURES = ["quantity", "discount", "tax", "saving"]


@entry("m08_select_by_correlation", """
    WITH x AS (SELECT l_extendedprice + l_quantity * 1500 - l_discount * 40000 AS y, l_quantity AS quantity, l_discount AS discount, l_tax AS tax, l_quantity * 2 + l_discount * 100 AS blend, l_quantity * l_discount AS saving FROM lineitem),
    r AS (SELECT 'quantity' AS feature, abs(corr(quantity, y)) AS r FROM x UNION ALL SELECT 'discount', abs(corr(discount, y)) FROM x UNION ALL SELECT 'tax', abs(corr(tax, y)) FROM x
          UNION ALL SELECT 'blend', abs(corr(blend, y)) FROM x UNION ALL SELECT 'saving', abs(corr(saving, y)) FROM x),
    c AS (SELECT 'quantity' AS a, 'blend' AS b, abs(corr(quantity, blend)) AS p FROM x UNION ALL SELECT 'quantity', 'saving', abs(corr(quantity, saving)) FROM x UNION ALL SELECT 'blend', 'saving', abs(corr(blend, saving)) FROM x)
    SELECT feature FROM r WHERE r >= 0.1 AND NOT EXISTS (SELECT 1 FROM c JOIN r o ON o.feature = CASE WHEN c.a = r.feature THEN c.b ELSE c.a END
      WHERE r.feature IN (c.a, c.b) AND p > 0.5 AND o.r > r.r)""")
def _(t):
    kept = P.select_by_corr(priced(t), [*FEATURES, "blend"], "price")
    return t.spark.createDataFrame([(k,) for k in kept], "feature string")


def coefficients(t, model):
    rows = [(n, float(c)) for n, c in zip(model.features, model.coefficients)] + [("(intercept)", model.intercept)]
    return t.spark.createDataFrame(rows, "feature string, coefficient double")


@entry("m09_select_by_lasso")
def _(t):
    model = M.fit_lasso_cv(priced(t), FEATURES, "price", KEYS)
    return t.spark.createDataFrame([(f,) for f in M.select_by_lasso(model)], "feature string")


@entry("m10_random_split")
def _(t):
    return (M.split_random(t.orders.select("o_orderkey"), ["o_orderkey"], 75, seed=42).groupBy("is_train")
            .agg(F.count(F.lit(1)).alias("orders")))


@entry("m11_least_squares_one_feature", """
    SELECT '(intercept)' AS feature, round(regr_intercept(l_extendedprice, l_quantity), 4) AS coefficient FROM lineitem
    UNION ALL SELECT 'quantity', round(regr_slope(l_extendedprice, l_quantity), 4) FROM lineitem""")
def _(t):
    model = M.fit_ols(priced(t), ["quantity"], "l_extendedprice")
    return coefficients(t, model).withColumn("coefficient", F.round("coefficient", 4))


@entry("m11_least_squares", """
    WITH s AS (SELECT var_pop(l_quantity) AS xx, var_pop(l_discount) AS zz, covar_pop(l_quantity, l_discount) AS xz,
      covar_pop(l_quantity, l_extendedprice) AS xy, covar_pop(l_discount, l_extendedprice) AS zy, avg(l_quantity) AS mx, avg(l_discount) AS mz, avg(l_extendedprice) AS my FROM lineitem),
    b AS (SELECT (xy * zz - zy * xz) / (xx * zz - xz * xz) AS bx, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS bz, mx, mz, my FROM s)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(my + bx * (l_quantity - mx) + bz * (l_discount - mz), 3) AS prediction FROM lineitem, b""")
def _(t):
    data = priced(t)
    model = M.fit_ols(data, ["quantity", "discount"], "l_extendedprice")
    return model.transform(data).select(*KEYS, F.round("prediction", 3).alias("prediction"))


@entry("m12_ridge")
def _(t):
    return coefficients(t, M.fit_ridge_cv(priced(t), FEATURES, "price", KEYS))


@entry("m13_lasso_one_feature", """
    WITH s AS (SELECT covar_pop(l_quantity, l_extendedprice) AS xy, var_pop(l_quantity) AS xx, avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem),
    b AS (SELECT p, sign(xy) * greatest(abs(xy) - p, 0) / xx AS beta, mx, my FROM s, (VALUES (10.0::DOUBLE), (1000.0), (100000.0), (10000000.0)) v(p))
    SELECT p AS penalty, round(beta, 4) + 0.0 AS slope, round(my - beta * mx, 3) AS intercept FROM b""")
def _(t):
    penalties = [10.0, 1e3, 1e5, 1e7]
    rows = [(p, float(m.coefficients[0]), m.intercept) for p, m in
            zip(penalties, M.fit_lasso(priced(t), ["quantity"], "l_extendedprice", penalties))]
    fits = t.spark.createDataFrame(rows, "penalty double, slope double, intercept double")
    return fits.select("penalty", (F.round("slope", 4) + 0.0).alias("slope"), F.round("intercept", 3).alias("intercept"))


@entry("m13_lasso")
def _(t):
    return coefficients(t, M.fit_lasso_cv(priced(t), FEATURES, "price", KEYS))


def rental_vectors(t):
    table = rental_features(t)(hourly(t)).dropna()
    return M.assemble(table, ["hr", "temp", "hum", "daylight", "dayofweek", "wind_influence"], "cnt")


def search_rows(t, found):
    rows = [(str(sorted(p.items())), m) for p, m in found.results]
    return t.spark.createDataFrame(rows, "parameters string, r2 double")


@entry("m14_tree_search")
def _(t):
    """The whole space of 224 candidates over five folds; where two of them ask Spark for the
    same tree, it is fitted once."""
    return search_rows(t, M.fit_tree_cv(rental_vectors(t), ["hour_no"]))


@entry("m15_forest_search")
def _(t):
    space = M.product_grid(n_estimators=[5, 10], max_depth=[4, 6], max_features=["auto", "sqrt"])
    return search_rows(t, M.fit_forest_search(rental_vectors(t), ["hour_no"], space, n_iter=2, folds=3))


@entry("m16_extra_trees")
def _(t):
    space = M.product_grid(n_estimators=[5, 10], max_depth=[4, 6], min_samples_leaf=[1, 3])
    return search_rows(t, M.fit_extra_trees(rental_vectors(t), ["hour_no"], space, n_iter=2, folds=3))


@entry("m17_grid_search")
def _(t):
    found = M.grid_search(M.decision_tree(), [{"maxDepth": d} for d in range(1, 9)], rental_vectors(t), ["hour_no"])
    return t.spark.createDataFrame([(str(found.best), found.validation_r2, found.train_r2)],
                                   "best string, validation_r2 double, train_r2 double")


SMALL = {"tree": {"space": M.product_grid(min_samples_split=[4], max_leaf_nodes=[8, 32]), "folds": 5},
         "forest": {"space": M.product_grid(n_estimators=[5], max_depth=[5]), "n_iter": 1, "folds": 5},
         "extra": {"space": M.product_grid(n_estimators=[5], max_depth=[5]), "n_iter": 1, "folds": 5}}


@entry("m18_model_families")
def _(t):
    table = M.split_random(rental_features(t)(hourly(t)).dropna(), ["hour_no"]).persist()
    features = ["hr", "temp", "hum", "daylight", "dayofweek"]
    return select_model(table.where("is_train = 1"), table.where("is_train = 0"), features, "cnt", ["hour_no"],
                        ("ols", "ridge", "lasso", "tree", "forest", "extra"), SMALL)[0]


def experiment(t):
    spec = Experiment(label="cnt", keys=["hour_no"], numeric=["temp", "atemp", "hum", "windspeed"],
                      categorical=["weathersit"], features=rental_features(t), is_test=F.col("hour_no") >= 600)
    return run_experiment(hourly(t), spec)


@entry("m19_experiment")
def _(t):
    """Four rounds of six families, each searched over its whole space, and the three best on the hold-out."""
    results = experiment(t)
    return results.board.withColumn("part", F.lit("validation")).unionByName(results.final.withColumn("part", F.lit("test")))
