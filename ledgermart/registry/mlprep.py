"""Queries on training data, its preparation, and trained models."""

from pyspark.sql import functions as F

from ..operators import features as f
from ..operators import mlprep, profile, scoring, training
from ..operators import registry as models
from ..operators.calendar import TrainingWindow
from ..session import checkpointed
from ..sources.stores import within
from .check import Registry
from .features import silver_sources
from .monitoring import baseline, labels, scores

registry = Registry()

TRAINING_DATE = "1999-01-01"
WINDOW = TrainingWindow("1997-11-01", "1998-10-31", "1998-11-01", "1998-12-31")
_NUMBERS = ["age", "annual_income", "credit_history_months", "fe_1_mean", "fe_1_std", "fe_4_mean"]
_TEXTS = ["age_group", "occupation_category", "credit_mix", "payment_of_min_amount"]


def rows(t):
    """Labels of the training window with their features."""
    store = f.feature_store_backfill(
        *silver_sources(t), WINDOW.train_test_start, WINDOW.oot_end
    )
    wanted = within(labels(t), WINDOW.train_test_start, WINDOW.oot_end)
    return mlprep.training_rows(wanted, store)


def split_rows(t):
    """Split once: every fit and every pass of a search would order the rows of the cut again."""
    return checkpointed(mlprep.with_splits(checkpointed(rows(t)), WINDOW))


def train_rows(t):
    return split_rows(t).where("split = 'train'")


def _each(columns, text, glue=" UNION ALL "):
    return glue.join(text.replace("{c}", c) for c in columns)


@registry.add(
    "training_rows",
    out="loan_id Customer_ID snapshot_date label:i age:i annual_income:f credit_mix fe_1_mean:f data_completeness_score:f",
    views="training",
    sql="SELECT * FROM training",
)
def training_rows(t):
    return rows(t).select(
        "loan_id", "Customer_ID", "snapshot_date", "label", "age", "annual_income", "credit_mix",
        "fe_1_mean", "data_completeness_score",
    )


@registry.add(
    "training_periods",
    out="period rows:i",
    views="label_store",
    sql="""SELECT CASE WHEN snapshot_date BETWEEN DATE '1997-11-01' AND DATE '1998-10-31' THEN 'train_test'
      WHEN snapshot_date BETWEEN DATE '1998-11-01' AND DATE '1998-12-31' THEN 'oot' END AS period, count(*) AS rows
      FROM label_store GROUP BY 1""",
)
def periods(t):
    return mlprep.with_period(labels(t), WINDOW).groupBy("period").agg(F.count("*").alias("rows"))


@registry.add(
    "ordered_split",
    out="loan_id snapshot_date split",
    views="split_rows",
    sql="SELECT loan_id, snapshot_date, split FROM split_rows",
)
def ordered_split(t):
    wanted = within(labels(t), WINDOW.train_test_start, WINDOW.oot_end)
    return mlprep.with_splits(wanted, WINDOW).select("loan_id", "snapshot_date", "split")


@registry.add(
    "ordered_split_of_all_labels",
    out="loan_id snapshot_date split",
    views="label_store",
    sql="""SELECT loan_id, snapshot_date, CASE WHEN row_number() OVER (ORDER BY snapshot_date, loan_id)
      <= n - ceil((1 - 0.7::DOUBLE) * n) THEN 'train' ELSE 'test' END AS split
      FROM label_store, (SELECT count(*) AS n FROM label_store)""",
)
def split_of_all(t):
    return mlprep.with_ordered_split(labels(t), 0.7).select("loan_id", "snapshot_date", "split")


@registry.add(
    "split_rates",
    out="split rows:i rate:f",
    views="split_rows",
    sql="SELECT split, count(*) AS rows, avg(label::DOUBLE) AS rate FROM split_rows GROUP BY 1",
)
def rates(t):
    wanted = within(labels(t), WINDOW.train_test_start, WINDOW.oot_end)
    return profile.split_rates(mlprep.with_splits(wanted, WINDOW))


@registry.add("stratified_folds")
def folds(t):
    folded = mlprep.with_folds(labels(t), 3, seed=88)
    return folded.groupBy("label", "fold").agg(F.count("*").alias("rows"))


_QUALITY = ["loan_id", *_NUMBERS, "age_group"]


@registry.add(
    "training_data_quality",
    out="""rows:i columns:i total_missing:i missing_percentage:f columns_with_missing high_missing_columns majority_share:f
      is_balanced data_quality_flags""",
    views="training",
    sql="WITH counts AS (SELECT count(*) AS n, sum(label) AS bad, "
    + ", ".join(f"count(*) - count({c}) AS m_{c}" for c in _QUALITY)
    + f""" FROM training), report AS (SELECT n AS rows, {len(_QUALITY)} AS columns, {" + ".join(f"m_{c}" for c in _QUALITY)} AS total_missing,
        concat_ws(',', {", ".join(f"CASE WHEN m_{c} > 0 THEN '{c}' END" for c in _QUALITY)}) AS columns_with_missing,
        concat_ws(',', {", ".join(f"CASE WHEN m_{c}::DOUBLE / n > 0.5 THEN '{c}' END" for c in _QUALITY)}) AS high_missing_columns,
        greatest(bad, n - bad)::DOUBLE / n AS majority_share FROM counts)
      SELECT *, total_missing * 100.0::DOUBLE / (rows * columns) AS missing_percentage, abs(majority_share - 0.5) < 0.3 AS is_balanced,
        concat_ws(',', CASE WHEN total_missing * 100.0::DOUBLE / (rows * columns) > 20 THEN 'HIGH_MISSING_VALUES' END,
          CASE WHEN abs(majority_share - 0.5) >= 0.3 THEN 'IMBALANCED_LABELS' END, CASE WHEN rows < 1000 THEN 'SMALL_SAMPLE_SIZE' END,
          CASE WHEN high_missing_columns <> '' THEN 'HIGH_MISSING_FEATURES' END) AS data_quality_flags FROM report""",
)
def quality(t):
    chosen = rows(t).select("Customer_ID", "snapshot_date", "label", "label_def", *_QUALITY)
    report = profile.training_data_quality(chosen)
    listed = ("columns_with_missing", "high_missing_columns", "data_quality_flags")
    return report.withColumns({c: F.array_join(c, ",") for c in listed})


_MEDIANS = _each(_NUMBERS, "SELECT '{c}' AS feature, median({c}::DOUBLE) AS median FROM train")


@registry.add("training_medians", out="feature median:f", views="train", sql=_MEDIANS)
def medians(t):
    return mlprep.medians(train_rows(t), _NUMBERS)


@registry.add(
    "median_imputed_rows",
    out="loan_id split " + " ".join(f"{c}:f" for c in _NUMBERS),
    views="split_rows train",
    sql="SELECT loan_id, split, "
    + ", ".join(f"coalesce({c}::DOUBLE, (SELECT median({c}::DOUBLE) FROM train)) AS {c}" for c in _NUMBERS)
    + " FROM split_rows",
)
def median_imputed(t):
    split = split_rows(t)
    fill = mlprep.fit_medians(split.where("split = 'train'"), _NUMBERS)
    return mlprep.imputed(split, fill, {}).select("loan_id", "split", *_NUMBERS)


@registry.add(
    "training_modes",
    out="feature mode",
    views="train",
    sql=_each(
        _TEXTS,
        """SELECT '{c}' AS feature, arg_min({c}, (-n, {c})) AS mode
        FROM (SELECT {c}, count(*) AS n FROM train WHERE {c} IS NOT NULL GROUP BY 1)""",
    ),
)
def modes(t):
    return mlprep.modes(train_rows(t), _TEXTS)


@registry.add(
    "category_imputation",
    out="loan_id credit_mix age_group occupation_category",
    views="split_rows train",
    sql="""SELECT loan_id, coalesce(credit_mix, 'Unknown') AS credit_mix, coalesce(age_group, 'Missing') AS age_group,
      coalesce(occupation_category, (SELECT arg_min(o, (-n, o)) FROM (SELECT occupation_category AS o, count(*) AS n
        FROM train WHERE occupation_category IS NOT NULL GROUP BY 1))) AS occupation_category FROM split_rows""",
)
def category_imputation(t):
    split = split_rows(t)
    common = mlprep.fit_modes(split.where("split = 'train'"), ["occupation_category"])
    fill = {"credit_mix": mlprep.UNKNOWN_LEVEL, "age_group": mlprep.MISSING_LEVEL, **common}
    return mlprep.imputed(split, {}, fill).select("loan_id", *fill)


@registry.add(
    "sentinel_filled_rows",
    out="loan_id " + " ".join(f"{c}:f" for c in _NUMBERS),
    views="training",
    sql="SELECT loan_id, " + ", ".join(f"coalesce({c}::DOUBLE, -999) AS {c}" for c in _NUMBERS) + " FROM training",
)
def sentinel(t):
    return mlprep.sentinel_filled(rows(t), _NUMBERS).select("loan_id", *_NUMBERS)


_MIXES = ["Good", "Standard", "Unknown"]


@registry.add(
    "one_hot_rows",
    out="loan_id " + " ".join(f"credit_mix_{m}:f" for m in _MIXES),
    views="split_rows",
    sql="SELECT loan_id, "
    + ", ".join(f"CASE WHEN credit_mix = '{m}' THEN 1.0::DOUBLE ELSE 0 END AS credit_mix_{m}" for m in _MIXES)
    + " FROM split_rows",
)
def one_hot(t):
    split = split_rows(t)
    levels = mlprep.fit_levels(split.where("split = 'train'"), ["credit_mix"])["credit_mix"]
    encoded = mlprep.one_hot("credit_mix", levels)
    return split.select("loan_id", *[F.expr(e).alias(name) for name, e in encoded.items()])


@registry.add(
    "level_codes",
    out="feature level code:i",
    views="train",
    sql=_each(
        _TEXTS,
        """SELECT '{c}' AS feature, {c} AS level, row_number() OVER (ORDER BY {c}) - 1 AS code
        FROM (SELECT DISTINCT {c} FROM train WHERE {c} IS NOT NULL)""",
    ),
)
def level_codes(t):
    return mlprep.level_codes(train_rows(t), _TEXTS)


@registry.add(
    "level_encoded_rows",
    out="loan_id occupation:f",
    views="split_rows",
    sql="""SELECT loan_id, coalesce(code, 0) AS occupation FROM split_rows LEFT JOIN (SELECT o, row_number() OVER (ORDER BY o) - 1 AS code
      FROM (SELECT DISTINCT occupation AS o FROM split_rows WHERE split = 'test' AND occupation IS NOT NULL AND occupation <> 'Mechanic'))
      ON o = occupation""",
)
def level_encoded(t):
    split = split_rows(t)
    known = split.where("split = 'test' AND occupation <> 'Mechanic'")
    levels = mlprep.fit_levels(known, ["occupation"])["occupation"]
    code = F.expr(mlprep.level_code("occupation", levels))
    return split.select("loan_id", code.alias("occupation"))


@registry.add(
    "standardized_rows",
    out="loan_id age:f annual_income:f",
    views="split_rows train",
    sql="""SELECT loan_id, (age - ma) / sa AS age, (annual_income::DOUBLE - mi) / si AS annual_income FROM split_rows,
      (SELECT avg(age) AS ma, stddev_pop(age) AS sa, avg(annual_income::DOUBLE) AS mi, stddev_pop(annual_income::DOUBLE) AS si FROM train)""",
)
def standardized(t):
    split = split_rows(t)
    names = ["age", "annual_income"]
    scale = mlprep.fit_scale(split.where("split = 'train'"), names)
    scaled = [
        F.expr(mlprep.standardized(f"CAST({c} AS DOUBLE)", *scale[c])).alias(c) for c in names
    ]
    return split.select("loan_id", *scaled)


@registry.add(
    "scale_statistics",
    out="feature mean:f deviation:f",
    views="silver_clickstream",
    sql=_each(
        ["fe_1", "fe_2", "fe_3"],
        "SELECT '{c}' AS feature, avg({c}::DOUBLE) AS mean, stddev_pop({c}::DOUBLE) AS deviation FROM silver_clickstream",
    ),
)
def scale_statistics(t):
    return mlprep.scale_statistics(silver_sources(t)[0], ["fe_1", "fe_2", "fe_3"])


_F = _each(
    _NUMBERS,
    """SELECT '{c}' AS feature, sum(n * (m - grand) * (m - grand)) / (count(*) - 1) / (sum(n * v) / (sum(n) - count(*))) AS f_statistic
    FROM (SELECT *, sum(n * m) OVER () / sum(n) OVER () AS grand FROM (SELECT label, count({c})::DOUBLE AS n, avg({c}::DOUBLE) AS m,
      var_pop({c}::DOUBLE) AS v FROM train WHERE {c} IS NOT NULL GROUP BY label))""",
)


@registry.add("anova_f_statistics", out="feature f_statistic:f", views="train", sql=_F)
def f_statistics(t):
    return mlprep.f_statistics(train_rows(t), _NUMBERS)


@registry.add(
    "top_features_by_f",
    out="feature f_statistic:f",
    views="train",
    sql=f"SELECT * FROM ({_F}) ORDER BY f_statistic DESC, feature LIMIT 3",
)
def top_features(t):
    return mlprep.top_features(f_statistics(t), 3)


@registry.add(
    "latest_model_versions",
    out="model_type model_version training_date",
    views="predictions",
    sql="""SELECT model_type, arg_max(v, d) AS model_version, max(d) AS training_date FROM (
      SELECT v, regexp_extract(v, '^credit_model_(.+)_(\\d{4}_\\d{2}_\\d{2})$', 1) AS model_type,
        CAST(replace(regexp_extract(v, '_(\\d{4}_\\d{2}_\\d{2})$', 1), '_', '-') AS DATE) AS d
      FROM (SELECT DISTINCT model_version AS v FROM predictions UNION ALL
        SELECT DISTINCT replace(model_version, '1999_01_01', '1999_04_01') FROM predictions WHERE model_version LIKE '%forest%'))
      GROUP BY 1""",
)
def latest(t):
    versions = t.predictions.select("model_version").distinct()
    newer = versions.where("model_version LIKE '%forest%'").select(
        F.replace("model_version", F.lit("1999_01_01"), F.lit("1999_04_01")).alias("model_version")
    )
    return models.latest_versions(versions.union(newer))


_SPLIT_AUC = """SELECT model_version, auc AS auc_test FROM (SELECT model_version,
    (sum(mid) FILTER (actual_label = 1) - p * (p + 1) / 2.0::DOUBLE) / (p * n) AS auc
  FROM (SELECT *, count(*) FILTER (actual_label = 1) OVER (PARTITION BY model_version)::DOUBLE AS p,
      count(*) FILTER (actual_label = 0) OVER (PARTITION BY model_version)::DOUBLE AS n,
      rank() OVER (PARTITION BY model_version ORDER BY model_prediction_proba)
        + (count(*) OVER (PARTITION BY model_version, model_prediction_proba) - 1) / 2.0::DOUBLE AS mid
    FROM monitored {where}) GROUP BY model_version, p, n)"""


@registry.add(
    "best_model",
    out="model_version auc_test:f",
    views="monitored",
    sql="SELECT * FROM ("
    + _SPLIT_AUC.replace("{where}", "WHERE snapshot_date BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'")
    + ") ORDER BY auc_test DESC, model_version LIMIT 1",
)
def best(t):
    return models.best_model(baseline(t), "auc_test")


@registry.add(
    "model_validation_report",
    out="model_version rows:i mean_probability:f std_probability:f auc_score:f",
    views="monitored",
    sql=f"""SELECT m.model_version, rows, mean_probability, std_probability, auc_test AS auc_score FROM (
      SELECT model_version, count(*) AS rows, avg(model_prediction_proba) AS mean_probability,
        stddev_pop(model_prediction_proba) AS std_probability FROM monitored GROUP BY 1) m
      JOIN ({_SPLIT_AUC.replace("{where}", "")}) USING (model_version)""",
)
def validation(t):
    return models.validation_report(scores(t))


@registry.add("preparation_statistics")
def preparation_statistics(t):
    train = train_rows(t)
    return mlprep.preparation_statistics(train, mlprep.boosting_columns(train.columns))


# --- fitted models: results depend on the optimiser, so there is no SQL for them -----------------


def _trained(t, model_type, **options):
    split = split_rows(t)
    model = training.train_model(
        split.where("split = 'train'"), model_type, TRAINING_DATE, **options
    )
    return split, model


@registry.add("prepared_vectors")
def prepared(t):
    split = split_rows(t)
    train = split.where("split = 'train'")
    sizes = []
    for model_type in training.FAMILIES:
        fitted = training.fit_preparation(model_type, train)
        vectors = fitted.apply(split).groupBy("split").agg(F.count("features").alias("vectors"))
        sizes.append(
            vectors.select(
                F.lit(model_type).alias("model_type"),
                "split",
                "vectors",
                F.lit(len(fitted.feature_names)).alias("entries"),
            )
        )
    return sizes[0].union(sizes[1]).union(sizes[2])


@registry.add("searched_regression")
def searched_regression(t):
    split, model = _trained(t, "logistic", draws=2, folds=2)
    return models.metrics_by_split(training.scored_rows(split, model))


@registry.add("forest_importance")
def forest_importance(t):
    small = {"n_estimators": 10, "max_depth": 4}
    return training.feature_importance(t.spark, _trained(t, "rf", parameters=small)[1])


@registry.add("boosting_registry_row")
def boosting_row(t):
    small = {"n_estimators": 5, "max_depth": 3, "scale_pos_weight": 2}
    split, model = _trained(t, "xgboost", parameters=small)
    return training.registry_row(split, model, TRAINING_DATE).drop("training_seconds")


@registry.add("scored_snapshots")
def scored_snapshots(t):
    _, model = _trained(t, "logistic", parameters={})
    store = f.feature_store_backfill(*silver_sources(t), TRAINING_DATE, "1999-03-01")
    scored = scoring.score_window(store, model.pipeline, model.version, TRAINING_DATE, "1999-03-01")
    return scored.drop("prediction_timestamp")
