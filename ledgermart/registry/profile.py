"""Data-profile queries."""

from pyspark.sql import functions as F

from ..operators import explore, profile, silver
from ..operators.calendar import month_calendar, timeline_points
from ..sources.sample_tables import FIRST_MONTH, LAST_MONTH
from .check import Registry

registry = Registry()

_FE = ["fe_1", "fe_2", "fe_3", "fe_4"]
_SOURCES = ("clickstream", "attributes", "financials", "loans")
_NUMBERS = ["Annual_Income_clean", "Num_of_Loan_clean", "Num_of_Delayed_Payment_clean",
            "Outstanding_Debt_clean", "Credit_Utilization_Ratio", "Delay_from_due_date",
            "Credit_History_Months"]


def _each(columns, text, glue=" UNION ALL "):
    return glue.join(text.replace("{c}", c) for c in columns)


def _sources(t, names=_SOURCES):
    return {name: getattr(t, name) for name in names}


def _dates(t):
    calendar = month_calendar(t.spark, FIRST_MONTH, LAST_MONTH)
    return [str(row.analysis_date) for row in timeline_points(calendar).collect()]


@registry.add(
    "distinct_customers",
    out="source customers:i",
    views="clickstream attributes financials loans",
    sql=_each(_SOURCES, "SELECT '{c}' AS source, count(DISTINCT Customer_ID) AS customers FROM {c}"),
)
def distinct_customers(t):
    return profile.distinct_customers(_sources(t))


@registry.add(
    "missing_values",
    out='"column" missing:i missing_pct:f',
    views="attributes financials",
    sql="SELECT * FROM ("
    + _each(
        ["Age", "SSN", "Occupation", "Type_of_Loan", "Credit_History_Age", "Credit_Mix", "Annual_Income"],
        """SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
        (count(*) - count({c})) * 100.0::DOUBLE / count(*) AS missing_pct
        FROM attributes JOIN financials USING (Customer_ID, snapshot_date)""",
    )
    + ") WHERE missing > 0",
)
def missing_values(t):
    both = t.attributes.join(t.financials, ["Customer_ID", "snapshot_date"])
    return profile.missing_values(both.drop("Customer_ID", "snapshot_date"))


@registry.add(
    "missing_values_of_clickstream",
    out='"column" missing:i missing_pct:f',
    views="clickstream",
    sql="SELECT * FROM ("
    + _each(
        _FE,
        """SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
        (count(*) - count({c})) * 100.0::DOUBLE / count(*) AS missing_pct FROM clickstream""",
    )
    + ") WHERE missing > 0",
)
def missing_clickstream(t):
    return profile.missing_values(t.clickstream)


@registry.add(
    "duplicate_rows",
    out="duplicate_rows:i",
    sql="""SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (
      SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem)) AS duplicate_rows""",
)
def duplicates(t):
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return profile.duplicate_rows(lines)


_PROFILE = ["Age", "Occupation", "Type_of_Loan", "Credit_Mix", "Num_of_Loan", "Annual_Income"]


@registry.add(
    "duplicate_profiles",
    out="duplicate_rows:i",
    views="attributes financials",
    sql=f"""WITH profiles AS (SELECT {", ".join(_PROFILE)} FROM attributes JOIN financials USING (Customer_ID, snapshot_date))
      SELECT (SELECT count(*) FROM profiles) - (SELECT count(*) FROM (SELECT DISTINCT * FROM profiles)) AS duplicate_rows""",
)
def duplicate_profiles(t):
    both = t.attributes.join(t.financials, ["Customer_ID", "snapshot_date"])
    return profile.duplicate_rows(both.select(*_PROFILE))


_SUMMARY = """SELECT '{c}' AS feature, count({c}) AS count, avg({c}::DOUBLE) AS mean, stddev_samp({c}::DOUBLE) AS std,
  min({c}) AS min, max({c}) AS max, quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.5) AS q50,
  quantile_cont({c}::DOUBLE, 0.75) AS q75 FROM """
_SUMMARY_OUT = "feature count:i mean:f std:f min:f max:f q25:f q50:f q75:f"


@registry.add(
    "numeric_summary_of_clickstream",
    out=_SUMMARY_OUT,
    views="silver_clickstream",
    sql=_each(_FE, _SUMMARY + "silver_clickstream"),
)
def summary_clickstream(t):
    return profile.numeric_summary(silver.silver_clickstream(t.clickstream), _FE)


@registry.add(
    "numeric_summary_of_financials",
    out=_SUMMARY_OUT,
    views="silver_financials",
    sql=_each(_NUMBERS, _SUMMARY + "silver_financials"),
)
def summary_financials(t):
    return profile.numeric_summary(silver.silver_financials(t.financials), _NUMBERS)


@registry.add(
    "numeric_summary_of_order_lines",
    out=_SUMMARY_OUT,
    sql=_each(["l_extendedprice", "l_quantity", "l_tax"], _SUMMARY + "lineitem"),
)
def summary_lines(t):
    return profile.numeric_summary(t.table("lineitem"), ["l_extendedprice", "l_quantity", "l_tax"])


@registry.add(
    "text_summary",
    out='feature count:i "unique":i top freq:i',
    views="attributes",
    sql=_each(
        ["Age", "SSN", "Occupation"],
        """SELECT '{c}' AS feature, sum(n) AS count, count(*) AS "unique",
        (arg_min(v, (-n, v))) AS top, max(n) AS freq
        FROM (SELECT {c} AS v, count(*) AS n FROM attributes WHERE {c} IS NOT NULL GROUP BY 1)""",
    ),
)
def text_summary(t):
    return profile.text_summary(t.attributes, ["Age", "SSN", "Occupation"])


@registry.add(
    "correlations",
    out="feature_a feature_b correlation:f",
    views="silver_financials",
    sql=" UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}::DOUBLE, {b}::DOUBLE) AS correlation "
        "FROM silver_financials"
        for a in _NUMBERS
        for b in _NUMBERS
    ),
)
def correlations(t):
    return profile.correlations(silver.silver_financials(t.financials), _NUMBERS)


@registry.add(
    "variances",
    out="feature variance:f",
    views="silver_clickstream",
    sql=_each(_FE, "SELECT '{c}' AS feature, var_samp({c}::DOUBLE) AS variance FROM silver_clickstream"),
)
def variances(t):
    return profile.variances(silver.silver_clickstream(t.clickstream), _FE)


_BOUNDS = """SELECT '{c}' AS feature, q1 - 1.5::DOUBLE * (q3 - q1) AS lower_bound, q3 + 1.5::DOUBLE * (q3 - q1) AS upper_bound
  FROM (SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM silver_clickstream)"""
_LONG = "SELECT Customer_ID, '{c}' AS feature, {c}::DOUBLE AS value FROM silver_clickstream"


@registry.add(
    "iqr_outliers",
    out="feature total_count:i percentage:f lower_count:i upper_count:i lower_bound:f upper_bound:f",
    views="silver_clickstream",
    sql=f"""WITH bounds AS ({_each(_FE, _BOUNDS)}), cells AS ({_each(_FE, _LONG)})
      SELECT feature, count(*) FILTER (value < lower_bound OR value > upper_bound) AS total_count,
        round(count(*) FILTER (value < lower_bound OR value > upper_bound) * 100.0::DOUBLE / count(*), 2) AS percentage,
        count(*) FILTER (value < lower_bound) AS lower_count, count(*) FILTER (value > upper_bound) AS upper_count,
        any_value(lower_bound) AS lower_bound, any_value(upper_bound) AS upper_bound
      FROM cells JOIN bounds USING (feature) GROUP BY feature""",
)
def iqr_outliers(t):
    return profile.iqr_outliers(silver.silver_clickstream(t.clickstream), _FE)


@registry.add(
    "iqr_outliers_of_events",
    out="feature total_count:i percentage:f lower_count:i upper_count:i lower_bound:f upper_bound:f",
    sql="""WITH bounds AS (SELECT q1 - 1.5::DOUBLE * (q3 - q1) AS lower_bound, q3 + 1.5::DOUBLE * (q3 - q1) AS upper_bound
        FROM (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events))
      SELECT 'value' AS feature, count(*) FILTER (value < lower_bound OR value > upper_bound) AS total_count,
        round(count(*) FILTER (value < lower_bound OR value > upper_bound) * 100.0::DOUBLE / count(*), 2) AS percentage,
        count(*) FILTER (value < lower_bound) AS lower_count, count(*) FILTER (value > upper_bound) AS upper_count,
        any_value(lower_bound) AS lower_bound, any_value(upper_bound) AS upper_bound FROM events, bounds""",
)
def iqr_events(t):
    return profile.iqr_outliers(t.table("events"), ["value"])


_TALLY = f"""WITH bounds AS ({_each(_FE, _BOUNDS)}), cells AS ({_each(_FE, _LONG)}),
  tally AS (SELECT Customer_ID, count(*) AS outliers FROM cells JOIN bounds USING (feature)
    WHERE value < lower_bound OR value > upper_bound GROUP BY Customer_ID) """


@registry.add(
    "outlier_tally",
    out="Customer_ID outliers:i",
    views="silver_clickstream",
    sql=_TALLY + "SELECT * FROM tally",
)
def outlier_tally(t):
    return profile.outlier_tally(silver.silver_clickstream(t.clickstream), _FE)


@registry.add(
    "outlier_tally_histogram",
    out="outliers:i customers:i",
    views="silver_clickstream",
    sql=_TALLY + "SELECT outliers, count(*) AS customers FROM tally GROUP BY outliers",
)
def tally_histogram(t):
    return profile.tally_histogram(outlier_tally(t))


@registry.add(
    "most_outlying_customers",
    out="Customer_ID outliers:i",
    views="silver_clickstream",
    sql=_TALLY + "SELECT * FROM tally ORDER BY outliers DESC, Customer_ID LIMIT 10",
)
def most_outlying(t):
    return outlier_tally(t).orderBy(F.desc("outliers"), "Customer_ID").limit(10)


@registry.add(
    "records_per_month",
    out="source month count:i",
    views="clickstream attributes financials loans",
    sql=_each(
        _SOURCES,
        """SELECT '{c}' AS source, CAST(date_trunc('month', snapshot_date) AS DATE) AS month, count(*) AS count
        FROM {c} GROUP BY 2""",
    ),
)
def per_month(t):
    return profile.records_per_month(_sources(t))


_MONTHLY = """SELECT '{c}' AS feature, CAST(date_trunc('month', snapshot_date) AS DATE) AS month,
  avg({c}::DOUBLE) AS mean, stddev_samp({c}::DOUBLE) AS std, quantile_cont({c}::DOUBLE, 0.5) AS median,
  count(*) AS count FROM silver_clickstream GROUP BY 2"""


@registry.add(
    "monthly_statistics",
    out="feature month mean:f std:f median:f count:i",
    views="silver_clickstream",
    sql=_each(_FE, _MONTHLY),
)
def monthly(t):
    return profile.monthly_statistics(silver.silver_clickstream(t.clickstream), _FE)


@registry.add(
    "feature_stability",
    out="feature periods:i mean_coef_of_variation:f median_coef_of_variation:f",
    views="silver_clickstream",
    sql=f"""SELECT feature, count(*) AS periods, stddev_samp(mean) / avg(mean) AS mean_coef_of_variation,
      stddev_samp(median) / avg(median) AS median_coef_of_variation
      FROM ({_each(_FE, _MONTHLY)}) GROUP BY feature""",
)
def stability(t):
    return profile.feature_stability(silver.silver_clickstream(t.clickstream), _FE)


@registry.add(
    "feature_variability",
    out="feature cv:f",
    views="silver_clickstream",
    sql=f"""SELECT feature, CASE WHEN m = 0 THEN 'inf'::DOUBLE ELSE s / abs(m) END AS cv FROM (
      {_each(_FE, "SELECT '{c}' AS feature, avg({c}::DOUBLE) AS m, stddev_samp({c}::DOUBLE) AS s FROM silver_clickstream")}
      ) WHERE s > 0 AND (m = 0 OR s / abs(m) > 0.3)""",
)
def variability(t):
    return profile.feature_variability(silver.silver_clickstream(t.clickstream), _FE, threshold=0.3)


_POTENTIAL_TEXT = ["Credit_Mix_clean", "Type_of_Loan"]


@registry.add(
    "feature_potential",
    out="feature potential_score:f completeness:f variability:f uniqueness:f",
    views="silver_financials",
    sql="SELECT *, 0.4::DOUBLE * completeness + 0.4::DOUBLE * variability + 0.2::DOUBLE * uniqueness AS potential_score FROM ("
    + _each(
        _NUMBERS,
        """SELECT '{c}' AS feature, count({c})::DOUBLE / count(*) AS completeness,
        CASE WHEN stddev_samp({c}::DOUBLE) > 0 AND abs(avg({c}::DOUBLE)) > 0
             THEN least(1.0::DOUBLE, stddev_samp({c}::DOUBLE) / abs(avg({c}::DOUBLE))) ELSE 0 END AS variability,
        least(1.0::DOUBLE, count(DISTINCT {c})::DOUBLE / count(*)) AS uniqueness FROM silver_financials""",
    )
    + " UNION ALL "
    + _each(
        _POTENTIAL_TEXT,
        """SELECT '{c}' AS feature, (SELECT count({c})::DOUBLE / count(*) FROM silver_financials) AS completeness,
        CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) ELSE 0 END AS variability,
        least(1.0::DOUBLE, count(*)::DOUBLE / (SELECT count(*) FROM silver_financials)) AS uniqueness
        FROM (SELECT count(*)::DOUBLE / sum(count(*)) OVER () AS p FROM silver_financials
              WHERE {c} IS NOT NULL GROUP BY {c})""",
    )
    + ")",
)
def potential(t):
    return profile.feature_potential(
        silver.silver_financials(t.financials), _NUMBERS, _POTENTIAL_TEXT
    )


_MI_FEATURES = ["click_fe_1", "click_fe_3", "attr_Age_clean"]
_MI_SQL = """WITH target AS (SELECT Customer_ID, Credit_Utilization_Ratio::DOUBLE AS y FROM silver_financials),
  clicks AS (SELECT Customer_ID, arg_max(fe_1, snapshot_date) AS click_fe_1, arg_max(fe_3, snapshot_date) AS click_fe_3
    FROM silver_clickstream GROUP BY 1),
  people AS (SELECT Customer_ID, arg_max(Age_clean, snapshot_date) AS attr_Age_clean FROM silver_attributes GROUP BY 1),
  complete AS (SELECT y, click_fe_1::DOUBLE AS click_fe_1, click_fe_3::DOUBLE AS click_fe_3, attr_Age_clean::DOUBLE AS attr_Age_clean
    FROM target LEFT JOIN clicks USING (Customer_ID) LEFT JOIN people USING (Customer_ID)
    WHERE y IS NOT NULL AND click_fe_1 IS NOT NULL AND click_fe_3 IS NOT NULL AND attr_Age_clean IS NOT NULL),
  cuts AS (SELECT quantile_cont(y, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS qy, """ + ", ".join(
    f"quantile_cont({c}, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS q_{c}" for c in _MI_FEATURES
) + """ FROM complete), binned AS (""" + _each(
    _MI_FEATURES,
    """SELECT '{c}' AS feature, len(list_filter(q_{c}, lambda q: {c} > q)) AS bx, len(list_filter(qy, lambda q: y > q)) AS by_
      FROM complete, cuts""",
) + """), joint AS (SELECT feature, bx, by_, count(*)::DOUBLE AS n FROM binned GROUP BY 1, 2, 3)
  SELECT feature, sum(n / total * ln(n * total / (nx * ny))) AS mutual_information FROM (
    SELECT *, sum(n) OVER (PARTITION BY feature) AS total, sum(n) OVER (PARTITION BY feature, bx) AS nx,
      sum(n) OVER (PARTITION BY feature, by_) AS ny FROM joint) GROUP BY feature"""  # fmt: skip


@registry.add(
    "binned_mutual_information",
    out="feature mutual_information:f",
    views="silver_financials silver_clickstream silver_attributes",
    sql=_MI_SQL,
)
def mutual_information(t):
    complete = explore.complete_with_target(
        silver.silver_financials(t.financials),
        "Credit_Utilization_Ratio",
        {"click": silver.silver_clickstream(t.clickstream), "attr": silver.silver_attributes(t.attributes)},
        ["fe_1", "fe_3", "Age_clean"],
    )
    return profile.binned_mutual_information(complete, _MI_FEATURES, "Credit_Utilization_Ratio")


@registry.add(
    "top_occupations",
    out="value count:i",
    views="attributes",
    sql="""SELECT Occupation AS value, count(*) AS count FROM attributes
      WHERE Occupation IS NOT NULL AND NOT regexp_full_match(Occupation, '_+')
      GROUP BY 1 ORDER BY count DESC, value LIMIT 3""",
)
def top_occupations(t):
    return profile.top_values(t.attributes, "Occupation", 3, pattern=profile.ONLY_UNDERSCORES)


_BOX = """quantile_cont({v}, 0.0) AS low, quantile_cont({v}, 0.25) AS q25, quantile_cont({v}, 0.5) AS q50,
  quantile_cont({v}, 0.75) AS q75, quantile_cont({v}, 1.0) AS high"""


@registry.add(
    "age_quartiles_by_occupation",
    out="Occupation_clean low:f q25:f q50:f q75:f high:f",
    views="silver_attributes",
    sql=f"""SELECT Occupation_clean, {_BOX.replace("{v}", "Age_clean::DOUBLE")} FROM silver_attributes
      WHERE Age_valid AND Occupation_clean IS NOT NULL GROUP BY 1""",
)
def age_box(t):
    valid = silver.silver_attributes(t.attributes).where("Age_valid")
    return profile.quartiles_by(valid, "Occupation_clean", "Age_clean")


@registry.add(
    "delay_quartiles_by_payment",
    out="Payment_of_Min_Amount low:f q25:f q50:f q75:f high:f",
    views="silver_financials",
    sql=f"""SELECT Payment_of_Min_Amount, {_BOX.replace("{v}", "Num_of_Delayed_Payment_clean::DOUBLE")}
      FROM silver_financials GROUP BY 1""",
)
def delay_box(t):
    rows = silver.silver_financials(t.financials)
    return profile.quartiles_by(rows, "Payment_of_Min_Amount", "Num_of_Delayed_Payment_clean")


_BIN = """CASE WHEN value = hi THEN {bins} - 1 ELSE least(floor((value - lo) * {bins}.0::DOUBLE / (hi - lo)), {bins} - 1) END AS bin"""


def _histogram_sql(columns, table, bins, where="value IS NOT NULL"):
    long = _each(columns, f"SELECT '{{c}}' AS feature, {{c}}::DOUBLE AS value FROM {table}")
    return f"""WITH kept AS (SELECT * FROM ({long}) WHERE {where}),
      ranged AS (SELECT *, min(value) OVER (PARTITION BY feature) AS lo, max(value) OVER (PARTITION BY feature) AS hi FROM kept)
      SELECT feature, bin, count(*) AS count, min(value) AS smallest, max(value) AS largest
      FROM (SELECT *, {_BIN.replace("{bins}", str(bins))} FROM ranged) GROUP BY feature, bin"""


_HISTOGRAM_OUT = "feature bin:i count:i smallest:f largest:f"


@registry.add(
    "histogram_of_clickstream",
    out=_HISTOGRAM_OUT,
    views="silver_clickstream",
    sql=_histogram_sql(_FE, "silver_clickstream", 20),
)
def histogram_clickstream(t):
    return profile.histogram(silver.silver_clickstream(t.clickstream), _FE, 20)


@registry.add(
    "histogram_of_incomes",
    out=_HISTOGRAM_OUT,
    views="silver_financials",
    sql=_histogram_sql(["Annual_Income_clean"], "silver_financials", 30, "value BETWEEN 0 AND 150000"),
)
def histogram_incomes(t):
    rows = silver.silver_financials(t.financials)
    return profile.histogram(rows, ["Annual_Income_clean"], 30, low=0, high=150000)


@registry.add(
    "unit_histogram_of_ages",
    out="unit:i count:i",
    views="silver_attributes",
    sql="SELECT Age_clean AS unit, count(*) AS count FROM silver_attributes WHERE Age_clean BETWEEN 0 AND 100 GROUP BY 1",
)
def unit_ages(t):
    return profile.unit_histogram(silver.silver_attributes(t.attributes), "Age_clean", 0, 100)


@registry.add(
    "trimmed_histogram_of_financials",
    out=_HISTOGRAM_OUT,
    views="silver_financials",
    sql="""WITH long AS (""" + _each(_NUMBERS, "SELECT '{c}' AS feature, {c}::DOUBLE AS value FROM silver_financials")
    + """), kept AS (SELECT feature, value FROM long JOIN (SELECT feature, quantile_cont(value, 0.05) AS tl,
        quantile_cont(value, 0.95) AS th FROM long GROUP BY feature) USING (feature) WHERE value BETWEEN tl AND th),
      ranged AS (SELECT *, min(value) OVER (PARTITION BY feature) AS lo, max(value) OVER (PARTITION BY feature) AS hi FROM kept)
      SELECT feature, bin, count(*) AS count, min(value) AS smallest, max(value) AS largest
      FROM (SELECT *, """ + _BIN.replace("{bins}", "15") + """ FROM ranged) GROUP BY feature, bin""",
)
def trimmed(t):
    return profile.trimmed_histogram(silver.silver_financials(t.financials), _NUMBERS, 15)


def _grid_sql(x, y, bins_x, bins_y, source):
    def place(c, bins):
        return (
            f"CASE WHEN {c} = h{c} THEN {bins} - 1 ELSE "
            f"least(floor(({c} - l{c}) * {bins}.0::DOUBLE / (h{c} - l{c})), {bins} - 1) END"
        )

    return f"""SELECT bin_x, bin_y, count(*) AS count FROM (SELECT {place("x", bins_x)} AS bin_x, {place("y", bins_y)} AS bin_y
      FROM (SELECT x, y, min(x) OVER () AS lx, max(x) OVER () AS hx, min(y) OVER () AS ly, max(y) OVER () AS hy
        FROM (SELECT {x} AS x, {y} AS y FROM {source}))) GROUP BY 1, 2"""


_RAW_NUMBERS = """(SELECT TRY_CAST(replace(Annual_Income, '_', '') AS DOUBLE) AS income,
  TRY_CAST(replace(Num_of_Loan, '_', '') AS DOUBLE) AS loans, Credit_Utilization_Ratio AS utilization FROM financials)"""


@registry.add(
    "grid_of_income_and_loans",
    out="bin_x:i bin_y:i count:i",
    views="financials",
    sql=_grid_sql("income", "loans", 50, 11,
                  _RAW_NUMBERS + " WHERE income > 0 AND income < 150000 AND loans BETWEEN 0 AND 10"),
)
def grid_income(t):
    rows = explore.plausible_incomes(t.financials)
    return profile.grid_counts(rows, "annual_income", "num_loans", 50, 11)


@registry.add(
    "grid_of_utilization_and_loans",
    out="bin_x:i bin_y:i count:i",
    views="financials",
    sql=_grid_sql("utilization", "loans", 20, 11,
                  _RAW_NUMBERS + " WHERE utilization BETWEEN 0 AND 100 AND loans BETWEEN 0 AND 10"),
)
def grid_utilization(t):
    rows = explore.plausible_utilization(t.financials)
    return profile.grid_counts(rows, "utilization", "num_loans", 20, 11)


@registry.add(
    "age_text_quality",
    out="rows:i non_numeric:i with_underscore:i out_of_range:i",
    views="attributes",
    sql=r"""SELECT count(*) AS rows, count(*) FILTER (regexp_matches(coalesce(Age, 'nan'), '[^0-9\.\-]')) AS non_numeric,
      count(*) FILTER (contains(Age, '_')) AS with_underscore,
      count(*) FILTER (TRY_CAST(replace(Age, '_', '') AS DOUBLE) < 0 OR TRY_CAST(replace(Age, '_', '') AS DOUBLE) > 120) AS out_of_range
      FROM attributes""",
)
def age_quality(t):
    return profile.age_text_quality(t.attributes)


@registry.add(
    "ssn_text_quality",
    out="rows:i not_matching:i special_characters:i",
    views="attributes",
    sql=r"""SELECT count(*) AS rows,
      count(*) FILTER (NOT regexp_full_match(coalesce(SSN, 'nan'), '(\d{3}-\d{2}-\d{4}|\d{9})')) AS not_matching,
      count(*) FILTER (regexp_matches(coalesce(SSN, 'nan'), '[^0-9\-]')) AS special_characters FROM attributes""",
)
def ssn_quality(t):
    return profile.ssn_text_quality(t.attributes)


@registry.add(
    "underscore_counts",
    out='"column" with_underscore:i percentage:f',
    views="financials",
    sql=_each(
        silver.FINANCIAL_TEXT,
        """SELECT '{c}' AS "column", count(*) FILTER (contains({c}, '_')) AS with_underscore,
        count(*) FILTER (contains({c}, '_')) * 100.0::DOUBLE / count(*) AS percentage FROM financials""",
    ),
)
def underscores(t):
    return profile.underscore_counts(t.financials, silver.FINANCIAL_TEXT)


_PLACEHOLDERS = ["Credit_Mix", "Payment_of_Min_Amount", "Type_of_Loan"]


@registry.add(
    "placeholder_counts",
    out='"column" different:i blank:i placeholder:i placeholder_pct:f',
    views="financials",
    sql=_each(
        _PLACEHOLDERS,
        """SELECT '{c}' AS "column", count(DISTINCT coalesce({c}, 'nan')) AS different, count(*) FILTER ({c} = '') AS blank,
        count(*) FILTER (regexp_full_match({c}, '_+')) AS placeholder,
        count(*) FILTER (regexp_full_match({c}, '_+')) * 100.0::DOUBLE / count(*) AS placeholder_pct FROM financials""",
    ),
)
def placeholders(t):
    return profile.placeholder_counts(t.financials, _PLACEHOLDERS)


@registry.add(
    "attribute_quality_split",
    out="""total:i age_valid:i age_underscore:i age_invalid:i ssn_valid:i ssn_corrupted:i occupation_valid:i
      occupation_placeholder:i""",
    views="attributes",
    sql=r"""SELECT total, total - u - (bad - u) AS age_valid, u AS age_underscore, bad - u AS age_invalid,
      total - c AS ssn_valid, c AS ssn_corrupted, total - p AS occupation_valid, p AS occupation_placeholder
      FROM (SELECT count(*) AS total, count(*) FILTER (contains(Age, '_')) AS u,
        count(*) FILTER (a IS NULL OR a < 18 OR a > 90) AS bad,
        count(*) FILTER (regexp_matches(coalesce(SSN, 'nan'), '[^0-9\-]')) AS c,
        count(*) FILTER (regexp_full_match(Occupation, '_+')) AS p
        FROM (SELECT *, TRY_CAST(replace(Age, '_', '') AS DOUBLE) AS a FROM attributes))""",
)
def quality_split(t):
    return profile.attribute_quality_split(t.attributes)


_POINTS = "(SELECT CAST(unnest(['1996-09-01', '1998-05-01', '2000-01-01']) AS DATE) AS analysis_date)"


@registry.add(
    "availability_over_time",
    out="""analysis_date clickstream_customers:i attributes_customers:i financials_customers:i all_sources:i
      clickstream_records:i attributes_records:i financials_records:i""",
    views="clickstream attributes financials",
    sql=f"""WITH seen AS (SELECT analysis_date, Customer_ID, count(*) FILTER (s = 'c') AS c, count(*) FILTER (s = 'a') AS a,
        count(*) FILTER (s = 'f') AS f FROM {_POINTS} p JOIN (
          SELECT 'c' AS s, Customer_ID, snapshot_date FROM clickstream UNION ALL
          SELECT 'a', Customer_ID, snapshot_date FROM attributes UNION ALL
          SELECT 'f', Customer_ID, snapshot_date FROM financials) r ON snapshot_date <= analysis_date GROUP BY 1, 2)
      SELECT analysis_date, count(*) FILTER (c > 0) AS clickstream_customers, count(*) FILTER (a > 0) AS attributes_customers,
        count(*) FILTER (f > 0) AS financials_customers, count(*) FILTER (c > 0 AND a > 0 AND f > 0) AS all_sources,
        sum(c) AS clickstream_records, sum(a) AS attributes_records, sum(f) AS financials_records FROM seen GROUP BY 1""",
)
def availability(t):
    return profile.availability_over_time(
        _sources(t, ("clickstream", "attributes", "financials")), _dates(t)
    )


@registry.add(
    "attribute_quality_at_a_date",
    out="records:i valid_age_pct:f valid_ssn_pct:f",
    views="silver_attributes",
    sql="""SELECT count(*) AS records, avg(CASE WHEN Age_valid THEN 1.0::DOUBLE ELSE 0 END) * 100 AS valid_age_pct,
      avg(CASE WHEN SSN_valid THEN 1.0::DOUBLE ELSE 0 END) * 100 AS valid_ssn_pct
      FROM silver_attributes WHERE snapshot_date <= DATE '1998-05-01'""",
)
def quality_at(t):
    return profile.attribute_quality_at(silver.explored_attributes(t.attributes), "1998-05-01")


@registry.add(
    "financial_summary_at_a_date",
    out=_SUMMARY_OUT,
    views="silver_financials",
    sql=_each(_NUMBERS[:5], _SUMMARY + "silver_financials WHERE snapshot_date <= DATE '1998-05-01'"),
)
def financial_summary_at(t):
    known = explore.up_to(silver.silver_financials(t.financials), "1998-05-01")
    return profile.numeric_summary(known, _NUMBERS[:5])
