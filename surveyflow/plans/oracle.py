"""Plain SQL over the given tables for every query that SQL can express.

The common part of the statements repeats the stages as common table expressions; the rest is written per query and
shares no logic with the DataFrame operators.
"""

from __future__ import annotations

import math

from surveyflow.sources.orders_survey import survey_select
from surveyflow.spec import default_spec

SPEC = default_spec()


def _list(columns, template: str = "{c}") -> str:
    return ", ".join(template.format(c=c, u=SPEC.missing_category) for c in columns)


_CLEAN_ITEM = "CASE WHEN {c} > 3 THEN NULL ELSE {c} END AS {c}"
_SCORE = " + ".join(SPEC.items)
_REST = [c for c in SPEC.columns if c not in SPEC.items and c != "MinutesSedentaryActivity"]
_SEDENTARY = (
    "CASE WHEN MinutesSedentaryActivity > 1440 THEN NULL ELSE MinutesSedentaryActivity END AS MinutesSedentaryActivity"
)


def _class(value: str) -> str:
    return (
        f"CASE WHEN {value} IS NULL THEN NULL WHEN {value} <= 4 THEN 'Minimala' WHEN {value} <= 9 THEN 'Usoara' "
        f"WHEN {value} <= 14 THEN 'Moderata' WHEN {value} <= 19 THEN 'Moderat_Severa' ELSE 'Severa' END"
    )


def _case(value: str, pairs, otherwise: str = "NULL") -> str:
    return f"CASE {value} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs) + f" ELSE {otherwise} END"


_AGE = (
    "CASE WHEN AgeInYearsAtScreening > 17 AND AgeInYearsAtScreening <= 29 THEN '18–29 ani' "
    "WHEN AgeInYearsAtScreening > 29 AND AgeInYearsAtScreening <= 44 THEN '30–44 ani' "
    "WHEN AgeInYearsAtScreening > 44 AND AgeInYearsAtScreening <= 59 THEN '45–59 ani' "
    "WHEN AgeInYearsAtScreening > 59 AND AgeInYearsAtScreening <= 100 THEN '60+ ani' END"
)

_STAGES = f"""WITH survey AS (
{survey_select()}
), cleaned AS (
  SELECT respondent_id, {_list(SPEC.items, _CLEAN_ITEM)}, {_list(_REST)}, {_SEDENTARY} FROM survey
), scored AS (
  SELECT *, {_SCORE} AS Depression_Score FROM cleaned
), gold AS (
  SELECT *, {_class('Depression_Score')} AS Depression_Severity,
    {_AGE} AS age_group
  FROM scored WHERE AgeInYearsAtScreening >= 18 AND Depression_Score IS NOT NULL
)"""


def _sql(body: str, *ctes: str) -> str:
    return ",\n".join([_STAGES, *ctes]) + "\n" + body


_SHOWN = tuple(SPEC.severity_display.items())
_LABEL = _case("Depression_Severity", _SHOWN)
_ORD = "CAST(list_position(['Minimala','Usoara','Moderata','Moderat_Severa','Severa'], Depression_Severity) - 1 AS INTEGER)"
_ALL = "respondent_id, " + ", ".join(SPEC.columns)


def _means(means) -> str:
    parts = []
    for column, alias, digits in means:
        parts.append(f"avg({column}) AS {alias}" if digits is None else f"round(avg({column}), {digits}) AS {alias}")
    return ", ".join(parts)


def _union(columns, template: str) -> str:
    return " UNION ALL ".join(template.format(c=c, u=SPEC.missing_category) for c in columns)


def _box(group: str, measure: str) -> tuple[str, ...]:
    return (
        f"""quartiles AS (
  SELECT {group} AS g, quantile_cont({measure}, 0.25) AS q1, quantile_cont({measure}, 0.5) AS med,
    quantile_cont({measure}, 0.75) AS q3
  FROM gold WHERE {group} IS NOT NULL AND {measure} IS NOT NULL GROUP BY 1
)""",
        f"""boxes AS (
  SELECT g AS {group}, count(*) AS n, q1, med AS median, q3,
    least(q1, min(CASE WHEN {measure} >= q1 - 1.5 * (q3 - q1) THEN {measure} END)) AS whisker_low,
    greatest(q3, max(CASE WHEN {measure} <= q3 + 1.5 * (q3 - q1) THEN {measure} END)) AS whisker_high,
    count(CASE WHEN {measure} < q1 - 1.5 * (q3 - q1) OR {measure} > q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
  FROM gold JOIN quartiles ON {group} = g WHERE {measure} IS NOT NULL GROUP BY g, q1, med, q3
)""",
    )


_BOX_COLUMNS = "n, q1, median, q3, whisker_low, whisker_high, outliers"

_SPLIT = (
    "sizes AS (SELECT Depression_Severity AS sev, count(*) AS n FROM gold GROUP BY 1)",
    "shares AS (SELECT sev, n, total, total - (total + 4) // 5 AS n_train FROM "
    "(SELECT sev, n, CAST(sum(n) OVER () AS BIGINT) AS total FROM sizes))",
    "parts AS (SELECT sev, n, n_train, n * n_train // total AS whole, n * n_train % total AS rest FROM shares)",
    "quotas AS (SELECT sev, n - whole - CASE WHEN row_number() OVER (ORDER BY rest DESC, sev) <= "
    "n_train - sum(whole) OVER () THEN 1 ELSE 0 END AS n_test FROM parts)",
    "ranked AS (SELECT respondent_id, Depression_Severity, row_number() OVER (PARTITION BY Depression_Severity "
    "ORDER BY md5(concat('42:', CAST(respondent_id AS VARCHAR))), respondent_id) AS place FROM gold)",
    "split AS (SELECT respondent_id, Depression_Severity, place <= n_test AS is_test "
    "FROM ranked JOIN quotas ON Depression_Severity = sev)",
)

_DICTIONARY = (
    "answers AS ("
    + _union(SPEC.categorical, "SELECT DISTINCT '{c}' AS \"column\", coalesce({c}, '{u}') AS \"value\" FROM gold")
    + ")",
    'dictionary AS (SELECT "column", "value", CAST(row_number() OVER (PARTITION BY "column" ORDER BY "value") - 1 '
    "AS INTEGER) AS idx FROM answers)",
)
_FILLED = "coalesce({c}, '{u}') AS {c}"
_INDEX = "CAST(dense_rank() OVER (ORDER BY coalesce({c}, '{u}')) - 1 AS DOUBLE) AS {c}_Idx"
_CLASS_INDEX = (
    "CAST(list_position(['Minimala','Moderat_Severa','Moderata','Severa','Usoara'], Depression_Severity) - 1 AS DOUBLE)"
)
_MEDIANS = (f"medians AS (SELECT {_list(SPEC.numeric, 'median({c}) AS m_{c}')} FROM gold)",)

_GUESS = (
    f"guesses AS (SELECT Depression_Severity AS label, {_class('4 * (' + ' + '.join(SPEC.items[:2]) + ')')} AS prediction "
    "FROM gold)",
    "cells AS (SELECT label, prediction, count(*) AS n FROM guesses GROUP BY 1, 2)",
)
_STUMP = (
    f"features AS (SELECT respondent_id, '{SPEC.items[0]}' AS f, {SPEC.items[0]} AS v FROM gold UNION ALL "
    f"SELECT respondent_id, '{SPEC.age}', {SPEC.age} FROM gold)",
    "learned AS (SELECT f, v, Depression_Severity AS sev FROM features JOIN split USING (respondent_id) WHERE NOT is_test)",
    "cuts AS (SELECT f, (v + lead(v) OVER (PARTITION BY f ORDER BY v)) / 2 AS cut FROM (SELECT DISTINCT f, v FROM learned))",
    "sides AS (SELECT f, cut, v <= cut AS below, sev, count(*) AS n FROM cuts JOIN learned USING (f) "
    "WHERE cut IS NOT NULL GROUP BY ALL)",
    "nodes AS (SELECT f, cut, below, sum(n) AS m, 1 - sum(n * n) / (sum(n) * sum(n)) AS gini, "
    "(list(sev ORDER BY n DESC, sev))[1] AS majority FROM sides GROUP BY ALL)",
    "best AS (SELECT f, cut FROM nodes GROUP BY f, cut ORDER BY sum(m * gini) / sum(m) LIMIT 1)",
    "stump AS (SELECT s.respondent_id, s.Depression_Severity, n.majority AS predicted_class FROM split s "
    "JOIN features x USING (respondent_id) JOIN best b ON x.f = b.f "
    "JOIN nodes n ON n.f = b.f AND n.cut = b.cut AND n.below = (x.v <= b.cut) WHERE s.is_test)",
)


def _hash(text: str) -> str:
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % 2147483647)"


def _bins(values: str, most: int) -> tuple[str, ...]:
    """Bins and cut points of (f, v)."""
    return (
        f"""histogram AS (
  SELECT f, v, n, sum(n) OVER (PARTITION BY f ORDER BY v) - n AS ahead, sum(n) OVER (PARTITION BY f) AS total,
    row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS place, count(*) OVER (PARTITION BY f) AS kinds
  FROM (SELECT f, v, count(*) AS n FROM {values} GROUP BY f, v)
)""",
        f"""bin_shares AS (
  SELECT f, CASE WHEN kinds <= {most} THEN place ELSE ahead * {most} // total END AS share, min(v) AS low, max(v) AS high,
    sum(n) AS n FROM histogram GROUP BY 1, 2
)""",
        """bins AS (
  SELECT f, CAST(row_number() OVER (PARTITION BY f ORDER BY share) - 1 AS INTEGER) AS bin, low, high, CAST(n AS BIGINT) AS n,
    CASE WHEN high + (nxt - high) / 2 < nxt THEN high + (nxt - high) / 2 WHEN nxt IS NOT NULL THEN high END AS cut
  FROM (SELECT *, lead(low) OVER (PARTITION BY f ORDER BY share) AS nxt FROM bin_shares)
)""",
    )


#: The shallow forest: three trees of two levels over four measures, two at a node, at most 16 bins.
SHALLOW = (SPEC.items[0], SPEC.age, "WeightKg", "SleepHoursWeekdaysOrWorkdays")
_POISSON = [math.floor(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) * 2147483647) for k in range(12)]


def _grown(at: str, level: int) -> tuple[str, ...]:
    """The best cut of every node of a level, and the rows one level down; nodes without a cut keep their rows."""
    return (
        f"""chosen{level} AS (
  SELECT tree, node, f FROM (SELECT tree, node, f, row_number() OVER (PARTITION BY tree, node
    ORDER BY md5(concat('42:', tree, ':', node, ':', f))) AS place
    FROM (SELECT DISTINCT tree, node FROM {at} WHERE node >= {2 ** level}) CROSS JOIN (SELECT DISTINCT f FROM bins)) WHERE place <= 2
)""",
        f"totals{level} AS (SELECT tree, node, sev, sum(w) AS n FROM {at} WHERE w > 0 GROUP BY ALL)",
        f"""sides{level} AS (
  SELECT c.tree, c.node, c.f, k.bin AS cut, a.sev, sum(CASE WHEN b.b <= k.bin THEN a.w ELSE 0 END) AS l,
    sum(CASE WHEN b.b > k.bin THEN a.w ELSE 0 END) AS r
  FROM chosen{level} c JOIN bins k ON k.f = c.f AND k.cut IS NOT NULL
    JOIN {at} a ON a.tree = c.tree AND a.node = c.node AND a.w > 0
    JOIN binned b ON b.respondent_id = a.respondent_id AND b.f = c.f GROUP BY ALL
)""",
        f"""scored{level} AS (
  SELECT tree, node, f, cut, CAST(sum(l * l) AS DOUBLE) / CAST(sum(l) AS DOUBLE) + CAST(sum(r * r) AS DOUBLE) / CAST(sum(r) AS DOUBLE) AS score
  FROM sides{level} GROUP BY tree, node, f, cut HAVING sum(l) > 0 AND sum(r) > 0
)""",
        f"""cuts{level} AS (
  SELECT s.* FROM scored{level} s JOIN (SELECT tree, node, CAST(sum(n * n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS own, count(*) AS kinds
    FROM totals{level} GROUP BY tree, node) t USING (tree, node) WHERE score > own AND kinds > 1
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY score DESC, f, cut) = 1
)""",
        f"""at{level + 1} AS (
  SELECT a.respondent_id, a.sev, a.is_test, a.tree, a.w,
    CASE WHEN c.f IS NULL THEN a.node ELSE 2 * a.node + CAST(b.b > c.cut AS INTEGER) END AS node
  FROM {at} a LEFT JOIN cuts{level} c USING (tree, node) LEFT JOIN binned b ON b.respondent_id = a.respondent_id AND b.f = c.f
)""",
    )


_SHALLOW = (
    *_MEDIANS,
    "wide AS (SELECT respondent_id, Depression_Severity AS sev, "
    + ", ".join(f"coalesce({c}, m_{c}) AS v{i}" if c in SPEC.numeric else f"{c} AS v{i}" for i, c in enumerate(SHALLOW))
    + " FROM gold, medians)",
    "long AS (" + " UNION ALL ".join(f"SELECT respondent_id, sev, {i} AS f, v{i} AS v FROM wide" for i in range(len(SHALLOW))) + ")",
    "learned AS (SELECT f, v FROM long JOIN split USING (respondent_id) WHERE NOT is_test)",
    *_bins("learned", 16),
    "binned AS (SELECT respondent_id, l.f, count(k.cut) AS b FROM long l LEFT JOIN bins k ON k.f = l.f AND k.cut < l.v GROUP BY 1, 2)",
    f"""bags AS (
  SELECT respondent_id, Depression_Severity AS sev, is_test, tree, CASE WHEN is_test THEN 0 ELSE
    {' + '.join(f'CAST(u >= {t} AS BIGINT)' for t in _POISSON)} END AS w, 1 AS node
  FROM (SELECT *, ({_hash("concat('bag:42:', respondent_id)")} * {_hash("concat('42:', tree, ':a')")}
    + {_hash("concat('42:', tree, ':b')")}) % 2147483647 AS u FROM split, (SELECT unnest([0, 1, 2]) AS tree))
)""",
    *_grown("bags", 0),
    *_grown("at1", 1),
    "leaves AS (SELECT tree, node, sev, CAST(sum(w) AS DOUBLE) AS n FROM at2 WHERE w > 0 GROUP BY ALL)",
    "odds AS (SELECT tree, node, sev, n / sum(n) OVER (PARTITION BY tree, node) AS p FROM leaves)",
    "votes AS (SELECT respondent_id, a.sev AS sev, o.sev AS guess, "
    + " + ".join(f"coalesce(sum(CASE WHEN tree = {t} THEN p END), 0)" for t in range(3))
    + " AS vote FROM at2 a JOIN odds o USING (tree, node) WHERE is_test GROUP BY 1, 2, 3)",
)
_REPORT = (
    *_GUESS,
    "classes AS (SELECT label AS class FROM cells UNION SELECT prediction FROM cells)",
    "sums AS (SELECT class, CAST(coalesce(sum(n) FILTER (label = class), 0) AS BIGINT) AS support, "
    "CAST(coalesce(sum(n) FILTER (prediction = class), 0) AS BIGINT) AS predicted, "
    "CAST(coalesce(sum(n) FILTER (label = class AND prediction = class), 0) AS BIGINT) AS hits "
    "FROM classes, cells GROUP BY class)",
    "ratios AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / predicted END AS precision_, "
    "CASE WHEN support = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / support END AS recall_ FROM sums)",
    "report AS (SELECT class, support, hits, CAST(precision_ AS DOUBLE) AS p, CAST(recall_ AS DOUBLE) AS r, "
    "CASE WHEN precision_ + recall_ = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(2 * precision_ * recall_ "
    "/ (precision_ + recall_) AS DOUBLE) END AS f FROM ratios)",
)


def _cell(c: str) -> str:
    return f"CAST(coalesce(sum(n) FILTER (prediction = '{c}'), 0) AS BIGINT)"


_AXIS = "axis AS (SELECT unnest(['Minimala','Moderat_Severa','Moderata','Severa','Usoara']) AS label)"
_CLASSES = ("Minimala", "Moderat_Severa", "Moderata", "Severa", "Usoara")


def _stage_rows(*stages: tuple[str, str, int]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS stage, count(*) AS \"rows\", CAST({width} AS INTEGER) AS \"columns\" FROM {source}"
        for name, source, width in stages
    )


def oracle_statements() -> dict[str, str]:
    """SQL by query name."""
    gold_all = f"{_ALL}, Depression_Score, Depression_Severity"
    adults = "survey WHERE AgeInYearsAtScreening >= 18"
    age_cells = ", ".join(
        f"CAST(count(*) FILTER (Depression_Severity = '{code}') AS DOUBLE) / count(*) * 100 AS \"{shown}\""
        for code, shown in _SHOWN
    )
    return {
        "normalize_missing": _sql(f"SELECT {_ALL} FROM survey"),
        "load_survey": _sql(f"SELECT {_ALL} FROM survey"),
        "respondent_key": _sql(
            'SELECT count(*) AS "rows", count(DISTINCT respondent_id) AS distinct_keys, '
            "count(*) - count(respondent_id) AS null_keys FROM survey"
        ),
        "scan_stage_table": _sql("SELECT respondent_id, AgeInYearsAtScreening, Depression_Score FROM gold"),
        "write_bronze_roundtrip": _sql(f"SELECT {_ALL} FROM survey"),
        "write_gold_roundtrip": _sql(f"SELECT {gold_all} FROM gold"),
        "stage_tables": _sql(
            _stage_rows(("bronze", "survey", 42), ("eligible", adults, 38), ("silver", "gold", 39), ("gold", "gold", 40))
        ),
        "stored_severity_stats": _sql(
            f"SELECT Depression_Severity, count(*) AS Total_Pacienti, {_means(SPEC.biomarkers)}, "
            f"{_means(SPEC.behaviour)}, {_ORD} AS severity_ord FROM gold GROUP BY Depression_Severity"
        ),
        "stage_profile": _sql(_stage_rows(("bronze", "survey", 42), ("adults", adults, 38), ("silver", "gold", 39))),
        "select_relevant": _sql(f"SELECT {_ALL} FROM survey"),
        "filter_adults": _sql(f"SELECT {_ALL} FROM {adults}"),
        "clean_items": _sql(f"SELECT respondent_id, {_list(SPEC.items)} FROM cleaned"),
        "clean_sedentary": _sql("SELECT respondent_id, MinutesSedentaryActivity FROM cleaned"),
        "row_score": _sql("SELECT respondent_id, Depression_Score FROM scored"),
        "scored_only": _sql("SELECT respondent_id, Depression_Score FROM scored WHERE Depression_Score IS NOT NULL"),
        "severity_class": _sql(
            f"SELECT respondent_id, Depression_Score, {_class('Depression_Score')} AS Depression_Severity FROM scored"
        ),
        "severity_display": _sql(f"SELECT respondent_id, Depression_Severity, {_LABEL} AS Severitate FROM gold"),
        "severity_ordinal": _sql(f"SELECT respondent_id, Depression_Severity, {_ORD} AS severity_ord FROM gold"),
        "age_group": _sql(f"SELECT respondent_id, AgeInYearsAtScreening, {_AGE} AS age_group FROM survey"),
        "feature_labels": _sql(
            f"SELECT feature, answers, {_case('feature', SPEC.feature_display.items(), 'feature')} AS feature_label FROM ("
            + _union([*SPEC.numeric, *SPEC.categorical], "SELECT '{c}' AS feature, count({c}) AS answers FROM gold")
            + ")"
        ),
        "feature_projection": _sql(
            f"SELECT {_list([c for c in SPEC.columns if c in SPEC.numeric or c in SPEC.categorical])} FROM gold"
        ),
        "null_columns": _sql(
            _union(
                [*SPEC.numeric, *SPEC.categorical, SPEC.score],
                "SELECT '{c}' AS \"column\", count({c}) < count(*) AS has_null FROM gold",
            )
        ),
        "fill_unknown": _sql(
            f"SELECT respondent_id, {_list(SPEC.categorical, _FILLED)} FROM gold"
        ),
        "validate_sedentary": _sql(
            "SELECT min(MinutesSedentaryActivity) AS min_value, max(MinutesSedentaryActivity) AS max_value, "
            "count(*) - count(MinutesSedentaryActivity) AS nulls FROM cleaned WHERE AgeInYearsAtScreening >= 18"
        ),
        "expect_rules": _sql(
            "SELECT 'adult' AS rule, count(*) - count(CASE WHEN AgeInYearsAtScreening >= 18 THEN 1 END) AS violations "
            "FROM survey UNION ALL SELECT 'sedentary_in_day', count(*) - count(CASE WHEN MinutesSedentaryActivity "
            f"<= 1440 THEN 1 END) FROM survey UNION ALL SELECT 'first_item_valid', count(*) - count(CASE WHEN "
            f"{SPEC.items[0]} BETWEEN 0 AND 3 THEN 1 END) FROM survey"
        ),
        "severity_distribution": _sql(
            "SELECT Depression_Severity, count(*) AS Total_Pacienti FROM gold GROUP BY 1 ORDER BY 2 DESC"
        ),
        "biomarkers_by_severity": _sql(
            f"SELECT Depression_Severity, {_means(SPEC.biomarkers)} FROM gold GROUP BY 1 ORDER BY 2 DESC"
        ),
        "behaviour_by_severity": _sql(
            f"SELECT Depression_Severity, {_means(SPEC.behaviour)} FROM gold GROUP BY 1 ORDER BY 3 DESC"
        ),
        "label_distribution": _sql(f"SELECT {_CLASS_INDEX} AS label, count(*) AS n FROM gold GROUP BY 1 ORDER BY 1"),
        "column_medians": _sql(
            _union(SPEC.numeric, "SELECT '{c}' AS measure, median({c}) AS median FROM gold WHERE {c} IS NOT NULL")
        ),
        "box_outliers": _sql(
            "SELECT respondent_id, age_group, Depression_Score FROM gold JOIN quartiles ON age_group = g "
            "WHERE Depression_Score < q1 - 1.5 * (q3 - q1) OR Depression_Score > q3 + 1.5 * (q3 - q1)",
            _box("age_group", "Depression_Score")[0],
        ),
        "top_items_by_mean": _sql(
            "SELECT item, mean_value FROM ("
            + _union(SPEC.items, "SELECT '{c}' AS item, avg({c}) AS mean_value FROM gold")
            + ") ORDER BY mean_value DESC, item LIMIT 10"
        ),
        "category_dictionary": _sql('SELECT "column", "value", idx FROM dictionary', *_DICTIONARY),
        "box_outliers_nan": _sql(
            "SELECT respondent_id, age_group, MinutesSedentaryActivity FROM grouped JOIN quartiles ON age_group = g "
            "WHERE MinutesSedentaryActivity < q1 - 1.5 * (q3 - q1) OR MinutesSedentaryActivity > q3 + 1.5 * (q3 - q1)",
            f"grouped AS (SELECT respondent_id, MinutesSedentaryActivity, {_AGE} AS age_group FROM survey)",
            _box("age_group", "MinutesSedentaryActivity")[0].replace("FROM gold", "FROM grouped"),
        ),
        "key_violations": (
            "WITH held AS (SELECT CASE WHEN o_custkey % 11 <> 0 THEN o_custkey END AS k, count(*) AS n FROM orders GROUP BY 1) "
            "SELECT CASE WHEN k IS NULL THEN 'null' ELSE 'repeated' END AS violation, count(*) AS keys, "
            'CAST(sum(n) AS BIGINT) AS "rows" FROM held WHERE k IS NULL OR n > 1 GROUP BY 1'
        ),
        "encode_categoricals": _sql(f"SELECT respondent_id, {_list(SPEC.categorical, _INDEX)} FROM gold"),
        "encode_label": _sql(f"SELECT respondent_id, Depression_Severity, {_CLASS_INDEX} AS label FROM gold"),
        "decode_label": _sql(
            f"SELECT respondent_id, {_CLASS_INDEX} AS label, Depression_Severity AS class_name FROM gold"
        ),
        "impute_median": _sql(
            f"SELECT respondent_id, {_list(SPEC.numeric, 'coalesce({c}, m_{c}) AS {c}')} FROM gold, medians", *_MEDIANS
        ),
        "impute_median_int": _sql(
            f"SELECT respondent_id, coalesce(x, m) AS {SPEC.numeric[0]} FROM halves, (SELECT median(x) AS m FROM halves)",
            "halves AS (SELECT respondent_id, CAST(CASE WHEN respondent_id % 5 <> 0 THEN respondent_id % 2 * 3 END AS DOUBLE) "
            "AS x FROM gold)",
        ),
        "assemble_features": _sql(
            f"SELECT respondent_id, {_CLASS_INDEX} AS label, "
            + ", ".join(
                [f"coalesce({c}, m_{c}) AS f_{i:02d}" for i, c in enumerate(SPEC.numeric)]
                + [
                    _INDEX.replace("{c}_Idx", f"f_{i:02d}").format(c=c, u=SPEC.missing_category)
                    for i, c in enumerate(SPEC.categorical, start=len(SPEC.numeric))
                ]
            )
            + " FROM gold, medians",
            *_MEDIANS,
        ),
        "stratified_split": _sql("SELECT respondent_id, Depression_Severity, is_test FROM split", *_SPLIT),
        "split_counts": _sql(
            "SELECT Depression_Severity, count(*) FILTER (NOT is_test) AS train_rows, "
            "count(*) FILTER (is_test) AS test_rows FROM split GROUP BY 1",
            *_SPLIT,
        ),
        "model_roundtrip": _sql(
            "SELECT count(*) AS rows_scored, count(*) AS rows_equal FROM split WHERE is_test", *_SPLIT
        ),
        "rf_scored_rows": _sql("SELECT respondent_id, Depression_Severity, true AS has_class FROM split WHERE is_test", *_SPLIT),
        "rf_confusion_margins": _sql(
            "SELECT axis.label AS label, count(s.respondent_id) AS test_rows FROM axis LEFT JOIN "
            "(SELECT * FROM split WHERE is_test) s ON axis.label = s.Depression_Severity GROUP BY 1",
            *_SPLIT,
            _AXIS,
        ),
        "rf_importance_profile": (
            f"SELECT CAST({len(SPEC.features)} AS BIGINT) AS features, CAST(0 AS BIGINT) AS negative, "
            "CAST(1 AS DOUBLE) AS total, CAST(10 AS INTEGER) AS listed"
        ),
        "rf_metric_identity": "SELECT true AS recall_is_accuracy",
        "feature_bins": _sql(
            "SELECT f AS feature, bin, low, high, n, cut FROM bins",
            *_SPLIT,
            *_MEDIANS,
            "wide AS (SELECT respondent_id, "
            + _list(SPEC.numeric, "coalesce({c}, m_{c}) AS {c}") + ", " + _list(SPEC.categorical, _INDEX) + " FROM gold, medians)",
            "learned AS ("
            + _union(SPEC.features, "SELECT '{c}' AS f, {c} AS v FROM wide JOIN split USING (respondent_id) WHERE NOT is_test")
            + ")",
            *_bins("learned", SPEC.max_bins),
        ),
        "shallow_predictions": _sql(
            "SELECT respondent_id, sev AS Depression_Severity, guess AS predicted_class FROM votes "
            "QUALIFY row_number() OVER (PARTITION BY respondent_id ORDER BY vote DESC, guess) = 1",
            *_SPLIT,
            *_SHALLOW,
        ),
        "shallow_cuts": _sql(
            "SELECT CAST(c.tree AS INTEGER) AS tree, CAST(c.node AS INTEGER) AS node, CAST(c.f AS INTEGER) AS feature, k.cut AS cut FROM "
            "(SELECT * FROM cuts0 UNION ALL SELECT * FROM cuts1) c JOIN bins k ON k.f = c.f AND k.bin = c.cut",
            *_SPLIT,
            *_SHALLOW,
        ),
        "stump_predictions": _sql(
            "SELECT respondent_id, Depression_Severity, predicted_class FROM stump", *_SPLIT, *_STUMP
        ),
        "stump_importances": _sql(
            f"SELECT f AS feature, CAST(f = (SELECT f FROM best) AS DOUBLE) AS importance FROM (SELECT DISTINCT f FROM features)",
            *_SPLIT,
            *_STUMP,
        ),
        "stump_confusion": _sql(
            "SELECT axis.label AS label, "
            + ", ".join(f"count(CASE WHEN predicted_class = '{c}' THEN 1 END) AS {c}" for c in _CLASSES)
            + " FROM axis LEFT JOIN stump ON axis.label = Depression_Severity GROUP BY axis.label",
            *_SPLIT,
            *_STUMP,
            _AXIS,
        ),
        "confusion_other": _sql(
            "SELECT axis.label AS label, "
            + ", ".join(f"count(CASE WHEN prediction = '{c}' THEN 1 END) AS {c}" for c in [*_CLASSES, "other"])
            + " FROM (SELECT label FROM axis UNION ALL SELECT 'other') axis LEFT JOIN others ON axis.label = others.label "
            "GROUP BY axis.label",
            f"others AS (SELECT Depression_Severity AS label, CASE WHEN {SPEC.items[2]} > 1 THEN 'other' ELSE "
            f"{_class('4 * (' + ' + '.join(SPEC.items[:2]) + ')')} END AS prediction FROM gold)",
            _AXIS,
        ),
        "crosstab_other": _sql(
            "SELECT age_group, "
            + ", ".join(
                f"CAST(count(CASE WHEN Depression_Severity = '{c}' THEN 1 END) AS DOUBLE) / count(*) * 100 AS {c}"
                for c in SPEC.severity_order[:-1]
            )
            + " FROM gold WHERE age_group IS NOT NULL GROUP BY 1"
        ),
        "crosstab_open": _sql(
            "SELECT r.age_group, c.seen, coalesce(n, 0) AS n, CAST(coalesce(n, 0) AS DOUBLE) / total * 100 AS percent "
            "FROM (SELECT age_group, CAST(sum(n) AS BIGINT) AS total FROM tab GROUP BY 1) r CROSS JOIN (SELECT DISTINCT seen FROM tab) c "
            "LEFT JOIN tab ON tab.age_group = r.age_group AND tab.seen = c.seen",
            f"tab AS (SELECT age_group, CASE WHEN {SPEC.items[1]} = 0 THEN 'Altele' ELSE Depression_Severity END AS seen, "
            "count(*) AS n FROM gold WHERE age_group IS NOT NULL GROUP BY 1, 2)",
        ),
        "confusion_open": _sql(
            "SELECT a.c AS label, b.c AS prediction, coalesce(n, 0) AS n FROM kinds a CROSS JOIN kinds b "
            "LEFT JOIN tab ON tab.label = a.c AND tab.prediction = b.c",
            f"tab AS (SELECT Depression_Severity AS label, CASE WHEN {SPEC.items[2]} > 1 THEN 'Altele' ELSE "
            f"{_class('4 * (' + ' + '.join(SPEC.items[:2]) + ')')} END AS prediction, count(*) AS n FROM gold GROUP BY 1, 2)",
            "kinds AS (SELECT label AS c FROM tab UNION SELECT prediction FROM tab)",
        ),
        "confusion_cells": _sql("SELECT label, prediction, n FROM cells", *_GUESS),
        "confusion_matrix": _sql(
            "SELECT axis.label AS label, "
            + ", ".join(f"{_cell(c)} AS {c}" for c in _CLASSES)
            + " FROM axis LEFT JOIN cells ON axis.label = cells.label GROUP BY axis.label",
            *_GUESS,
            _AXIS,
        ),
        "chart_confusion_rule": _sql(
            f"SELECT {_case('axis.label', _SHOWN)} AS Severitate, "
            + ", ".join(f'{_cell(c)} AS "{SPEC.severity_display[c]}"' for c in _CLASSES)
            + " FROM axis LEFT JOIN cells ON axis.label = cells.label GROUP BY axis.label",
            *_GUESS,
            _AXIS,
        ),
        "class_report": _sql(
            'SELECT class, support, round(p, 12) AS "precision", round(r, 12) AS recall, round(f, 12) AS f1 FROM report',
            *_REPORT,
        ),
        "eval_metrics": _sql(
            "SELECT round(CAST(sum(hits) AS DOUBLE) / sum(support), 12) AS accuracy, "
            "round(sum(f * support) / sum(support), 12) AS f1, "
            'round(sum(p * support) / sum(support), 12) AS "precision", '
            "round(sum(r * support) / sum(support), 12) AS recall FROM report",
            *_REPORT,
        ),
        "chart_distribution": _sql(
            f"SELECT {_LABEL} AS Severitate, {_ORD} AS severity_ord, patients, "
            "CAST(patients AS DOUBLE) / CAST(sum(patients) OVER () AS DOUBLE) * 100 AS percent "
            "FROM (SELECT Depression_Severity, count(*) AS patients FROM gold GROUP BY 1) ORDER BY 2"
        ),
        "chart_biomarkers": _sql(
            f"SELECT {_LABEL} AS Severitate, {_ORD} AS severity_ord, {_means(SPEC.chart_biomarkers)} "
            "FROM gold GROUP BY Depression_Severity ORDER BY 2"
        ),
        "chart_age_severity": _sql(
            f"SELECT age_group, {age_cells} FROM gold WHERE age_group IS NOT NULL GROUP BY 1 ORDER BY 1"
        ),
        "chart_box_sedentary": _sql(
            f"SELECT {_LABEL} AS Severitate, {_ORD} AS severity_ord, {_BOX_COLUMNS} FROM boxes ORDER BY 2",
            *_box("Depression_Severity", "MinutesSedentaryActivity"),
        ),
        "chart_box_sleep": _sql(
            f"SELECT {_LABEL} AS Severitate, {_ORD} AS severity_ord, {_BOX_COLUMNS} FROM boxes ORDER BY 2",
            *_box("Depression_Severity", "SleepHoursWeekdaysOrWorkdays"),
        ),
        "chart_box_score": _sql(
            f"SELECT age_group, {_BOX_COLUMNS} FROM boxes ORDER BY 1", *_box("age_group", "Depression_Score")
        ),
    }
