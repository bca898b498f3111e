"""Known totals of the derived survey at three scales."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from surveyflow.plans import queries as Q
from surveyflow.plans import stages
from surveyflow.sources.orders_survey import ITEM_HASH, MEASURE_HASH, STRING_HASH

EXPECTED = {
    "0.001": ((1500, 1372, 984), (570, 181, 36, 103, 94), (29, 49), (114, 36, 7, 21, 19), (15, 25, 19, 0)),
    "0.01": ((15000, 13804, 9846), (5769, 1867, 422, 1084, 704), (273, 421), (1154, 374, 84, 217, 141),
             (103, 140, 172, 289)),
    "0.1": ((150000, 137893, 98176), (57458, 18284, 4323, 10935, 7176), (2895, 4218), (11492, 3657, 865, 2187, 1435),
            (1243, 1537, 1599, 2797)),
}


@pytest.mark.parametrize("sf", EXPECTED)
def test_totals(spark, spec, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    (rows, adults, scored), classes, (above, missing), test, outliers = EXPECTED[sf]
    raw = Q.bronze(spark, sf_dir)
    sedentary = F.col("MinutesSedentaryActivity")
    found = raw.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(spec.age) >= 18).alias("adults"),
        F.count_if(sedentary > 1440).alias("above"),
        F.count_if(sedentary.isNull()).alias("missing"),
    ).first()
    assert (found["rows"], found["adults"]) == (rows, adults)
    assert (found["above"], found["missing"]) == (above, missing)

    sizes = dict(stages.gold(stages.silver(raw, spec), spec).groupBy(spec.severity).count().collect())
    assert sizes == dict(zip(spec.severity_order, classes)) and sum(sizes.values()) == scored
    split = {r[spec.severity]: r["test_rows"] for r in Q.split_counts(spark, sf_dir).collect()}
    assert split == dict(zip(spec.severity_order, test))
    boxes = {r["age_group"]: r["outliers"] for r in Q.registered()["chart_box_score"](spark, sf_dir).collect()}
    assert boxes == dict(zip(spec.age_labels, outliers))


def test_every_survey_column_is_defined(spec):
    defined = {*ITEM_HASH, *STRING_HASH, *MEASURE_HASH, "AgeInYearsAtScreening", "MinutesSedentaryActivity"}
    assert defined == set(spec.columns)


def test_feature_list(spec):
    assert len(spec.columns) == 37 and len(spec.numeric) == 12 and len(spec.features) == 25
    assert set(spec.feature_display) == set(spec.features)
    assert not set(spec.features) & spec.excluded and len(spec.excluded) == 16
