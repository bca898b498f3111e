"""Survey test data derived from the ``orders`` table: one respondent per order.

Every expression is integer arithmetic plus multiples of powers of two and is valid in Spark SQL and in ANSI engines
alike, so both sides of a comparison see identical values. Orders are narrow and the survey is wide, so the orders are
spread evenly first: a file whose rows lie in one group is read by one task, but not widened by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surveyflow.spec import COLUMNS

# --- Fixed values of the test-data definition ----------------------------------------------------------------------

ITEM_HASH = {
    "FeelingDownDepressedOrHopeless": (39, 28),
    "HaveLittleInterestInDoingThings": (65, 35),
    "FeelingBadAboutYourself": (91, 42),
    "FeelingTiredOrHavingLittleEnergy": (117, 49),
    "MovingOrSpeakingSlowlyOrTooFast": (143, 56),
    "TroubleConcentratingOnThings": (169, 63),
    "TroubleSleepingOrSleepingTooMuch": (195, 70),
    "PoorAppetiteOrOvereating": (221, 77),
}

# column: (p, q, number of values)
STRING_HASH = {
    "HowOftenDoYouFeelDepressed": (23, 7, 5),
    "HowOftenDoYouFeelWorriedOrAnxious": (29, 9, 5),
    "TakeMedicationForDepression": (35, 11, 2),
    "TakeMedicationForTheseFeelings": (41, 13, 2),
    "EverToldDoctorHadTroubleSleeping": (47, 15, 2),
    "HowOftenFeelOverlySleepyDuringDay": (53, 17, 5),
    "Gender": (59, 19, 2),
    "RacehispanicOrigin": (65, 21, 6),
    "MaritalStatus": (71, 23, 6),
    "EducationLevelAdults20": (77, 25, 5),
    "AnnualHouseholdIncome": (83, 27, 12),
    "VigorousRecreationalActivities": (89, 29, 2),
    "ModerateRecreationalActivities": (95, 31, 2),
    "WalkOrBicycle": (101, 33, 2),
    "HaveSeriousDifficultyWalking": (107, 35, 2),
    "HowOftenDoYouSnore": (113, 37, 4),
    "SmokedAtLeast100CigarettesInLife": (119, 39, 2),
}

# column: (null hash p, q), low, step, (value hash p, q, n)
MEASURE_HASH = {
    "SleepHoursWeekdaysOrWorkdays": ((43, 4), 4, 0.5, (35, 11, 18)),
    "DietaryFiberGm_DR1TOT": ((45, 5), 2, 0.25, (39, 13, 161)),
    "EnergyKcal_DR1TOT": ((47, 6), 600, 1.0, (43, 15, 3401)),
    "AlcoholGm_DR1TOT": ((49, 7), 0, 0.5, (47, 17, 121)),
    "WeightKg": ((51, 8), 40, 0.5, (51, 19, 201)),
    "WaistCircumferenceCm": ((53, 9), 60, 0.5, (55, 21, 161)),
    "TrunkFatG": ((55, 10), 3000, 1.0, (59, 23, 25001)),
    "Glycohemoglobin": ((57, 11), 4, 0.125, (63, 25, 41)),
    "TotalCholesterolMgdl": ((59, 12), 100, 1.0, (67, 27, 201)),
    "SystolicBloodPres1StRdgMmHg": ((61, 13), 90, 2.0, (71, 29, 51)),
}

# --- End of fixed values -------------------------------------------------------------------------------------------


def _h(p: int, q: int, n: int) -> str:
    return f"((o_orderkey*{p} + o_custkey*{q}) % {n})"


_B = f"CASE WHEN {_h(37, 11, 100)}<60 THEN 0 WHEN {_h(37, 11, 100)}<80 THEN 1 WHEN {_h(37, 11, 100)}<93 THEN 2 ELSE 3 END"


def _expression(column: str) -> str:
    if column == "AgeInYearsAtScreening":
        return f"CAST(12 + {_h(7, 1, 75)} AS DOUBLE)"
    if column in ITEM_HASH:
        r = _h(*ITEM_HASH[column], 101)
        return (
            f"CAST(CASE WHEN {r}=0 THEN 7 WHEN {r}=1 THEN 9 WHEN {r}<4 THEN NULL "
            f"ELSE LEAST(3,GREATEST(0,({_B})+({r}%3)-1)) END AS DOUBLE)"
        )
    if column in STRING_HASH:
        p, q, k = STRING_HASH[column]
        r = _h(p, q, 103)
        return f"CASE WHEN {r}<3 THEN NULL ELSE CONCAT('L', CAST({r}%{k} AS STRING)) END"
    if column == "MinutesSedentaryActivity":
        r = _h(29, 3, 107)
        return (
            f"CAST(CASE WHEN {r}=0 THEN 7777 WHEN {r}=1 THEN 9999 WHEN {r}<5 THEN NULL "
            f"ELSE 60*(1+{r}%10)+40*({_B}) END AS DOUBLE)"
        )
    (zp, zq), low, step, value = MEASURE_HASH[column]
    r = _h(*value)
    return (
        f"CASE WHEN {_h(zp, zq, 19)}=0 THEN NULL "
        f"ELSE {low}+CAST({step} AS DOUBLE)*{r}+CAST({step} AS DOUBLE)*({_B}) END"
    )


def survey_expressions() -> dict[str, str]:
    """``{column: SQL expression over orders}``, key first, then the survey columns in their order."""
    return {"respondent_id": "o_orderkey", **{c: _expression(c) for c in COLUMNS}}


def survey_select() -> str:
    """The same projection as SQL text over a relation named ``orders``."""
    columns = ",\n  ".join(f"{e} AS {c}" for c, e in survey_expressions().items())
    return f"SELECT\n  {columns}\nFROM orders"


def survey(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """The wide raw survey of a data directory; ``extra`` order columns are appended unchanged.

    Rows are dealt by all the columns that are read, so a key that repeats or is null is no hot one.
    """
    read = list(dict.fromkeys(("o_orderkey", "o_custkey", *extra)))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(*read).repartition(*read)
    return orders.selectExpr(*[f"{e} AS {c}" for c, e in survey_expressions().items()], *extra)

