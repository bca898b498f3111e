"""Declarative description of one survey.

Every operator takes the names and limits it needs from a :class:`SurveySpec`, so another questionnaire is another
spec, not other code.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from fractions import Fraction

# --- Fixed values: column names, codes and labels of the published survey tables and reports -----------------------

ITEMS = (
    "FeelingDownDepressedOrHopeless",
    "HaveLittleInterestInDoingThings",
    "FeelingBadAboutYourself",
    "FeelingTiredOrHavingLittleEnergy",
    "MovingOrSpeakingSlowlyOrTooFast",
    "TroubleConcentratingOnThings",
    "TroubleSleepingOrSleepingTooMuch",
    "PoorAppetiteOrOvereating",
)

COLUMNS = ITEMS + (
    "HowOftenDoYouFeelDepressed",
    "HowOftenDoYouFeelWorriedOrAnxious",
    "TakeMedicationForDepression",
    "TakeMedicationForTheseFeelings",
    "EverToldDoctorHadTroubleSleeping",
    "HowOftenFeelOverlySleepyDuringDay",
    "AgeInYearsAtScreening",
    "Gender",
    "RacehispanicOrigin",
    "MaritalStatus",
    "EducationLevelAdults20",
    "AnnualHouseholdIncome",
    "MinutesSedentaryActivity",
    "VigorousRecreationalActivities",
    "ModerateRecreationalActivities",
    "WalkOrBicycle",
    "HaveSeriousDifficultyWalking",
    "SleepHoursWeekdaysOrWorkdays",
    "HowOftenDoYouSnore",
    "DietaryFiberGm_DR1TOT",
    "EnergyKcal_DR1TOT",
    "AlcoholGm_DR1TOT",
    "SmokedAtLeast100CigarettesInLife",
    "WeightKg",
    "WaistCircumferenceCm",
    "TrunkFatG",
    "Glycohemoglobin",
    "TotalCholesterolMgdl",
    "SystolicBloodPres1StRdgMmHg",
)

# Encoder order of the string features.
CATEGORICAL = (
    "Gender",
    "RacehispanicOrigin",
    "MaritalStatus",
    "EducationLevelAdults20",
    "HowOftenDoYouSnore",
    "HowOftenFeelOverlySleepyDuringDay",
    "EverToldDoctorHadTroubleSleeping",
    "SmokedAtLeast100CigarettesInLife",
    "WalkOrBicycle",
    "HaveSeriousDifficultyWalking",
    "VigorousRecreationalActivities",
    "ModerateRecreationalActivities",
    "AnnualHouseholdIncome",
)

# Consequences or direct measures of the target: never features.
AUXILIARY = (
    "TakeMedicationForDepression",
    "TakeMedicationForTheseFeelings",
    "HowOftenDoYouFeelDepressed",
    "HowOftenDoYouFeelWorriedOrAnxious",
)

SEVERITY_CUTS = ((4, "Minimala"), (9, "Usoara"), (14, "Moderata"), (19, "Moderat_Severa"))
SEVERITY_TOP = "Severa"

SEVERITY_DISPLAY = {
    "Minimala": "Minimală",
    "Usoara": "Ușoară",
    "Moderata": "Moderată",
    "Moderat_Severa": "Moderat-Severă",
    "Severa": "Severă",
}

# Names of report columns.
PATIENTS = "Total_Pacienti"
SEVERITY_NAME = "Severitate"

AGE_EDGES = (17, 29, 44, 59, 100)
AGE_LABELS = ("18–29 ani", "30–44 ani", "45–59 ani", "60+ ani")

FEATURE_DISPLAY = {
    "AgeInYearsAtScreening": "Vârstă (ani)",
    "WeightKg": "Greutate (kg)",
    "WaistCircumferenceCm": "Circumferință talie (cm)",
    "TrunkFatG": "Grăsime trunchi (g)",
    "Glycohemoglobin": "Hemoglobină glicozilată (%)",
    "TotalCholesterolMgdl": "Colesterol total (mg/dL)",
    "SystolicBloodPres1StRdgMmHg": "Tensiune arterială sistolică (mmHg)",
    "SleepHoursWeekdaysOrWorkdays": "Ore de somn pe noapte",
    "MinutesSedentaryActivity": "Minute de sedentarism pe zi",
    "DietaryFiberGm_DR1TOT": "Fibre alimentare (g/zi)",
    "EnergyKcal_DR1TOT": "Aport energetic (kcal/zi)",
    "AlcoholGm_DR1TOT": "Consum alcool (g/zi)",
    "Gender_Idx": "Gen",
    "RacehispanicOrigin_Idx": "Origine etnică",
    "MaritalStatus_Idx": "Stare civilă",
    "EducationLevelAdults20_Idx": "Nivel de educație",
    "AnnualHouseholdIncome_Idx": "Venit anual al gospodăriei",
    "HowOftenDoYouSnore_Idx": "Frecvența sforăitului",
    "HowOftenFeelOverlySleepyDuringDay_Idx": "Somnolență diurnă",
    "EverToldDoctorHadTroubleSleeping_Idx": "Probleme de somn (raportate la medic)",
    "SmokedAtLeast100CigarettesInLife_Idx": "Fumat (>100 țigări în viață)",
    "WalkOrBicycle_Idx": "Deplasare pe jos / cu bicicleta",
    "HaveSeriousDifficultyWalking_Idx": "Dificultate serioasă la mers",
    "VigorousRecreationalActivities_Idx": "Activitate fizică viguroasă",
    "ModerateRecreationalActivities_Idx": "Activitate fizică moderată",
}

# Reported group means: (column, name in the report, decimals or None).
BIOMARKERS = (
    ("Glycohemoglobin", "Avg_HbA1c", 2),
    ("TotalCholesterolMgdl", "Avg_Cholesterol", 1),
    ("SystolicBloodPres1StRdgMmHg", "Avg_Systolic", 1),
    ("WeightKg", "Avg_Weight", 1),
    ("WaistCircumferenceCm", "Avg_Waist", 1),
)
BEHAVIOUR = (
    ("SleepHoursWeekdaysOrWorkdays", "Avg_Sleep", 2),
    ("MinutesSedentaryActivity", "Avg_Sedentary_Min", 1),
    ("AlcoholGm_DR1TOT", "Avg_Alcohol", 2),
    ("AgeInYearsAtScreening", "Avg_Age", 1),
)
CHART_BIOMARKERS = (
    ("Glycohemoglobin", "HbA1c_mediu", None),
    ("TotalCholesterolMgdl", "Colesterol_mediu", None),
    ("SystolicBloodPres1StRdgMmHg", "Tensiune_medie", None),
    ("WeightKg", "Greutate_medie", None),
)

# --- End of fixed values -------------------------------------------------------------------------------------------

Mean = tuple[str, str, int | None]


@dataclass(frozen=True)
class SurveySpec:
    key: str
    columns: tuple[str, ...]
    items: tuple[str, ...]
    item_max: float
    bounds: dict[str, float]
    age: str
    min_age: float
    score: str
    severity: str
    cuts: tuple[tuple[float, str], ...]
    top: str
    categorical: tuple[str, ...]
    auxiliary: tuple[str, ...]
    age_edges: tuple[float, ...]
    age_labels: tuple[str, ...]
    severity_display: dict[str, str]
    feature_display: dict[str, str]
    biomarkers: tuple[Mean, ...]
    behaviour: tuple[Mean, ...]
    chart_biomarkers: tuple[Mean, ...]
    missing_category: str = "UNKNOWN"
    index_suffix: str = "_Idx"
    label: str = "label"
    test_size: Fraction = Fraction(1, 5)
    seed: int = 42
    trees: int = 50
    depth: int = 8
    #: Also bounds the rows (max_bins squared, 10,000 at least) among which the library looks for a feature's cut points;
    #: the counts behind each cut cover all training rows.
    max_bins: int = 128
    bootstrap: bool = True
    features_per_node: str = "auto"
    extra_excluded: tuple[str, ...] = field(default=())

    @property
    def severity_order(self) -> list[str]:
        """Classes from mildest to worst."""
        return [name for _, name in self.cuts] + [self.top]

    @property
    def severity_classes(self) -> list[str]:
        """Classes in encoder order (code points, so upper case and ``_`` sort before lower case)."""
        return sorted(self.severity_order)

    @property
    def excluded(self) -> frozenset[str]:
        """Columns that must never reach the model: target, score, label, items, auxiliaries, key."""
        return frozenset(
            (self.severity, self.score, self.label, self.key, *self.items, *self.auxiliary, *self.extra_excluded)
        )

    @property
    def numeric(self) -> list[str]:
        """Numeric features in selection order."""
        return [c for c in self.columns if c not in self.excluded and c not in self.categorical]

    @property
    def indexed(self) -> list[str]:
        return [c + self.index_suffix for c in self.categorical if c not in self.excluded]

    @property
    def features(self) -> list[str]:
        """Model inputs in assembler order: numerics, then the encoded categoricals."""
        return self.numeric + self.indexed


def default_spec() -> SurveySpec:
    """The depression-screening survey."""
    return SurveySpec(
        key="respondent_id",
        columns=COLUMNS,
        items=ITEMS,
        item_max=3,
        bounds={"MinutesSedentaryActivity": 1440},
        age="AgeInYearsAtScreening",
        min_age=18,
        score="Depression_Score",
        severity="Depression_Severity",
        cuts=SEVERITY_CUTS,
        top=SEVERITY_TOP,
        categorical=CATEGORICAL,
        auxiliary=AUXILIARY,
        age_edges=AGE_EDGES,
        age_labels=AGE_LABELS,
        severity_display=SEVERITY_DISPLAY,
        feature_display=FEATURE_DISPLAY,
        biomarkers=BIOMARKERS,
        behaviour=BEHAVIOUR,
        chart_biomarkers=CHART_BIOMARKERS,
    )
