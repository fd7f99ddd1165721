"""Declarative configuration: columns, bins, bounds, thresholds, roles.

Operators never hard-code a table layout. ``CLINICAL`` below is one instance
of these classes; another table needs another instance, not other code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

Bounds = dict[str, tuple[float, float]]


@dataclass(frozen=True)
class Bin:
    """Ordered binning of one column into labels (right-closed by default)."""

    column: str
    edges: tuple[float, ...]
    labels: tuple[str, ...]
    out: str
    closed: str = "right"
    include_lowest: bool = True


@dataclass(frozen=True)
class FeatureConfig:
    """The feature chain: clean, bin, encode, derive."""

    features: tuple[str, ...]
    zero_missing: tuple[str, ...] = ()
    bins: tuple[Bin, ...] = ()
    products: tuple[tuple[str, str, str], ...] = ()  # (a, b, out)
    ratios: tuple[tuple[str, str, str], ...] = ()  # (a, b, out)
    flags: tuple[tuple[str, float, str], ...] = ()  # (column, threshold, out)
    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)
    epsilon: float = 1e-8
    label: str = "target"
    key: tuple[str, ...] = ()
    unknown_flags: bool = False

    @property
    def numeric(self) -> list[str]:
        """Columns that are imputed and scaled: raw, products, ratios, 0/1 flags."""
        derived = [out for *_, out in self.products + self.ratios + self.flags]
        return list(self.features) + derived

    @property
    def dummies(self) -> list[str]:
        names = []
        for b in self.bins:
            names += [f"{b.out}_{label}" for label in b.labels[1:]]
            if self.unknown_flags:
                names.append(f"{b.out}_unknown")
        return names

    @property
    def output(self) -> list[str]:
        return self.numeric + self.dummies


@dataclass(frozen=True)
class Roles:
    """Column roles declared once and handed to every monitoring check."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    target: str = "target"
    prediction: str = "prediction"
    score: str | None = None
    key: tuple[str, ...] = ()


@dataclass(frozen=True)
class SuiteConfig:
    """Data-quality suite: range tests, mean tests, drift test."""

    ranges: Bounds
    means: tuple[str, ...]
    sigmas: float = 2.0
    psi_threshold: float = 0.2
    psi_bins: int = 10
    fixed_limits: dict[str, float] = field(default_factory=dict)


@dataclass(frozen=True)
class MonitorThresholds:
    drift: float = 0.25
    failed_tests: int = 0
    accuracy: float = 0.75
    parity: float = 0.1


@dataclass(frozen=True)
class RetrainThresholds:
    drift: float = 0.3
    accuracy: float = 0.75
    f1: float = 0.70
    parity: float = 0.15
    failed_tests: int = 2


@dataclass(frozen=True)
class AdviceThresholds:
    drift: float = 0.2
    accuracy: float = 0.8
    parity: float = 0.1


# --- Fixed values: must equal the behaviour this library is compatible with ---

RISK_LABELS = ("Low Risk", "Medium Risk", "High Risk")
RISK_CUTS = (0.3, 0.7)
RISK_ADVICE = {
    "Low Risk": "Maintain healthy lifestyle. Regular checkups recommended.",
    "Medium Risk": "Lifestyle modifications recommended. Consult healthcare provider.",
    "High Risk": "Immediate medical consultation recommended.",
}
LOW_CONFIDENCE = 0.75
BATCH_LIMIT = 1000

DEPLOY_MINIMUMS = {
    "accuracy": 0.75,
    "precision": 0.70,
    "recall": 0.65,
    "f1_score": 0.70,
    "roc_auc": 0.75,
}

RENAME_MAP = {
    "class": "target",
    "preg": "pregnancies",
    "plas": "glucose",
    "pres": "blood_pressure",
    "skin": "skin_thickness",
    "insu": "insulin",
    "mass": "bmi",
    "pedi": "diabetes_pedigree_function",
}
POSITIVE_CLASS = "tested_positive"

# Range tables (inclusive on both sides).
SCORING_BOUNDS: Bounds = {
    "pregnancies": (0, 20),
    "glucose": (50, 300),
    "blood_pressure": (40, 200),
    "skin_thickness": (0, 100),
    "insulin": (0, 1000),
    "bmi": (10, 80),
    "diabetes_pedigree_function": (0, 5),
    "age": (18, 120),
}
BATCH_BOUNDS: Bounds = {
    "glucose": (0, 300),
    "blood_pressure": (40, 200),
    "bmi": (10, 70),
    "age": (18, 100),
}
SCHEMA_BOUNDS: Bounds = {
    "pregnancies": (0, 20),
    "glucose": (0, 300),
    "blood_pressure": (0, 200),
    "skin_thickness": (0, 100),
    "insulin": (0, 1000),
    "bmi": (10, 80),
    "diabetes_pedigree_function": (0, 5),
    "age": (18, 120),
}
MONITOR_BOUNDS: Bounds = {
    "glucose": (50, 300),
    "blood_pressure": (40, 200),
    "bmi": (10, 80),
    "age": (18, 120),
}
NON_NEGATIVE = ("glucose", "blood_pressure", "bmi", "age")

# Risk score used to label a generated or unlabeled table: weights and percentile.
RISK_WEIGHTS = {"glucose": 0.02, "bmi": 0.01, "age": 0.005, "diabetes_pedigree_function": 2.0}
RISK_PERCENTILE = 0.65
CLIP_BOUNDS: Bounds = {
    "pregnancies": (0, 17),
    "glucose": (0, 200),
    "blood_pressure": (0, 122),
    "skin_thickness": (0, 99),
    "insulin": (0, 846),
    "bmi": (15, 67),
    "diabetes_pedigree_function": (0.08, 2.42),
    "age": (21, 81),
}

CLINICAL = FeatureConfig(
    features=(
        "pregnancies",
        "glucose",
        "blood_pressure",
        "skin_thickness",
        "insulin",
        "bmi",
        "diabetes_pedigree_function",
        "age",
    ),
    zero_missing=("glucose", "blood_pressure", "skin_thickness", "insulin", "bmi"),
    bins=(
        Bin("bmi", (0, 18.5, 25, 30, 100), ("underweight", "normal", "overweight", "obese"), "bmi_category"),
        Bin("age", (0, 30, 50, 100), ("young", "middle", "older"), "age_group"),
        Bin("glucose", (0, 100, 125, 200), ("normal", "prediabetic", "diabetic"), "glucose_category"),
    ),
    products=(("bmi", "age", "bmi_age_interaction"),),
    ratios=(("glucose", "bmi", "glucose_bmi_ratio"),),
    flags=(("pregnancies", 5, "high_pregnancy_risk"),),
    aliases={"bmi": ("bmi", "mass"), "glucose": ("glucose", "plas"), "pregnancies": ("pregnancies", "preg")},
    key=("patient_id",),
)

CLINICAL_ROLES = Roles(
    numeric=CLINICAL.features, target="target", prediction="diabetes_prediction", key=("patient_id",)
)
CLINICAL_SUITE = SuiteConfig(ranges=MONITOR_BOUNDS, means=("glucose", "bmi", "age"))
