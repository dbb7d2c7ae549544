"""Column roles, codebooks and policy constants of a client repayment table.

One row is one client with six monthly statements; suffix 1 (``pay_0``,
``bill_amt1``, ``pay_amt1``) is the most recent month.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Names, codes and policy numbers that results depend on.
ID = "id"
TARGET = "default_payment_next_month"
PAY = ("pay_0", "pay_2", "pay_3", "pay_4", "pay_5", "pay_6")
BILL = tuple(f"bill_amt{m}" for m in range(1, 7))
PAID = tuple(f"pay_amt{m}" for m in range(1, 7))
LIMIT = "limit_bal"
NUMERIC = (LIMIT, "age", *PAY, *BILL, *PAID)
CATEGORICAL = ("education",)
SENSITIVE = ("sex", "marriage")
FEATURES = (*NUMERIC, *CATEGORICAL)

CODEBOOK = {"sex": (1, 2), "education": (1, 2, 3, 4), "marriage": (1, 2, 3)}

DEFAULT_RATE_BAND = (0.10, 0.40)
SPLIT_FRACTIONS = {"train": 0.70, "validation": 0.15, "test": 0.15}
SEED = 42

# Inclusive (low, high) range per scored field; None leaves a side open.
FIELD_RANGES = {
    LIMIT: (0, 1_000_000),
    "age": (18, 100),
    **{c: (-2, 9) for c in PAY},
    **{c: (None, None) for c in BILL},
    **{c: (0, None) for c in PAID},
    "education": (1, 6),
}


@dataclass(frozen=True)
class Roles:
    """Which column plays which part; everything else derives from this."""

    id: str = ID
    target: str = TARGET
    numeric: tuple[str, ...] = NUMERIC
    categorical: tuple[str, ...] = CATEGORICAL
    sensitive: tuple[str, ...] = SENSITIVE

    def __post_init__(self) -> None:
        leaked = set(self.sensitive) & set(self.features)
        if leaked:
            raise ValueError(f"sensitive columns may not be features: {sorted(leaked)}")

    @property
    def features(self) -> tuple[str, ...]:
        return (*self.numeric, *self.categorical)

    @property
    def ordered(self) -> tuple[str, ...]:
        """Canonical column order: id, numeric, categorical, sensitive, target."""
        return (self.id, *self.features, *self.sensitive, self.target)


ROLES = Roles()


@dataclass(frozen=True)
class Policy:
    """Decision policy and error costs."""

    decline_threshold: float = 0.60
    cost_false_negative: float = 5.0
    cost_false_positive: float = 1.0
    threshold_min: float = 0.05
    threshold_max: float = 0.80
    threshold_step: float = 0.01
    selection_tolerance: float = 0.005
    decisions: dict[str, str] = field(
        default_factory=lambda: {"LOW": "APPROVE", "MEDIUM": "REVIEW", "HIGH": "DECLINE"}
    )

    @property
    def grid(self) -> list[float]:
        steps = round((self.threshold_max - self.threshold_min) / self.threshold_step)
        return [round(self.threshold_min + i * self.threshold_step, 4) for i in range(steps + 1)]


POLICY = Policy()


def _type_of(column: str) -> T.DataType:
    if column == ID:
        return T.LongType()
    if column == LIMIT or column in BILL or column in PAID:
        return T.DoubleType()
    return T.IntegerType()


#: Explicit scan schema of the canonical 25-column client table.
CLIENT_SCHEMA = T.StructType([T.StructField(c, _type_of(c)) for c in ROLES.ordered])

#: Raw header names as delivered -> canonical names.
RAW_NAMES = {
    **{c.upper(): c for c in ROLES.ordered if c != TARGET},
    "default payment next month": TARGET,
}
