"""Codes and numbers mapped to readable groups."""

from __future__ import annotations

from arrearscope.functions.scalars import name, text

# Labels of the codebook and of the right-closed age bands.
GROUP_LABELS = {
    "sex": {1: "male", 2: "female"},
    "marriage": {1: "married", 2: "single", 3: "other"},
    "education": {1: "graduate", 2: "university", 3: "high_school", 4: "other"},
}
AGE_BANDS = ((25, "<=25"), (35, "26-35"), (45, "36-45"), (55, "46-55"), (None, "56+"))
UNKNOWN = "unknown"


def group_label(column: str) -> str:
    """Codebook label; an unmapped code shows as text and null as 'unknown'."""
    c = name(column)
    labels = " ".join(f"WHEN {k} THEN {text(v)}" for k, v in GROUP_LABELS.get(column, {}).items())
    code = f"coalesce(cast({c} AS string), {text(UNKNOWN)})"
    return f"CASE {c} {labels} ELSE {code} END" if labels else code


def age_band(age: str = "age") -> str:
    """Right-closed bands (0, 25], (25, 35] ...; null and non-positive: unknown."""
    bands = " ".join(
        f"ELSE {text(label)}" if upper is None else f"WHEN {age} <= {upper} THEN {text(label)}"
        for upper, label in AGE_BANDS
    )
    return f"CASE WHEN {age} IS NULL OR {age} <= 0 THEN {text(UNKNOWN)} {bands} END"
