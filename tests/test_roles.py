import pytest

from arrearscope.roles import CLIENT_SCHEMA, FEATURES, POLICY, RAW_NAMES, ROLES, SENSITIVE, Roles


def test_schema_and_roles():
    assert len(CLIENT_SCHEMA.fields) == 25
    assert len(FEATURES) == 21
    assert not set(SENSITIVE) & set(FEATURES)
    assert len(RAW_NAMES) == 25
    assert list(RAW_NAMES.values()) == list(ROLES.ordered)


def test_sensitive_columns_may_not_be_features():
    with pytest.raises(ValueError, match="sex"):
        Roles(categorical=("education", "sex"))


def test_threshold_grid():
    grid = POLICY.grid
    assert len(grid) == 76
    assert grid[0] == 0.05 and grid[12] == 0.17 and grid[-1] == 0.8
