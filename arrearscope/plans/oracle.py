"""The registered queries once more as plain SQL for DuckDB.

Written independently of the Spark side: windows over whole tables, lists and
lateral sub-selects where Spark uses staged projections and prefix sums. Only
column lists and fixed constants are shared.
"""

from __future__ import annotations

from arrearscope.functions.engineered import ENGINEERED
from arrearscope.plans import scorecard as sc
from arrearscope.roles import BILL, FEATURES, NUMERIC, PAID, PAY, ROLES, SEED, TARGET


# Fixed values, written out once more so that the comparison is with them and not with the engine.
CODEBOOK = {"sex": (1, 2), "education": (1, 2, 3, 4), "marriage": (1, 2, 3)}
FIELD_RANGES = {
    "limit_bal": (0, 1_000_000),
    "age": (18, 100),
    **{f"pay_{m}": (-2, 9) for m in (0, 2, 3, 4, 5, 6)},
    **{f"bill_amt{m}": (None, None) for m in (1, 2, 3, 4, 5, 6)},
    **{f"pay_amt{m}": (0, None) for m in (1, 2, 3, 4, 5, 6)},
    "education": (1, 6),
}
GROUP_LABELS = {
    "sex": {1: "male", 2: "female"},
    "marriage": {1: "married", 2: "single", 3: "other"},
    "education": {1: "graduate", 2: "university", 3: "high_school", 4: "other"},
}
AGE_BANDS = ((25, "<=25"), (35, "26-35"), (45, "36-45"), (55, "46-55"), (None, "56+"))
#: Thresholds 0.05, 0.06 ... 0.80.
GRID = [round(0.05 + i / 100, 2) for i in range(76)]

#: Display labels, written out for comparison and independent of the engine.
_SHOWN = {
    "payment_delay_rate": "late-payment frequency",
    "serious_delay_rate": "serious delinquency frequency",
    "max_delay_months": "worst payment delay (months)",
    "pay_duly_rate": "share of months paid in full",
    "revolving_use_rate": "share of months with revolving balance",
    "total_bill_amount": "total billed amount",
    "avg_bill_amount": "average monthly bill",
    "bill_volatility": "bill volatility",
    "total_payment_amount": "total repaid amount",
    "avg_payment_amount": "average monthly repayment",
    "payment_volatility": "repayment volatility",
    "net_cash_flow": "net cash flow (repayments - bills)",
    "payment_to_bill_ratio": "repayment-to-bill ratio",
    "credit_utilization": "credit utilisation",
    "payment_to_limit_ratio": "repayment-to-limit ratio",
    "bill_trend": "bill trend over window",
    "recent_delay_flag": "most recent month delinquency",
    "limit_bal": "credit limit",
    "age": "age",
    "education": "education level",
    **{f"pay_{m}": f"repayment status (month -{m})" for m in (0, 2, 3, 4, 5, 6)},
    **{f"bill_amt{m}": f"statement balance (month -{m})" for m in (1, 2, 3, 4, 5, 6)},
    **{f"pay_amt{m}": f"amount repaid (month -{m})" for m in (1, 2, 3, 4, 5, 6)},
    **{f"education_{v}": f"education level {v}" for v in (1, 2, 3, 4)},
}


def _shown(feature: str) -> str:
    return _SHOWN[feature.removeprefix("num__").removeprefix("cat__")]


SCALED = (*NUMERIC, *ENGINEERED)


def h32(x: str) -> str:
    return f"cast(cast(('0x' || substr(md5({x}), 1, 8)) AS UBIGINT) AS BIGINT)"


def r6(x: str, places: int = 6) -> str:
    """Rounded for display; adding zero turns a negative zero into zero."""
    return f"(round({x}, {places}) + 0e0)"


def cols(names) -> str:
    return ", ".join(names)


def ratio(a: str, b: str) -> str:
    return f"coalesce(cast({a} AS double) / nullif(cast({b} AS double), 0e0), 0e0)"


# -- common tables ---------------------------------------------------------------

_MONTHLY = ",\n    ".join(
    f"max(CASE WHEN rk = {m} THEN {src} END) AS {c}"
    for names, src in ((PAY, "pay"), (BILL, "bill"), (PAID, "pay_amt"))
    for m, c in enumerate(names, start=1)
)

CTE = {
    "paid": (
        (),
        """SELECT l_orderkey AS k, sum(cast(l_extendedprice AS decimal(12,2)) * (1 - cast(l_discount AS decimal(4,2)))) AS amt
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey""",
    ),
    "st": (
        ("paid",),
        """SELECT o_custkey AS cid,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rk,
    cast(coalesce(amt, 0) AS double) AS pay_amt,
    CASE WHEN o_orderstatus = 'P' THEN cast(cast(o_totalprice AS decimal(14,2)) - coalesce(amt, 0) AS double) ELSE o_totalprice END AS bill
  FROM orders LEFT JOIN paid ON k = o_orderkey""",
    ),
    "s6": (
        ("st",),
        """SELECT cid, rk, pay_amt, bill,
    CASE WHEN bill <= 0 THEN -2 WHEN pay_amt >= bill THEN -1 WHEN pay_amt >= 0.5e0 * bill THEN 0
         WHEN pay_amt >= 0.25e0 * bill THEN 1 WHEN pay_amt >= 0.1e0 * bill THEN 2
         WHEN pay_amt > 0 THEN 3 ELSE 4 END AS pay
  FROM st WHERE rk <= 6""",
    ),
    "wide": (("s6",), f"SELECT cid, {_MONTHLY} FROM s6 GROUP BY cid"),
    "panel": (
        ("wide",),
        f"""SELECT c_custkey AS id,
  CASE WHEN c_acctbal > 0 THEN cast(cast(c_acctbal AS decimal(12,2)) * 50 AS double) ELSE 0e0 END AS limit_bal,
  CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE cast(21 + c_custkey % 49 AS int) END AS age,
  {cols((*PAY, *BILL, *PAID))},
  cast((c_custkey * 7 + c_nationkey) % 7 AS int) AS education,
  CASE WHEN c_custkey % 97 = 0 THEN 0 ELSE cast(1 + c_custkey % 2 AS int) END AS sex,
  cast(c_nationkey % 4 AS int) AS marriage,
  CASE WHEN {h32("'y:' || cast(c_custkey AS string)")} / 4294967296e0
     < 0.06e0 + CASE WHEN pay_0 > 0 THEN 0.20e0 ELSE 0e0 END + CASE WHEN pay_2 > 0 THEN 0.15e0 ELSE 0e0 END
     THEN 1 ELSE 0 END AS {TARGET}
FROM customer LEFT JOIN wide ON cid = c_custkey""",
    ),
    "scored": (
        (),
        """SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
  round(least(1e0, greatest(0e0, 0.05e0 + 3 * l_discount + 0.004e0 * l_quantity
        + CASE WHEN l_returnflag = 'R' THEN 0.15e0 ELSE 0e0 END)), 2) AS p,
  l_linestatus AS grp FROM lineitem""",
    ),
    "clean": (
        ("panel",),
        """SELECT * REPLACE (
    CASE WHEN education IN (1, 2, 3, 4) THEN education ELSE 4 END AS education,
    CASE WHEN marriage IN (1, 2, 3) THEN marriage ELSE 3 END AS marriage,
    CASE WHEN sex IN (1, 2) THEN sex END AS sex) FROM panel""",
    ),
}


def engineered(source: str) -> str:
    """The 17 features over a source of cleaned rows, by lists of six months."""

    def plus(names) -> str:
        return " + ".join(f"coalesce({c}, 0e0)" for c in names)

    def present(names) -> str:
        return f"len(list_filter([{cols(names)}], lambda v: v IS NOT NULL))"

    def std(names, mean: str) -> str:
        squares = " + ".join(f"coalesce(({c} - {mean}) * ({c} - {mean}), 0e0)" for c in names)
        return f"CASE WHEN {present(names)} > 1 THEN sqrt(({squares}) / ({present(names)} - 1)) ELSE 0e0 END"

    def finite(a: str, b: str) -> str:
        q = f"({a}) / nullif({b}, 0)"
        return f"CASE WHEN isfinite({q}) THEN {q} ELSE 0e0 END"

    pays = f"[{cols(PAY)}]"

    def months(test: str) -> str:
        return f"len(list_filter({pays}, lambda v: v {test})) / 6e0"

    return f"""SELECT t2.*,
    {std(BILL, 'avg_bill_amount')} AS bill_volatility,
    {std(PAID, 'avg_payment_amount')} AS payment_volatility,
    total_payment_amount - total_bill_amount AS net_cash_flow,
    {finite('total_payment_amount', 'total_bill_amount')} AS payment_to_bill_ratio,
    {finite('avg_bill_amount', 'limit_bal')} AS credit_utilization,
    {finite('avg_payment_amount', 'limit_bal')} AS payment_to_limit_ratio
  FROM (SELECT t1.*,
      total_bill_amount / nullif({present(BILL)}, 0) AS avg_bill_amount,
      total_payment_amount / nullif({present(PAID)}, 0) AS avg_payment_amount
    FROM (SELECT src.*,
        {months('> 0')} AS payment_delay_rate,
        {months('>= 2')} AS serious_delay_rate,
        cast(greatest(list_max({pays}), CASE WHEN {present(PAY)} > 0 THEN 0 END) AS double) AS max_delay_months,
        {months('IN (-1, -2)')} AS pay_duly_rate,
        {months('= 0')} AS revolving_use_rate,
        {plus(BILL)} AS total_bill_amount,
        {plus(PAID)} AS total_payment_amount,
        {finite('bill_amt6 - bill_amt1', 'abs(bill_amt1)')} AS bill_trend,
        CASE WHEN pay_0 > 0 THEN 1 ELSE 0 END AS recent_delay_flag
      FROM {source} src) t1) t2"""


CTE["feats"] = (("clean",), engineered("clean"))
CTE["ranked"] = (
    ("feats",),
    f"""SELECT *, row_number() OVER (PARTITION BY {TARGET} ORDER BY h, id) AS rk,
    count(*) OVER (PARTITION BY {TARGET}) AS nc
  FROM (SELECT *, {h32(f"'{SEED}:' || cast(id AS string)")} AS h FROM feats)""",
)
CTE["parts"] = (
    ("ranked",),
    """SELECT *, CASE WHEN rk <= floor(0.70e0 * nc + 0.5e0) THEN 'train'
    WHEN rk <= floor(0.85e0 * nc + 0.5e0) THEN 'validation' ELSE 'test' END AS split FROM ranked""",
)
CTE["meds"] = (
    ("parts",),
    "SELECT "
    + ", ".join(f"quantile_cont(cast({c} AS double), 0.5e0) AS med_{c}" for c in (*SCALED, "education"))
    + " FROM parts WHERE split = 'train'",
)


def filled(c: str) -> str:
    return f"coalesce(cast({c} AS double), med_{c})"


CTE["bounds"] = (
    ("parts", "meds"),
    "SELECT "
    + ", ".join(
        f"quantile_cont({filled(c)}, 0.01e0) AS lo_{c}, quantile_cont({filled(c)}, 0.99e0) AS hi_{c}" for c in SCALED
    )
    + " FROM parts, meds WHERE split = 'train'",
)


def clipped(c: str) -> str:
    return f"least(greatest({filled(c)}, lo_{c}), hi_{c})"


CTE["moments"] = (
    ("parts", "meds", "bounds"),
    "SELECT "
    + ", ".join(f"avg({clipped(c)}) AS mean_{c}, stddev_pop({clipped(c)}) AS std_{c}" for c in SCALED)
    + " FROM parts, meds, bounds WHERE split = 'train'",
)
CTE["mode_education"] = (
    ("parts",),
    """SELECT education AS mode_education FROM parts WHERE split = 'train' AND education IS NOT NULL
  GROUP BY education ORDER BY count(*) DESC, education LIMIT 1""",
)


def standardised(c: str) -> str:
    return f"({clipped(c)} - mean_{c}) / CASE WHEN std_{c} = 0 THEN 1e0 ELSE std_{c} END"


def one_hot(v: int) -> str:
    return f"CASE WHEN coalesce(education, mode_education) = {v} THEN 1e0 ELSE 0e0 END"


def encoded_sql(name: str) -> str:
    kind, column = name.split("__", 1)
    return standardised(column) if kind == "num" else one_hot(int(column.rsplit("_", 1)[1]))


PARAMS = "meds, bounds, moments, mode_education"
PARAM_NEEDS = ("meds", "bounds", "moments", "mode_education")


def log_odds_sql() -> str:
    terms = " + ".join(f"({w!r}::double) * ({encoded_sql(c)})" for c, w in sc.WEIGHTS.items())
    return f"({sc.INTERCEPT!r}::double) + {terms}"


def sigmoid(z: str) -> str:
    return f"1e0 / (1e0 + exp(-({z})))"


RAW_P = sigmoid(log_odds_sql())
CALIBRATED_P = sigmoid(f"({sc.SLOPE!r}::double) * ({RAW_P}) + ({sc.OFFSET!r}::double)")

CTE["carded"] = (
    ("parts", *PARAM_NEEDS),
    f"SELECT parts.*, {RAW_P} AS raw_p, {CALIBRATED_P} AS cal_p FROM parts, {PARAMS}",
)

# score-level tables of `scored`
CTE["levels"] = (
    ("scored",),
    """SELECT p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY p""",
)


def ranked_levels(source: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    return f"""SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
    sum(pos) OVER ({part}) AS np, sum(neg) OVER ({part}) AS nn
  FROM {source} WINDOW w AS ({part} ORDER BY p DESC ROWS UNBOUNDED PRECEDING)"""


CTE["curve"] = (("levels",), ranked_levels("levels"))
AUC = "sum(neg * (tp - pos / 2e0)) / max(np * cast(nn AS double))"
AP = "sum(pos * (tp / cast(tp + fp AS double))) / max(np)"


def confusion_of(t: str, p: str = "p", y: str = "y") -> str:
    return f"""cast(count(*) FILTER ({p} >= {t} AND {y} = 1) AS bigint) AS tp,
    cast(count(*) FILTER ({p} < {t} AND {y} = 0) AS bigint) AS tn,
    cast(count(*) FILTER ({p} >= {t} AND {y} = 0) AS bigint) AS fp,
    cast(count(*) FILTER ({p} < {t} AND {y} = 1) AS bigint) AS fn"""


RATES = f"""{ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {ratio('tp', 'tp + fp')} AS "precision",
    {ratio('tp', 'tp + fn')} AS recall, {ratio('tn', 'tn + fp')} AS specificity,
    {ratio('2 * tp', '2 * tp + fp + fn')} AS f1, {ratio('fp', 'fp + tn')} AS false_positive_rate,
    {ratio('fn', 'fn + tp')} AS false_negative_rate"""


def suite(source: str, thresholds: list[float], y: str = "y", p: str = "p", by: str = "", places: int = 9) -> str:
    """The metric suite over a source, one row per threshold and group."""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    on = f"USING ({by})" if by else "ON true"
    parts = []
    for t in thresholds:
        parts.append(
            f"""SELECT {keys}{t!r}::double AS threshold, {RATES}, tp, tn, fp, fn, n, n_defaults, brier, ll
    FROM (SELECT {keys}{confusion_of(repr(t) + '::double', p, y)}, count(*) AS n,
        cast(count(*) FILTER ({y} = 1) AS bigint) AS n_defaults, avg(({p} - {y}) * ({p} - {y})) AS brier,
        -avg(CASE WHEN {y} = 1 THEN ln(least(greatest({p}, 1e-15), 1 - 1e-15))
             ELSE ln(1 - least(greatest({p}, 1e-15), 1 - 1e-15)) END) AS ll
      FROM ({source}) GROUP BY ALL)"""
        )
    ranked = ranked_levels(
        f"""(SELECT {keys}{p} AS p, count(*) FILTER ({y} = 1) AS pos, count(*) FILTER ({y} = 0) AS neg
      FROM ({source}) GROUP BY ALL)""",
        by,
    )
    names = ("accuracy", '"precision"', "recall", "specificity", "f1")
    return f"""SELECT {keys}threshold, {", ".join(f"{r6(c, places)} AS {c}" for c in names)},
    {r6('roc_auc', places)} AS roc_auc, {r6('pr_auc', places)} AS pr_auc,
    {r6('false_positive_rate', places)} AS false_positive_rate,
    {r6('false_negative_rate', places)} AS false_negative_rate,
    {r6('brier', places)} AS brier_score, {r6('ll', places)} AS log_loss,
    tp AS true_positives, tn AS true_negatives, fp AS false_positives, fn AS false_negatives, n, n_defaults
  FROM ({" UNION ALL ".join(parts)}) JOIN
    (SELECT {keys}{AUC} AS roc_auc, {AP} AS pr_auc FROM ({ranked}) {group}) {on}"""


def sql(body: str, *needs: str) -> str:
    """Prefix a query with the common tables it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in CTE[name][0]:
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for need in needs:
        visit(need)
    heads = ", ".join(f"{c} AS MATERIALIZED ({CTE[c][1]})" for c in ordered)
    return f"WITH RECURSIVE {heads} {body}" if ordered else body


ORACLE: dict[str, str] = {}


def add(key: str, body: str, *needs: str) -> None:
    if key in ORACLE:
        raise ValueError(f"duplicate oracle {key}")
    ORACLE[key] = sql(body, *needs)


ALL25 = cols(ROLES.ordered)

# -- S ------------------------------------------------------------------------------

add("s01_load_raw", f"SELECT {ALL25} FROM panel", "panel")
add("s02_rename", f"SELECT {ALL25} FROM panel", "panel")
add("s03_project", f"SELECT {ALL25} FROM panel", "panel")
_FINGERPRINT = f"""substr(sha256(concat_ws(',', '{"|".join(ROLES.ordered)}',
    cast(sum(cast({h32(f"concat_ws('|', cast(id AS string), cast({TARGET} AS string))")} AS hugeint)) AS string),
    cast(count(*) AS string))), 1, 16)"""
add("s04_fingerprint", f"SELECT {_FINGERPRINT} AS fingerprint FROM panel", "panel")
add(
    "s05_preview",
    f"""SELECT count(*) AS n_rows, cast(25 AS bigint) AS n_columns, {r6(f'avg({TARGET})')} AS target_rate,
    {_FINGERPRINT} AS fingerprint FROM panel""",
    "panel",
)
_RUNS = f"""SELECT 'run-' || grp AS run_id, 'fixed_' || grp AS model_name, {r6(AUC, 9)} AS roc_auc, {r6(AP, 9)} AS pr_auc
  FROM ({ranked_levels("(SELECT grp, p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY grp, p)", "grp")})
  GROUP BY grp"""
add("s08_run_log", _RUNS, "scored")
add("s09_best_run", f"SELECT run_id, model_name, pr_auc FROM ({_RUNS}) ORDER BY pr_auc DESC, run_id LIMIT 1", "scored")

# -- V ------------------------------------------------------------------------------

add("v02_invalid_targets", f"SELECT count(*) FILTER ({TARGET} NOT IN (0, 1)) AS n_invalid FROM panel", "panel")
_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_missing FROM panel" for c in ROLES.ordered
)
add("v03_missing_by_column", f"SELECT * FROM ({_MISSING}) WHERE n_missing > 0", "panel")
add(
    "v03_missing_total",
    f"""SELECT cast(coalesce(sum(n_missing), 0) AS bigint) AS n_missing,
    count(*) FILTER (n_missing > 0) AS n_columns_with_missing FROM ({_MISSING})""",
    "panel",
)
add(
    "v04_duplicate_rows",
    f"""SELECT 'clients' AS table_name, (SELECT count(*) FROM panel) - (SELECT count(*) FROM (SELECT DISTINCT {ALL25} FROM panel)) AS n_duplicate_rows
  UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem)
    - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem))""",
    "panel",
)
add(
    "v05_duplicate_ids",
    """SELECT 'clients' AS table_name, count(*) - count(DISTINCT id) AS n_duplicate_ids FROM panel
  UNION ALL SELECT 'lineitem', count(*) - count(DISTINCT l_orderkey) FROM lineitem""",
    "panel",
)
_CODES = " UNION ALL ".join(
    f"SELECT '{c}' AS attribute, {c} AS code FROM panel WHERE {c} NOT IN ({cols(map(str, CODEBOOK[c]))})" for c in CODEBOOK
)
add("v06_out_of_codebook", f"SELECT attribute, code, count(*) AS n FROM ({_CODES}) GROUP BY attribute, code", "panel")
add(
    "v07_default_rate",
    f"SELECT cast(sum({TARGET}) AS bigint) AS n_defaults, {r6(f'avg({TARGET})')} AS default_rate FROM panel",
    "panel",
)
add(
    "v08_quality_report",
    f"""SELECT count(*) AS n_rows, cast(25 AS bigint) AS n_columns, cast(21 AS bigint) AS n_features,
    (SELECT cast(sum(n_missing) AS bigint) FROM ({_MISSING})) AS n_missing,
    (SELECT string_agg(column_name || '=' || n_missing, ';' ORDER BY column_name) FROM ({_MISSING}) WHERE n_missing > 0) AS missing_by_column,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT {ALL25} FROM panel)) AS n_duplicate_rows,
    count(*) - count(DISTINCT id) AS n_duplicate_ids,
    count(*) FILTER ({TARGET} NOT IN (0, 1)) AS n_invalid_targets,
    cast(sum({TARGET}) AS bigint) AS n_defaults, round_even(avg({TARGET}), 6) AS default_rate,
    (SELECT string_agg(attribute || '.' || code || '=' || n, ';' ORDER BY attribute, cast(code AS string))
       FROM (SELECT attribute, code, count(*) AS n FROM ({_CODES}) GROUP BY ALL)) AS out_of_codebook
  FROM panel""",
    "panel",
)
add(
    "v09_scoring_batch",
    f"SELECT count(*) AS n_rows, count(*) FILTER ({' AND '.join(f'{c} IS NULL' for c in FEATURES)}) AS n_all_missing FROM panel",
    "panel",
)


def _rule(c: str, low, high) -> str:
    out = f"CASE WHEN {c} IS NULL THEN '{c}:missing'"
    if low is not None:
        out += f" WHEN {c} < {low} THEN '{c}:below {low}'"
    if high is not None:
        out += f" WHEN {c} > {high} THEN '{c}:above {high}'"
    return out + " END"


_REJECTIONS = f"list_filter([{', '.join(_rule(c, *b) for c, b in FIELD_RANGES.items())}], lambda v: v IS NOT NULL)"
add(
    "v10_quarantine",
    f"""SELECT id, len(r) = 0 AS accepted, array_to_string(r, ';') AS rejections
  FROM (SELECT id, {_REJECTIONS} AS r FROM panel)""",
    "panel",
)

# -- C, E ------------------------------------------------------------------------------

for _key, _c in (("c01_education", "education"), ("c02_marriage", "marriage"), ("c03_sex", "sex")):
    add(_key, f"SELECT id, {_c} FROM clean", "clean")
add("c04_features_target", f"SELECT {cols((*FEATURES, TARGET))} FROM clean", "clean")
add("c05_covariates", "SELECT id, sex, marriage FROM clean", "clean")
add("c06_clean", f"SELECT {ALL25} FROM clean", "clean")
add(
    "e00_safe_ratio",
    f"""SELECT id, {r6("coalesce(CASE WHEN isfinite(pay_amt1 / nullif(bill_amt1, 0)) THEN pay_amt1 / nullif(bill_amt1, 0) END, 0e0)")} AS ratio
  FROM clean""",
    "clean",
)
E_KEYS = {f"e{i:02d}_{c}": c for i, c in enumerate(ENGINEERED, start=1)}
for _key, _c in E_KEYS.items():
    _value = _c if _c == "recent_delay_flag" else f"{r6(_c)} AS {_c}"
    add(_key, f"SELECT id, {_value} FROM feats", "feats")

# -- P ------------------------------------------------------------------------------

add("p01_split", f"SELECT id, {TARGET}, split FROM parts", "parts")
add(
    "p03_split_profile",
    f"""SELECT split, count(*) AS n, cast(sum({TARGET}) AS bigint) AS n_defaults, {r6(f'avg({TARGET})')} AS default_rate,
    count(sex) AS n_sex, count(marriage) AS n_marriage, {r6('avg(limit_bal)')} AS mean_limit FROM parts GROUP BY split""",
    "parts",
)
add(
    "p04_folds",
    f"""SELECT id, cast({' + '.join(f'CASE WHEN rk > floor(({i}e0 / 5e0) * nc + 0.5e0) THEN 1 ELSE 0 END' for i in range(1, 5))} AS int) AS fold
  FROM (SELECT id, row_number() OVER (PARTITION BY {TARGET} ORDER BY h, id) AS rk, count(*) OVER (PARTITION BY {TARGET}) AS nc
    FROM parts WHERE split = 'train')""",
    "parts",
)

# -- F ------------------------------------------------------------------------------


def _long(names, value, source: str, **columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, " + ", ".join(f"{r6(v(c))} AS {k}" for k, v in columns.items()) + f" FROM {source}"
        for c in names
    )


add("f01_medians", _long(SCALED, None, "meds", median=lambda c: f"med_{c}"), "meds")
add("f02_most_frequent", "SELECT mode_education AS most_frequent FROM mode_education", "mode_education")
add(
    "f03_winsor_bounds",
    _long(SCALED, None, "bounds", low=lambda c: f"lo_{c}", high=lambda c: f"hi_{c}"),
    "bounds",
)
add(
    "f04_clipped",
    f"SELECT id, {', '.join(f'{r6(clipped(c))} AS {c}' for c in SCALED)} FROM parts, meds, bounds",
    "parts",
    "meds",
    "bounds",
)
add(
    "f05_scaling",
    _long(SCALED, None, "moments", mean=lambda c: f"mean_{c}", std=lambda c: f"std_{c}"),
    "moments",
)
add(
    "f06_one_hot",
    f"SELECT id, {', '.join(f'{one_hot(v)} AS cat__education_{v}' for v in (2, 3, 4))} FROM parts, mode_education",
    "parts",
    "mode_education",
)
add("f07_routed_columns", f"SELECT {cols((*SCALED, 'education'))} FROM (SELECT * REPLACE ({', '.join(f'{r6(c)} AS {c}' for c in ENGINEERED if c != 'recent_delay_flag')}) FROM feats)", "feats")
ENCODED = [*(f"num__{c}" for c in SCALED), *(f"cat__education_{v}" for v in (2, 3, 4))]
add(
    "f08_preprocess",
    f"SELECT id, split, {', '.join(f'{r6(encoded_sql(c), 4)} AS {c}' for c in ENCODED)} FROM parts, {PARAMS}",
    "parts",
    *PARAM_NEEDS,
)
add(
    "f09_engineered_step",
    f"SELECT {cols((*FEATURES, *(f'{r6(c)} AS {c}' if c != 'recent_delay_flag' else c for c in ENGINEERED)))} FROM feats",
    "feats",
)
add(
    "f10_feature_names",
    f"""SELECT cast(row_number() OVER () - 1 AS int) AS position, feature FROM (SELECT unnest([{', '.join(f"'num__{c}'" for c in SCALED)}]
    || (SELECT list('cat__education_' || education ORDER BY education)[2:] FROM (SELECT DISTINCT education FROM parts WHERE split = 'train'))) AS feature)""",
    "parts",
)
add("f11_reference_medians", _long(FEATURES, None, "meds", median=lambda c: f"med_{c}"), "meds")

# -- M ------------------------------------------------------------------------------

_WEIGHTED = f"""SELECT feature, cast(0 AS double) AS gradient, true AS curved FROM (
  SELECT unnest(['intercept', {', '.join(f"'num__{c}'" for c in SCALED)}]
    || (SELECT list('cat__education_' || education ORDER BY education)[2:]
        FROM (SELECT DISTINCT education FROM parts WHERE split = 'train'))) AS feature)"""
# at an optimum every gradient is zero
add("m02_optimum", _WEIGHTED, "parts")
add(
    "m11_optima",
    f"SELECT strategy, w.* FROM ({_WEIGHTED}) AS w, (VALUES ('unweighted'), ('class_weight_balanced')) AS s(strategy)",
    "parts",
)

_DUMMY = f"""CASE WHEN {h32(f"'{SEED}:' || cast(id AS string)")} / 4294967296e0
    < (SELECT avg({TARGET}) FROM parts WHERE split = 'train') THEN 1e0 ELSE 0e0 END"""
add("m01_dummy", f"SELECT id, {_DUMMY} AS p FROM parts WHERE split = 'validation'", "parts")
add(
    "m07_class_weights",
    f"""SELECT {TARGET}, count(*) AS n, {r6(f"(SELECT count(*) FROM parts WHERE split = 'train') / (2e0 * count(*))")} AS weight
  FROM parts WHERE split = 'train' GROUP BY {TARGET}""",
    "parts",
)
_CANDIDATES = {
    "dummy": f"SELECT {TARGET} AS y, {_DUMMY} AS p FROM parts WHERE split = 'validation'",
    "raw_scorecard": f"SELECT {TARGET} AS y, raw_p AS p FROM carded WHERE split = 'validation'",
    "calibrated_scorecard": f"SELECT {TARGET} AS y, cal_p AS p FROM carded WHERE split = 'validation'",
}
_COMPARED = " UNION ALL ".join(f"SELECT '{m}' AS model, * FROM ({suite(q, [0.5], places=4)})" for m, q in _CANDIDATES.items())
add("m09_comparison", _COMPARED, "parts", "carded")
add(
    "m10_selected_model",
    f"""SELECT model, pr_auc, complexity FROM (SELECT model, pr_auc, CASE model WHEN 'dummy' THEN -1 WHEN 'raw_scorecard' THEN 0 ELSE 1 END AS complexity,
      max(pr_auc) OVER () AS best FROM ({_COMPARED}))
  WHERE pr_auc >= best - 0.005e0 ORDER BY complexity, pr_auc DESC, model LIMIT 1""",
    "parts",
    "carded",
)

# -- K ------------------------------------------------------------------------------

# Platt scaling by Newton steps on the score levels; C = 1, intercept free.
_STEPS = 14
_newton = ["b0 AS MATERIALIZED (SELECT 0e0 AS a, 0e0 AS b)"]
for _i in range(1, _STEPS + 1):
    _newton.append(
        f"""b{_i} AS MATERIALIZED (SELECT a - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12) AS a,
      b - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12) AS b FROM (
    SELECT max(a) AS a, max(b) AS b, sum(w * m * p) - sum(pos * p) + max(a) AS g1, sum(w * m) - sum(pos) AS g2,
      sum(w * m * (1 - m) * p * p) + 1 AS h11, sum(w * m * (1 - m) * p) AS h12, sum(w * m * (1 - m)) AS h22
    FROM (SELECT p, pos, pos + neg AS w, a, b, 1e0 / (1e0 + exp(-(a * p + b))) AS m FROM levels, b{_i - 1})))"""
    )
_PLATT_HEAD = ", ".join(_newton)
_PLATT = f"1e0 / (1e0 + exp(-(a * p + b)))"


def with_platt(body: str) -> str:
    base = sql("", "levels").rstrip()
    return f"{base}, {_PLATT_HEAD} {body}"


# Isotonic fit by its max-min formula over the few score levels.
_ISO = """means AS MATERIALIZED (SELECT lo.p AS a, hi.p AS b, sum(m.pos) / cast(sum(m.pos + m.neg) AS double) AS mean
    FROM levels lo, levels hi, levels m WHERE lo.p <= hi.p AND m.p BETWEEN lo.p AND hi.p GROUP BY lo.p, hi.p),
  upper AS MATERIALIZED (SELECT l.p, m.a, min(m.mean) AS low FROM levels l JOIN means m ON m.a <= l.p AND m.b >= l.p GROUP BY l.p, m.a),
  iso AS MATERIALIZED (SELECT p, max(low) AS fitted FROM upper GROUP BY p)"""


def with_iso(body: str) -> str:
    return f"{sql('', 'levels').rstrip()}, {_ISO} {body}"


ORACLE["k01_sigmoid"] = with_platt(
    f"SELECT p, {r6(_PLATT, 5)} AS calibrated, count(*) AS n FROM scored, b{_STEPS} GROUP BY ALL"
)
ORACLE["k02_isotonic"] = with_iso(
    f"SELECT p, {r6('fitted')} AS calibrated, count(*) AS n FROM scored JOIN iso USING (p) GROUP BY ALL"
)
add(
    "k03_bounded",
    f"SELECT id, {r6('least(greatest(1.5e0 * raw_p - 0.2e0, 0e0), 1e0)')} AS p FROM carded",
    "carded",
)
ORACLE["k04_best_method"] = (
    f"{sql('', 'levels').rstrip()}, {_PLATT_HEAD}, {_ISO}, both_m AS (SELECT 'sigmoid' AS method, avg(({_PLATT} - y) * ({_PLATT} - y)) AS brier_score "
    f"FROM scored, b{_STEPS} UNION ALL SELECT 'isotonic', avg((fitted - y) * (fitted - y)) FROM scored JOIN iso USING (p)) "
    f"SELECT method AS selected, {r6('brier_score')} AS brier_score FROM both_m ORDER BY both_m.brier_score, method LIMIT 1"
)
add(
    "k05_calibration_gain",
    f"""SELECT {r6('a')} AS brier_raw, {r6('b')} AS brier_calibrated, {r6('a - b')} AS improvement
  FROM (SELECT avg((raw_p - {TARGET}) * (raw_p - {TARGET})) AS a, avg((cal_p - {TARGET}) * (cal_p - {TARGET})) AS b
    FROM carded WHERE split = 'test')""",
    "carded",
)
add(
    "k06_reliability",
    f"""SELECT bin, count(*) AS n, {r6('avg(p)')} AS mean_predicted, {r6('avg(y)')} AS observed_rate
  FROM (SELECT p, y, cast(len(list_filter(e, lambda v: v < p)) AS int) AS bin
    FROM scored, (SELECT quantile_cont(p, [{', '.join(f'{i}e0/10' for i in range(1, 10))}]) AS e FROM scored)) GROUP BY bin""",
    "scored",
)

# -- A ------------------------------------------------------------------------------

add("a01_hard_label", "SELECT y, p, CASE WHEN p >= 0.5e0 THEN 1 ELSE 0 END AS predicted, count(*) AS n FROM scored GROUP BY ALL", "scored")
add(
    "a02_confusion",
    f"""SELECT tp AS true_positives, tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp + tn + fp + fn AS n,
    tp + fn AS n_defaults FROM (SELECT {confusion_of('0.5e0')} FROM scored)""",
    "scored",
)
A_RATES = {
    "a03_accuracy": "accuracy",
    "a04_precision": "precision",
    "a05_recall": "recall",
    "a06_specificity": "specificity",
    "a07_f1": "f1",
}
for _key, _c in A_RATES.items():
    add(_key, f'SELECT {r6(chr(34) + _c + chr(34), 9)} AS "{_c}" FROM (SELECT {RATES} FROM (SELECT {confusion_of("0.5e0")} FROM scored))', "scored")
add(
    "a08_fpr_fnr",
    f"""SELECT {r6('false_positive_rate', 9)} AS false_positive_rate, {r6('false_negative_rate', 9)} AS false_negative_rate
  FROM (SELECT {RATES} FROM (SELECT {confusion_of('0.5e0')} FROM scored))""",
    "scored",
)
add("a09_roc_auc", f"SELECT {r6(AUC, 9)} AS roc_auc FROM curve", "curve")
add("a10_average_precision", f"SELECT {r6(AP, 9)} AS pr_auc FROM curve", "curve")
add("a11_brier", f"SELECT {r6('avg((p - y) * (p - y))', 9)} AS brier_score FROM scored", "scored")
add(
    "a12_log_loss",
    f"""SELECT {r6('-avg(CASE WHEN y = 1 THEN ln(least(greatest(p, 1e-15), 1 - 1e-15)) ELSE ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)) END)', 9)} AS log_loss
  FROM scored""",
    "scored",
)
add("a13_metric_suite", suite("SELECT * FROM scored", [0.5]), "scored")
add("a13_metric_suite_by_group", suite("SELECT * FROM scored", [0.3, 0.5], by="grp"), "scored")
add(
    "a14_roc_points",
    f"""SELECT p AS threshold, {r6('fp / cast(nn AS double)', 9)} AS fpr, {r6('tp / cast(np AS double)', 9)} AS tpr FROM curve
  UNION ALL SELECT NULL, 0e0, 0e0""",
    "curve",
)
add(
    "a15_pr_points",
    f"""SELECT p AS threshold, {r6('tp / cast(tp + fp AS double)', 9)} AS "precision", {r6('tp / cast(np AS double)', 9)} AS recall,
    {r6('np / cast(np + nn AS double)', 9)} AS prevalence FROM curve
  UNION ALL SELECT NULL, 1e0, 0e0, {r6('max(np) / cast(max(np + nn) AS double)', 9)} FROM curve""",
    "curve",
)
add("a16_business_cost", f"SELECT 0.17e0 AS threshold, 5e0 * fn + 1e0 * fp AS expected_cost FROM (SELECT {confusion_of('0.17e0')} FROM scored)", "scored")


def sweep_of(source: str, p: str = "p", y: str = "y") -> str:
    return f"""SELECT threshold, {ratio('tp', 'tp + fp')} AS "precision", {ratio('tp', 'tp + fn')} AS recall,
    {ratio('2 * tp', '2 * tp + fp + fn')} AS f1, {ratio('fp', 'fp + tn')} AS fpr, {ratio('fn', 'fn + tp')} AS fnr,
    5e0 * fn + 1e0 * fp AS expected_cost
  FROM (SELECT threshold, {confusion_of('threshold', p, y)} FROM (SELECT {p}, {y} FROM {source}),
      (SELECT unnest([{', '.join(f'{t!r}::double' for t in GRID)}]) AS threshold) GROUP BY threshold)"""


def choice_of(swept: str) -> str:
    return f"""SELECT arg_min(threshold, struct_pack(c := expected_cost, t := threshold)) AS operating_threshold,
    arg_max(threshold, struct_pack(c := f1, t := -threshold)) AS f1_optimal_threshold,
    arg_min(threshold, struct_pack(c := expected_cost, t := threshold)) AS cost_optimal_threshold,
    {r6('arg_min(f1, struct_pack(c := expected_cost, t := threshold))', 9)} AS f1_at_operating,
    min(expected_cost) AS expected_cost_operating, 'business_cost_minimisation' AS selection_rule FROM ({swept})"""


add(
    "a17_sweep",
    f"""SELECT threshold, {', '.join(f'{r6(chr(34) + c + chr(34), 9)} AS "{c}"' for c in ('precision', 'recall', 'f1', 'fpr', 'fnr'))}, expected_cost
  FROM ({sweep_of('scored')})""",
    "scored",
)
add("a18_thresholds", choice_of(sweep_of("scored")), "scored")
_TESTED = f"SELECT {TARGET} AS y, cal_p AS p FROM carded WHERE split = 'test'"
_F1_T = f"(SELECT f1_optimal_threshold FROM ({choice_of(sweep_of('(' + _TESTED + ')'))}))"
add(
    "a19_saved_model_audit",
    f"""SELECT 'operating' AS rule, 'test' AS split, * FROM ({suite(_TESTED, [sc.APPROVE], places=6)})
  UNION ALL SELECT 'f1_optimal', 'test', * FROM ({suite(_TESTED, [0.0], places=6).replace('0.0::double', _F1_T)})""",
    "carded",
)
add("a20_class_distribution", f"SELECT y, count(*) AS n, {r6('count(*) / cast(sum(count(*)) OVER () AS double)')} AS share FROM scored GROUP BY y", "scored")

# -- G ------------------------------------------------------------------------------


def audited_sql(source: str, keys: str, t: str, p: str, y: str) -> str:
    return f"""SELECT {keys}, n, tp + fn AS n_defaults, {r6(ratio('tp + fn', 'n'), 9)} AS base_rate,
    {r6(ratio('tp + fp', 'n'), 9)} AS selection_rate, {r6(ratio('tp', 'tp + fp'), 9)} AS "precision", {r6(ratio('tp', 'tp + fn'), 9)} AS recall,
    {r6(ratio('fp', 'fp + tn'), 9)} AS false_positive_rate, {r6(ratio('fn', 'fn + tp'), 9)} AS false_negative_rate
  FROM (SELECT {keys}, count(*) AS n, {confusion_of(t, p, y)} FROM ({source}) GROUP BY ALL)"""


def label_case(c: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in GROUP_LABELS[c].items())
    return f"CASE {c} {whens} ELSE coalesce(cast({c} AS string), 'unknown') END"


_BAND = (
    "CASE WHEN age IS NULL OR age <= 0 THEN 'unknown' "
    + " ".join(f"WHEN age <= {u} THEN '{v}'" for u, v in AGE_BANDS if u is not None)
    + f" ELSE '{AGE_BANDS[-1][1]}' END"
)
add("g01_group_metrics", audited_sql("SELECT * FROM scored", "grp", "0.5e0", "p", "y"), "scored")
add(
    "g02_group_labels",
    f"SELECT id, {label_case('sex')} AS sex, {label_case('marriage')} AS marriage, {label_case('education')} AS education FROM panel",
    "panel",
)
add("g03_age_bands", f"SELECT id, {_BAND} AS age_band FROM panel", "panel")
_AUDIT = audited_sql(
    " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, {label} AS \"group\", cal_p AS p, {TARGET} AS y FROM carded"
        for a, label in (("sex", label_case("sex")), ("marriage", label_case("marriage")), ("age_band", _BAND))
    ),
    'attribute, "group"',
    repr(sc.APPROVE) + "::double",
    "p",
    "y",
)
add("g04_audit", _AUDIT, "carded")
add("s06_csv_reports", _AUDIT, "carded")
add(
    "g05_disparity",
    " UNION ALL ".join(
        f"""SELECT attribute, '{m}' AS metric, {r6(f'min({m})')} AS min, {r6(f'max({m})')} AS max, {r6(f'max({m}) - min({m})')} AS spread
  FROM ({_AUDIT}) GROUP BY attribute"""
        for m in ("recall", "false_positive_rate", "false_negative_rate", "selection_rate")
    ),
    "carded",
)
add(
    "s07_json_reports",
    f"""SELECT cast(to_json(struct_pack(grp := grp, true_positives := tp, true_negatives := tn, false_positives := fp, false_negatives := fn)) AS string) AS value
  FROM (SELECT grp, {confusion_of('0.5e0')} FROM scored GROUP BY grp)""",
    "scored",
)

# -- D ------------------------------------------------------------------------------


def tier_sql(p: str) -> str:
    return f"CASE WHEN {p} < {sc.APPROVE!r}::double THEN 'LOW' WHEN {p} < {sc.DECLINE!r}::double THEN 'MEDIUM' ELSE 'HIGH' END"


def decision_sql(p: str) -> str:
    return f"CASE WHEN {p} < {sc.APPROVE!r}::double THEN 'APPROVE' WHEN {p} < {sc.DECLINE!r}::double THEN 'REVIEW' ELSE 'DECLINE' END"


def score_sql(p: str) -> str:
    return f"cast(round_even(1000e0 * (1e0 - least(greatest({p}, 0e0), 1e0)), 0) AS int)"


add("d01_probability", f"SELECT id, {r6('raw_p')} AS raw_probability, {r6('cal_p')} AS default_probability FROM carded", "carded")
add("d02_predicted_label", f"SELECT id, CASE WHEN cal_p >= {sc.APPROVE!r}::double THEN 1 ELSE 0 END AS label FROM carded", "carded")
add("d03_risk_tier", f"SELECT p, {tier_sql('p')} AS risk_tier, count(*) AS n FROM scored GROUP BY ALL", "scored")
add("d04_decision", f"SELECT p, {decision_sql('p')} AS decision, count(*) AS n FROM scored GROUP BY ALL", "scored")
add("d05_risk_score", f"SELECT id, {score_sql('bill_amt1 / 1e6')} AS risk_score FROM panel", "panel")
_SCORED = f"""SELECT id, {r6('cal_p')} AS default_probability, {tier_sql('cal_p')} AS risk_tier, {decision_sql('cal_p')} AS decision,
    {score_sql('cal_p')} AS risk_score FROM carded"""
add("d06_batch_score", _SCORED, "carded")
add("s10_model_round_trip", _SCORED, "carded")
_PAYLOAD = f"""SELECT id, round_even(cal_p, 6) AS default_probability, {tier_sql('cal_p')} AS risk_tier, {decision_sql('cal_p')} AS decision,
    {score_sql('cal_p')} AS risk_score, 'scorecard-1' AS model_version FROM carded"""
add("d07_payload", _PAYLOAD, "carded")
add(
    "d08_portfolio",
    f"""SELECT risk_tier, decision, count(*) AS n, {r6('avg(cal_p)')} AS mean_probability
  FROM (SELECT {tier_sql('cal_p')} AS risk_tier, {decision_sql('cal_p')} AS decision, cal_p FROM carded) GROUP BY ALL""",
    "carded",
)

# -- X ------------------------------------------------------------------------------


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def factors_of(source: str) -> str:
    """Top eight of each sign from (id, feature, contribution, shown)."""
    return f"""SELECT id, direction, cast(place AS int) AS place, feature, shown + 0e0 AS contribution FROM (
    SELECT *, CASE WHEN contribution > 0 THEN 'risk_increasing' ELSE 'protective' END AS direction,
      row_number() OVER (PARTITION BY id, contribution > 0 ORDER BY abs(contribution) DESC, feature) AS place
    FROM ({source}) WHERE contribution <> 0) WHERE place <= 8"""


_TERMS = " UNION ALL ".join(
    f"SELECT id, {quoted(_shown(c))} AS feature, ({w!r}::double) * ({encoded_sql(c)}) AS contribution FROM parts, {PARAMS}"
    for c, w in sc.WEIGHTS.items()
)
add(
    "x03_linear_contributions",
    factors_of(f"SELECT *, round_even(contribution, 4) AS shown FROM ({_TERMS})"),
    "parts",
    *PARAM_NEEDS,
)


def _reset(c: str) -> str:
    return f"CASE WHEN reset = '{c}' THEN med_{c} ELSE cast({c} AS double) END AS {c}"


_RESETS = f"""(SELECT clean.id, reset, {', '.join(_reset(c) for c in FEATURES)}
  FROM clean, meds, (SELECT unnest(['', {', '.join(quoted(c) for c in FEATURES)}]) AS reset))"""
_VARIANTS = f"SELECT id, reset, {CALIBRATED_P} AS p FROM ({engineered(_RESETS)}), {PARAMS}"
_LABEL = "CASE v.reset " + " ".join(f"WHEN '{c}' THEN {quoted(_shown(c))}" for c in FEATURES) + " END"
_ABLATED = factors_of(
    f"""SELECT v.id, {_LABEL} AS feature, round_even(b.p - v.p, 4) AS contribution, round_even(b.p - v.p, 4) AS shown
    FROM ({_VARIANTS}) v JOIN ({_VARIANTS}) b ON b.id = v.id AND b.reset = '' WHERE v.reset <> ''"""
)
add("x04_ablation", _ABLATED, "clean", *PARAM_NEEDS)
add(
    "x06_feature_labels",
    f"""SELECT feature, label, {r6('value', 4)} AS mean_value FROM ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {quoted(_shown(c))} AS label, avg({encoded_sql(c)}) AS value FROM parts, {PARAMS}" for c in ENCODED)})""",
    "parts",
    *PARAM_NEEDS,
)
_RAW_LABELS = {**{c: _shown(c) for c in FEATURES}}
add(
    "x07_top_importances",
    f"""SELECT feature, {r6('importance')} AS importance, label FROM (
    {' UNION ALL '.join(f"SELECT 'num__{c}' AS feature, abs(corr(cast({c} AS double), cast({TARGET} AS double))) AS importance, {quoted(_shown(c))} AS label FROM parts WHERE split = 'train'" for c in SCALED)})
  ORDER BY importance DESC, feature LIMIT 20""",
    "parts",
)

# -- N ------------------------------------------------------------------------------

add("n01_target_counts", f"SELECT {TARGET}, count(*) AS n FROM panel GROUP BY {TARGET}", "panel")
add(
    "n02_default_rate_by_attribute",
    " UNION ALL ".join(
        f"SELECT '{c}' AS attribute, {c} AS code, {r6(f'avg({TARGET})')} AS default_rate FROM panel WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in ("sex", "education", "marriage")
    ),
    "panel",
)
_DESCRIBED = ("limit_bal", "age", "bill_amt1", "pay_amt1")
add(
    "n03_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS "count", {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std,
    {r6(f'cast(min({c}) AS double)')} AS min, {r6(f'quantile_cont(cast({c} AS double), 0.25e0)')} AS q25,
    {r6(f'quantile_cont(cast({c} AS double), 0.5e0)')} AS q50, {r6(f'quantile_cont(cast({c} AS double), 0.75e0)')} AS q75,
    {r6(f'cast(max({c}) AS double)')} AS max FROM panel"""
        for c in _DESCRIBED
    ),
    "panel",
)
add(
    "n04_histograms",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, cast(least(floor((least(greatest(cast({c} AS double), lo), hi) - lo) / ((hi - lo) / 40)), 39) AS int) AS bin, count(*) AS n
  FROM panel, (SELECT quantile_cont(cast({c} AS double), 0.01e0) AS lo, quantile_cont(cast({c} AS double), 0.99e0) AS hi FROM panel)
  WHERE {c} IS NOT NULL GROUP BY ALL"""
        for c in _DESCRIBED
    ),
    "panel",
)
add(
    "n05_engineered_means_by_target",
    f"""SELECT {TARGET}, {', '.join(f'{r6(f"avg({c})")} AS {c}' for c in ('payment_delay_rate', 'max_delay_months', 'credit_utilization', 'payment_to_bill_ratio'))}
  FROM feats GROUP BY {TARGET}""",
    "feats",
)

# -- T ------------------------------------------------------------------------------

add("t01_stream_scores", _PAYLOAD, "carded")
add(
    "t02_stream_quarantine",
    f"""SELECT id, len(r) = 0 AS accepted, CASE WHEN len(r) = 0 THEN round_even(cal_p, 6) END AS default_probability,
    CASE WHEN len(r) > 0 THEN array_to_string(r, ';') END AS rejections
  FROM (SELECT id, {_REJECTIONS} AS r FROM panel) JOIN (SELECT id, cal_p FROM carded) USING (id)""",
    "panel",
    "carded",
)
add("t03_stream_explanations", _ABLATED, "clean", *PARAM_NEEDS)
