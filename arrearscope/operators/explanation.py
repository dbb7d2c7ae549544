"""Global importances and per-client factors."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from statistics import fmean, pstdev

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrearscope.functions.engineered import STAGES, engineer
from arrearscope.functions.labels import label_sql
from arrearscope.functions.scalars import name, number, seeded_hash, sigmoid, text
from arrearscope.operators.cleaning import clean
from arrearscope.operators.curves import areas
from arrearscope.operators.scoring import RiskModel, decision, risk_tier, set_aside
from arrearscope.roles import FEATURES, ROLES, SEED
from arrearscope.session import tidy, written

TOP_FACTORS = 8
TOP_IMPORTANCES = 20
REPEATS = 5
#: Rows ranked by one task, about; any number gives the same ranks.
ROWS_PER_RANGE = 200_000

FACTOR_TYPE = "array<struct<feature:string,contribution:double>>"


# -- global ------------------------------------------------------------------------


def feature_importance(spark: SparkSession, model: RiskModel) -> DataFrame:
    """(feature, importance, label): tree importances or absolute coefficients."""
    names = model.prep.names
    if model.linear is not None:
        values = [abs(model.linear.coefficients[c]) for c in names]
    else:
        values = [float(v) for v in model.classifier.featureImportances.toArray()]
    if len(values) != len(names):
        raise ValueError(f"{len(values)} importances for {len(names)} features")
    rows = spark.createDataFrame(list(zip(names, values)), "feature string, importance double")
    return rows.withColumn("label", F.expr(label_sql("feature"))).orderBy(F.desc("importance"), "feature")


def top_importances(importance: DataFrame, n: int = TOP_IMPORTANCES) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def _ranked(rows: DataFrame, seed: str, parts: int) -> DataFrame:
    """Append ``_rank``: the 0-based place in the order of (hash of seed and id, id, values).

    The hash is cut into equal ranges, which are ranked on their own and shifted by the
    rows of lower ranges; the number of ranges does not change the order.
    """
    h = seeded_hash(seed, ROLES.id)
    placed = rows.selectExpr("*", f"{h} AS _h").selectExpr("*", f"cast(_h * {parts} DIV 4294967296 AS int) AS _part")
    totals = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    order = Window.partitionBy("_part").orderBy("_h", ROLES.id, *FEATURES, "y")
    ranked = placed.join(offsets, "_part").withColumn("_rank", F.col("_before") + F.row_number().over(order) - 1)
    return ranked.drop("_h", "_part", "_before")


def _donors(df: DataFrame, repeats: int, seed: int) -> DataFrame:
    """Append ``donors``: for each repeat, the features of the row at the same place in another order.

    Orders follow from hashes of seed, repeat and id, so donors do not depend on the
    layout of the table, and each repeat is a permutation of all rows.
    """
    rows = written(df.select(ROLES.id, *FEATURES, "y"), "permutation-rows")
    parts = 1 + rows.count() // ROWS_PER_RANGE
    placed = _ranked(rows, f"{seed}:0", parts)
    for r in range(1, repeats + 1):
        other = _ranked(rows, f"{seed}:{r}", parts)
        placed = placed.join(other.select("_rank", F.struct(*FEATURES).alias(f"_donor_{r}")), "_rank")
    given = [f"_donor_{r}" for r in range(1, repeats + 1)]
    return placed.withColumn("donors", F.array(*given)).drop("_rank", *given)


def permutation_importance(
    model: RiskModel,
    df: DataFrame,
    features: tuple[str, ...] = FEATURES,
    repeats: int = REPEATS,
    seed: int = SEED,
    target: str = ROLES.target,
    parallelism: int = 4,
) -> DataFrame:
    """Mean and std of the ROC-AUC drop when a raw column is permuted.

    Feature by feature, every row becomes one variant per repeat that takes the
    donors' value of that column only; the areas of all repeats come from one grouped
    curve, whose scores are dropped before the next feature; ``parallelism`` features
    are in work at a time. Uses the uncalibrated probability.
    """
    spark = df.sparkSession
    with tidy(spark):
        placed = written(_donors(df.select(ROLES.id, *FEATURES, F.col(target).alias("y")), repeats, seed), "permutation")

        # the variants are data, so the scoring code is generated once for all features
        swapped = [
            f"if(permuted = {text(c)}, get(donors, turn - 1).{name(c)}, {name(c)}) AS {name(c)}" if c in features else name(c)
            for c in FEATURES
        ]

        def areas_of(permuted: str, turns: range) -> list[float | None]:
            pairs = ", ".join(f"named_struct('permuted', {text(permuted)}, 'turn', {r})" for r in turns)
            rows = placed.selectExpr("*", f"inline(array({pairs}))").selectExpr("turn", "y", *swapped)
            with tidy(spark):  # a row per repeat
                found = areas(model.raw_probability(rows, "p").select("turn", "y", "p"), by=("turn",)).collect()
            return [r["roc_auc"] for r in found]

        [baseline] = areas_of("", range(1))

        def importance_of(c: str) -> tuple[str, float | None, float | None]:
            drops = [baseline - a for a in areas_of(c, range(1, repeats + 1)) if None not in (a, baseline)]
            return c, fmean(drops) if drops else None, pstdev(drops) if drops else None

        with ThreadPoolExecutor(parallelism) as pool:
            found = list(pool.map(inheritable_thread_target(spark)(importance_of), features))
    importance = spark.createDataFrame(found, "feature string, importance_mean double, importance_std double")
    return importance.withColumn("label", F.expr(label_sql("feature"))).orderBy(F.desc("importance_mean"), "feature")


# -- per client ----------------------------------------------------------------------


def _strongest(factors: str, top_k: int, decimals: int | None = None) -> tuple[str, str]:
    """(risk-increasing, protective): the top factors of each sign, by name on ties."""

    def ranked(sign: int) -> str:
        kept = f"filter({factors}, f -> f.contribution * {sign} > 0)"
        keyed = f"transform({kept}, f -> struct(f.contribution * {-sign} AS k, f.feature AS feature))"
        value = f"f.k * {-sign}"
        if decimals is not None:
            value = f"bround({value}, {decimals})"
        return (
            f"transform(slice(array_sort({keyed}), 1, {top_k}), "
            f"f -> struct(f.feature AS feature, {value} AS contribution))"
        )

    return ranked(1), ranked(-1)


def linear_contributions(
    model: RiskModel, df: DataFrame, top_k: int = TOP_FACTORS
) -> DataFrame | None:
    """Exact log-odds contributions per row, or None for a non-linear model."""
    linear = model.linear
    if linear is None:
        return None
    inputs = df.selectExpr(*FEATURES, set_aside(df.columns))
    rows = model.prep.encode(engineer(clean(inputs)), keep=("_in",))
    factors = ", ".join(
        f"named_struct('feature', {label_sql(text(c))}, 'contribution', {term})"
        for c, term in linear.terms().items()
    )
    up, down = _strongest("_factors", top_k, 4)
    return rows.selectExpr("_in", f"array({factors}) AS _factors").selectExpr(
        "_in.*", f"{up} AS risk_increasing", f"{down} AS protective"
    )


def _replaced(sql: str, columns: dict[str, str]) -> str:
    """SQL with column names, quoted or not, replaced."""
    for column, other in columns.items():
        sql = re.sub(rf"`{column}`|\b{column}\b", other, sql)
    return sql


def _linear_variants(model: RiskModel, df: DataFrame) -> DataFrame:
    """(_in, _z, _z0, _z1, ...): log-odds of a row, and with each feature at its training median.

    A reset feature changes its own model input and the engineered features made of it;
    only these are computed again, stage by stage, as further columns of the row. All
    other terms of the sum are shared, and terms keep their order, so the log-odds equal
    those of scoring the changed row.
    """
    reference, linear = model.prep.reference, model.linear
    # what a reset feature changes: column -> the SQL of its other value
    changed = {c: {c: number(float(reference[c]))} for c in FEATURES}
    rows = clean(df.selectExpr(*FEATURES, set_aside(df.columns)))
    rows = rows.selectExpr("_in", *[f"cast({name(c)} AS double) AS {name(c)}" for c in FEATURES])
    for stage in STAGES:
        made = {c: sql for c, sql in stage.items()}
        for i, c in enumerate(FEATURES):
            for column, sql in stage.items():
                other = _replaced(sql, changed[c])
                if other != sql:
                    made[f"_{i}_{column}"] = other
        rows = rows.selectExpr("*", *[f"{sql} AS {name(c)}" for c, sql in made.items()])
        for i, c in enumerate(FEATURES):
            changed[c] |= {column: name(f"_{i}_{column}") for column in stage if f"_{i}_{column}" in made}
    inputs = model.prep.encoded()
    weights = {c: number(float(w)) for c, w in linear.coefficients.items()}
    terms = {f"_t_{j}": f"{w} * ({inputs[c]})" for j, (c, w) in enumerate(weights.items())}
    sums = [list(terms)]
    for i, c in enumerate(FEATURES):
        own = []
        for j, (column, w) in enumerate(weights.items()):
            other = _replaced(inputs[column], changed[c])
            if other != inputs[column]:
                terms[f"_t_{i}_{j}"] = f"{w} * ({other})"
            own.append(f"_t_{i}_{j}" if other != inputs[column] else f"_t_{j}")
        sums.append(own)
    rows = rows.selectExpr("_in", *[f"{sql} AS {c}" for c, sql in terms.items()])
    start = number(float(linear.intercept))
    names = ["_z", *[f"_z{i}" for i in range(len(FEATURES))]]
    return rows.selectExpr("_in", *[f"{' + '.join([start, *own])} AS {z}" for z, own in zip(names, sums)])


def _linear_ablation(model: RiskModel, df: DataFrame) -> DataFrame:
    """(_in, default_probability, _factors) of a linear model: a projection, row by row."""
    rows = _linear_variants(model, df)
    names = [c for c in rows.columns if c != "_in"]
    rows = rows.selectExpr("_in", *[f"{sigmoid(c)} AS {c}" for c in names])
    if model.calibrator is not None:
        for c in names:
            rows = model.calibrator.apply(rows, c, f"_p{c}").drop(c)
        names = [f"_p{c}" for c in names]
    base, *resets = names
    factors = ", ".join(
        f"struct({label_sql(text(c))} AS feature, bround({base} - {p}, 4) AS contribution)" for c, p in zip(FEATURES, resets)
    )
    return rows.selectExpr("_in", f"{base} AS default_probability", f"array({factors}) AS _factors")


def _exploded_ablation(model: RiskModel, df: DataFrame) -> DataFrame:
    """(_in, default_probability, _factors, _copies) of any model, by scoring every variant.

    Rows are spread by a hash of their values before the fan-out, so the
    variants of a row stay in their task and are put together again without a second
    shuffle. Equal rows are counted map-side and explained once; a repeated task finds
    the same keys.
    """
    reference = model.prep.reference
    packed = df.selectExpr(*FEATURES, set_aside(df.columns))
    row = F.md5(F.to_json("_in", {"ignoreNullFields": "false"})).alias("_row")
    keyed = clean(packed).groupBy(row).agg(F.first(F.struct("_in", *FEATURES)).alias("_one"), F.count("*").cast("int").alias("_copies"))
    keyed = keyed.selectExpr("_row", "_copies", "_one.*")
    resets = ", ".join(text(c) for c in ("", *FEATURES))
    reset = keyed.selectExpr("*", f"explode(array({resets})) AS _reset").selectExpr(
        "_row",
        "_reset",
        "if(_reset = '', _in, NULL) AS _in",
        "if(_reset = '', _copies, NULL) AS _copies",
        *[
            f"if(_reset = {text(c)}, {number(float(reference[c]))}, cast({name(c)} AS double)) AS {name(c)}"
            for c in FEATURES
        ],
    )
    scored = model.probability(reset, "_p", cleaned=True, keep=("_row", "_reset")).select("_row", "_reset", "_in", "_copies", "_p")
    gathered = scored.groupBy("_row").agg(
        F.expr("first(_in, true) AS _in"),
        F.expr("max(_copies) AS _copies"),
        F.expr("max(if(_reset = '', _p, NULL)) AS default_probability"),
        F.expr("collect_list(if(_reset <> '', struct(_reset AS feature, _p AS p), NULL)) AS _variants"),
    )
    change = "bround(default_probability - v.p, 4)"
    factors = f"transform(_variants, v -> struct({label_sql('v.feature')} AS feature, {change} AS contribution))"
    return gathered.selectExpr("_in", "default_probability", f"{factors} AS _factors", "_copies")


def ablation_contributions(model: RiskModel, df: DataFrame, top_k: int = TOP_FACTORS) -> DataFrame:
    """Change of the calibrated probability when one feature is reset to its training median.

    The 22 variants of a row are further columns of it for a linear model, without any
    shuffle, and rows of their own for others. Every row is listed once.
    """
    if not model.prep.reference:
        empty = F.array().cast(FACTOR_TYPE)
        return model.probability(df).withColumns({"risk_increasing": empty, "protective": empty})
    up, down = _strongest("_factors", top_k)
    factors = (f"{up} AS risk_increasing", f"{down} AS protective")
    if model.linear is not None:
        return _linear_ablation(model, df).selectExpr("_in.*", "default_probability", *factors)
    listed = _exploded_ablation(model, df).selectExpr("_in", "default_probability", "_copies", *factors)
    again = listed.selectExpr("*", "explode(array_repeat(0, _copies)) AS _copy")
    return again.selectExpr("_in.*", "default_probability", "risk_increasing", "protective")


def explained(model: RiskModel, df: DataFrame, top_k: int = TOP_FACTORS) -> DataFrame:
    """Probability, tier, decision and ablation factors per row."""
    tier = risk_tier("default_probability", model.approve_threshold, model.decline_threshold)
    factors = ablation_contributions(model, df, top_k)
    return factors.selectExpr("*", f"{tier} AS risk_tier", f"{decision(tier)} AS decision").withColumn(
        "default_probability", F.bround("default_probability", 6)
    )
