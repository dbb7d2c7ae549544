"""Client tables: explicit-schema scans, renaming, fingerprint and preview."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrearscope.functions.scalars import hash32, name, text
from arrearscope.roles import CLIENT_SCHEMA, RAW_NAMES, ROLES, Roles

CANONICAL_TO_RAW = {v: k for k, v in RAW_NAMES.items()}

#: The client table under its delivered header names.
RAW_SCHEMA = T.StructType(
    [T.StructField(CANONICAL_TO_RAW[f.name], f.dataType) for f in CLIENT_SCHEMA.fields]
)

#: What the banner row above the header holds in place of the first feature.
BANNER_CELL = "X1"


def rename_raw(df: DataFrame) -> DataFrame:
    """Delivered header names to canonical names; others pass through."""
    return df.withColumnsRenamed(RAW_NAMES)


def project_canonical(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Known columns in canonical order; unknown ones are dropped."""
    return df.select(*[c for c in roles.ordered if c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is null everywhere after the scan: NaN sorts above all numbers."""
    return df.withColumns(
        {
            f.name: F.when(~F.isnan(f.name), F.col(f.name))
            for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        }
    )


def to_raw(df: DataFrame) -> DataFrame:
    """Canonical to delivered names, for writing the exchange form."""
    return df.select(*[F.col(c).alias(CANONICAL_TO_RAW.get(c, c)) for c in df.columns])


def _require(found: list[str], path: str) -> None:
    """Every delivered column must be in the file; a scan would fill an absent one with nulls."""
    absent = [f.name for f in RAW_SCHEMA.fields if f.name not in found]
    if absent:
        raise ValueError(f"columns not in {path}: {', '.join(absent)}")


def _read_typed(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    _require(spark.read.format(fmt).load(path).columns, path)
    table = spark.read.schema(RAW_SCHEMA).format(fmt).load(path)
    return project_canonical(nan_to_null(rename_raw(table)))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return _read_typed(spark, path, "parquet")


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return _read_typed(spark, path, "orc")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV delivered with a banner row above the header, in any number of files.

    Files split across tasks, so "the second line" has no meaning there; the
    banner and header rows are recognised by their content, and columns are taken
    by the names in the header, which all files must share. Absent and unknown
    names raise. Files without any header are taken in the delivered order. A
    malformed number raises under ANSI casts instead of turning into a silent null.
    """
    rows = spark.read.option("header", False).csv(path)
    key = CANONICAL_TO_RAW[ROLES.id]
    cells = F.array(*rows.columns)
    headers = rows.filter(F.array_contains(cells, key)).select(cells.alias("names")).distinct().limit(2).collect()
    if len(headers) > 1:
        raise ValueError(f"the files of {path} have different headers")
    names = headers[0]["names"] if headers else [f.name for f in RAW_SCHEMA.fields]
    if len(names) != len(rows.columns):
        raise ValueError(f"{path} has no header and not the delivered number of columns")
    _require(names, path)
    known = {f.name for f in RAW_SCHEMA.fields}
    if unknown := [n for n in names if n not in known]:
        raise ValueError(f"unknown columns in {path}: {', '.join(map(str, unknown))}")
    rows = rows.toDF(*names)
    header = F.col(key) == key
    banner = F.array_contains(F.array(*names), BANNER_CELL)
    rows = rows.filter(~F.coalesce(header, F.lit(False)) & ~F.coalesce(banner, F.lit(False)))
    typed = rows.select(*[_number(f) for f in RAW_SCHEMA.fields])
    return project_canonical(nan_to_null(rename_raw(typed)))


def _number(f: T.StructField):
    value = F.col(f.name).cast("double")  # spreadsheets may write 2 as 2.0
    return value.cast(f.dataType).alias(f.name) if f.name != CANONICAL_TO_RAW[ROLES.id] else F.col(
        f.name
    ).cast("decimal(20,2)").cast("bigint").alias(f.name)


READERS = {"parquet": read_parquet, "orc": read_orc, "csv": read_csv}


def load_clients(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read, rename, canonicalise missing values and order the columns."""
    if fmt not in READERS:
        raise ValueError(f"format must be one of {sorted(READERS)}, got {fmt!r}")
    return READERS[fmt](spark, path)


def fingerprint(df: DataFrame, roles: Roles = ROLES, columns: tuple[str, ...] | None = None) -> DataFrame:
    """16 hex digits over the column names, the row contents and the row count.

    Row hashes are summed, so the value does not depend on row order or
    partitioning. By default the id and the label are hashed; pass ``columns``
    to cover more.
    """
    hashed = columns or (roles.id, roles.target)
    cells = ", ".join(f"coalesce(cast({name(c)} AS string), '?')" for c in hashed)
    row = hash32(f"concat_ws('|', {cells})")
    content = f"cast(sum(cast({row} AS decimal(38,0))) AS string)"
    parts = f"concat_ws(',', {text('|'.join(df.columns))}, {content}, cast(count(*) AS string))"
    return df.selectExpr(f"substring(sha2({parts}, 256), 1, 16) AS fingerprint")


def preview(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Rows, columns, target rate and fingerprint in one row."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.avg(roles.target).alias("target_rate"),
    ).withColumn("fingerprint", fingerprint(df, roles).scalar())
