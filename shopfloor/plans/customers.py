"""Customer profile: residence and employee status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.operators.aggregation import latest

EMPLOYEE_TYPE = "O"  # fixed value


def _branded(df: DataFrame, brand: str | None) -> DataFrame:
    return df if brand is None else df.where(F.col("brand_code") == brand)


def latest_customer_type(history: DataFrame, brand: str | None = None) -> DataFrame:
    """The newest type change of each customer; a change without a time counts as newest."""
    return latest(_branded(history, brand).select("customer_id", "upgrade_date_time"), ["customer_id"], "upgrade_date_time")


def _with_residence(customers: DataFrame, types: DataFrame, addresses: DataFrame, provinces: DataFrame, brand) -> DataFrame:
    known = types.select(F.col("code").alias("customer_type_code"))
    where = _branded(addresses, brand).select("customer_id", "province_code")
    area = provinces.select(
        F.col("code").alias("province_code"),
        F.when(F.col("country_code") != "OTHERS", F.col("country_code")).alias("_country"),
    )
    return (
        _branded(customers, brand)
        .join(known, F.col("customer_type") == F.col("customer_type_code"), "left")
        .join(where, "customer_id", "left")
        .join(area, "province_code", "left")
        .select(
            "customer_id", "birth_year", "gender_code", "customer_type_code",
            F.coalesce("_country", "exact_country").alias("residence_country"),
        )
    )


def employee_flag(
    customers: DataFrame,
    types: DataFrame,
    addresses: DataFrame,
    provinces: DataFrame,
    residences: DataFrame,
    brand: str | None = None,
) -> DataFrame:
    """Severity per customer and profile group: 2 current employee, 1 other group of one, 0 none.

    The current group is the one holding the customer's newest type change. A change pairs
    with every address of the customer, so ties between addresses settle it: lowest
    residence, birth year, gender, type code, NULLs first. The type history therefore never
    has to be multiplied with the addresses.
    """
    rows = _with_residence(customers, types, addresses, provinces, brand).distinct()
    order = ("residence_country", "birth_year", "gender_code", "customer_type_code")
    fields = [F.col(c) for c in order]
    # A struct minimum compares field by field with NULLs first.
    current = rows.groupBy("customer_id").agg(F.min(F.struct(*fields)).alias("_now"))
    employee = F.coalesce(F.col("customer_type_code") == EMPLOYEE_TYPE, F.lit(False))
    is_current = F.struct(*fields).eqNullSafe(F.col("_now"))
    codes = residences.select("residence_country", F.col("country_code").alias("_code"))
    return (
        rows.join(current, "customer_id")
        .withColumn("_flag", F.when(employee & is_current, 2).when(employee, 1).otherwise(0))
        .join(codes, "residence_country", "left")
        .groupBy("customer_id", "birth_year", "gender_code", F.col("_code").alias("residence_country"))
        .agg(F.max("_flag").alias("emp_flag"))
    )


def customer_profile(customers, types, addresses, provinces, residences, brand: str | None = None) -> DataFrame:
    """One row per customer and profile group with employee status E, F or NULL."""
    flags = employee_flag(customers, types, addresses, provinces, residences, brand)
    return flags.select(
        "customer_id",
        "birth_year",
        F.col("gender_code").alias("gender"),
        "residence_country",
        F.when(F.col("emp_flag") == 2, "E").when(F.col("emp_flag") == 1, "F").alias("employee_status_code"),
    )
