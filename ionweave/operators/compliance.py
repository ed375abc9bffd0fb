"""Do a dataset and its calibration run use the same acquisition scheme?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compliance_report(
    dataset: DataFrame, calibration: DataFrame, energy: str = "CollisionEnergy", strict: bool = False
) -> DataFrame:
    """Lowest energies, constancy of the calibration energy, and equality of the schemes.

    The schemes agree if the tables hold the same rows, with the same repeats, once the
    energy column is left out.  ``complies`` is false if they do not, or if the dataset goes
    below the calibration energy.  ``strict=True`` raises in that case.  One scan of each
    table and one shuffle of pre-aggregated rows.
    """
    rest = [c for c in dataset.columns if c != energy]
    same_columns = set(rest) == {c for c in calibration.columns if c != energy}
    keys = rest if same_columns else []

    def side(df: DataFrame, is_dataset: bool) -> DataFrame:
        e = F.col(energy)
        return df.select(
            *keys,
            F.lit(1 if is_dataset else -1).alias("_balance"),
            (e if is_dataset else F.lit(None).cast(df.schema[energy].dataType)).alias("_d"),
            (F.lit(None).cast(df.schema[energy].dataType) if is_dataset else e).alias("_c"),
            F.lit(0 if is_dataset else 1).alias("_c_rows"),
            (F.lit(False) if is_dataset else e.isNull()).alias("_c_null"),
        )

    rows = side(dataset, True).unionByName(side(calibration, False))
    groups = rows.groupBy(*keys).agg(
        F.sum("_balance").alias("_balance"),
        F.min("_d").alias("_d"),
        F.min("_c").alias("_c"),
        F.max("_c").alias("_c_max"),
        F.sum("_c_rows").alias("_c_rows"),
        F.bool_or("_c_null").alias("_c_null"),
    )
    constant = (F.min("_c") == F.max("_c_max")) & ~F.bool_or("_c_null")
    report = groups.agg(
        F.min("_d").alias("dataset_min_collision_energy"),
        F.min("_c").alias("calibration_min_collision_energy"),
        F.when(F.coalesce(F.sum("_c_rows"), F.lit(0)) == 0, F.raise_error(F.lit("the calibration is empty")).cast("boolean"))
        .otherwise(F.coalesce(constant, F.lit(False)))
        .alias("constant_collision_energy"),
        (F.lit(same_columns) & F.coalesce(F.max(F.abs("_balance")) == 0, F.lit(True))).alias("schemes_agree"),
    )
    too_low = F.coalesce(
        F.col("dataset_min_collision_energy") < F.col("calibration_min_collision_energy"), F.lit(False)
    )
    report = report.withColumn("complies", F.col("schemes_agree") & ~too_low)
    if strict:
        row = report.first()
        if not row["schemes_agree"]:
            raise ValueError("dataset and calibration have different window schemes")
        if not row["complies"]:
            raise ValueError("the dataset has collision energies below the calibration")
    return report
