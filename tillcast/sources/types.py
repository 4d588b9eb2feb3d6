"""Typing text columns: by rule (forecast results) and by looking at the values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.texts import composite_key, key_part


def type_results(text: DataFrame, store_width: int = 3) -> DataFrame:
    """Typed forecast results from an all-text table: the composite id is split, numbers cast
    (bad text becomes NULL), the store zero-padded, columns renamed, and the series key added."""
    numbers = {c: F.col(c).try_cast("double") for c in ("predict_sales", "predict_error", "upper", "order_prediction")}
    # lpad alone would cut longer codes off.
    padded = F.when(F.length("store_code") >= store_width, F.col("store_code")).otherwise(
        F.lpad("store_code", store_width, "0"))
    return (text.withColumns({"item_id": key_part("full_item", 1).try_cast("int"),
                              "variant_id": key_part("full_item", 2).try_cast("int"),
                              "week": F.col("week").try_cast("int"),
                              "store_code": padded, **numbers})
            .withColumn("item_store", composite_key("full_item", "store_code"))
            .withColumnsRenamed({"week": "week_key", "predict_sales": "forecast", "order_prediction": "order_qty"}))


def infer_types(text: DataFrame, required: list[str] = ()) -> DataFrame:
    """Text columns as bigint if all their values are, else double if all are, else text.

    One aggregate counts the failures of all columns; rows without the required ids go first."""
    rows = text.dropna(subset=list(required)) if required else text
    names = [c for c, t in rows.dtypes if t == "string"]
    fails = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"{c}\x1f{t}")
             for c in names for t in ("bigint", "double")]
    if not fails:
        return rows
    bad = rows.agg(*fails).first().asDict()

    def kind(c: str) -> str:
        return next((t for t in ("bigint", "double") if bad[f"{c}\x1f{t}"] == 0), "string")

    return rows.withColumns({c: F.col(c).cast(kind(c)) for c in names})
