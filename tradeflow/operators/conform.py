"""Normalise long trade rows and conform products to codes and categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean_label, parse_month
from .filters import drop_missing, exclude_values
from .lookup import lookup, lookup_default, materialize_mapped


def normalize_trade(df: DataFrame, measure: str, invalid_reporters: Sequence[str],
                    excluded_partners: Sequence[str], *, date_col: str = "date",
                    keep: Sequence[str] = (), date_kind: str | None = None) -> DataFrame:
    """Clean labels, parse the month, drop incomplete rows and non-country labels.

    Input columns: country, date (text month), product, indicator, partner,
    ``measure`` and any ``keep`` columns (lineage). Output adds year and month.
    Exclusions apply to the cleaned labels. With ``date_kind``, a value that
    was a real date cell (kind ``'date'``) is taken as that date; text must
    match the month format.
    """
    date = parse_month(date_col)
    if date_kind is not None:
        date = F.when(F.col(date_kind) == F.lit("date"),
                      F.substring(F.col(date_col), 1, 10).try_cast("date")).otherwise(date)
    cleaned = df.select(
        clean_label("country").alias("country"),
        date.alias("date"),
        F.col("product"), F.col("indicator"),
        clean_label("partner").alias("partner"),
        F.col(measure),
        *[F.col(c) for c in keep],
        # spark_partition_id() is nondeterministic, so Catalyst keeps the
        # filters below above this projection: each label is cleaned once
        # instead of again inside every pushed-down predicate.
        F.spark_partition_id().alias("__part"),
    )
    out = drop_missing(cleaned.where(F.col("__part") >= 0), ["country", "partner", "date", measure])
    out = exclude_values(out, "country", invalid_reporters)
    out = exclude_values(out, "partner", excluded_partners).drop("__part")
    return out.withColumns({"year": F.year("date"), "month": F.month("date")})


def strict_inline(df: DataFrame, source: str, target: str, context: str) -> DataFrame:
    """In-plan mapping check: the job fails on the first unmapped value.

    No extra job runs, but only one offending value is reported; use
    :func:`~tradeflow.operators.lookup.materialize_mapped` for the full list.
    """
    bad = F.col(target).isNull() & F.col(source).isNotNull()
    msg = F.concat(F.lit(f"Unmapped values in {context}: {source} -> {target}: "), F.col(source).cast("string"))
    # The check is a filter condition (true or raise), so it runs for every row
    # that reaches it; a checked output column would only be evaluated for rows
    # that survive later filters.
    checked = df.where(F.when(bad, F.raise_error(msg)).otherwise(F.lit(True)))
    # Nondeterministic barrier: filters written after the check (e.g. on
    # looked-up flags) must not move below it, where they would drop the
    # unmapped rows first or turn the lookup into an inner join.
    return checked.withColumn("__check", F.spark_partition_id()).where(F.col("__check") >= 0).drop("__check")


def conform_tyre(df: DataFrame, product_dim: DataFrame, category_dim: DataFrame, context: str,
                 *, eager: bool | None = True) -> DataFrame:
    """product -> hs_code, category -> general_category, all strict.

    ``eager``: True writes the rows now and fails with the full list of unmapped
    values (:func:`~tradeflow.operators.lookup.materialize_mapped`);
    False fails the job in-plan on the first one; None leaves the check to the
    caller (e.g. on the written output).
    """
    out = lookup(df, product_dim, "product", ["hs_code", "category"])
    out = lookup(out, category_dim, "category", ["general_category"])
    checks = [("product", "hs_code"), ("product", "category"), ("category", "general_category")]
    if eager:
        return materialize_mapped(out, checks, context)
    if eager is not None:
        for source, target in checks:
            out = strict_inline(out, source, target, context)
    return out


def conform_vehicle(df: DataFrame, product_dim: DataFrame, general_dim: DataFrame,
                    excluded_hs: Sequence[str], context: str, *, eager: bool | None = True) -> DataFrame:
    """product -> hs_code (strict); excluded headings out; hs -> general, default Other, Other out."""
    out = lookup(df, product_dim, "product", ["hs_code"])
    if eager:
        out = materialize_mapped(out, [("product", "hs_code")], context)
    elif eager is not None:
        out = strict_inline(out, "product", "hs_code", context)
    out = exclude_values(out, "hs_code", excluded_hs)
    out = lookup_default(out, general_dim, "hs_code", {"general_category": "Other"})
    return out.where(F.col("general_category") != F.lit("Other"))


def combined_product_dim(tyre_products: DataFrame, tyre_categories: DataFrame,
                         vehicle_products: DataFrame, vehicle_general: DataFrame,
                         excluded_hs: Sequence[str]) -> DataFrame:
    """One dictionary ``product -> type, hs_code, category, general_category, keep``.

    Lets a single fact stream carrying both branches be conformed with one
    broadcast join. ``keep`` is false where the vehicle rules drop the product
    (excluded heading, or general category ``Other``).
    """
    tyre = (tyre_products.join(tyre_categories, "category", "left")
            .select("product", F.lit("Tyre").alias("type"), "hs_code", "category",
                    "general_category", F.lit(True).alias("keep")))
    vehicle = (vehicle_products.join(vehicle_general, "hs_code", "left")
               .select("product", F.lit("Vehicle").alias("type"), "hs_code",
                       F.lit(None).cast("string").alias("category"),
                       F.coalesce("general_category", F.lit("Other")).alias("general_category")))
    vehicle = vehicle.withColumn(
        "keep", ~F.col("hs_code").isin(list(excluded_hs)) & (F.col("general_category") != F.lit("Other")))
    return tyre.unionByName(vehicle)
