"""Evaluation: long predictions, metric levels with GROUPING SETS, final model choice.

AGG-4..6, AGG-13, COL-17, COL-18, FIL-11, FIL-13, JOI-15, REP-1, SET-6.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast import config as C
from panelcast.functions.metrics import METRIC_NAMES, metric_aggs, valid_pair
from panelcast.operators.features import directional_hit

LEVELS = ("overall", "by_disease", "by_county", "by_disease_county", "by_lead_week")


def to_long(wide: DataFrame, id_cols, model_cols, name_col: str = "model_name", value_col: str = "y_pred",
            drop_missing: bool = True) -> DataFrame:
    """SET-6 / JOI-15: one row per (row, model) from a wide prediction matrix."""
    long = wide.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in model_cols]).unpivot(
        list(id_cols), list(model_cols), name_col, value_col
    )
    return long.where(F.col(value_col).isNotNull()) if drop_missing else long


def with_hit(long: DataFrame, model_cols=("model_name",), key_cols=C.KEY_COLS) -> DataFrame:
    """WIN-8 per model and series, on the rows where the model predicted."""
    return directional_hit(long, [*model_cols, *key_cols])


def metric_levels(long: DataFrame, group_cols, by_lead_week: bool = False, add_hit: bool = True,
                  key_cols=C.KEY_COLS) -> DataFrame:
    """AGG-5 / AGG-6: metrics per model at overall, disease, county, disease x county (and lead week).

    ``long`` has key_cols, yearweek, y_true, y_pred and the ``group_cols``
    (context + model identity, constant inside a model). One Expand + hash
    aggregate computes every level.
    """
    df = with_hit(long, group_cols, key_cols) if add_hit else long
    df = df.where(valid_pair("y_true", "y_pred"))
    sets = [list(group_cols), [*group_cols, "disease"], [*group_cols, "county"], [*group_cols, "disease", "county"]]
    cols = [*group_cols, "disease", "county"]
    if by_lead_week:
        sets.append([*group_cols, "lead_week"])
        cols.append("lead_week")
    g = df.groupingSets(sets, *cols).agg(
        *metric_aggs("y_true", "y_pred", "_hit"),
        F.grouping("disease").alias("_gd"),
        F.grouping("county").alias("_gc"),
        *([F.grouping("lead_week").alias("_gl")] if by_lead_week else []),
    )
    lvl = (
        F.when(F.col("_gl") == 0, F.lit("by_lead_week")) if by_lead_week else F.when(F.lit(False), F.lit(""))
    )
    lvl = (
        lvl.when((F.col("_gd") == 1) & (F.col("_gc") == 1), F.lit("overall"))
        .when(F.col("_gc") == 1, F.lit("by_disease"))
        .when(F.col("_gd") == 1, F.lit("by_county"))
        .otherwise(F.lit("by_disease_county"))
    )
    out = g.select(
        *group_cols,
        lvl.alias("metric_level"),
        F.coalesce(F.col("disease").cast("string"), F.lit("ALL")).alias("disease"),
        F.coalesce(F.col("county").cast("string"), F.lit("ALL")).alias("county"),
        *([F.col("lead_week")] if by_lead_week else []),
        "n_obs",
        *METRIC_NAMES,
    )
    return out


def with_context(df: DataFrame, context: dict) -> DataFrame:
    """COL-18: literal context columns (source, task, run settings, prediction type)."""
    return df.select(*[F.lit(v).alias(k) for k, v in context.items() if k not in df.columns], "*")


def select_final_model(metric_df: DataFrame, meta_model: str, meta_eval_type: str) -> DataFrame:
    """REP-1: the final model of each (source, task).

    The combiner wins only when its evaluation was honest (``rolling_meta_oof``)
    and its overall WAPE is below the best base model's; else the best base
    model; else the combiner. Returns one row per (data_source, model_task)
    with final_model_name, final_model_layer, selected_wape.
    """
    layer, name = C.combiner_layer(meta_model), C.combiner_model_name(meta_model)
    overall = metric_df.where(F.col("metric_level") == "overall")
    keys = [c for c in ("data_source", "model_task") if c in metric_df.columns]
    fin = F.col("WAPE").isNotNull() & ~F.isnan("WAPE") & (F.abs(F.col("WAPE")) != float("inf"))
    base = (
        overall.where((F.col("model_layer") == "base") & fin)
        .groupBy(*keys)
        .agg(F.min_by(F.struct("WAPE", "model_name"), F.struct("WAPE", "model_name")).alias("_b"))
    )
    comb = (
        overall.where((F.col("model_layer") == layer) & (F.col("model_name") == name))
        .groupBy(*keys)
        .agg(F.first(F.when(fin, F.col("WAPE")), ignorenulls=True).alias("_stack_wape"))
    )
    j = base.join(comb, keys, "full")
    honest = F.lit(meta_eval_type == "rolling_meta_oof") & F.col("_stack_wape").isNotNull()
    use_stack = honest & (F.col("_b.WAPE").isNull() | (F.col("_stack_wape") < F.col("_b.WAPE")))
    has_base = F.col("_b.model_name").isNotNull()
    return j.select(
        *keys,
        F.when(use_stack, F.lit(name)).when(has_base, F.col("_b.model_name")).otherwise(F.lit(name)).alias("final_model_name"),
        F.when(use_stack, F.lit(layer)).when(has_base, F.lit("base")).otherwise(F.lit(layer)).alias("final_model_layer"),
        F.when(use_stack, F.col("_stack_wape")).when(has_base, F.col("_b.WAPE")).alias("selected_wape"),
    )
