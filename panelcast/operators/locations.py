"""Location keys, the location map and geography relabelling (SCA-1, SCA-10, SET-5, AGG-3, PAN-2..4, JOI-7/8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast import config as C


def strip_ws(col) -> F.Column:
    """Remove leading/trailing whitespace (like Python ``str.strip``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, r"^[\s　]+|[\s　]+$", "")


def location_key(col) -> F.Column:
    """SCA-1: null -> '', strip, 臺 -> 台, drop normal and full-width spaces."""
    c = F.col(col) if isinstance(col, str) else col
    s = strip_ws(c.cast("string"))
    s = F.translate(s, "臺", "台")
    s = F.regexp_replace(s, "[ 　]", "")
    return F.coalesce(s, F.lit(""))


def scan_locations(dim_location: DataFrame) -> DataFrame:
    """SRC-6: distinct (old_name, new_name, branch_t) with a branch; an empty dimension is an error."""
    missing = {"old_name", "new_name", "branch_t"} - set(dim_location.columns)
    if missing:
        raise RuntimeError(f"the location table lacks {sorted(missing)}")
    if dim_location.isEmpty():
        raise RuntimeError("the location table has no rows")
    return dim_location.select("old_name", "new_name", "branch_t").where(F.col("branch_t").isNotNull()).distinct()


def expand_locations(base: DataFrame) -> DataFrame:
    """SET-5: one row per name (old and new) of a place: (county_key, new_name, branch_t); blank names are left out."""
    new_clean = F.coalesce(strip_ws(F.col("new_name").cast("string")), F.lit("None"))
    branch = strip_ws(F.col("branch_t").cast("string"))

    def valid(c):
        return F.col(c).isNotNull() & (strip_ws(F.col(c).cast("string")) != "")

    return (
        base.where(valid("old_name")).select(location_key("old_name").alias("county_key"), new_clean.alias("new_name"), branch.alias("branch_t"))
        .unionByName(
            base.where(valid("new_name")).select(location_key("new_name").alias("county_key"), new_clean.alias("new_name"), branch.alias("branch_t"))
        )
    )


def location_conflicts(expanded: DataFrame) -> DataFrame:
    """AGG-3: keys that belong to more than one branch, and how many."""
    return expanded.groupBy("county_key").agg(F.countDistinct("branch_t").alias("n_branch")).where(F.col("n_branch") > 1)


def build_location_map(dim_location: DataFrame) -> DataFrame:
    """PAN-2: (county_key, new_name, branch_t), one row per key; a key with two branches is an error.

    Errors give the number of conflicts and a few names.
    """
    expanded = expand_locations(scan_locations(dim_location))
    conflicts = location_conflicts(expanded)
    bad = conflicts.count()
    if bad:
        some = [r[0] for r in conflicts.orderBy("county_key").limit(5).collect()]
        raise RuntimeError(f"{bad} places belong to more than one branch, first of them {some}")
    picked = expanded.groupBy("county_key").agg(F.min(F.struct("branch_t", "new_name")).alias("_m"))
    return picked.select("county_key", F.col("_m.new_name").alias("new_name"), F.col("_m.branch_t").alias("branch_t"))


def unmapped_places(df: DataFrame, location_map: DataFrame) -> DataFrame:
    """JOI-8: the distinct place names that the location map does not know."""
    keyed = df.where(F.col("county").isNotNull()).select(F.col("county").cast("string"), location_key("county").alias("county_key"))
    return keyed.join(location_map.select("county_key"), "county_key", "left_anti").select("county").distinct()


def map_county_to_branch(df: DataFrame, location_map: DataFrame, check: bool = True) -> DataFrame:
    """JOI-7 / JOI-8: county -> branch label; unmapped names are an error (listed)."""
    if "county" not in df.columns:
        raise RuntimeError("branches are looked up by county, which the table lacks")
    keyed = df.withColumn("county_key", location_key("county"))
    m = location_map.select("county_key", "branch_t")
    if check:
        names = unmapped_places(df, location_map)
        missing = names.count()
        if missing:
            some = [r[0] for r in names.orderBy(1).limit(5).collect()]
            raise RuntimeError(f"{missing} places have no branch, first of them {some}")
    out = keyed.join(m, "county_key", "left")
    return out.withColumn("county", F.col("branch_t").cast("string")).drop("county_key", "branch_t")


def relabel_offshore(col="county", offshore=C.OFFSHORE_COUNTIES, label=C.OFFSHORE_LABEL) -> F.Column:
    """SCA-10: trimmed county, offshore set -> one label."""
    c = strip_ws(F.col(col).cast("string"))
    return F.when(c.isin(*offshore), F.lit(label)).otherwise(c)
