"""What the runs read: calendar and places come from tables that are already made, not from further passes over the large ones."""

import datetime as dt

from panelcast.operators import locations as L
from panelcast.plans import catalog as K
from panelcast.sources import calendar as CA
from panelcast.sources import testviews as TV


def tables(spark, path) -> str:
    """Rows of the four weeks from 2000-01-03 on; one supplier without lines, one line without a date."""
    day = [dt.datetime(2000, 1, 3) + dt.timedelta(days=i) for i in range(28)]
    made = {
        "region": spark.createDataFrame([(0, "R0"), (1, "R1")], "r_regionkey int, r_name string"),
        "nation": spark.createDataFrame([(0, "N0", 0), (1, "N1", 1), (2, "N2", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "s_suppkey long, s_nationkey int"),
        "lineitem": spark.createDataFrame([(1 + i % 2, "A", d) for i, d in enumerate(day)] + [(3, "A", None)],
                                          "l_suppkey long, l_returnflag string, l_shipdate timestamp"),
        "orders": spark.createDataFrame([(d,) for d in day], "o_orderdate timestamp"),
    }
    for name, df in made.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_calendar_and_places_do_not_read_the_large_tables_again(spark, tmp_path, monkeypatch):
    sf, read, passes = tables(spark, tmp_path), {}, []

    def spied(module, name):
        run = getattr(module, name)

        def call(df, *args):
            read[name] = df.inputFiles()
            return run(df, *args)

        monkeypatch.setattr(module, name, call)

    whole = TV.dim_weekdate
    monkeypatch.setattr(TV, "dim_weekdate", lambda t: passes.append(1) or whole(t))
    monkeypatch.setattr(K, "_MEMO", {})
    spied(CA, "calendar_features")
    spied(L, "build_location_map")
    places = sorted((r["county_key"], r["branch_t"]) for r in K.location_map(spark, sf).collect())
    days, weeks = K.weekdate(spark, sf).count(), {r["yearweek"]: r for r in K.calendar(spark, sf).collect()}
    assert places == [("N0", "R0"), ("N1", "R1")]
    assert days == 366 + 365 and weeks[200005]["eve"] == 4 and weeks[200041]["di_period"] == 1
    assert len(passes) == 1 and read == {"calendar_features": [], "build_location_map": []}
