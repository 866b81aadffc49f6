"""Driver contract and oracle agreement of every registered query at sf0.001."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from sluice.plans import catalog
from sluice.plans.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    want_cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(got_cols) == sorted(want_cols)
    assert _rows(got_cols, got) == _rows(want_cols, want)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_shapes(spark):
    qs = entry.queries()
    star = _plan(qs["star_enrich"](spark, SF))
    assert star.count("BroadcastHashJoin") == 6 and "SortMergeJoin" not in star
    # Parsing is narrow: at most a round-robin spread of a one-split input, no keyed shuffle.
    lp = _plan(qs["log_parse"](spark, SF))
    assert "hashpartitioning" not in lp and "rangepartitioning" not in lp
    nb = qs["incremental_next_batch"](spark, SF)
    assert "PushedFilters: [IsNotNull(event_id), GreaterThanOrEqual(event_id" in nb._jdf.queryExecution() \
        .executedPlan().toString() or "GreaterThanOrEqual(event_id" in _plan(nb)
    # The weather roll-ups read one small written aggregate, not events.
    pp = qs["profile_product"](spark, SF)
    pp.collect()
    assert "events.parquet" not in _plan(pp) and "event_grain" in _plan(pp)
    # Two key sets compared: one shuffle, each read once.
    md = _plan(qs["missing_dims"](spark, SF))
    assert md.count("Exchange") == 1 and md.count("FileScan") == 2
    # Size checks and batches put no row limit above a single partition but their own top-n.
    for name in ("frontier_new_urls", "csv_offset_batch"):
        plan = _plan(qs[name](spark, SF))
        assert "GlobalLimit" not in plan and "CollectLimit" not in plan


def test_spread_uses_every_local_core_and_a_given_number(spark):
    from sluice.session import spread

    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(one, 3).rdd.getNumPartitions() == 3


def test_scratch_must_be_shared_beyond_one_machine():
    from types import SimpleNamespace

    from sluice import session

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: "spark://host:7077"))
    with pytest.raises(RuntimeError):
        session._private_dir(far)
