"""Plan-shape checks: the scale properties the README promises, read off the physical plan."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def physical(df):
    """Root of the physical plan (under AQE: the plan AQE starts from)."""
    p = df._jdf.queryExecution().executedPlan()
    return p.executedPlan() if p.nodeName() == "AdaptiveSparkPlan" else p


def scans(plan, table):
    return [n for n in _nodes(plan) if "Scan" in n.nodeName() and f"{table}.parquet" in n.toString()]


def broadcast_subtrees(plan):
    return [n for n in _nodes(plan) if n.nodeName() == "BroadcastExchange"]


def test_fact_scan_reads_only_needed_columns(spark):
    p = physical(E.queries()["fact_week_estab_cause"](spark, SF_SMALL))
    (scan,) = scans(p, "lineitem")
    cols = set(scan.output().toString().replace("List(", "").replace(")", "").split(", "))
    names = {c.split("#")[0] for c in cols}
    assert "l_comment" not in names and "l_shipinstruct" not in names
    assert {"l_suppkey", "l_partkey", "l_quantity", "l_shipdate"} <= names


@pytest.mark.parametrize("name", ["fact_week_estab_cause", "season_report", "lag_correlation"])
def test_fact_side_is_never_broadcast(spark, name):
    p = physical(E.queries()[name](spark, SF_SMALL))
    for b in broadcast_subtrees(p):
        assert not scans(b, "lineitem") and not scans(b, "orders"), b.toString()


def test_dimension_beyond_bound_is_shuffled_not_broadcast(spark):
    spark.conf.set("hebdo.broadcast.maxRows", "0")
    try:
        p = physical(E.queries()["fact_week_estab_cause"](spark, SF_SMALL))
    finally:
        spark.conf.unset("hebdo.broadcast.maxRows")
    for b in broadcast_subtrees(p):
        assert not scans(b, "supplier") and not scans(b, "part"), b.toString()
    assert any(n.nodeName() in ("ShuffledHashJoin", "SortMergeJoin") for n in _nodes(p))
    # within the bound the same dimensions are broadcast
    p = physical(E.queries()["fact_week_estab_cause"](spark, SF_SMALL))
    assert any(scans(b, "supplier") for b in broadcast_subtrees(p))


SUMMED = ["cases_by_date", "cases_by_year_week", "cases_by_commune", "cases_by_age_group", "cases_by_establishment", "top_communes",
          "year_week_heatmap", "cases_by_week_of_year", "cases_by_city_week", "lag_correlation", "peak_alert_report", "peaks_left_names",
          "dim_time", "dim_commune", "normalize_key_text", "linear_trend", "label_year_week"]


def _raw_exchanges(plan):
    """Exchanges of line items that no aggregate has reduced."""
    def below(node):
        if "Aggregate" in node.nodeName() or "Exchange" in node.nodeName():
            return []
        children = node.children()
        return [node] + [x for i in range(children.size()) for x in below(children.apply(i))]

    out = []
    for n in _nodes(plan):
        if "Exchange" in n.nodeName():
            under = [x for i in range(n.children().size()) for x in below(n.children().apply(i))]
            if any("lineitem.parquet" in x.toString() and "Scan" in x.nodeName() for x in under):
                out.append(n)
    return out


@pytest.mark.parametrize("name", SUMMED)
def test_past_the_bound_line_items_are_summed_before_any_shuffle(spark, name):
    spark.conf.set("hebdo.broadcast.maxRows", "0")
    try:
        p = physical(E.queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.unset("hebdo.broadcast.maxRows")
    assert _raw_exchanges(p) == []


@pytest.mark.parametrize("name", ["fact_week_estab_cause", "cases_by_cause", "dim_cause", "dedupe_by_key", "dedupe_rows", "fk_orphans_cause"])
def test_past_the_bound_line_items_move_once_for_their_cause(spark, name):
    spark.conf.set("hebdo.broadcast.maxRows", "0")
    try:
        p = physical(E.queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.unset("hebdo.broadcast.maxRows")
    assert len(_raw_exchanges(p)) == 1


@pytest.mark.parametrize("name", ["peak_alert_report", "peaks_left_names", "fact_left_season", "row_col_counts"])
def test_line_items_are_scanned_once(spark, name):
    """The checkpointed queries read the lines while they are built; their plans hold no scan of them."""
    p = physical(E.queries()[name](spark, SF_SMALL))
    assert len(scans(p, "lineitem")) == (0 if name in ("fact_left_season", "row_col_counts") else 1)
