"""Physical-plan properties the design relies on (checked on sf0.001)."""

import contextlib
import io
import re

import pytest

from tests.conftest import SF_SMALL
from velotide.registry import QUERIES


def plan(spark, name) -> str:
    df = QUERIES[name](spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def shuffles_on(p: str, key: str) -> int:
    return len(re.findall(rf"Exchange\s*\nInput [^\n]*\nArguments: hashpartitioning\({key}", p))


def test_month_run_prunes_raw_partitions(spark):
    p = plan(spark, "incremental_month")
    assert re.search(r"PartitionFilters: \[.*source_month#\d+ = 2024-01-01", p)


@pytest.mark.parametrize("name", ["trip_history", "fct_trip", "fct_status", "agg_daily_trip_summary"])
def test_dimension_sides_are_broadcast(spark, name):
    p = plan(spark, name)
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p


def test_station_daily_is_one_shuffle_rollup(spark):
    p = plan(spark, "agg_station_daily")
    assert p.count("Union") >= 1
    assert shuffles_on(p, "station_key") == 1          # the (station, day) rollup
    assert "partial_sum" in p                           # map-side combine before it
    assert "FullOuter" not in p


def test_station_activity_is_one_shuffle(spark):
    p = plan(spark, "agg_station_activity")
    assert shuffles_on(p, "station_key") == 1 and "FullOuter" not in p


def test_dedups_limit_before_the_shuffle(spark):
    p = plan(spark, "status_dedup_logical")
    assert re.search(r"WindowGroupLimit.*\n(.*\n){0,3}.*Partial", p) or "Partial" in p.split("WindowGroupLimit")[-1]
    assert p.count("WindowGroupLimit") >= 4             # partial + final for both dedups


def test_variant_counts_combine_map_side(spark):
    p = plan(spark, "station_variants")
    assert "partial_count" in p
