"""Physical plans: no task that all rows meet in, no nested loops over rows, filters and columns pushed to the scan."""

import pytest

from curata.plans import catalog

SF = "/root/testdata/sf0.001"


#: Plans with one task over aggregates: a row per partition, a row per group.
COUNTED = {"duplicate_groups": 1, "balanced_oversample": 1}


def plan(spark, name):
    return catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["duplicate_groups", "numbered_ids", "balanced_oversample", "hamming_pairs", "feature_distributions", "unique_theta_match", "pilot_leakage", "leakage_pairs", "split_fingerprint", "downstream_summary", "reviews_applied"])
def test_no_single_task_over_rows(spark, name):
    text = plan(spark, name)
    lines = text.splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(single) <= COUNTED.get(name, 0)
    assert all("HashAggregate" in "".join(lines[i + 1 : i + 3]) for i in single)
    assert "CartesianProduct" not in text
    assert name == "balanced_oversample" or "NestedLoop" not in text  # there: one row, the largest group's size


def test_the_gate_grid_meets_cells(spark):
    lines = plan(spark, "gate_sweep").splitlines()
    loop = next(i for i, line in enumerate(lines) if "NestedLoop" in line)
    assert any("HashAggregate" in line or "AQEShuffleRead" in line or "Exchange" in line for line in lines[loop + 1 : loop + 6])  # rows are counted before


def test_round_robin_drops_what_a_group_cannot_give(spark):
    assert "WindowGroupLimit" in plan(spark, "round_robin_pick")


def test_scans_read_what_is_asked(spark):
    text = plan(spark, "line_renumber")
    assert "PushedFilters" in text and "l_extendedprice" not in text
