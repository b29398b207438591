"""Physical plans: what is read, what is shuffled, and what is never done."""

import re

import pytest

from clonewell import plans


def plan_of(spark, folder, name):
    return plans.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, columns",
    [
        ("p5_found", {"line_id", "readbase", "called_at"}),
        ("p5_sequences", {"line_id", "readbase", "called_at", "bclen"}),
        ("read_fates", {"readbase", "qual", "bclen", "loaded_at"}),
        ("value_histogram", {"bclen"}),
        ("match_pairs", {"query_id", "ref_id", "mismatch", "indel", "dist"}),
        ("top_operations", {"op", "refpos"}),
    ],
)
def test_only_needed_columns_are_read(spark, small_tables, name, columns):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>(?:,|\n|$)", plan_of(spark, small_tables[0], name))
    read = {x.split(":")[0] for s in schemas for x in s.split(",")}
    assert read == columns


@pytest.mark.parametrize("name", ["p5_found", "read_fates", "precluster_quality", "histogram_of_histogram", "base_composition"])
def test_aggregates_hash_and_combine_before_the_shuffle(spark, small_tables, name):
    plan = plan_of(spark, small_tables[0], name)
    assert "SortAggregate" not in plan and plan.count("HashAggregate") >= 2


@pytest.mark.parametrize("name", ["neighbor_join", "nearest_library_match", "genotype_jaccard", "region_join", "fuzzy_counts", "precluster_members", "paired_loci"])
def test_no_pairwise_comparison_of_tables(spark, small_tables, name):
    plan = plan_of(spark, small_tables[0], name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["jackpot", "no_match_fraction", "connected_components", "reads_with_calls"])
def test_filters_reach_the_scan(spark, small_tables, name):
    plan = plan_of(spark, small_tables[0], name)
    assert "PushedFilters" in plan
