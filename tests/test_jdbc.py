"""JDBC reader: argument checks (no database server may run in the test environment)."""

import pytest

from leadscope.sources.jdbc import read_table


def test_range_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        read_table(spark, "jdbc:none://x", "t", partition_column="id", num_partitions=4)
