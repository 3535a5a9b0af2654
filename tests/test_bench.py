"""The bench times every method once."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402

from lagjoin.plans.catalog import CATALOG  # noqa: E402


def test_no_aliases_in_the_bench():
    functions = [CATALOG[name][0] for name in bench.HEADLINE]
    assert len(set(functions)) == len(functions)
    assert {n for names in bench.PHASES.values() for n in names} == set(bench.HEADLINE)
