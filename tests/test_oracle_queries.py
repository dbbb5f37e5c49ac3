"""Every registered batch query equals its DuckDB oracle on the smallest tables.

(The driver's gate runs the same pairs at sf0.01; ``tools/check_oracle.py``
does it locally.)  Stream keys are covered in ``test_streaming.py``.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from rideflux.plans import catalog
from tests.conftest import SF_SMALL, assert_same

SLOW_PREFIXES = ("stream_", "raw_", "replay_", "table_history", "compact_gold", "quarantine_", "backfill_", "pipeline_")
BATCH_KEYS = sorted(k for k in catalog.queries() if not k.startswith(SLOW_PREFIXES))


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(catalog.oracle_sql()) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["window_start", "window_end", "zone_id", "zone_name"]
    assert df.count() > 0


@pytest.mark.parametrize("name", BATCH_KEYS)
def test_query_matches_oracle(spark, name):
    assert_same(catalog.queries()[name](spark, SF_SMALL), catalog.oracle_sql()[name], SF_SMALL)


def test_registry_loads_without_a_spark_session():
    """The driver may ask for the SQL before any session exists."""
    import subprocess
    import sys

    from tests.conftest import ROOT
    code = ("import __spark_entry__ as E; o = E.oracle_sql(); q = E.queries(); "
            "assert 0 < len(o) <= len(q) and set(o) <= set(q); print(len(q))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout.strip()) == len(E.queries())
