"""The command line runs the application and table jobs end to end."""

from __future__ import annotations

import glob

from rideflux.__main__ import main
from rideflux.operators.layout import read_compacted, read_table
from rideflux.sources.json_events import PARSERS
from rideflux.streaming import jobs
from tests.conftest import SF_SMALL


def test_cli_stream_setup_optimize_compact_history(spark, tmp_dir, capsys):
    from rideflux.plans.queries_ops import file_topic
    topics = f"{tmp_dir}/topics"
    for s in PARSERS:
        file_topic(spark, SF_SMALL, s, topics)  # writes {topics}/topics/<stream>
    base = f"{tmp_dir}/app"
    # One path: create, optimise the empty table, stream into it, optimise again.
    assert main(["setup", "--base", base], spark=spark) == 0
    assert main(["setup", "--base", base], spark=spark) == 0
    out = capsys.readouterr().out
    assert out.count("created") == 5 and out.count("exists") == 5
    assert main(["optimize", "--base", base, "--table", "ride_demand_by_zone"], spark=spark) == 0
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert main(["stream", "--base", base, "--topics", f"{topics}/topics", "--available-now",
                     "--state-partitions", "4"], spark=spark) == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    demand = jobs.read_gold(spark, base, "ride_demand_by_zone")
    assert demand.count() > 0

    assert main(["optimize", "--base", base, "--table", "ride_demand_by_zone"], spark=spark) == 0
    opt = read_table(spark, f"{base}/optimized/ride_demand_by_zone", "ride_demand_by_zone")
    assert opt.count() == demand.count()

    assert main(["compact", "--base", base], spark=spark) == 0
    assert main(["compact", "--base", base], spark=spark) == 0
    out = capsys.readouterr().out
    assert "nothing new" in out
    assert read_compacted(spark, f"{base}/compacted/ride_demand_by_zone", "ride_demand_by_zone").count() == \
        demand.count()

    assert main(["history", "--base", base, "--limit", "2"], spark=spark) == 0
    assert "ride_demand_by_zone" in capsys.readouterr().out
    assert glob.glob(f"{base}/_checkpoints/*")
