"""Text sinks: existing output fails unless overwrite is asked for; one file on request."""

import glob

import pytest

from songpulse.operators.summary import genre_hour_count, summary_lines
from songpulse.plans.derived import Derived
from songpulse.session import local_path, scratch_path
from songpulse.sources import sinks


def test_summary_sink_modes(spark):
    lines = summary_lines(genre_hour_count(Derived(spark, "/root/testdata/sf0.001").enriched))
    path = scratch_path(spark, "summary")
    sinks.write_summary_lines(lines, path, single_file=True)
    assert len(glob.glob(local_path(path) + "/part-*")) == 1
    with pytest.raises(Exception):
        sinks.write_summary_lines(lines, path)
    sinks.write_summary_lines(lines, path, mode="overwrite")
    got = sorted(r[0] for r in sinks.read_summary_lines(spark, path).collect())
    assert got == sorted(r[0] for r in lines.collect())
    assert all(len(x.split(",")) == 3 for x in got)
