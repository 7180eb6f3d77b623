"""Parsing queries in a session with Spark's own defaults, in a process of its own."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PARSING = ("schema_version_counts", "drift_fields", "parse_event_lines", "quarantine_lines", "stream_recorded_feed",
           "load_stamps")


def test_parsing_does_not_depend_on_the_session(scratch):
    env = {k: v for k, v in os.environ.items() if k != "SPARK_CHECKPOINT_DIR"}
    out = subprocess.run([sys.executable, "tools/oracle_check.py", "--plain", "/root/testdata/sf0.001", *PARSING],
                         cwd=ROOT, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0 and out.stdout.count("'ok': True") == len(PARSING), out.stdout + out.stderr[-2000:]
