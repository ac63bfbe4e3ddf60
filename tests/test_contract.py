"""Driver contract: bench.py prints exactly one JSON line; the CLI lists
every key."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="gap_distribution,profile_encounter_classes",
               BENCH_SKIP_INGEST="1", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], cwd=str(tmp_path),
                         env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["metric"] and d["value"] > 0
    assert set(d["queries"]) == {"gap_distribution", "profile_encounter_classes"}
    assert d["sf"] == "0.001"


def test_cli_lists_every_key():
    out = subprocess.run([sys.executable, "-m", "stayline", "list"], cwd=ROOT,
                         capture_output=True, text=True, timeout=300)
    assert out.returncode == 0
    keys = [ln.split()[0] for ln in out.stdout.splitlines() if ln.strip()]
    sys.path.insert(0, ROOT)
    from stayline import catalog
    assert sorted(keys) == sorted(catalog.queries())


def test_entry_schema_is_stable(spark):
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    df = E.entry(spark)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("episode_id", "string"), ("patient_id", "string"), ("admitted_at", "timestamp_ntz"),
        ("discharged_at", "timestamp_ntz"), ("stay_in_episode", "bigint"),
        ("readmitted_30d", "boolean"), ("gender", "string"), ("age_at_admission", "int"),
        ("length_of_stay_days", "int"), ("prior_episodes", "bigint"),
        ("prior_episodes_365d", "bigint"), ("active_disorders_at_discharge", "bigint")]
