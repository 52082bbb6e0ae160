import json
import os
import subprocess
import sys
import tempfile

from .conftest import FIXTURES, ROOT


def test_cli_job_runs_end_to_end():
    out = tempfile.mkdtemp(prefix="run-cli-")
    env = dict(os.environ, PYTHONPATH=ROOT)
    proc = subprocess.run([sys.executable, "-m", "regiscope", "job", "--csv-dir", FIXTURES,
                           "--out", f"{out}/job", "--master", "local[2]", "--batch-id", "20250101_000000"],
                          cwd=out, env=env, capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    res = json.loads(proc.stdout.strip().splitlines()[-1])
    assert res["final_rows"] == 6 and res["batch_id"] == "20250101_000000"
    assert os.path.isdir(f"{out}/job/gold/wilayah_final") and os.path.isdir(f"{out}/job/export/wilayah_final_json")
