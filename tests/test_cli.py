"""``python -m tidemark daily`` drives run_daily from paths."""

import json
import os

from tidemark.__main__ import main
from tidemark.session import scratch_path
from tidemark.sources import snapshots as SN


def test_cli_daily_branches(spark, capsys):
    base = scratch_path(spark, "t-cli").replace("file:", "")
    os.makedirs(f"{base}/branches/branch_id=ALL")
    with open(f"{base}/branches/branch_id=ALL/p.json", "w") as f:
        f.write(json.dumps({"_embedded": {"branches": [{"branchId": "b1", "name": "Main"}]}}))
    hub = f"{base}/hub"
    assert main(["daily", "--hub", hub, "--run", "20250105000000", "--run-date", "2025-01-05",
                 "--branches-pages", f"{base}/branches"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["phases"] == ["branches"]
    assert [(r.branch_id, r.name) for r in SN.read_table(spark, hub, "branches").collect()] == [("b1", "Main")]
