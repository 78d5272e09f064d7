"""``python -m verification [name ...]``: check queries at a data folder and print what differs."""

from __future__ import annotations

import os
import sys
import time

from gleanwell.session import local_session
from verification.compare import differences
from verification.registry import ORACLE, QUERIES

folder = os.environ.get("CHECK_DIR", "/root/testdata/sf0.01")
spark = local_session()
spark.sparkContext.setLogLevel("OFF")
wanted = sys.argv[1:] or list(QUERIES)
bad = 0
for name in wanted:
    start = time.time()
    try:
        if name in ORACLE:
            problems = differences(spark, folder, QUERIES[name], ORACLE[name])
            note = "ok" if not problems else "DIFFERENT " + "; ".join(problems)
        else:
            rows = QUERIES[name](spark, folder).collect()
            note = f"rows only: {len(rows)}; first {str(rows[0])[:200] if rows else None}"
    except Exception as error:  # report and go on with the next query
        note = f"FAILED {type(error).__name__}: {str(error)[:700]}"
    bad += note.startswith(("DIFFERENT", "FAILED"))
    print(f"{name:28s} {time.time() - start:6.1f}s {note}", flush=True)
print(f"{len(wanted)} queries, {bad} not right")
sys.exit(1 if bad else 0)
