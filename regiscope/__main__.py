"""Command line: run the whole health-domain job.

    python -m regiscope job --csv-dir DIR --out BASE [--batch-id ID] [--master local[*]]

Reads the four raw CSV files from ``DIR``, publishes them as keyed JSON
messages, ingests them with a bounded stream into Bronze, and writes Silver,
Gold (``wilayah_risk_score``), Gold final (``wilayah_final``), the k sweep, the
regions flagged per contamination level, both models, the serving tables of
dashboard and map and a JSON export below ``BASE``, which should be a shared folder on a cluster. Without ``--master``
the master comes from spark-submit / the cluster configuration.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m regiscope")
    sub = ap.add_subparsers(dest="cmd", required=True)
    job = sub.add_parser("job", help="CSV -> Bronze -> Silver -> Gold -> Gold final")
    job.add_argument("--csv-dir", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--batch-id", default=None, help="default: UTC now as YYYYMMDD_HHMMSS")
    job.add_argument("--boundaries", default=None, help="GeoJSON of the regions, for the map's boundary layer")
    job.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    from .plans import layers as L
    from .session import get_session

    now = datetime.now(timezone.utc)
    batch_id = args.batch_id or now.strftime("%Y%m%d_%H%M%S")
    spark = get_session("regiscope-job", master=args.master)
    res = L.run(spark, args.csv_dir, args.out.rstrip("/"), batch_id, now.strftime("%Y-%m-%dT%H:%M:%S"),
                boundaries=args.boundaries)
    final = res["final"]
    print(json.dumps({"batch_id": batch_id, "messages": res["messages"], "silver_rows": res["silver_rows"],
                      "final_rows": final.count(), "silhouette": res["silhouette"],
                      "k_sweep": [tuple(r) for r in res["k_sweep"].orderBy("k").collect()], "out": args.out}))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
