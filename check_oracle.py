"""Run registered queries against their DuckDB oracles: python check_oracle.py [sf_dir] [names...]"""

import json
import sys
import time

from feedlens.plans.registry import queries
from feedlens.plans.verify import compare, duck_connect
from feedlens.session import build_session


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(queries())
    spark = build_session("local[8]")
    con = duck_connect(sf_dir)
    bad = 0
    for n in names:
        t = time.time()
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "error", "error": str(e)[:400]}
        r["sec"] = round(time.time() - t, 2)
        bad += r["status"] not in ("match", "rows-only")
        print(json.dumps(r, default=str), flush=True)
    print(f"# {len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
