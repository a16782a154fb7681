"""Run the queries against their SQL: python -m workload.check [sf_dir] [name …]"""

from __future__ import annotations

import sys
import time
import traceback

from colonnade.session import build_session
from workload import registry
from workload.compare import compare, connect


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    """Print one line per query; the exit code counts failures."""
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    con, sqls, failed = connect(sf_dir), registry.oracles(), 0
    for name, query in registry.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            if name in sqls:
                same, note = compare(spark, con, query, sqls[name], sf_dir)
            else:
                same, note = True, f"{query(spark, sf_dir).count()} rows, no SQL, {time.time() - begin:.1f}s"
        except Exception:
            same, note = False, traceback.format_exc()[-1500:]
        failed += not same
        print("ok  " if same else "FAIL", name, note, flush=True)
        spark.catalog.clearCache()
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
