"""Compare every registered query with its oracle, as the driver does.

    python tests/run_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_mod  # noqa: E402
from plotcover.session import build_session  # noqa: E402
from tests.oracle_compare import compare, duck_connection  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session()
    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    con = duck_connection(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        if name not in sqls:
            t0 = time.time()
            n = qs[name](spark, sf_dir).count()
            print(f"{name:28s} rows-only {n} rows {time.time() - t0:.1f}s")
            continue
        t0 = time.time()
        r = compare(spark, sf_dir, qs[name], sqls[name], con)
        ok = r["columns_match"] and r["hash_match"] and r["rows_spark"] == r["rows_oracle"]
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows {r['rows_spark']}/{r['rows_oracle']} "
              f"cols {r['columns_match']} hash {r['hash_match']} {time.time() - t0:.1f}s")
        if not r["columns_match"]:
            print("   spark ", r["spark_columns"], "\n   oracle", r["oracle_columns"])
        elif not ok:
            s = sorted(map(str, r["spark_rows"]))
            d_idx = [r["d_cols"].index(c) for c in r["s_cols"]]
            d = sorted(str(tuple(row[i] for i in d_idx)) for row in r["oracle_rows"])
            only_s = [x for x in s if x not in set(d)][:3]
            only_d = [x for x in d if x not in set(s)][:3]
            print("   spark only ", only_s, "\n   oracle only", only_d)
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
