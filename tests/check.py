"""Command line: python tests/check.py SF_DIR [name-prefix ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from salesmart import session  # noqa: E402
from salesmart.plans import oracle_sql, queries  # noqa: E402
from tests.compare import connect, problems  # noqa: E402


def main() -> int:
    sf_dir, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark, con = session.build("check"), connect(sf_dir)
    sql, bad, total = oracle_sql(), 0, 0
    for name, build in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        total += 1
        start = time.time()
        try:
            found = problems(spark, con, build, sql.get(name), sf_dir)
        except Exception as error:  # report and go on
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'BAD ' if found else 'ok  '} {name} {time.time() - start:.2f}s {'' if name in sql else '(no SQL)'}", *found, sep="\n      " if found else " ", flush=True)
    print(f"{total - bad} of {total} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
