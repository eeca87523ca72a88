"""Command line: python tests/check.py [folder] [name-prefix ...]"""

import sys
import time
import traceback

sys.path.insert(0, ".")
from quarry.catalog import all_queries  # noqa: E402
from quarry.session import local_session  # noqa: E402
from tests.oracle import difference  # noqa: E402

folder = sys.argv[1]
wanted = sys.argv[2:]
spark = local_session(8)
bad = 0
for name, query in all_queries().items():
    if wanted and not any(name.startswith(w) for w in wanted):
        continue
    start = time.time()
    try:
        if query.sql:
            text = difference(spark, folder, query) or "ok"
        else:
            rows = query.run(spark, folder).collect()
            text = f"rows {len(rows)} {str(rows[:1])[:200]}"
    except Exception as error:
        text = "ERROR " + str(error)[:900]
        if "-v" in sys.argv:
            traceback.print_exc()
    bad += not (text == "ok" or text.startswith("rows"))
    print(f"{name:34s} {time.time() - start:6.1f}s {text}", flush=True)
print("bad:", bad)
