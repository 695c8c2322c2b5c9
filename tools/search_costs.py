"""What the full grid search costs: runs each model's search for some seconds and projects its ledger.

    python tools/search_costs.py SF_DIR SECONDS [FOLDER]

The folder is the ledger: called again with the same one, the search goes on."""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from matchspark.functions.constants import FEATURE_NAMES  # noqa: E402
from matchspark.operators import models, search  # noqa: E402
from matchspark.plans import common, pipeline  # noqa: E402
from matchspark.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir, seconds = sys.argv[1], float(sys.argv[2])
    folder = sys.argv[3] if len(sys.argv) > 3 else tempfile.mkdtemp(prefix="ledger-")
    spark = get_spark("local[8]", 8, extra={"spark.driver.memory": "16g"})
    prep = pipeline.prepare_training(common.game_rows(spark, sf_dir))
    n = prep.train.count()
    print(f"{sf_dir}: {n} training games, ledger {folder}")
    for name in models.MODEL_NAMES:
        found = search.search(prep.train, FEATURE_NAMES, folder, names=[name], seconds=seconds, refit=False)
        for r in search.Ledger(spark, folder).costs(found.run, found.planned, 4).collect():
            print(f"{r.model}: {r.done or 0} of {r.planned} fits, {r.seconds_a_fit or 0:.2f} s a fit, "
                  f"{(r.projected_hours or 0) * 4:.2f} hours one after the other", flush=True)


if __name__ == "__main__":
    main()
