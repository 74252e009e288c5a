"""spark-submit entry point: ``spark-submit submit.py ingest|stream ...`` (see sonara/jobs.py)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sonara.jobs import main  # noqa: E402

if __name__ == "__main__":
    raise SystemExit(main())
