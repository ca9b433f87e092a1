"""``python -m feedlens <job> ...`` or ``spark-submit feedlens/__main__.py <job> ...``: see ``feedlens.jobs``."""

import os
import sys

if __package__ in (None, ""):  # run as a script (spark-submit): make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedlens.jobs import run  # noqa: E402

if __name__ == "__main__":
    run()
