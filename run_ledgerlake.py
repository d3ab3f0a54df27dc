"""Launcher for spark-submit (which runs a file, not a module):

    spark-submit --py-files ledgerlake.zip run_ledgerlake.py run --raw ... --out ...
"""

import sys

from ledgerlake.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
