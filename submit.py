"""spark-submit launcher: ``spark-submit --py-files pagesift.zip submit.py <command> ...``."""

import sys

from pagesift.plans.cli import main

if __name__ == "__main__":
    sys.exit(main())
