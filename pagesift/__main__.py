"""``python -m pagesift <command>``: see :mod:`pagesift.plans.cli`."""

import sys

from .plans.cli import main

sys.exit(main())
