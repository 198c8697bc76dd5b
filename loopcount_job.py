"""Script for spark-submit; see ``loopcount/__main__.py``."""

import sys

from loopcount.__main__ import main

sys.exit(main())
