"""``python -m ratewave <command> ...``: see :mod:`ratewave.cli`."""

import sys

from ratewave.cli import main

sys.exit(main())
