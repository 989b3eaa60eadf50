"""``python -m blotter ...`` runs the command line (see ``blotter.cli``)."""

import sys

from blotter.cli import main

sys.exit(main())
