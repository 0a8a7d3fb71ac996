"""``python -m tallyspark run|stream|test ...`` (same as ``python -m tallyspark.cli``)."""

import sys

from tallyspark.cli import main

sys.exit(main())
