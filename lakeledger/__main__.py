import sys

from lakeledger.cli import main

sys.exit(main())
