import sys

from starloom.cli import main

sys.exit(main())
