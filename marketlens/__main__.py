import sys

from marketlens.cli import main

sys.exit(main())
