import sys

from framelake.cli import main

sys.exit(main())
