"""spark-submit entry point: spark-submit --py-files tillflow.zip submit.py --lake … <job>"""

import sys

from tillflow.cli import main

sys.exit(main())
