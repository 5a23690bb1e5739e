"""``python -m rainrisk <command> ...`` runs the job module (see ``rainrisk.jobs``)."""

import sys

from rainrisk.jobs import main

sys.exit(main())
