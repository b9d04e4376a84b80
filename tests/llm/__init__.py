"""A package, so that test modules may have the names of those above; they import one another by plain name."""

import os
import sys

sys.path.append(os.path.dirname(os.path.abspath(__file__)))
