"""Column -> Column helpers (all JVM-side built-ins, no Python UDFs)."""
from quarry.functions.predicates import *  # noqa: F401,F403
from quarry.functions.text import *  # noqa: F401,F403
from quarry.functions.vectors import *  # noqa: F401,F403
