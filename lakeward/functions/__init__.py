"""Column builders.  Everything here returns a ``Column`` and stays inside
whole-stage code generation, except :func:`nfc` (one Arrow pandas UDF)."""

from lakeward.functions.cleanse import *  # noqa: F401,F403
from lakeward.functions.keys import *  # noqa: F401,F403
from lakeward.functions.dates import *  # noqa: F401,F403
from lakeward.functions.predicates import *  # noqa: F401,F403
