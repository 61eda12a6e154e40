from panelweave.functions.semantics import *  # noqa: F401,F403
from panelweave.functions.units import *  # noqa: F401,F403
