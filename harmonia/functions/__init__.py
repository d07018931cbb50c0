from harmonia.functions.exprs import *  # noqa: F401,F403
from harmonia.functions.timefn import *  # noqa: F401,F403
