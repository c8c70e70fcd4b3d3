from wattline.functions.timefns import *  # noqa: F401,F403
