"""Column -> Column helper library (cleaning, dates, numbers, keys)."""

from .cleaning import *  # noqa: F401,F403
from .cleaning import CLAIM_STATUS_REFERENCE, map_code  # noqa: F401
from .dates import *  # noqa: F401,F403
from .keys import NULL_KEY_TOKEN, packed, surrogate_key, unpacked  # noqa: F401
from .numeric import *  # noqa: F401,F403
