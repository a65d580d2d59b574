from etoile.functions.numeric import exact_sum, rounded_avg, round_half_even  # noqa: F401
from etoile.functions.dates import delay_days, date_parts  # noqa: F401
from etoile.functions.lookups import region_of, REGION_BY_STATE, DEFAULT_REGION  # noqa: F401
