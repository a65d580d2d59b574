"""Fixed lookup values the results depend on.

Kept as a literal map expression: a 27-entry lookup is cheaper as an in-codegen
``element_at(map, key)`` than as a join of any kind.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Brazilian state code -> macro-region; unknown or null state -> "Outro".
REGION_BY_STATE = {
    "SP": "Sudeste", "RJ": "Sudeste", "MG": "Sudeste", "ES": "Sudeste",
    "RS": "Sul", "SC": "Sul", "PR": "Sul",
    "BA": "Nordeste", "PE": "Nordeste", "CE": "Nordeste", "MA": "Nordeste",
    "PB": "Nordeste", "RN": "Nordeste", "AL": "Nordeste", "SE": "Nordeste", "PI": "Nordeste",
    "GO": "Centro-Oeste", "MT": "Centro-Oeste", "MS": "Centro-Oeste", "DF": "Centro-Oeste",
    "AM": "Norte", "PA": "Norte", "RO": "Norte", "AC": "Norte", "AP": "Norte", "RR": "Norte", "TO": "Norte",
}
DEFAULT_REGION = "Outro"
DEFAULT_CATEGORY = "unknown"
ALL_REGIONS = "Toutes"


def _region_map() -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(REGION_BY_STATE.items())])


def region_of(state: Column) -> Column:
    """Region of a state code; ``Outro`` when the code is unknown or null."""
    return F.coalesce(F.try_element_at(_region_map(), state), F.lit(DEFAULT_REGION))
