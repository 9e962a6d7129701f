"""Run parameters of the cleaning job and the marts.

The reference hard-codes its date window and revenue buckets; here they are
parameters so the same code runs on data of any period and price level.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    min_date: _dt.date = _dt.date(2020, 1, 1)
    as_of: _dt.date | None = None          # None → current_date() of the run
    low_below: float = 20.0                # amount < low_below → "Low"
    medium_below: float = 100.0            # amount < medium_below → "Medium", else "High"

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


# Production defaults (the reference's constants).
DEFAULT = Params()

# Parameters for the star-schema fixture: order dates run 1995-01-01 … 2001-08-01
# and line totals 901.82 … 104,997.88, so the window and bands are moved.
FIXTURE = Params(min_date=_dt.date(1996, 1, 1), as_of=_dt.date(2001, 3, 1),
                 low_below=20000.0, medium_below=60000.0)
