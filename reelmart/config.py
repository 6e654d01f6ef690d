"""Pipeline parameters (one frozen object passed to the operators)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class MartConfig:
    # Defaults of the modelled pipeline's variables.
    cast_top_n: int = 10
    crew_top_n: int = 10  # declared by the modelled pipeline, used nowhere
    min_vote_count: int = 50
    min_films: int = 5
    top_n_movies: int = 10
    historic_start_date: dt.date = dt.date(2026, 1, 1)
    # Synthetic history: months back from the current month start; the end
    # bound is exclusive, so months -6 .. -2 are generated.
    history_start_months: int = 6
    history_end_months: int = 1
    # Window NULL order for DESC keys: NULLS FIRST matches the warehouse the
    # pipeline was written for (NULL is the largest value there).
    desc_nulls_first: bool = True
    # JSON casts: "fail" raises on a bad value (strict ``::`` casts),
    # "null" turns it into NULL.
    on_error: str = "fail"
