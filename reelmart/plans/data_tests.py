"""The modelled pipeline's declared data tests, run over our own marts.

``DECLARED`` lists every declared test as (model, kind, column(s), argument);
``declared_checks(marts)`` turns it into D1-D7 rules over a mapping of model
name -> DataFrame, and ``run_declared(marts)`` evaluates them with
``quality.run_checks`` (one row per check with its failure count).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from reelmart.operators import quality

# Accepted values declared by the modelled pipeline.
STATUSES = ("Released", "Rumored", "Planned", "In Production", "Post Production", "Canceled",
            "Ended")
ROLES = ("actor", "director")
TIERS = ("1: <$25M", "2: $25M-$50M", "3: $50M-$100M", "4: >$100M")

# The declared tests, model by model (71 in total).
DECLARED = [
    ("stg_movie_details", "unique", "movie_id", None),
    ("stg_movie_details", "not_null", "movie_id", None),
    ("stg_movie_details", "non_negative", "budget", None),
    ("stg_movie_details", "non_negative", "revenue", None),
    ("stg_credits", "unique", "movie_id", None),
    ("stg_credits", "not_null", "movie_id", None),
    ("stg_credits", "not_null", "cast_list", None),
    ("stg_credits", "not_null", "crew_list", None),
    ("int_movie_genre", "relationships", "movie_id", ("stg_movie_details", "movie_id")),
    ("int_movie_genre", "not_null", "genre_id", None),
    ("int_movie_genre", "not_null", "genre_name", None),
    ("int_movie_company", "relationships", "movie_id", ("stg_movie_details", "movie_id")),
    ("int_movie_company", "not_null", "company_id", None),
    ("int_movie_company", "not_null", "company_name", None),
    ("int_movie_cast", "relationships", "movie_id", ("stg_credits", "movie_id")),
    ("int_movie_cast", "not_null", "person_id", None),
    ("int_movie_cast", "not_null", "person_name", None),
    ("int_movie_director", "relationships", "movie_id", ("stg_credits", "movie_id")),
    ("int_movie_director", "not_null", "person_id", None),
    ("int_movie_director", "not_null", "person_name", None),
    ("dim_genre", "not_null", "genre_id", None),
    ("dim_genre", "unique", "genre_id", None),
    ("dim_genre", "not_null", "genre_name", None),
    ("dim_company", "not_null", "company_id", None),
    ("dim_company", "unique", "company_id", None),
    ("dim_company", "relationships", "company_id", ("int_movie_company", "company_id")),
    ("dim_company", "not_null", "company_name", None),
    ("dim_person", "not_null", "person_id", None),
    ("dim_person", "unique", "person_id", None),
    ("dim_person", "not_null", "person_name", None),
    ("fact_movie", "unique", "movie_id", None),
    ("fact_movie", "not_null", "movie_id", None),
    ("fact_movie", "accepted_values", "status", STATUSES),
    ("fact_movie", "not_null", "vote_average", None),
    ("fact_movie", "accepted_range", "vote_average", (0, 10)),
    ("fact_movie_snapshot", "unique_combination", ("movie_id", "snapshot_date"), None),
    ("fact_movie_snapshot", "not_null", "movie_id", None),
    ("fact_movie_snapshot", "not_null", "snapshot_date", None),
    ("bridge_movie_genre", "unique_combination", ("movie_id", "genre_id"), None),
    ("bridge_movie_genre", "not_null", "movie_id", None),
    ("bridge_movie_genre", "relationships", "movie_id", ("fact_movie", "movie_id")),
    ("bridge_movie_genre", "not_null", "genre_id", None),
    ("bridge_movie_genre", "relationships", "genre_id", ("dim_genre", "genre_id")),
    ("bridge_movie_cast", "unique_combination", ("movie_id", "person_id"), None),
    ("bridge_movie_cast", "not_null", "movie_id", None),
    ("bridge_movie_cast", "relationships", "movie_id", ("fact_movie", "movie_id")),
    ("bridge_movie_cast", "not_null", "person_id", None),
    ("bridge_movie_cast", "relationships", "person_id", ("dim_person", "person_id")),
    ("bridge_movie_director", "unique_combination", ("movie_id", "person_id"), None),
    ("bridge_movie_director", "not_null", "movie_id", None),
    ("bridge_movie_director", "relationships", "movie_id", ("fact_movie", "movie_id")),
    ("bridge_movie_director", "not_null", "person_id", None),
    ("bridge_movie_director", "relationships", "person_id", ("dim_person", "person_id")),
    ("bridge_movie_company", "unique_combination", ("movie_id", "company_id"), None),
    ("bridge_movie_company", "not_null", "movie_id", None),
    ("bridge_movie_company", "relationships", "movie_id", ("fact_movie", "movie_id")),
    ("bridge_movie_company", "not_null", "company_id", None),
    ("bridge_movie_company", "relationships", "company_id", ("dim_company", "company_id")),
    ("daily_movie_trends", "unique_combination", ("movie_id", "snapshot_date"), None),
    ("daily_movie_trends", "not_null", "movie_id", None),
    ("agg_talented_cast_member", "not_null", "person_id", None),
    ("agg_talented_cast_member", "not_null", "person_name", None),
    ("agg_talented_cast_member", "not_null", "role_type", None),
    ("agg_talented_cast_member", "accepted_values", "role_type", ROLES),
    ("agg_genre_roi", "not_null", "genre_name", None),
    ("agg_genre_roi", "not_null", "release_year", None),
    ("agg_budget_outcomes", "not_null", "budget_tier", None),
    ("agg_budget_outcomes", "accepted_values", "budget_tier", TIERS),
    ("agg_genre_evolution", "not_null", "genre_name", None),
    ("agg_genre_evolution", "not_null", "release_year", None),
    ("agg_genre_evolution", "not_null", "release_month", None),
]


def _rule(marts: Mapping[str, DataFrame], kind: str, column, arg):
    if kind == "not_null":
        return quality.NotNull(column)
    if kind == "unique":
        return quality.Unique(column)
    if kind == "unique_combination":
        return quality.UniqueCombination(tuple(column))
    if kind == "accepted_values":
        return quality.AcceptedValues(column, tuple(arg))
    if kind == "accepted_range":
        return quality.AcceptedRange(column, arg[0], arg[1])
    if kind == "non_negative":
        return quality.NonNegative(column)
    if kind == "relationships":
        parent, parent_col = arg
        return quality.Relationship(column, marts[parent], parent_col)
    raise ValueError(kind)


def declared_checks(marts: Mapping[str, DataFrame]) -> list[tuple[str, DataFrame, object]]:
    """(model, frame, rule) for every declared test."""
    return [(model, marts[model], _rule(marts, kind, column, arg))
            for model, kind, column, arg in DECLARED]


def run_declared(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared test over the marts, one row per check."""
    return quality.run_checks(declared_checks(marts))
