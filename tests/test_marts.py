"""Mart semantics on hand-made payloads (FIXTURES.md section 4)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from reelmart.config import MartConfig
from reelmart.operators import quality
from reelmart.plans import marts

T0 = dt.datetime(2026, 3, 1, 10, 0)


def raw(spark, docs):
    """docs: list of (payload dict, ingested_at)."""
    return spark.createDataFrame([(json.dumps(d), t) for d, t in docs],
                                 "raw_payload string, ingested_at timestamp_ntz")


def movie(i, **kw):
    d = {"id": i, "title": f"M{i}", "release_date": "2020-05-01", "budget": 10, "revenue": 25,
         "vote_average": 7.0, "vote_count": 100, "popularity": 5.0,
         "genres": [{"id": 1, "name": "Action"}],
         "production_companies": [{"id": 9, "name": "Co", "origin_country": ""}]}
    d.update(kw)
    return d


def member(pid, pop, order, name=None, character="c"):
    return {"id": pid, "name": name or f"P{pid}", "character": character, "order": order,
            "popularity": pop, "credit_id": f"cr{pid}-{order}", "gender": 1,
            "known_for_department": "Acting", "department": "Acting", "job": "Actor",
            "adult": False}


def test_staging_latest_load_and_fact(spark):
    # 4.1, 4.2, 4.5
    r = raw(spark, [(movie(1, budget=0, revenue=5), T0), (movie(1, budget=10, revenue=25),
                                                          T0 + dt.timedelta(hours=1)),
                    (movie(2, budget=0, revenue=5), T0)])
    fact = {x.movie_id: x for x in marts.fact_movie(marts.stg_movie_details(r)).collect()}
    assert fact[1].budget == 10 and fact[1].revenue_to_budget_ratio == 2.5
    assert fact[1].profit_margin == 1.5 and fact[1].profit == 15 and fact[1].has_financial_data
    assert fact[2].budget is None and not fact[2].has_financial_data
    assert fact[2].revenue_to_budget_ratio is None


def test_explode_genres_and_companies(spark):
    # 4.9 (missing / null / [] -> no rows), 4.11 ('' country -> NULL)
    r = raw(spark, [(movie(1), T0), (movie(2, genres=None), T0), (movie(3, genres=[]), T0),
                    ({k: v for k, v in movie(4).items() if k != "genres"}, T0)])
    stg = marts.stg_movie_details(r)
    g = marts.int_movie_genre(stg).collect()
    assert [(x.movie_id, x.genre_name) for x in g] == [(1, "Action")]
    c = marts.int_movie_company(stg).filter("movie_id = 1").first()
    assert c.origin_country is None


def _credits(spark, cast, crew=(), mid=1):
    return raw(spark, [({"id": mid, "cast": list(cast), "crew": list(crew)}, T0)])


def test_cast_cap_and_bridge(spark):
    # 4.6 rounding + cap, 4.7 a person twice -> one bridge row (higher popularity)
    cast = [member(100, 5.4, 1), member(101, 5.3, 0)] + [member(200 + i, 1.0, i + 2)
                                                          for i in range(10)]
    cast.append(member(100, 0.4, 30, character="cameo"))
    cr = marts.stg_credits(_credits(spark, cast))
    ic = marts.int_movie_cast(cr)
    assert ic.count() == 10
    ids = {x.person_id for x in ic.collect()}
    assert {100, 101} <= ids
    dup_cast = [member(7, 3.0, 0, character="a"), member(7, 9.0, 1, character="b")]
    b = marts.bridge_movie_cast(marts.int_movie_cast(marts.stg_credits(_credits(spark, dup_cast))))
    rows = b.collect()
    assert len(rows) == 1 and rows[0].popular_character == "b"


def test_directors_any_case(spark):
    # 4.8
    crew = [{"id": 1, "name": "A", "job": "DIRECTOR"}, {"id": 2, "name": "B", "job": "Director"},
            {"id": 3, "name": "C", "job": "Producer"}]
    d = marts.int_movie_director(marts.stg_credits(_credits(spark, [], crew)))
    assert sorted(x.person_id for x in d.collect()) == [1, 2]


def test_cast_null_vs_missing(spark):
    # 4.10: JSON null passes not_null, a missing key fails it
    r = raw(spark, [({"id": 1, "cast": None, "crew": []}, T0), ({"id": 2, "crew": []}, T0)])
    cr = marts.stg_credits(r)
    failing = quality.failing(cr, quality.NotNull("cast_list")).collect()
    assert [x.movie_id for x in failing] == [2]


def test_talent_and_trends(spark):
    # 4.13 votes 50 vs 51; 4.14 4 vs 5 films; 4.15 actor and director; 4.20 ties
    cfg = MartConfig()
    movies = [movie(i, vote_count=51 if i < 6 else 50, popularity=float(10 - (i % 3)))
              for i in range(1, 8)]
    r = raw(spark, [(m, T0) for m in movies])
    fact = marts.fact_movie(marts.stg_movie_details(r))
    cast_rows = []
    for i in range(1, 8):
        members = [member(1, 2.0, 0)] if i <= 5 else []
        members += [member(2, 1.0, 1)] if i <= 4 else []
        cast_rows.append(({"id": i, "cast": members,
                           "crew": [{"id": 1, "name": "P1", "job": "Director",
                                     "popularity": 2.0}] if i <= 5 else []}, T0))
    cr = marts.stg_credits(raw(spark, cast_rows))
    ic, idr = marts.int_movie_cast(cr), marts.int_movie_director(cr)
    t = marts.agg_talented_cast_member(fact, marts.bridge_movie_cast(ic),
                                       marts.bridge_movie_director(idr),
                                       marts.dim_person(ic, idr), cfg)
    got = {(x.person_id, x.role_type): x.movie_count for x in t.collect()}
    assert got == {(1, "actor"): 5, (1, "director"): 5}
    snap = marts.fact_movie_snapshot(r, None, None, cfg)
    trends = marts.daily_movie_trends(fact, snap, MartConfig(top_n_movies=1))
    # only movies with > 50 votes; the top popularity value (10.0 = ids 3)
    assert sorted({x.movie_id for x in trends.collect()}) == [3]
    trends2 = marts.daily_movie_trends(fact, snap, MartConfig(top_n_movies=2))
    assert sorted({x.movie_id for x in trends2.collect()}) == [1, 3, 4]


def test_snapshot_semantics(spark, scratch):
    cfg = MartConfig()
    day = dt.datetime(2026, 3, 1)
    # 4.16: two captures in one run -> the later one
    r1 = raw(spark, [(movie(1, popularity=1.0), day + dt.timedelta(hours=1)),
                     (movie(1, popularity=2.0), day + dt.timedelta(hours=5))])
    seed = spark.createDataFrame([(1, dt.date(2026, 3, 1), 9.0, 7.0, 10, 5),
                                  (1, dt.date(2026, 2, 1), 8.0, 7.0, 10, 5)],
                                 "movie_id long, snapshot_date date, popularity double, "
                                 "vote_average double, vote_count long, revenue long")
    first = marts.fact_movie_snapshot(r1, None, seed, cfg)
    rows = {x.snapshot_date: x for x in first.collect()}
    # 4.19: observed beats synthetic on the same day
    assert rows[dt.date(2026, 3, 1)].popularity == 2.0
    assert not rows[dt.date(2026, 3, 1)].is_synthetic and rows[dt.date(2026, 2, 1)].is_synthetic
    # 4.17: a second run on the same day changes nothing
    r2 = raw(spark, [(movie(1, popularity=3.0), day + dt.timedelta(hours=9))])
    second = marts.fact_movie_snapshot(r2, first, None, cfg)
    assert sorted(map(tuple, second.collect())) == sorted(map(tuple, first.collect()))
    # next day is added
    r3 = raw(spark, [(movie(1, popularity=4.0), day + dt.timedelta(days=1, hours=1))])
    third = marts.fact_movie_snapshot(r3, first, None, cfg)
    assert third.count() == first.count() + 1


def test_fact_incremental_late_row(spark):
    # 4.18: a late row with an older stamp is not merged
    cfg = MartConfig()
    base = marts.fact_movie(marts.stg_movie_details(raw(spark, [(movie(1, title="old"), T0)])))
    late = raw(spark, [(movie(1, title="late"), T0 - dt.timedelta(hours=1)),
                       (movie(2, title="new"), T0 + dt.timedelta(hours=1))])
    merged = marts.fact_movie(marts.stg_movie_details(late), base, cfg)
    got = {x.movie_id: x.title for x in merged.collect()}
    assert got == {1: "old", 2: "new"}
    again = marts.fact_movie(marts.stg_movie_details(late), merged, cfg)
    assert {x.movie_id: x.title for x in again.collect()} == got  # 4.22 re-run safety


def test_genre_roi_no_financial_group(spark):
    # 4.21 counts > 0, financial count 0, means and medians NULL
    r = raw(spark, [(movie(1, budget=0), T0), (movie(2, budget=0), T0)])
    stg = marts.stg_movie_details(r)
    ig = marts.int_movie_genre(stg)
    roi = marts.agg_genre_roi(marts.fact_movie(stg), marts.bridge_movie_genre(ig),
                              marts.dim_genre(ig)).first()
    assert roi.movie_count == 2 and roi.movie_count_with_financial_data == 0
    assert roi.average_revenue_to_budget_ratio is None and roi.median_profit_margin is None


def test_renamed_genre_flags_unique(spark):
    # 4.24
    r = raw(spark, [(movie(1), T0), (movie(2, genres=[{"id": 1, "name": "Actionn"}]), T0)])
    dg = marts.dim_genre(marts.int_movie_genre(marts.stg_movie_details(r)))
    assert dg.count() == 2
    assert quality.failing(dg, quality.Unique("genre_id")).count() == 1


def test_budget_outcomes_and_evolution(spark):
    r = raw(spark, [(movie(1, budget=30_000_000, revenue=60_000_000), T0),
                    (movie(2, budget=20_000_000, revenue=10_000_000), T0),
                    (movie(3, budget=0), T0)])
    stg = marts.stg_movie_details(r)
    fact = marts.fact_movie(stg)
    out = {x.budget_tier: x for x in marts.agg_budget_outcomes(fact).collect()}
    assert set(out) == {"1: <$25M", "2: $25M-$50M"}
    assert out["2: $25M-$50M"].average_profit == 30_000_000
    ig = marts.int_movie_genre(stg)
    ev = marts.agg_genre_evolution(fact, marts.bridge_movie_genre(ig), marts.dim_genre(ig)).first()
    assert (ev.release_year, ev.release_month, ev.average_popularity) == (2020, 5, 5.0)


def test_genre_roi_reads_its_rows_once_for_all(spark):
    """no read of the rows has a filter of its own, or Spark runs the joins again for it."""
    fact = spark.createDataFrame(
        [(1, dt.date(2020, 1, 1), True, 2.0, 1.0), (2, dt.date(2020, 5, 1), True, 4.0, 3.0), (3, dt.date(2020, 5, 1), True, 5.0, 4.0)],
        "movie_id long, release_date date, has_financial_data boolean, revenue_to_budget_ratio double, profit_margin double")
    bridge = spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "movie_id long, genre_id long")
    genres = spark.createDataFrame([(7, "a"), (8, None)], "genre_id long, genre_name string")
    roi = marts.agg_genre_roi(fact, bridge, genres)
    plan = roi._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x and "isnotnull(genre_name" in x]
    got = {r.genre_name: (r.movie_count, r.median_revenue_to_budget_ratio, r.median_profit_margin) for r in roi.collect()}
    assert got == {"a": (2, 3.0, 2.0), None: (1, None, None)}
