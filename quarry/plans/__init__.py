"""Registered queries (name -> Spark plan, DuckDB oracle SQL)."""
from quarry.plans import stats_queries, text_queries, trip_queries  # noqa: F401
from quarry.plans import synth_queries  # noqa: F401,E402
from quarry.plans import pattern_queries, reco_queries  # noqa: F401,E402
from quarry.plans import model_queries  # noqa: F401,E402
