"""aqarlens: listing-price analytics as Spark DataFrame plans.

Raw, messy listing tables go in; cleaned listings, features, target
encodings, profiling aggregates, Spark ML regressors and scored rows come
out.  Every operator is a lazy DataFrame plan of built-in expressions; the
only values that reach the driver are bounded summaries (a median, a
quantile limit, a global mean, per-column mapping sizes).
"""

from aqarlens.session import checkpoint_dir, materialize, session

__all__ = ["checkpoint_dir", "materialize", "session"]
