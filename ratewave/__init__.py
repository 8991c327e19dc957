"""ratewave: ratings analytics on Spark DataFrames, batch and streaming.

Every operator is a DataFrame-to-DataFrame function.  The same functions run
over a static DataFrame or a streaming one, so batch answers and stream
answers come from one definition.
"""

from ratewave.session import build_session, shared_dir, use_utc, utc_session

__all__ = ["build_session", "shared_dir", "use_utc", "utc_session"]
