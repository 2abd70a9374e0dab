"""ripplet: panel time-series analytics (bars, causal features, forecasters,
metrics, residual diagnostics and forecast comparison) expressed as Spark
DataFrame / SQL / ML / Structured Streaming plans."""

from ripplet.session import get_session, checkpoint_root, materialize

__all__ = ["get_session", "checkpoint_root", "materialize"]
