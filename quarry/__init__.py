"""quarry: a medallion (bronze / silver / gold) batch pipeline on Spark.

Layers are plain functions ``f(DataFrame, ...) -> DataFrame``. Nothing is
collected to the driver; every model is a lazy plan that Catalyst optimises
and a writer materialises.
"""

from quarry.session import ensure_checkpoint_dir, get_session, shared_dir

__all__ = ["get_session", "ensure_checkpoint_dir", "shared_dir"]
