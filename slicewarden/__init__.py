"""slicewarden: data-quality checks, publish and history for daily table slices, on Spark.

Every operator takes and returns DataFrames built from built-in Spark SQL
functions; writing is kept apart from computing.  See README.md for the map
from operators to modules.
"""

from slicewarden.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]
