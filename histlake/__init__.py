"""histlake: a PySpark toolkit for exported listening histories.

Layers: landing JSON -> all-string bronze -> typed, keyed, deduplicated silver,
plus interval attribution, year/coordinate expansion, weather documents,
change detection, profiling and incremental loads.  Everything is built from
the public DataFrame / SQL API; there are no custom Catalyst rules.
"""

from histlake.session import build_session, configure, scratch_dir

__all__ = ["build_session", "configure", "scratch_dir"]
