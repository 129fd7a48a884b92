"""velotide: bike-share data platform on Spark DataFrames.

Layers, in the order a daily run uses them:

* ``sources``   -- landing readers (trip CSV, station JSON, feed responses),
                   fixture views over the test tables, table loading.
* ``functions`` -- column helpers (whitespace trim, canonical station name,
                   minute-boundary difference, haversine, date keys) and the
                   data-quality rule arrays.
* ``operators`` -- reusable DataFrame operators: first-by dedup, size-checked
                   broadcast, data checks, partition replacement, top-k.
* ``plans``     -- the models: staging, station identity, trips, status,
                   dimensions, facts, aggregates, analyses, run log.
* ``streaming`` -- the station-status stream (parse, structural filter,
                   idempotent foreachBatch sink).
"""

from velotide.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]
