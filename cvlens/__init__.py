"""cvlens: resume and skill analytics expressed as Spark DataFrame plans.

Layout:

* ``sources``   - readers (CSV, category folders, alias dictionary, JSON) and
                  adapters that derive resume-shaped frames from the driver tables.
* ``functions`` - Column-level building blocks (text cleaning, section spans,
                  noise predicates, similarity scores, indel ratio).
* ``operators`` - DataFrame -> DataFrame steps (skills, mining, features,
                  models, clustering, metrics, validation, scoring).
* ``sinks``     - JSON / parquet / model writers.
* ``plans``     - the catalogue of registered queries and their SQL oracles.
* ``streaming`` - the same row-level steps applied to a file stream.
"""

from cvlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
