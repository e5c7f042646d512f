"""Scans, sinks and the stand-in inputs derived from the driver's tables."""

from quarry.sources.files import (  # noqa: F401
    ACCESS_LOG_SCHEMA,
    CLAIMS_CATEGORICAL,
    CLAIMS_NUMERIC,
    MOVIES_SCHEMA,
    PARTICLE_FEATURES,
    RATINGS_SCHEMA,
    freeze,
    read_access_log,
    read_claims_csv,
    read_movies_csv,
    read_particle_csv,
    read_ratings_csv,
    write_parquet,
)
from quarry.sources.tables import load_table  # noqa: F401
