"""Registered queries over the driver's tables."""

from studyloom.catalog import study_queries  # noqa: F401
from studyloom.catalog import consolidate_queries  # noqa: F401
from studyloom.catalog import series_queries  # noqa: F401
from studyloom.catalog import label_queries  # noqa: F401
from studyloom.catalog import report_queries  # noqa: F401
from studyloom.catalog import mapping_queries  # noqa: F401
from studyloom.catalog import privacy_queries  # noqa: F401
from studyloom.catalog import file_queries  # noqa: F401
