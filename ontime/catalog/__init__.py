"""All registered queries. Importing the modules below fills the registry."""

from ontime.catalog import q_clean, q_ml, q_quality, q_reports, q_sources  # noqa: F401
from ontime.catalog.registry import ORACLE, QUERIES  # noqa: F401
