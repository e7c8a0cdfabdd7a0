"""Sources: driver tables and the derived series, files, Kafka options, JDBC."""

from trendlake.sources.tables import observations, table  # noqa: F401
