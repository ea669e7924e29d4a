"""Sinks: files, catalog tables and JDBC."""

from lakeloom.sinks.targets import (Target, create_if_absent, dual_publish, exists, jdbc_options,
                                    publish_zone, read, write, zone_folder)

__all__ = ["Target", "create_if_absent", "dual_publish", "exists", "jdbc_options",
           "publish_zone", "read", "write", "zone_folder"]
