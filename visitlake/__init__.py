"""Web-log analytics as Spark jobs: parse, validate, enrich, roll up and publish visitor metrics."""

__version__ = "0.1.0"
