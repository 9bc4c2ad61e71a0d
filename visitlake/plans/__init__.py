"""The three jobs: ETL of a day, visitor KPIs of a run date, hourly report of a day."""
