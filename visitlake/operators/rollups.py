"""Platform and browser roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.functions.text import blank_to, is_blank
from visitlake.schema import ALL, UNKNOWN

# Grouping columns of each level, finest first.
PLATFORM_LEVELS = (("pl", "ver"), ("pl",), ())
BROWSER_LEVELS = (("browser", "browser_v"), ("browser",))


def normalise_name_version(name: str, version: str) -> dict[str, Column]:
    """A blank version is `unknown`; a blank name makes both `unknown`."""
    blank_name = is_blank(F.col(name))
    return {
        name: F.when(blank_name, F.lit(UNKNOWN)).otherwise(F.col(name)),
        version: F.when(blank_name, F.lit(UNKNOWN)).otherwise(blank_to(F.col(version), UNKNOWN)),
    }


def level_label(name: str) -> Column:
    """Value of a grouping column, or `all` on levels that leave it out."""
    return F.when(F.grouping(name) == 1, F.lit(ALL)).otherwise(F.col(name))


def platform_labels(name: Column, version: Column) -> Column:
    """The (name, version) pairs a row counts under."""
    return _labels("platform", (name, version), (name, F.lit(ALL)), (F.lit(ALL), F.lit(ALL)))


def browser_labels(name: Column, version: Column) -> Column:
    """As `platform_labels`; browsers have no level above the single browser."""
    return _labels("browser", (name, F.lit(ALL)), (name, version))


def _labels(prefix: str, *pairs) -> Column:
    return F.array(*[F.struct(n.alias(f"{prefix}_name"), v.alias(f"{prefix}_version")) for n, v in pairs])


def rollup_platform(df: DataFrame) -> DataFrame:
    """Rows repeated under each platform level, labelled `platform_name`, `platform_version`."""
    named = df.withColumns(normalise_name_version("pl", "ver"))
    return named.select("*", F.inline(platform_labels(F.col("pl"), F.col("ver"))))


def rollup_browser(df: DataFrame) -> DataFrame:
    """Rows repeated under each browser level, labelled `browser_name`, `browser_version`."""
    named = df.withColumns(normalise_name_version("browser", "browser_v"))
    return named.select("*", F.inline(browser_labels(F.col("browser"), F.col("browser_v"))))
