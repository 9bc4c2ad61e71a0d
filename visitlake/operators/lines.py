"""Raw access-log lines -> field maps -> checked, enriched event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake import schema as S
from visitlake.functions.agents import BROWSER_RULES, OS_RULES, with_user_agent
from visitlake.functions.ip import ip_to_long, parse_region
from visitlake.functions.params import (
    add_params, after_question_mark, computed_once, cut_line, is_three_fields, parse_server_time,
)
from visitlake.functions.text import blank_to_null, is_blank, trim_controls, whole_number
from visitlake.functions.timeparts import event_date, midnight_millis
from visitlake.operators.ip_ranges import EVERY, join_ip_range

RESERVED_FIELDS = ["ip", "s_time", *S.REGION_COLUMNS, *S.AGENT_COLUMNS]


def parse_log_lines(
    lines: DataFrame, value_col: str = "value", protect_reserved: bool = False
) -> DataFrame:
    """Adds `fields` (map of names to text) and `parse_error` to raw lines.

    `fields` starts with `ip` and, when readable, `s_time` of the line; request parameters follow and win
    over them, as later ones win over earlier ones. `protect_reserved` keeps clients from setting the
    columns the pipeline derives itself. `fields` is null where `parse_error` is set.
    """
    cut = lines.withColumn("_cut", cut_line(F.col(value_col)))
    trimmed = cut.withColumns({
        "_three": is_three_fields(F.col("_cut")),
        **{name: trim_controls(F.get("_cut", F.lit(i))) for i, name in enumerate(("_ip", "_time", "_request"))},
    })
    after = trimmed.withColumn("_after", F.when(F.col("_three"), after_question_mark(F.col("_request"))))
    queried = after.withColumn("_query", blank_to_null(F.col("_after")))
    error = F.when(~F.col("_three"), S.BAD_LINE).when(F.col("_query").isNull(), S.NO_PARAMETERS)
    timed = queried.withColumn("_millis", parse_server_time(F.col("_time")).cast("string"))
    own = {"ip": F.col("_ip"), "s_time": F.col("_millis")}
    if protect_reserved:
        timed = timed.withColumn("_own", F.map_filter(
            F.create_map(*[c for n, v in own.items() for c in (F.lit(n), v)]), lambda k, v: v.isNotNull()
        ))
    parsed = add_params(timed.withColumn("parse_error", error), "_query", "fields", own, ("parse_error",))
    if protect_reserved:
        given = F.map_filter("fields", lambda k, v: ~k.isin(RESERVED_FIELDS))
        parsed = parsed.withColumn("fields", F.map_concat(given, "_own"))
    return parsed.select(*lines.columns, "fields", "parse_error")


def rolled_by_size(lines: DataFrame, max_bytes: int, value_col: str = "value", roll_col: str = "roll") -> DataFrame:
    """Adds the name of the text file a line belongs in: none holds over `max_bytes`, newlines counted, but for a longer line alone.

    Every partition fills files of its own, in order, by running sums of bytes; a line that takes over an eighth of a file gets
    one to itself, so that the others fill seven eighths and the last of them still fits. Null lines take a newline.
    """
    return _rolled(lines, max_bytes, value_col, roll_col).drop("_number")


def packed_by_size(lines: DataFrame, max_bytes: int, keys: list[str], value_col: str = "value") -> DataFrame:
    """One row per file of `rolled_by_size` and `keys`: its lines in order, a newline between, as `value_col`.

    For files that may well be a row: a task holds some hundred of them at a time.
    """
    line = F.struct("_number", F.coalesce(value_col, F.lit("")).alias("line"))
    files = _rolled(lines, max_bytes, value_col, "_roll").groupBy(*keys, "_roll").agg(F.array_sort(F.collect_list(line)).alias("_lines"))
    return files.select(F.array_join(F.col("_lines")["line"], "\n").alias(value_col), *keys)


def _rolled(lines: DataFrame, max_bytes: int, value_col: str, roll_col: str) -> DataFrame:
    """`rolled_by_size` with the order of the lines, `_number`."""
    if max_bytes < 8:
        raise ValueError("a file holds at least 8 bytes")
    size = F.coalesce(F.octet_length(value_col), F.lit(0)).cast("bigint") + 1
    told = lines.withColumns({"_part": F.spark_partition_id(), "_number": F.monotonically_increasing_id(), "_size": size})
    short = F.col("_size") <= max_bytes // 8
    before = F.sum(F.when(short, F.col("_size")).otherwise(0)).over(
        Window.partitionBy("_part").orderBy("_number").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_size")
    part = F.col("_part").cast("string")
    filled = F.concat_ws("-", part, F.floor(F.col("_before") / (max_bytes - max_bytes // 8)).cast("string"))
    alone = F.concat_ws("-", part, F.lit("long"), F.col("_number").cast("string"))
    return told.withColumn("_before", before).withColumn(roll_col, F.when(short, filled).otherwise(alone)).drop(
        "_part", "_size", "_before")


def required_fields(platform: Column, event: Column, strict: bool = False) -> Column:
    """Names of the fields an event must carry; null when the platform does not send such events."""
    needed = None
    for (pl, en), names in S.REQUIRED_FIELDS.items():
        names = (*names, *S.STRICT_WEBSITE_FIELDS) if strict and pl == S.WEBSITE else names
        listed = F.array(*[F.lit(n) for n in names]).cast("array<string>")
        needed = (F.when if needed is None else needed.when)((platform == pl) & (event == en), listed)
    return needed


def classify_events(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """Adds `reject_reason` to parsed lines; null marks the rows to store.

    `strict` also asks website events for a visitor and a session id.
    """
    fields, needed = F.col("fields"), F.col("_needed")
    event, platform = F.col("_en"), F.col("_pl")
    known = F.coalesce(event.isin([e[2] for e in S.EVENTS]), F.lit(False))
    platforms = sorted({pl for pl, _ in S.REQUIRED_FIELDS})
    staged = parsed.select("*", *[fields[n].alias(f"_{n}") for n in ("en", "pl", "s_time")]).withColumn(
        "_needed", required_fields(platform, event, strict)
    )
    reason = (
        F.when(F.col("parse_error").isNotNull(), F.col("parse_error"))
        .when(~known, S.UNKNOWN_EVENT)
        .when(whole_number(F.col("_s_time")).isNull(), S.BAD_SERVER_TIME)
        .when(is_blank(platform), S.MISSING_PLATFORM)
        .when(~platform.isin(platforms), S.UNKNOWN_PLATFORM)
        .when(needed.isNull(), S.EVENT_NOT_ALLOWED)
        .when(F.exists(needed, lambda n: is_blank(F.element_at(fields, n))), S.MISSING_FIELD)
    )
    return computed_once(staged.withColumn("reject_reason", reason), parsed.columns, ["reject_reason"])


def valid_events(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reject_reason").isNull())


def rejected_lines(classified: DataFrame, value_col: str = "value") -> DataFrame:
    return classified.filter(F.col("reject_reason").isNotNull()).select(
        F.col(value_col).alias("value"), "reject_reason"
    )


def reject_counts(classified: DataFrame) -> DataFrame:
    """Rejected lines per reason."""
    return rejected_lines(classified).groupBy("reject_reason").agg(F.count("*").alias("lines"))


def add_region(valid: DataFrame, ip_ranges: DataFrame | None, **join_options) -> DataFrame:
    """Sets country, province and city in `fields` from the range holding `ip`; without ranges nothing changes.

    Place texts are read once per range, not once per event, and rows are looked up while they are still one
    map wide.
    """
    if ip_ranges is None:
        return valid
    region = F.map_from_arrays(
        F.array(*[F.lit(c) for c in S.REGION_COLUMNS]), F.array(*[F.col("_region")[c] for c in S.REGION_COLUMNS])
    )
    regions = ip_ranges.select(
        "begin_ip", "end_ip", parse_region(F.coalesce("country", F.lit(""))).alias("_region")
    ).select("begin_ip", "end_ip", region.alias("_place"))
    ip = F.col("fields")["ip"]
    numbered = valid.withColumn("_ip_number", F.when(~is_blank(ip), ip_to_long(ip)))
    located = join_ip_range(numbered, regions, "_ip_number", **join_options)

    def nowhere(country: str) -> Column:
        return F.create_map(*[
            F.lit(t) for c in S.REGION_COLUMNS for t in (c, country if c == "country" else S.UNKNOWN)
        ])

    unlocated = F.when(F.col("_ip_number").isNull(), nowhere(S.UNKNOWN)).otherwise(nowhere(S.UNKNOWN_COUNTRY))
    others = F.map_filter("fields", lambda k, v: ~k.isin(S.REGION_COLUMNS))
    return located.withColumn("fields", F.map_concat(others, F.coalesce("_place", unlocated))).drop(
        "_ip_number", "_place"
    )


def to_event_columns(valid: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Field map -> one column per well-known field; the others stay in the map `extra`.

    Blank values stay as they are here: they are part of an event's identity until `drop_blanks`.
    """
    f = F.col("fields")
    return valid.select(
        *(keep or []),
        whole_number(f["s_time"]).alias("s_time"),
        *[f[c].alias(c) for c in S.TEXT_COLUMNS],
        f[S.USER_AGENT].alias(S.USER_AGENT),
        F.map_filter(f, lambda k, v: ~k.isin(S.KNOWN_FIELDS)).alias("extra"),
    )


def add_user_agent(events: DataFrame, browser_rules=None, os_rules=None) -> DataFrame:
    """Sets browser and operating system columns from the user agent and drops its raw text."""
    parsed = with_user_agent(events, S.USER_AGENT, "_agent", browser_rules or BROWSER_RULES, os_rules or OS_RULES)
    found = F.col("_agent").isNotNull()
    return parsed.withColumns(
        {c: F.when(found, F.col("_agent")[c]).otherwise(F.col(c)) for c in S.AGENT_COLUMNS}
    ).drop("_agent", S.USER_AGENT)


def with_row_key(events: DataFrame, tz: str = "UTC") -> DataFrame:
    """Adds `time_in_day` (ms since midnight of the event's day) and `row_hash` (CRC32 of visitor and content)."""
    s_time = F.col("s_time")
    named = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c))) for c in sorted(S.TEXT_COLUMNS)]
    extra = F.transform(
        F.array_sort(F.map_entries("extra")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    content = F.concat_ws("\x01", F.coalesce(F.col("u_ud"), F.lit("")), s_time.cast("string"), *named, extra)
    return events.withColumns({
        "time_in_day": s_time - midnight_millis(event_date(s_time, tz), tz),
        "row_hash": F.crc32(F.encode(content, "UTF-8")),
    })


def dedupe_events(events: DataFrame) -> DataFrame:
    """Keeps one of several rows with the same content in every column.

    All columns are grouping keys, so copies shrink to one row per task before the shuffle and a group of
    copies of any size costs one row per task afterwards. Maps compare by their sorted entries.
    """
    maps = [f.name for f in events.schema.fields if f.dataType.typeName() == "map"]
    flat = events.withColumns({c: F.array_sort(F.map_entries(c)) for c in maps}) if maps else events
    unique = flat.distinct()
    return unique.withColumns({c: F.map_from_entries(c) for c in maps}) if maps else unique


def with_agent_fields(valid: DataFrame) -> DataFrame:
    """Puts browser and operating system into `fields` in place of the raw user agent, as `add_user_agent` does in columns."""
    fields = F.col("fields")
    parsed = with_user_agent(valid.withColumn("_text", fields[S.USER_AGENT]), "_text", "_agent", BROWSER_RULES, OS_RULES)
    found = F.map_from_arrays(F.array(*[F.lit(c) for c in S.AGENT_COLUMNS]), F.array(*[F.col("_agent")[c] for c in S.AGENT_COLUMNS]))
    others = F.map_filter(fields, lambda k, v: ~k.isin(S.USER_AGENT, *S.AGENT_COLUMNS))
    kept = F.map_filter(fields, lambda k, v: k != S.USER_AGENT)
    named = F.when(F.col("_agent").isNotNull(), F.map_concat(others, found)).otherwise(kept)
    return parsed.withColumn("fields", named).drop("_agent", "_text")


def event_digest(valid: DataFrame, located: bool) -> Column:
    """SHA-256 of what tells events of `with_agent_fields` apart: as `dedupe_events`, all but what follows from the rest.

    Regions are left out where they will be looked up from the address (`located`).
    """
    fields = F.col("fields")
    left_out = ["s_time", *(S.REGION_COLUMNS if located else [])]
    entries = F.array_sort(F.map_entries(F.map_filter(fields, lambda k, v: v.isNotNull() & ~k.isin(left_out))))
    text = lambda e: F.concat_ws("\x01", F.length(e["key"]), F.length(e["value"]), F.concat(e["key"], e["value"]))
    content = F.concat_ws("\x01", whole_number(fields["s_time"]).cast("string"), F.transform(entries, text))
    return F.sha2(F.encode(content, "UTF-8"), 256)


def dedupe_lines(valid: DataFrame, keep: list[str], located: bool) -> DataFrame:
    """Keeps one of several valid lines that `dedupe_events` would take for one event, before regions are looked up."""
    named = with_agent_fields(valid)
    return named.withColumn("_digest", event_digest(named, located)).dropDuplicates([*keep, "_digest"]).drop("_digest")


def drop_blanks(events: DataFrame) -> DataFrame:
    """Blank values become null; blank names and values leave `extra`."""
    cleaned = {c: blank_to_null(F.col(c)) for c in S.TEXT_COLUMNS}
    cleaned["extra"] = F.map_filter("extra", lambda k, v: ~is_blank(k) & ~is_blank(v))
    return events.withColumns(cleaned)


def to_event_rows(
    valid: DataFrame,
    ip_ranges: DataFrame | None = None,
    tz: str = "UTC",
    dedupe: bool = True,
    keep: list[str] | None = None,
    **join_options,
) -> DataFrame:
    """Valid parsed lines -> rows of the event table (without its day column).

    `join_options` go to `join_ip_range`. Where an event gets a row for EVERY range that holds its address, duplicates leave
    before the lookup, since two ranges may name one place.
    """
    lines = valid.select(*(keep or []), "fields")
    if dedupe and ip_ranges is not None and join_options.get("overlaps") == EVERY:
        lines, dedupe = dedupe_lines(lines, keep or [], True), False
    located = add_region(lines, ip_ranges, **join_options)
    events = add_user_agent(to_event_columns(located, keep))
    keyed = with_row_key(events, tz).select(*(keep or []), *S.EVENT_COLUMNS)
    return drop_blanks(dedupe_events(keyed) if dedupe else keyed)


def event_log_view(events: DataFrame) -> DataFrame:
    """The six text columns and the server time that hourly reports read, plus the row key."""
    return events.select(
        F.concat_ws("-", "time_in_day", "row_hash").alias("key"),
        "pl", "ver", "en", "u_ud", "u_sd", F.col("s_time").cast("bigint").alias("s_time"),
    )
