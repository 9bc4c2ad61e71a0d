"""Request line pieces: fields, server time, query string, parameters."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.functions.text import blank_to_null, is_blank, trim_controls, url_decode
from visitlake.schema import LINE_SEPARATOR


def computed_once(df: DataFrame, keep: list[str], computed: list[str]) -> DataFrame:
    """Columns `keep` and `computed`, the latter safe from being computed again by later filters.

    The optimizer moves filters below projections by repeating the projected expressions, which would
    parse each line again for every field tested. A one-element `inline` stops that.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*computed))))


def cut_line(line: Column) -> Column:
    """All fields of a line, empty ones included."""
    return F.split(trim_controls(line), re.escape(LINE_SEPARATOR))


def is_three_fields(fields: Column) -> Column:
    """Whether a cut line has exactly three fields, not counting empty ones at the end."""
    tail = F.array_join(F.slice(fields, 4, F.greatest(F.size(fields) - 3, F.lit(0))), "")
    return F.coalesce((F.get(fields, F.lit(2)) != "") & (tail == ""), F.lit(False))


def parse_server_time(c: Column) -> Column:
    """`seconds.millis` text -> epoch milliseconds (truncated); null when it is not a time."""
    seconds = F.when(~is_blank(c), trim_controls(c)).try_cast("double")
    millis = (seconds * 1000).try_cast("bigint")
    return F.when(millis != -1, millis)


def after_question_mark(request: Column) -> Column:
    """What follows the first `?`, null when there is none."""
    return F.when(
        F.contains(request, F.lit("?")), F.substring(request, F.instr(request, "?") + 1, F.octet_length(request))
    )


def extract_query(request: Column) -> Column:
    """What follows the first `?`; null when there is none, it comes last or only blanks follow."""
    return blank_to_null(after_question_mark(request))


# One parameter: its name up to the first `=` and its value up to the next one. Something other than `=` has
# to follow the first `=`, so `k`, `k=` and `k==` are no parameters while `k==v` is one with an empty value.
_PARAMETER = r"(?:^|&)([^&=]*)=(?==*[^&=])([^&=]*)"
_CONTROL = r"[\x00-\x20]"
_ESCAPED_MARK = r"%0[123]"
# Stand-ins for an escaped `&` and `=` while the others are decoded, and the separator of joined texts.
_AMPERSAND, _EQUALS, _JOINT = "\x02", "\x03", "\x01"


def add_params(
    df: DataFrame, query_col: str, out_col: str, first: dict[str, Column] | None = None, settled: tuple[str, ...] = ()
) -> DataFrame:
    """Adds the map of the decoded parameters of a query string, after the entries `first`.

    The last one of equal names counts, also against `first`. Parameters with malformed escapes and entries
    without a value are left out. A parameter `=v` has the empty name. A null query gives a null map.

    Nearly all query strings are decoded as a whole and cut up by two passes of one pattern. Escaped
    separators are set aside meanwhile. Strings with raw control characters or malformed escapes are cut up
    first and decoded piece by piece. Neither the map nor the columns `settled` are computed again by filters.
    """
    first = first or {}
    query = F.col(query_col)
    escaped = F.contains(query, F.lit("%")) | F.contains(query, F.lit("+"))
    separators = F.contains(query, F.lit("%26")) | F.contains(query, F.lit("%3"))
    aside = query
    for escape, mark in (("%26", _AMPERSAND), ("%3D", _EQUALS), ("%3d", _EQUALS)):
        aside = F.replace(aside, F.lit(escape), F.lit(mark))
    aside = F.when(separators, aside).otherwise(query)
    touchy = query.rlike(_CONTROL) | (F.contains(query, F.lit("%0")) & query.rlike(_ESCAPED_MARK))
    whole = F.when(~touchy, F.when(escaped, url_decode(aside)).otherwise(query))
    staged = df.withColumns({"_whole": whole, "_aside": separators})

    def restore(texts: Column) -> Column:
        joined = F.array_join(texts, _JOINT)
        joined = F.replace(F.replace(joined, F.lit(_AMPERSAND), F.lit("&")), F.lit(_EQUALS), F.lit("="))
        return F.split(joined, _JOINT)

    def piecewise() -> Column:
        names, values = (F.transform(_pieces(query, g), lambda t: url_decode(trim_controls(t))) for g in (1, 2))
        return F.filter(
            F.zip_with(names, values, lambda n, v: F.struct(n.alias("name"), v.alias("value"))),
            lambda e: e["name"].isNotNull() & e["value"].isNotNull(),
        )

    at_once = F.col("_whole").isNotNull()
    staged = staged.withColumns({
        f"_cut{g}": F.when(at_once, _pieces(F.col("_whole"), g)).otherwise(piecewise()[part])
        for g, part in ((1, "name"), (2, "value"))
    })

    def texts(group: int) -> Column:
        cut = F.col(f"_cut{group}")
        return F.when(F.col("_aside") & at_once & (F.size(cut) > 0), restore(cut)).otherwise(cut)

    # last entry first, so that the first of equal names counts
    names = [F.when(v.isNotNull(), F.lit(n)) for n, v in first.items()]
    staged = staged.withColumns({
        "_names": F.reverse(F.concat(F.array_compact(F.array(*names)), texts(1)) if first else texts(1)),
        "_values": F.reverse(F.concat(F.array_compact(F.array(*first.values())), texts(2)) if first else texts(2)),
    }).withColumn("_distinct", F.array_distinct("_names"))

    repeated = F.size("_distinct") < F.size("_names")
    chosen = F.transform("_distinct", lambda n: F.element_at("_values", F.array_position("_names", n).cast("int")))
    params = F.map_from_arrays("_distinct", F.when(repeated, chosen).otherwise(F.col("_values")))
    done = staged.withColumn(out_col, F.when(query.isNotNull(), params))
    return computed_once(done, [c for c in df.columns if c not in settled], [*settled, out_col])


def _pieces(text: Column, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(_PARAMETER), F.lit(group))
