"""Access-log lines to wide event rows, and wide rows to cells and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir import schemas
from clickweir.functions.dates import server_time_millis
from clickweir.functions.text import blank_to_null, crc32_of, drop_trailing, url_decoded
from clickweir.operators.columns import computed_once

_CELL_TYPE = "array<struct<column:string,value:string>>"

_HAS_VALUE = r"=[^=]"
# A broken escape inside the value, that is between the first and second '='.
_MALFORMED = r"^[^=]*=[^=]*%(?![0-9A-Fa-f]{2})"


def _line_parts(line: Column) -> Column:
    # Trailing empty fields do not count as fields.
    return F.split(drop_trailing(line, schemas.LOG_SEPARATOR), r"\^A")


def is_log_line(line: Column) -> Column:
    """True when the line has exactly the four log fields (a blank line has one)."""
    return F.coalesce(F.size(_line_parts(line)) == 4, F.lit(False))


def split_log_line(df: DataFrame, line: str = "value") -> DataFrame:
    """Replace the raw line by ip, s_time, http_host and uri; other columns stay.

    Lines without exactly four fields give no row.
    """
    passthrough = [c for c in df.columns if c != line]
    parts = computed_once(df, "_parts", _line_parts(F.col(line))).where(F.size("_parts") == 4)
    return parts.select(
        *passthrough,
        *[F.get("_parts", F.lit(i)).alias(name)
          for i, name in enumerate([*schemas.HEADER_COLUMNS, "uri"])],
    )


def parse_uri_params(uri: Column) -> Column:
    """Query-string parameters as a map with URL-decoded values.

    Only a URI with exactly one ``?`` has parameters. Text after a second ``=``
    is ignored, a repeated key keeps its last value, and a pair without a value
    or with a malformed escape is left out.
    """
    halves = F.split(drop_trailing(uri, "?"), r"\?")
    query = F.when(F.size(halves) == 2, F.get(halves, F.lit(1))).otherwise("")
    # Plain string tests decide most pairs; the regular expressions see the rest.
    pairs = F.filter(
        F.split(query, "&"),
        lambda p: p.contains("=")
        & (~p.endswith("=") | p.rlike(_HAS_VALUE))
        & (~p.contains("%") | ~p.rlike(_MALFORMED)),
    )
    encoded = F.map_from_entries(F.transform(
        pairs,
        lambda p: F.struct(
            F.substring_index(p, "=", 1).alias("key"),
            F.substring_index(F.substring_index(p, "=", 2), "=", -1).alias("value"),
        ),
    ))
    return F.transform_values(encoded, lambda _, v: url_decoded(v))


def parse_event(df: DataFrame) -> DataFrame:
    """Add ``params``, the parameters of each line's URI."""
    return computed_once(df, "params", parse_uri_params(F.col("uri")))


def event_attributes(df: DataFrame) -> DataFrame:
    """Add ``attrs``, a parsed line as one map: header fields and parameters.

    A parameter named like a header field replaces it.
    """
    header = F.create_map(*[
        x for name in schemas.HEADER_COLUMNS for x in (F.lit(name), F.col(name))
    ])
    return df.withColumn("attrs", F.map_concat(header, F.col("params")))


def filter_known_events(df: DataFrame) -> DataFrame:
    """Keep parsed lines whose ``en`` parameter names one of the known events."""
    return df.where(F.col("params")["en"].isin(list(schemas.EVENTS)))


def project_event(df: DataFrame) -> DataFrame:
    """Known columns out of a parsed line; the other parameters stay in ``attrs``.

    A parameter named like a header field replaces it in the event; ``client_ip``
    keeps the line's own address for the region lookup.
    """
    passthrough = [c for c in df.columns
                   if c not in {"params", "uri", *schemas.HEADER_COLUMNS}]
    known, params = schemas.EVENT_COLUMNS, F.col("params")
    return df.select(
        *passthrough,
        F.col("ip").alias("client_ip"),
        *[F.coalesce(params[c], F.col(c)).alias(c) for c in schemas.HEADER_COLUMNS],
        *[params[c].alias(c) for c in known if c not in schemas.HEADER_COLUMNS],
        F.map_filter(params, lambda k, _: ~k.isin(known)).alias("attrs"),
    )


def row_key(s_time: Column, u_ud: Column, u_mid: Column, en: Column) -> Column:
    """``<epoch millis>_<crc32>`` of user, member and event; blank ids are left out."""
    return F.concat_ws(
        "_",
        server_time_millis(s_time).cast("string"),
        crc32_of(blank_to_null(u_ud), blank_to_null(u_mid), en).cast("string"),
    )


def with_row_key(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "row_key", row_key(F.col("s_time"), F.col("u_ud"), F.col("u_mid"), F.col("en"))
    )


def to_cells(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Unpivot wide events to one (row_key, column, value) row per present value."""
    typed = [c for c in schemas.EVENT_COLUMNS if c in df.columns]
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in typed
    ])
    if "attrs" in df.columns:
        rest = F.map_entries(F.coalesce("attrs", F.create_map().cast("map<string,string>")))
        cells = F.concat(cells, rest.cast(_CELL_TYPE))
    return (
        df.select(*(keep or []), "row_key", F.explode(cells).alias("cell"))
        .select(*(keep or []), "row_key", "cell.column", "cell.value")
        .where(F.col("value").isNotNull())
    )


def from_cells(cells: DataFrame, columns: list[str], order: str | None = None) -> DataFrame:
    """Pivot cells back to one row per row key.

    With ``order`` the newest value of each cell wins; without it each cell must
    be unique already.
    """
    rank = F.col(order) if order else F.lit(1)
    return cells.groupBy("row_key").agg(*[
        F.max_by("value", F.when(F.col("column") == name, rank)).alias(name) for name in columns
    ])
