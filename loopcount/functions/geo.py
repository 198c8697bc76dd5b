"""WKT geometry as plain columns.

Only three kinds matter: POINT for sites, LINESTRING and MULTILINESTRING for roads. A road is
always stored as MULTILINESTRING text (a LINESTRING is wrapped, any other kind is no road),
written with single blanks and ', ' between coordinates, plus a parsed nested array
``ARRAY<ARRAY<STRUCT<lon, lat>>>``. Coordinates are written in one way (``number``), so that texts
of equal geometries are equal, however they were spelled (F9).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every geometry is WGS 84 longitude/latitude.
SRID = 4326
SRID_METADATA = {"srid": SRID}


def with_srid(col, name: str):
    """F8: tag a geometry column (WKT text, lon, lat, coordinates) with its SRID as column metadata."""
    return col.alias(name, metadata=SRID_METADATA)


_NUM = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_COORD = rf"{_NUM}\s+{_NUM}(?:\s+{_NUM}){{0,2}}"
_LINE_BODY = rf"\(\s*{_COORD}(?:\s*,\s*{_COORD})*\s*\)"
_MULTI_BODY = rf"\(\s*{_LINE_BODY}(?:\s*,\s*{_LINE_BODY})*\s*\)"

POINT_RE = rf"(?i)^POINT\s*(?:ZM|Z|M)?\s*\(\s*({_NUM})\s+({_NUM})(?:\s+{_NUM}){{0,2}}\s*\)$"
LINE_RE = rf"(?is)^(MULTILINESTRING|LINESTRING)\s*(ZM|Z|M)?\s*(\(.*\)|EMPTY)$"
LINE_BODY_RE = rf"^(?:{_LINE_BODY}|EMPTY)$"
MULTI_BODY_RE = rf"^(?:{_MULTI_BODY}|EMPTY)$"


def missing_to_null(wkt: Column) -> Column:
    """the text 'null' and blank text mean no geometry."""
    text = F.trim(wkt)
    return F.when(text.isin("", "null"), F.lit(None).cast("string")).otherwise(text)


def is_point_or_null(wkt: Column, site: Column) -> Column:
    """D22 as a filter: true, or an error that names the site of a text that is no POINT."""
    fail = F.raise_error(F.concat(F.lit("site "), site, F.lit(" has no POINT geometry: "), wkt))
    return F.when(wkt.isNotNull() & ~wkt.rlike(POINT_RE), fail).otherwise(F.lit(True))


def number(value: Column) -> Column:
    """A double in its one spelling: the fewest decimals that tell it, no exponent, no trailing
    zeros, no sign of zero. Beyond 1e-5 to 1e15 in size, where digits may not fit a decimal,
    Java's text of the double."""
    size = F.abs(value)
    plain = F.regexp_replace(value.cast("string").try_cast("decimal(38,22)").cast("string"), r"\.?0+$", "")
    return F.when(value == 0, F.lit("0")).when((size >= 1e-5) & (size < 1e15), plain).otherwise(value.cast("string"))


_TOKEN_RE = r"^(\(*)([^(),]*)([),]*)$"


def _numbers(body: Column) -> Column:
    """A canonically spaced body with every coordinate as ``number``."""
    def one(token: Column) -> Column:
        text = F.regexp_extract(token, _TOKEN_RE, 2)
        return F.concat(F.regexp_extract(token, _TOKEN_RE, 1), number(text.try_cast("double")), F.regexp_extract(token, _TOKEN_RE, 3))

    return F.array_join(F.transform(F.split(body, " "), one), " ")


def canonical_point(wkt: Column) -> Column:
    """a checked POINT text, written anew: two coordinates, each as ``number``."""
    lon, lat = point_coords(wkt)
    return F.when(wkt.isNotNull(), F.concat(F.lit("POINT ("), number(lon), F.lit(" "), number(lat), F.lit(")")))


def point_coords(wkt: Column) -> tuple[Column, Column]:
    """(lon, lat) of a checked POINT text."""
    part = lambda i: F.when(wkt.isNotNull(), F.regexp_extract(wkt, POINT_RE, i).cast("double"))
    return part(1), part(2)


def _canonical_spacing(body: Column) -> Column:
    body = F.regexp_replace(F.trim(body), r"\s+", " ")
    body = F.regexp_replace(body, r"\s*,\s*", ", ")
    body = F.regexp_replace(body, r"\(\s*", "(")
    return F.regexp_replace(body, r"\s*\)", ")")


def _line(wkt: Column) -> tuple[Column, Column, Column, Column]:
    """Kind, dimensions and canonical body of a line text, and whether the body is well formed."""
    kind = F.upper(F.regexp_extract(wkt, LINE_RE, 1))
    dim = F.upper(F.regexp_extract(wkt, LINE_RE, 2))
    raw_body = F.regexp_extract(wkt, LINE_RE, 3)
    body = F.when(F.upper(raw_body) == "EMPTY", F.lit("EMPTY")).otherwise(_canonical_spacing(raw_body))
    valid = F.when(kind == "LINESTRING", body.rlike(LINE_BODY_RE)).otherwise(body.rlike(MULTI_BODY_RE))
    return kind, dim, body, valid


def is_line_other_or_null(wkt: Column) -> Column:
    """A filter: true, or an error for a LINESTRING or MULTILINESTRING whose coordinates are malformed."""
    kind, _, _, valid = _line(wkt)
    looks_like_line = F.upper(F.trim(wkt)).rlike(r"^(MULTI)?LINESTRING\b")
    return F.when(wkt.isNotNull() & looks_like_line & ((kind == "") | ~valid),
                  F.raise_error(F.concat(F.lit("malformed line geometry: "), wkt))).otherwise(F.lit(True))


def road_multilinestring(wkt: Column) -> Column:
    """MULTILINESTRING text of a checked line; LINESTRING is wrapped; other kinds give NULL."""
    kind, dim, body, _ = _line(wkt)
    wrapped = F.when((kind == "LINESTRING") & (body != "EMPTY"), F.concat(F.lit("("), body, F.lit(")"))
                     ).otherwise(body)
    wrapped = F.when(body == "EMPTY", wrapped).otherwise(_numbers(wrapped))
    head = F.when(dim == "", F.lit("MULTILINESTRING ")).otherwise(F.concat(F.lit("MULTILINESTRING "), dim, F.lit(" ")))
    return F.when(wkt.isNotNull() & (kind != ""), F.concat(head, wrapped))


def road_key(road_wkt: Column) -> Column:
    """A short key of the road text; NULL for no road."""
    return F.when(road_wkt.isNotNull(), F.xxhash64(road_wkt))


def road_parts(road_wkt: Column) -> Column:
    """Nested coordinates of a canonical MULTILINESTRING text: one array per line part."""
    parts = F.regexp_extract_all(road_wkt, F.lit(r"\(([^()]*)\)"), 1)

    def coord(point: Column) -> Column:
        xy = F.split(F.trim(point), " ")
        return F.struct(xy[0].cast("double").alias("lon"), xy[1].cast("double").alias("lat"))

    return F.when(road_wkt.isNotNull(), F.transform(parts, lambda p: F.transform(F.split(p, ","), coord)))
