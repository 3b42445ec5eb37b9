"""Identifiers, paths, file names and text formats, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from halocline.functions.flow import ColumnOrName, as_col


def face_label(face_id: ColumnOrName) -> Column:
    """Eight digits with leading zeros."""
    return F.format_string("%08d", as_col(face_id).cast("long"))


def degree_key(x: ColumnOrName) -> Column:
    """Whole degrees, cut towards zero: -152.78 gives -152 and -0.4 gives 0."""
    return as_col(x).cast("int")


def decimal_key(x: ColumnOrName, decimals: int = 2) -> Column:
    """The first decimals of the absolute value, cut, as text with leading zeros."""
    scale = 10**decimals
    digits = F.floor((F.abs(as_col(x)) - F.floor(F.abs(as_col(x)))) * scale).cast("long").cast("string")
    return F.coalesce(F.lpad(digits, decimals, "0"), F.lit("null"))  # padded, as a formatter costs far more a row


def partition_path(lat: ColumnOrName, lon: ColumnOrName) -> Column:
    return F.concat(F.lit("lat_deg="), degree_key(lat), F.lit("/lon_deg="), degree_key(lon), F.lit("/lat_dec="), decimal_key(lat), F.lit("/lon_dec="), decimal_key(lon))


def grid_id(lat: ColumnOrName, lon: ColumnOrName) -> Column:
    return F.concat_ws("_", degree_key(lat), degree_key(lon), decimal_key(lat), decimal_key(lon))


def point_file_name(location: ColumnOrName, face_id: ColumnOrName, lat: ColumnOrName, lon: ColumnOrName, temporal: str = "1h", dataset: str = "hindcast", version: str = "v1.0.0") -> Column:
    return F.concat(as_col(location), F.lit(f".{dataset}.face="), face_label(face_id), F.lit(".lat="), F.format_string("%.7f", as_col(lat)), F.lit(".lon="), F.format_string("%.7f", as_col(lon)), F.lit(f"-{temporal}.b4.{version}.parquet"))


def full_year_uri(base: str, location: ColumnOrName, face_id: ColumnOrName, lat: ColumnOrName, lon: ColumnOrName, **name: str) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), as_col(location), F.lit("/"), partition_path(lat, lon), F.lit("/"), point_file_name(location, face_id, lat, lon, **name))


POINT_FILE = r"face=(\d+)\.lat=(-?\d+\.\d+)\.lon=(-?\d+\.\d+)-(1h|30m)"


def parse_point_file(name: ColumnOrName) -> Column:
    """struct(face_id, lat, lon, temporal) of a point file's name, null where the name has no such form."""
    part = lambda i: F.regexp_extract(as_col(name), POINT_FILE, i)
    return F.when(as_col(name).rlike(POINT_FILE), F.struct(part(1).cast("long").alias("face_id"), part(2).alias("lat"), part(3).alias("lon"), part(4).alias("temporal")))


def parse_partition_path(path: ColumnOrName) -> Column:
    """struct of the four keys of a partition path, or null."""
    keys = ("lat_deg", "lon_deg", "lat_dec", "lon_dec")
    part = {k: F.regexp_extract(as_col(path), rf"{k}=(-?\d+)", 1) for k in keys}
    whole = F.lit(True)
    for k in keys:
        whole = whole & (part[k] != "")
    return F.when(whole, F.struct(*[part[k].cast("int").alias(k) for k in keys]))


def parse_data_file(name: ColumnOrName) -> Column:
    """struct(location, dataset, level, date, version, ext) of a dot-separated data file name."""
    n = as_col(name)
    parts = F.split(n, r"\.")
    date = F.get(F.filter(parts, lambda p: p.rlike(r"^\d{8}$")), F.lit(0))
    return F.struct(F.get(parts, F.lit(0)).alias("location"), F.get(parts, F.lit(1)).alias("dataset"), F.nullif(F.regexp_extract(n, r"\.(00|a1|a2|b[1-7])\.", 1), F.lit("")).alias("level"), F.to_date(date, "yyyyMMdd").alias("date"), F.nullif(F.regexp_extract(n, r"\.v(\d+\.\d+\.\d+)\.", 1), F.lit("")).alias("version"), F.element_at(parts, -1).alias("ext"))


def data_file_name(location: ColumnOrName, dataset: str, level: str, stamp: ColumnOrName, temporal: str, version: str, ext: str) -> Column:
    """The name that parse_data_file reads."""
    t = as_col(stamp)
    return F.concat_ws(".", as_col(location), F.concat(F.lit(dataset), F.lit(f"-{temporal}")), F.lit(level), F.date_format(t, "yyyyMMdd"), F.date_format(t, "HHmmss"), F.lit(f"v{version}"), F.lit(ext))


def level_file_name(location: ColumnOrName, dataset: str, level: str, stamp: ColumnOrName | None, qualifier: str | None = None, temporal: str | None = None, version: str | None = None, created: ColumnOrName | None = None, ext: str | None = "nc") -> Column:
    """A data level's file: location, dataset with qualifier and resolution, level, date and time, version, time of creation.

    What is None is left out; without ``stamp`` the name has no date and time.
    """
    parts = [as_col(location), F.lit("-".join(x for x in (dataset, qualifier, temporal) if x)), F.lit(level)]
    parts += [F.date_format(as_col(stamp), "yyyyMMdd"), F.date_format(as_col(stamp), "HHmmss")] if stamp is not None else []
    parts += [F.lit(f"v{version}")] if version else []
    parts += [F.concat(F.lit("created="), F.date_format(as_col(created), "yyyyMMdd_HHmm"), F.lit("Z"))] if created is not None else []
    return F.concat_ws(".", *parts, *([F.lit(ext)] if ext else []))


def figure_file_name(location: ColumnOrName, dataset: str, level: str, stamp: ColumnOrName, title: ColumnOrName, qualifier: str | None = None, temporal: str | None = None, ext: str = "png") -> Column:
    """A figure's file: as that of its data, without the time of day, with its title."""
    return F.concat_ws(".", dated(location, dataset, level, stamp, qualifier, temporal), as_col(title), F.lit(ext))


def original_file_name(location: ColumnOrName, dataset: str, stamp: ColumnOrName, original: ColumnOrName, qualifier: str | None = None, temporal: str | None = None) -> Column:
    """An original file under the conventions: level 00, without the time of day, its own name behind ``raw``."""
    return F.concat_ws(".", dated(location, dataset, "00", stamp, qualifier, temporal), F.lit("raw"), as_col(original))


def dated(location: ColumnOrName, dataset: str, level: str, stamp: ColumnOrName, qualifier: str | None, temporal: str | None) -> Column:
    return F.concat_ws(".", level_file_name(location, dataset, level, None, qualifier, temporal, ext=None), F.date_format(as_col(stamp), "yyyyMMdd"))


#: Names in which a second date stands where the time of day belongs.
DATE_FOR_TIME = r"^(.+\.b1_vap\.\d{8})\.((?:19|[2-9]\d)\d{6})\.(v[\d.]+\.nc)$"


def repaired_file_name(name: ColumnOrName, first: ColumnOrName) -> Column:
    """The name with the time of day of the file's first row where a second date stood; any other name as it is."""
    n = as_col(name)
    part = lambda i: F.regexp_extract(n, DATE_FOR_TIME, i)
    return F.when(n.rlike(DATE_FOR_TIME), F.concat_ws(".", part(1), F.date_format(as_col(first), "HHmmss"), part(3))).otherwise(n)


def parse_face_batch(name: ColumnOrName) -> Column:
    """struct(batch, first, last) of a face batch's file name, null otherwise."""
    pattern = r"batch_(\d+)_faces_(\d+)_(\d+)"
    part = lambda i: F.regexp_extract(as_col(name), pattern, i).cast("long")
    return F.when(as_col(name).rlike(pattern), F.struct(part(1).alias("batch"), part(2).alias("first"), part(3).alias("last")))


def semver(text: ColumnOrName) -> Column:
    """Comparable struct(major, minor, patch), null where the text has no such form."""
    pattern = r"^v?(\d+)\.(\d+)\.(\d+)$"
    part = lambda i: F.regexp_extract(as_col(text), pattern, i).cast("int")
    return F.when(as_col(text).rlike(pattern), F.struct(part(1).alias("major"), part(2).alias("minor"), part(3).alias("patch")))


def next_patch(text: ColumnOrName) -> Column:
    v = semver(text)
    return F.concat_ws(".", v["major"], v["minor"], v["patch"] + 1)


def parse_wkt_polygon(wkt: ColumnOrName) -> Column:
    """array of struct(lon, lat) of a POLYGON's outer ring."""
    ring = F.regexp_extract(as_col(wkt), r"(?i)POLYGON\s*\(\(([^()]*)\)", 1)
    point = lambda p: F.struct(F.split(F.trim(p), r"\s+")[0].cast("double").alias("lon"), F.split(F.trim(p), r"\s+")[1].cast("double").alias("lat"))
    return F.when(ring != "", F.transform(F.split(ring, ","), point))


def clean_html(text: ColumnOrName) -> Column:
    """Tags gone, the common entities as characters, white space collapsed."""
    out = F.regexp_replace(as_col(text), r"<[^>]*>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def hsds_time(t: ColumnOrName) -> Column:
    """Fixed-width UTC text."""
    return F.concat(F.date_format(as_col(t), "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))


def from_mjd(days: ColumnOrName) -> Column:
    """Modified Julian days (from 1858-11-17) as a timestamp."""
    return F.timestamp_micros(F.round((as_col(days) - 40587.0) * 86_400_000_000).cast("long"))


def human_size(size: ColumnOrName) -> Column:
    s = as_col(size).cast("double")
    out = F.when(s < 1024, F.format_string("%.2f B", s))
    for k, unit in enumerate(("KB", "MB", "GB", "TB"), 1):
        out = out.when(s < 1024.0 ** (k + 1), F.format_string(f"%.2f {unit}", s / 1024.0**k))
    return out.otherwise(F.format_string("%.2f PB", s / 1024.0**5))


def human_time(seconds: ColumnOrName) -> Column:
    s = as_col(seconds).cast("double")
    minutes, hours = F.floor(s / 60) % 60, F.floor(s / 3600)
    return F.when(s < 60, F.format_string("%.1fs", s)).when(s < 3600, F.format_string("%dm %ds", minutes.cast("long"), F.floor(s % 60).cast("long"))).otherwise(F.format_string("%dh %dm", hours.cast("long"), minutes.cast("long")))


def render_template(template: ColumnOrName, values: dict[str, ColumnOrName]) -> Column:
    """``{name}`` replaced by each value; null while a placeholder is left over."""
    out = as_col(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), as_col(value))
    return F.when(~out.rlike(r"\{\w+\}"), out)


def multipart_etag(content: ColumnOrName, part_size: int) -> Column:
    """md5 of a small object, else md5 of its parts' md5s and their number."""
    c = as_col(content)
    n = F.ceil(F.length(c) / part_size).cast("int")
    parts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.md5(F.substring(c, i * part_size + 1, F.lit(part_size))))
    return F.when(F.length(c) <= part_size, F.md5(c)).otherwise(F.concat(F.md5(F.unhex(F.array_join(parts, ""))), F.lit("-"), n))


# Names of exported variables, and variables that an export leaves out.
EXPORT_NAMES = {"lat_center": "latitude", "lon_center": "longitude", "h_center": "water_depth", "vap_utc_timezone_offset": "timezone", "vap_jurisdiction": "jurisdiction"}
NOT_EXPORTED = ("lat_node", "lon_node", "nv", "face", "node", "sigma", "sigma_layer", "time", "x_center", "y_center", "x", "y", "zeta", "meta_mesh_exterior_boundary_wkt")


def export_name(variable: ColumnOrName, static: ColumnOrName) -> Column:
    """A variable's name in an export; null if it is left out.  Static variables lose their prefix."""
    v = as_col(variable)
    fixed = F.element_at(F.create_map(*[F.lit(x) for pair in EXPORT_NAMES.items() for x in pair]), v)
    return F.when(v.isin(*NOT_EXPORTED), F.lit(None)).otherwise(F.coalesce(fixed, F.when(as_col(static), F.regexp_replace(v, "^vap_", "")), v))
