"""``{FIELD}`` templates for file names and directories.

Templates are data (one per product), so they are filled and turned into
patterns by column expressions; no template passes through the driver.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field name -> (format with default layout, pattern of its values).
FIELDS = {
    "Y": ("{Y:04d}", r"(19|2\d)\d\d"),
    "m": ("{m:02d}", r"(0\d|1[0-2])"),
    "b": ("{b}", r"Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"),
    "d": ("{d:02d}", r"[0-3]\d"),
    "y": ("{y:02d}", r"\d\d"),
    "j": ("{j:03d}", r"[0-3]\d\d"),
    "H": ("{H:02d}", r"[0-2]\d"),
    "M": ("{M:02d}", r"[0-6]\d"),
    "S": ("{S:02d}", r"[0-6]\d"),
    "MILLI": ("{MILLI:03d}", r"\d{3}"),
    "MICRO": ("{MICRO:03d}", r"\d{3}"),
    "QACODE": ("{QACODE}", r"ok|ignore|problem"),
    "VERSION": ("{VERSION}", r"\d+\.\d+\.\d+"),
    "DATE": ("{DATE}", r"(19|2\d)\d\d(0\d|1[0-2])[0-3]\d"),
    "datetime": ("{datetime}", r"(19|2\d)\d\d(0\d|1[0-2])[0-3]\d"),
    "mday": ("{mday:d}", r"-?\d+"),
    "APID": ("{APID:x}", r"[\da-fA-F]+"),
    "??": ("{??}", r".."),
    "???": ("{???}", r"..."),
    "????": ("{????}", r"...."),
    "nn": ("{nn}", r"\d\d"),
    "nnn": ("{nnn}", r"\d\d\d"),
    "nnnn": ("{nnnn}", r"\d\d\d\d"),
}
NAME_FIELDS = ("INSTRUMENT", "SATELLITE", "SPACECRAFT", "MISSION", "PRODUCT", "LEVEL", "ROOTDIR")


def date_fields(moment: Column) -> dict[str, Column]:
    """Every date field of a date or time column as zero-padded text.

    `datetime` is the ISO date, the form a bare date takes when printed.
    """
    layouts = {
        "Y": "yyyy", "m": "MM", "b": "MMM", "d": "dd", "y": "yy", "j": "DDD",
        "H": "HH", "M": "mm", "S": "ss", "MILLI": "SSS", "DATE": "yyyyMMdd",
        "datetime": "yyyy-MM-dd",
    }
    out = {name: F.date_format(moment, layout) for name, layout in layouts.items()}
    out["MICRO"] = F.substring(F.date_format(moment, "SSSSSS"), 4, 3)
    return out


def fill(template: Column, fields: dict[str, Column]) -> Column:
    """Replace ``{FIELD}`` (also written with its default layout) by the field's text.

    Unknown fields stay as they are.  A null field leaves its place unfilled.
    """
    for name, value in fields.items():
        text = F.coalesce(value.cast("string"), F.lit("{" + name + "}"))
        for spelling in dict.fromkeys(("{" + name + "}", FIELDS.get(name, ("",))[0])):
            if spelling:
                template = F.replace(template, F.lit(spelling), text)
    return template


def fill_literal(template: str, fields: dict[str, Column]) -> Column:
    """Fill one known template whose fields may carry number layouts such as ``{Y:04d}``.

    Values must be numeric where a number layout is given.  A field that is
    not supplied raises KeyError, as there is nothing to put in its place.
    """
    pieces = []
    for literal, name, layout, _ in string.Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            value = fields[name]
            pieces.append(F.format_string("%" + layout, value) if layout else value.cast("string"))
    return F.concat(*pieces) if pieces else F.lit("")


def to_pattern(template: Column, known: dict[str, Column] | None = None) -> Column:
    """A template as a regular expression: known fields filled, the rest as patterns.

    Fields with no pattern of their own become ``.*``.  Other text is kept
    unescaped, so a template may hold expression syntax.
    """
    out = fill(template, known or {})
    special = "|".join(
        "".join("\\" + c if not c.isalnum() else c for c in name) for name in FIELDS
    )
    out = F.regexp_replace(out, r"\{(?!(?:" + special + r")[:}])[^{}]*\}", ".*")
    for name, (layout, pattern) in FIELDS.items():
        for spelling in dict.fromkeys(("{" + name + "}", layout)):
            out = F.replace(out, F.lit(spelling), F.lit("(" + pattern + ")"))
    return out


def literal_prefix(template: Column) -> Column:
    """The leading text of a template, names filled in, that every match must start with.

    It ends before the first field or expression character; a character made
    optional by the one after it is left out.  A template with a choice in
    its own text has no sure start.
    """
    plain = r"^([A-Za-z0-9_/ -]*)(?![*?+])"
    return F.when(template.contains("|"), F.lit("")).otherwise(F.regexp_extract(template, plain, 1))


def substitute_path(
    path: Column,
    file_date: Column,
    start_time: Column,
    version_text: Column,
    names: dict[str, Column] | None = None,
) -> Column:
    """Fill a directory or full path: names, date parts of the file date, time parts of the start.

    Unknown fields are left alone.
    """
    by_date = date_fields(file_date)
    by_time = date_fields(start_time)
    fields = dict(names or {})
    fields.update({k: by_date[k] for k in ("Y", "m", "d", "b", "y", "j")})
    fields.update({k: by_time[k] for k in ("H", "M", "S")})
    fields["VERSION"] = version_text
    fields["DATE"] = by_date["DATE"]
    out = path
    for name, value in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"),
                        F.coalesce(value.cast("string"), F.lit("{" + name + "}")))
    return out


def substitute_names(text: Column, names: dict[str, Column], passes: int = 3) -> Column:
    """Fill name fields in dimension text, repeated since a name may hold a field itself."""
    for _ in range(passes):
        for name in NAME_FIELDS:
            if name in names:
                mark = "{" + name + "}"
                text = F.replace(text, F.lit(mark),
                                 F.coalesce(names[name].cast("string"), F.lit(mark)))
    return text
