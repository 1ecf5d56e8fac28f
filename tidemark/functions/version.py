"""Three-part versions (interface, quality, revision) as one comparable struct.

Structs compare field by field from the left, so ``<``, ``max`` and sorting
on the struct order versions without any packing into one number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = ("interface", "quality", "revision")
STRUCT = "struct<interface:int,quality:int,revision:int>"

_TEXT = r"^\s*([+-]?\d+)\s*\.\s*([+-]?\d+)\s*\.\s*([+-]?\d+)\s*$"
_IN_NAME = r"[vV](\d+)\.(\d+)\.(\d+)\."


def version(interface, quality, revision) -> Column:
    """Build a version from three columns or literals."""
    values = [v if isinstance(v, Column) else F.lit(v) for v in (interface, quality, revision)]
    return F.struct(*[v.cast("int").alias(p) for v, p in zip(values, PARTS)])


def version_of(alias: str | None = None) -> Column:
    """The version held in the three ``*_version`` columns of a file, code or inspector row."""
    prefix = f"{alias}." if alias else ""
    return version(*[F.col(f"{prefix}{part}_version") for part in PARTS])


def _matched(text: Column, pattern: str) -> Column:
    parts = [F.regexp_extract(text, pattern, i).try_cast("int") for i in (1, 2, 3)]
    return F.when(text.rlike(pattern), version(*parts))


def parse_version(text: Column) -> Column:
    """``x.y.z`` to a version; null when malformed or when the interface is 0."""
    parsed = _matched(text, _TEXT)
    return F.when(parsed["interface"] != 0, parsed)


def version_error(text: Column) -> Column:
    """Why `text` is not a version, or null when it is one."""
    return (
        F.when(text.isNull() | ~text.rlike(_TEXT), F.lit("malformed"))
        .when(_matched(text, _TEXT)["interface"] == 0, F.lit("interface starts at 1"))
    )


def format_version(value: Column) -> Column:
    """A version as ``x.y.z`` text; null stays null."""
    text = F.concat_ws(".", *[value[p].cast("string") for p in PARTS])
    return F.when(value.isNotNull(), text)


def version_difference(left: Column, right: Column) -> Column:
    """Part-by-part ``left - right``."""
    return F.struct(*[(left[p] - right[p]).alias(p) for p in PARTS])


def next_version(value: Column, part: int | Column) -> Column:
    """Raise one part (0, 1 or 2) and zero the parts below it."""
    part = part if isinstance(part, Column) else F.lit(part)
    i, q, r = (value[p] for p in PARTS)
    return (
        F.when(part == 0, version(i + 1, 0, 0))
        .when(part == 1, version(i, q + 1, 0))
        .when(part == 2, version(i, q, r + 1))
    )


def apply_difference(value: Column, difference: Column) -> Column:
    """Raise revision, then quality, then interface, each where the difference is above 0.

    The order matters: a later, higher part resets the lower ones.
    """
    for part in (2, 1, 0):
        value = F.when(difference[PARTS[part]] > 0, next_version(value, part)).otherwise(value)
    return value


def extract_version(name: Column) -> Column:
    """First ``vX.Y.Z.`` inside a file name as a version, else null."""
    return _matched(name, _IN_NAME)


def extract_base(name: Column) -> Column:
    """The text before the first ``vX.Y.Z.`` of a file name, else null."""
    return F.when(name.rlike(_IN_NAME), F.regexp_extract(name, "^(.*?)" + _IN_NAME, 1))


def legacy_number(value: Column) -> Column:
    """The older single-number order ``1000*interface + 100*quality + revision``."""
    return value["interface"] * 1000 + value["quality"] * 100 + value["revision"]
