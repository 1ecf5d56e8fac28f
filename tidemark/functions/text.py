"""Text kept in catalogue columns: ``k=v`` lists, truth words, globs, paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings.
TRUE_WORDS = ["True", "true", "1", "Yes", "yes", "Y", "y"]
NONE_WORDS = ["", "None", "none", "NONE"]


def keyword_map(text: Column) -> Column:
    """``k=v k=v`` text to a map; reading stops at the first word without ``=``.

    Of repeated keys the last one wins.  Only the part between the first and
    the second ``=`` is the value.
    """
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    pairs = F.transform(words, lambda w: F.split(w, "=", -1))
    first_bad = F.array_position(F.transform(pairs, lambda p: F.size(p) < 2), F.lit(True))
    kept = F.when(first_bad > 0, F.slice(pairs, F.lit(1), first_bad.cast("int") - 1)).otherwise(pairs)
    key_then_value = F.transform(kept, lambda p: F.struct(p[0].alias("key"), p[1].alias("value")))
    last_wins = F.aggregate(
        key_then_value,
        F.array().cast("array<struct<key:string,value:string>>"),
        lambda acc, kv: F.concat(F.filter(acc, lambda old: old["key"] != kv["key"]), F.array(kv)),
    )
    return F.map_from_entries(last_wins)


def merge_keywords(maps: Column) -> Column:
    """Merge an array of keyword maps from left to right, later entries winning."""
    return F.aggregate(
        maps,
        F.create_map().cast("map<string,string>"),
        lambda acc, m: F.map_concat(
            F.map_filter(acc, lambda k, _: ~F.map_contains_key(m, k)), m
        ),
    )


def is_true(text: Column) -> Column:
    """True for the accepted truth words, false for everything else and null."""
    return F.coalesce(text.isin(TRUE_WORDS), F.lit(False))


def none_if(text: Column) -> Column:
    """Null for the words that stand for nothing."""
    return F.when(~text.isin(NONE_WORDS), text)


def glob_pattern(glob: str) -> str:
    """A shell glob (``*``, ``?``, ``[...]``) as a whole-name regular expression."""
    out, i = [], 0
    while i < len(glob):
        char = glob[i]
        close = glob.find("]", i + 2) if char == "[" else -1
        if char == "*":
            out.append(".*")
        elif char == "?":
            out.append(".")
        elif close > 0:
            body = glob[i + 1 : close].replace("\\", "\\\\")
            out.append("[" + ("^" + body[1:] if body[0] == "!" else body) + "]")
            i = close
        else:
            out.append("\\" + char if not char.isalnum() else char)
        i += 1
    return "(?s)^" + "".join(out) + "$"


def glob_match(name: Column, glob: str) -> Column:
    return name.rlike(glob_pattern(glob))


def any_glob(name: Column, globs: list[str]) -> Column:
    """Does `name` match at least one of the globs?"""
    return reduce(lambda a, b: a | b, [glob_match(name, g) for g in globs], F.lit(False))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def join_path(*parts: Column) -> Column:
    """Join path pieces with one ``/`` between them, skipping empty ones."""
    kept = [F.nullif(F.regexp_replace(p, "/+$", ""), F.lit("")) for p in parts[:-1]]
    return F.concat_ws("/", *kept, parts[-1])
