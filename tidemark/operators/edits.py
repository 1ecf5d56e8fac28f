"""Bulk edits of catalogue tables, returned as the edited table or a change list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.templates import substitute_names
from tidemark.functions.version import format_version, version_of
from tidemark.model import Catalogue
from tidemark.operators.catalogue import full_paths


@dataclass(frozen=True)
class Replace:
    """Put `new` wherever `old` stands."""

    old: str
    new: str

    def __post_init__(self):
        if not self.old:
            raise ValueError("the text to look for is empty")

    def apply(self, text: Column) -> Column:
        return F.replace(text, F.lit(self.old), F.lit(self.new))


def insert_before(mark: str, text: str) -> Replace:
    """Put `text` before every `mark`."""
    return Replace(mark, text + mark)


def insert_after(mark: str, text: str) -> Replace:
    """Put `text` after every `mark`."""
    return Replace(mark, mark + text)


def _changed(rows: DataFrame, column: str, edited: Column, where: Column | None) -> DataFrame:
    """The column with `edited` in the chosen rows; a null text stays null."""
    chosen = F.col(column).isNotNull() if where is None else F.col(column).isNotNull() & where
    return rows.withColumn(column, F.when(chosen, edited).otherwise(F.col(column)))


def edit_text(rows: DataFrame, column: str, edit: Replace, where: Column | None = None) -> DataFrame:
    """Edit a text column of all rows, or of those matching `where`."""
    return _changed(rows, column, edit.apply(F.col(column)), where)


def _command_words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def edit_flag_values(code: DataFrame, flag: str, edit: Replace, where: Column | None = None) -> DataFrame:
    """Edit the word behind each occurrence of a flag in the arguments of codes; words are set apart by one blank."""
    words = _command_words(F.col("arguments"))
    behind = F.transform(
        words, lambda w, i: F.when((i > 0) & (F.get(words, i - 1) == flag), edit.apply(w)).otherwise(w))
    return _changed(code, "arguments", F.array_join(behind, " "), where)


def join_flag_values(code: DataFrame, flag: str, where: Column | None = None) -> DataFrame:
    """Give a repeated flag in the arguments of codes once, with its values joined by commas.

    The first value comes first, the others follow from the last one back.
    """
    words = _command_words(F.col("arguments"))
    places = F.filter(F.sequence(F.lit(0), F.size(words)), lambda i: F.coalesce(F.get(words, i) == flag, F.lit(False)))
    first = F.get(places, F.lit(0))
    repeats = F.filter(places, lambda i: i > first)
    values = F.concat(
        F.array(F.get(words, first + 1)), F.transform(F.reverse(repeats), lambda i: F.get(words, i + 1)))
    joined = F.transform(words, lambda w, i: F.when(i == first + 1, F.array_join(values, ",")).otherwise(w))
    kept = F.filter(joined, lambda w, i: ~F.array_contains(repeats, i) & ~F.array_contains(repeats, i - 1))
    return _changed(code, "arguments", F.array_join(F.when(F.size(repeats) > 0, kept).otherwise(words), " "), where)


def arguments_with_root(code: DataFrame, root: str) -> DataFrame:
    """Codes whose arguments hold the literal root folder, with ``{ROOTDIR}`` in its place."""
    return code.where(F.col("arguments").contains(root)).withColumn(
        "arguments", F.replace("arguments", F.lit(root), F.lit("{ROOTDIR}"))
    )


# Text columns that may hold name fields, and the column that leads to the product.
_NAMED = {
    "product": ("product_id", ("product_name", "relative_path", "format", "product_description")),
    "inspector": ("product", ("filename", "relative_path", "description", "arguments")),
    "process": ("output_product", ("process_name", "extra_params")),
    "file": ("product_id", ("filename", "verbose_provenance", "quality_comment", "process_keywords")),
}


def fill_names(catalogue: Catalogue, table: str, product_trace: DataFrame) -> DataFrame:
    """A table with ``{PRODUCT}``, ``{INSTRUMENT}`` and the other name fields in its text filled in.

    Rows whose product has no trace-back keep their text.  `product_trace`
    needs one row per product.
    """
    column, texts = _NAMED[table]
    rows = getattr(catalogue, table)
    names = product_trace.select(
        F.col("product_id").alias(column), F.col("product_name").alias("_product"), F.col("level").alias("_level"),
        F.col("instrument_name").alias("_instrument"), F.col("satellite_name").alias("_satellite"),
        F.col("mission_name").alias("_mission"), F.col("rootdir").alias("_rootdir"),
    )
    fields = {
        "INSTRUMENT": F.col("_instrument"), "SATELLITE": F.col("_satellite"), "SPACECRAFT": F.col("_satellite"),
        "MISSION": F.col("_mission"), "PRODUCT": F.col("_product"), "LEVEL": F.col("_level"),
        "ROOTDIR": F.col("_rootdir"),
    }
    filled = {t: substitute_names(F.col(t), fields) for t in texts if t in rows.columns}
    return rows.join(names, column, "left").withColumns(filled).select(*rows.columns)


def move_product(
    catalogue: Catalogue, product: int, new_path: str, product_trace: DataFrame, root: str
) -> tuple[DataFrame, DataFrame]:
    """The product table with the new directory, and (old path, new path) of its files on disk."""
    is_it = F.col("product_id") == product
    files = catalogue.file.where(is_it & F.col("exists_on_disk"))
    moved_trace = product_trace.withColumn(
        "relative_path", F.when(is_it, F.lit(new_path)).otherwise(F.col("relative_path"))
    )
    before = full_paths(files, product_trace, root).select("file_id", F.col("full_path").alias("old_path"))
    after = full_paths(files, moved_trace, root).select("file_id", F.col("full_path").alias("new_path"))
    product_table = catalogue.product.withColumn(
        "relative_path", F.when(is_it, F.lit(new_path)).otherwise(F.col("relative_path"))
    )
    return product_table, before.join(after, "file_id")


def rename_files(files: DataFrame, renames: DataFrame) -> DataFrame:
    """Files with the names of `renames` (filename, new_name) exchanged."""
    return (
        files.join(renames.select("filename", "new_name"), "filename", "left")
        .withColumn("filename", F.coalesce("new_name", "filename"))
        .select(*files.columns)
    )


def set_code_current(code: DataFrame, ids: DataFrame, current: bool) -> DataFrame:
    """Set the newest and the active flag of the given codes together."""
    marked = ids.select("code_id", F.lit(True).alias("_marked")).distinct()
    hit = F.col("_marked").isNotNull()
    flag = F.lit(current)
    return (
        code.join(marked, "code_id", "left")
        .withColumns({
            "newest_version": F.when(hit, flag).otherwise(F.col("newest_version")),
            "active_code": F.when(hit, flag).otherwise(F.col("active_code")),
        })
        .select(*code.columns)
    )


def succeed_codes(code: DataFrame, successors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Append new codes in place of old ones.

    `successors` has the code columns of the new code and `replaces`, the id
    of the old.  A new code must have a higher version than the one it
    replaces; returned are the code table with old codes retired and accepted
    new ones current, and the refused rows with their reason.
    """
    old = code.select(F.col("code_id").alias("replaces"), version_of().alias("_old"))
    checked = successors.join(old, "replaces", "left")
    reason = F.when(F.col("_old").isNull(), "no such code").when(
        ~(version_of() > F.col("_old")),
        F.concat(F.lit("version is not above "), format_version(F.col("_old"))),
    )
    checked = checked.withColumn("reason", reason)
    accepted = checked.where("reason IS NULL")
    retired = set_code_current(code, accepted.select(F.col("replaces").alias("code_id")), False)
    new = accepted.withColumns({"newest_version": F.lit(True), "active_code": F.lit(True)}).select(*code.columns)
    return retired.unionByName(new), checked.where("reason IS NOT NULL").select("code_id", "replaces", "reason")


def delete_rows(table: DataFrame, keys: DataFrame) -> DataFrame:
    """The table without the rows that match the key columns of `keys`."""
    return table.join(keys, keys.columns, "left_anti").select(*table.columns)


def delete_processes(catalogue: Catalogue, ids: DataFrame) -> Catalogue:
    """Remove processes (`process_id`) with their input links."""
    return catalogue.replace(
        process=delete_rows(catalogue.process, ids.select("process_id")),
        productprocesslink=delete_rows(catalogue.productprocesslink, ids.select("process_id")),
    )


def add_input_links(catalogue: Catalogue, links: DataFrame) -> DataFrame:
    """Input links (process_id, input_product_id, ...) that do not exist yet, defaults filled."""
    from tidemark.model import conform

    rows = conform(links.withColumn("optional", F.coalesce("optional", F.lit(False)))
                   if "optional" in links.columns else links.withColumn("optional", F.lit(False)),
                   "productprocesslink")
    return rows.dropDuplicates(["process_id", "input_product_id"]).join(
        catalogue.productprocesslink, ["process_id", "input_product_id"], "left_anti"
    )
