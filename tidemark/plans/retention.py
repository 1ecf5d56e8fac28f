"""Which old files may go, and the table of what to do with each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import join_path
from tidemark.model import Catalogue
from tidemark.operators.catalogue import newest_ids
from tidemark.operators.lineage import reach


def retention_candidates(catalogue: Catalogue, cutoff) -> DataFrame:
    """Ids of the files that nothing keeps.

    Kept are the newest files, released files and everything those were made
    from, plus input-less files dated up to `cutoff` and all made from them.
    """
    files, links = catalogue.file, catalogue.filefilelink
    wanted = newest_ids(files).unionByName(catalogue.release.select("file_id"))
    made = links.select(F.col("resulting_file").alias("file_id")).distinct()
    old = files.where(F.col("utc_file_date") <= F.lit(cutoff).cast("date")).select("file_id")
    old_roots = old.join(made, "file_id", "left_anti")
    # Both directions in one loop: a node is twice the id, plus one on the way down.
    up, down = F.lit(0), F.lit(1)

    def node(column: str, way) -> Column:
        return F.col(column).cast("long") * 2 + way

    seeds = wanted.select(node("file_id", up).alias("node")).unionByName(old_roots.select(node("file_id", down).alias("node")))
    edges = links.select(node("resulting_file", up).alias("node"), node("source_file", up).alias("next")).unionByName(
        links.select(node("source_file", down).alias("node"), node("resulting_file", down).alias("next")))
    kept = reach(seeds, edges).select(F.shiftright("node", 1).alias("file_id"))
    return files.select("file_id").join(kept, "file_id", "left_anti")


def reap_plan(
    candidates: DataFrame, paths: DataFrame, action: str, root: str, archive: str | None = None,
    spare_last: bool = False,
) -> DataFrame:
    """One row per file or record to reap, newest first within product and date.

    `paths` has the file columns and `full_path`.  ``action="files"`` covers
    files on disk (deleted, or moved below `archive`); ``"records"`` covers
    catalogue rows whose file is gone.  `spare_last` leaves out the last
    candidate by product, date and version.
    """
    if action not in ("files", "records"):
        raise ValueError("action must be 'files' or 'records'")
    if archive is not None and action != "files":
        raise ValueError("an archive folder needs action='files'")
    order = ["product_id", "utc_file_date", "interface_version", "quality_version", "revision_version", "file_id"]
    rows = paths.join(candidates.select("file_id"), "file_id", "left_semi")
    if spare_last:
        last = rows.orderBy(*[F.col(c).desc() for c in order]).limit(1).select("file_id")
        rows = rows.join(last, "file_id", "left_anti")
    rows = rows.where(F.col("exists_on_disk") if action == "files" else ~F.col("exists_on_disk"))
    if action == "records":
        target, word = F.lit(None).cast("string"), "purge record"
    elif archive is None:
        target, word = F.lit(None).cast("string"), "delete file"
    else:
        start = root.rstrip("/") + "/"
        path = F.col("full_path")
        inner = F.when(path.startswith(F.lit(start)), F.substr(path, F.lit(len(start) + 1))).otherwise(path)
        target, word = join_path(F.lit(archive), inner), "archive file"
    return (
        rows.select("file_id", "full_path", target.alias("archive_path"), F.lit(word).alias("action"), *order[:-1])
        .orderBy(*[F.col(c).desc() for c in order])
        .drop(*order[:-1])
    )
