"""What has to be made or made again: from changed files to a run list.

One pass plans all changed files at once:

``affected``         changed newest files -> (process, day) cells
``required_inputs``  the newest files on disk each cell needs
``with_code``        the code valid for the process on the day
``with_output``      name, level and product of the output
``with_version``     the version to write, or why nothing is to be done
``run_list``         one row per output, in order, with its command

A row that drops out keeps its cell with a `reason`.  No step loops over
files, days or processes; only the walk past existing versions takes
rounds, as many as their number has binary digits.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between
from tidemark.functions.templates import date_fields, fill
from tidemark.functions.text import basename, join_path, keyword_map, merge_keywords
from tidemark.functions.version import (
    PARTS,
    format_version,
    next_version,
    version,
    version_difference,
    version_of,
)
from tidemark.model import Catalogue
from tidemark.operators import workset
from tidemark.operators.catalogue import (
    CELL,
    cell_versions,
    first_seen,
    in_date_range,
    newest,
    newest_ids,
    resolve,
    select_files,
)
from tidemark.operators.skew import join_to_groups
from tidemark.operators.trace import code_for_process, process_of_output, trace_products
from tidemark.session import durable

# Timebases that can be planned, and the level of a run without output.
TIMEBASES = ("FILE", "DAILY", "RUN")
RUN_LEVEL = 5000.0

# A plan row: one per cell, for FILE processes also per trigger keyword, and per asked bump.
KEY = ["process_id", "day", "keywords", "version_bump"]
# A list of products up to this long is given to the scan as a filter; longer ones are left to the join.
PRUNED_PRODUCTS = 1_000

_VERSION_ORDER = ["interface_version", "quality_version", "revision_version"]


def _same(left: str, right: str, keys: list[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    )


# -- pruning ---------------------------------------------------------------


def _near(files: DataFrame, cells: DataFrame) -> DataFrame:
    """The rows of `files` in the given cells (product_id, utc_file_date).

    The first and last date and the products of the cells, one small row,
    become literals, so that the scan is pruned to their months and products;
    the semi-join does the rest.  A null date is a cell of its own.
    """
    bounds = cells.agg(
        F.min("utc_file_date").alias("first"), F.max("utc_file_date").alias("last"),
        F.collect_set("product_id").alias("products"), F.max(F.col("utc_file_date").isNull()).alias("undated"),
    ).first()
    kept = files.where(F.col("product_id").isin(bounds.products)) if len(bounds.products) <= PRUNED_PRODUCTS else files
    if not bounds.undated:
        kept = in_date_range(kept, bounds.first, bounds.last)
    keys = cells.select(*[F.col(c).alias(f"_{c}") for c in CELL]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in CELL])
    return kept.join(keys, same, "left_semi")


# -- affected cells ---------------------------------------------------------


def chosen_processes(catalogue: Catalogue, keys: list[int | str]) -> DataFrame:
    """The processes (`process_id`) of a list of ids and names; what matches nothing is left out."""
    given = catalogue.process.sparkSession.createDataFrame([(str(k),) for k in keys], "key string")
    found = resolve(given, catalogue.process, "process_id", "process_name")
    return found.where("id IS NOT NULL").select(F.col("id").alias("process_id")).distinct()


def affected(
    catalogue: Catalogue, queue: DataFrame, skip_run: bool = False, only: list[int | str] | None = None,
    neighbours: bool = False,
) -> DataFrame:
    """Cells to plan for the queued files (`file_id`, `version_bump`).

    Files that are not newest trigger nothing.  A file triggers every day its
    data touch.  With `neighbours` it also triggers the days that use it as
    yesterday's or tomorrow's input.  A timebase that cannot be planned
    leaves its rows with a reason.  `only` limits the processes, given by id
    or name.
    """
    files = catalogue.file.select(
        "file_id", "product_id", "utc_file_date", "process_keywords",
        F.to_date("utc_start_time").alias("_first"), F.to_date("utc_stop_time").alias("_last"),
    )
    queued = durable(
        queue.select("file_id", F.col("version_bump").cast("smallint").alias("version_bump")).join(files, "file_id"))
    ranked = newest_ids(_near(catalogue.file, queued))
    changed = queued.join(ranked, "file_id", "left_semi")
    process = catalogue.process.select("process_id", F.col("output_timebase").alias("timebase"))
    if skip_run:
        process = process.where(~F.col("timebase").eqNullSafe("RUN"))
    if only is not None:
        process = process.join(chosen_processes(catalogue, only), "process_id", "left_semi")
    links = catalogue.productprocesslink.select(
        "process_id", F.col("input_product_id").alias("product_id"), "yesterday", "tomorrow")
    first, last = F.col("_first"), F.col("_last")
    if neighbours:
        first, last = F.date_sub(first, F.col("tomorrow")), F.date_add(last, F.col("yesterday"))
    by_file = F.col("timebase") == "FILE"
    planned = F.col("timebase").isin(*TIMEBASES)
    return (
        changed.join(links.join(process, "process_id"), "product_id")
        .select(
            "process_id", "timebase", F.explode(days_between(first, last)).alias("day"),
            F.when(by_file, F.col("process_keywords")).alias("keywords"), "version_bump",
            F.when(~F.coalesce(planned, F.lit(False)), F.lit("timebase not supported")).alias("reason"),
        )
        .distinct()
    )


# -- inputs -----------------------------------------------------------------


def _spans(files: DataFrame) -> DataFrame:
    """Newest file of each product, file date and pair of days its data start and end on.

    Whether a file overlaps a window of whole days depends on these days
    alone, so ranking inside each span first loses nothing, and a crowded
    cell shrinks to its few distinct spans before anything is joined.
    """
    narrow = files.select(
        "file_id", "product_id", "utc_file_date", *_VERSION_ORDER, "process_keywords",
        F.to_date("utc_start_time").alias("first_day"), F.to_date("utc_stop_time").alias("last_day"),
    )
    return newest(narrow, ["product_id", "utc_file_date", "first_day", "last_day"])


def _serving(files: DataFrame, links: DataFrame, first, last) -> DataFrame:
    """The rows of `files` that can serve a day from `first` to `last`, pruned where the scan can do it.

    The widest windows of the links and their products, one small row, become
    literals.  Processes that go by file date need a date in reach, DAILY
    ones a time; with both, either will do.
    """
    bounds = links.agg(
        F.max("yesterday").alias("back"), F.max("tomorrow").alias("ahead"), F.collect_set("input_product_id").alias("products"),
        F.max(F.col("timebase").eqNullSafe("DAILY")).alias("by_time"), F.max(~F.col("timebase").eqNullSafe("DAILY")).alias("by_date"),
    ).first()
    if first is None or not bounds.products:
        return files.where(F.lit(False))
    low, high = first - dt.timedelta(days=max(bounds.back, 0)), last + dt.timedelta(days=max(bounds.ahead, 0))
    if len(bounds.products) <= PRUNED_PRODUCTS:
        files = files.where(F.col("product_id").isin(bounds.products))
    if not bounds.by_time:
        return in_date_range(files, low, high)
    in_time = (F.col("utc_stop_time") >= F.lit(low).cast("timestamp_ntz")) & (
        F.col("utc_start_time") < F.lit(high + dt.timedelta(days=1)).cast("timestamp_ntz"))
    in_date = F.col("utc_file_date").between(F.lit(low), F.lit(high))
    return files.where(in_time | in_date if bounds.by_date else in_time)


def input_candidates(files: DataFrame, links: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Files each cell may take, newest per input product and file date.

    `links` has process_id, timebase, input_product_id, optional, yesterday
    and tomorrow.  DAILY processes match the days the data span, the others
    the file date.  Each file is repeated for the days it can serve, so the
    match is an equi join and not a range join.  With `wanted` (process_id,
    day) only these cells are ranked.
    """
    daily = F.col("timebase") == "DAILY"
    first = F.when(daily, F.col("first_day")).otherwise(F.col("utc_file_date"))
    last = F.when(daily, F.col("last_day")).otherwise(F.col("utc_file_date"))
    days = days_between(F.date_sub(first, F.col("tomorrow")), F.date_add(last, F.col("yesterday")))
    spans = _spans(files).withColumnRenamed("product_id", "input_product_id")
    rows = spans.join(links, "input_product_id").withColumn("day", F.explode(days))
    if wanted is not None:
        rows = rows.join(wanted, ["process_id", "day"], "left_semi")
    return newest(rows, ["process_id", "day", "input_product_id", "utc_file_date"])


def as_date(value) -> dt.date:
    """A date bound given as text, date or time."""
    if isinstance(value, str):
        return dt.date.fromisoformat(value[:10])
    return value.date() if isinstance(value, dt.datetime) else value


def _links(catalogue: Catalogue) -> DataFrame:
    process = catalogue.process.select("process_id", F.col("output_timebase").alias("timebase"))
    return catalogue.productprocesslink.select(
        "process_id", "input_product_id", "optional", "yesterday", "tomorrow").join(process, "process_id")


def required_inputs(catalogue: Catalogue, cells: DataFrame) -> DataFrame:
    """Plan rows with their `inputs` (sorted file ids), or the reason there are none.

    Inputs are the newest files *on disk*.  A required product with no file
    cancels the row, an optional one may be absent.  A FILE process then
    keeps the inputs whose keywords equal the trigger's (null equals null).
    """
    links = _links(catalogue)
    live = cells.where("reason IS NULL")
    wanted = live.select("process_id", "day").distinct()
    used = links.join(wanted.select("process_id").distinct(), "process_id", "left_semi")
    reach = wanted.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    serving = _serving(catalogue.file.where("exists_on_disk"), used, reach.first, reach.last)
    found = input_candidates(serving, used, wanted)
    needed = links.groupBy("process_id").agg(
        F.count(F.when(~F.col("optional"), 1)).alias("_needed"))
    # Bounded by the days in a process's input windows, not by the files.
    gathered = found.groupBy("process_id", "day").agg(
        F.array_sort(F.collect_list(F.struct("file_id", "process_keywords"))).alias("_found"),
        F.size(F.collect_set(F.when(~F.col("optional"), F.col("input_product_id")))).alias("_present"),
    )
    rows = (
        cells.join(gathered, ["process_id", "day"], "left").join(needed, "process_id", "left")
    )
    matching = F.when(
        F.col("timebase") == "FILE",
        F.filter("_found", lambda f: f["process_keywords"].eqNullSafe(F.col("keywords"))),
    ).otherwise(F.col("_found"))
    rows = rows.withColumn("_kept", F.coalesce(matching, F.array().cast("array<struct<file_id:bigint,process_keywords:string>>")))
    missing = F.coalesce("_present", F.lit(0)) < F.coalesce("_needed", F.lit(0))
    reason = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(missing, F.lit("required input missing"))
        .when(F.size("_kept") == 0, F.lit("no inputs"))
    )
    return rows.select(
        *KEY, "timebase", reason.alias("reason"),
        F.transform("_kept", lambda f: f["file_id"]).alias("inputs"),
        F.transform("_kept", lambda f: f["process_keywords"]).alias("input_keywords"),
    )


# -- code and output --------------------------------------------------------


def with_code(catalogue: Catalogue, plan: DataFrame, dated: DataFrame) -> DataFrame:
    """Add the code valid for the process on the day; none or several is a reason not to run.

    `dated` has the distinct (process_id, day) pairs of the plan, and may
    have more.  Taken from the cells, they spare a second run of the inputs.
    """
    code = code_for_process(dated, catalogue.code)
    facts = catalogue.code.select("code_id", "output_interface_version", version_of().alias("code_version"))
    reason = F.coalesce(
        "reason",
        F.when(F.col("n_codes") == 0, F.lit("no active code")).when(F.col("n_codes") > 1, F.lit("several active codes")),
    )
    return (
        plan.join(code, ["process_id", "day"], "left")
        .join(facts, "code_id", "left")
        .withColumn("reason", reason)
        .drop("n_codes")
    )


def with_output(catalogue: Catalogue, plan: DataFrame) -> DataFrame:
    """Add output product, level and the file name with its version still open.

    Keywords of the inputs fill fields of the same name; inputs without any
    keywords leave them open.  A RUN process makes no file and is named after
    itself and its lowest input.
    """
    # One trace-back per product, or the product is left out.
    facts = ["level", "format", "product_name", "instrument_name", "satellite_name"]
    product = (
        trace_products(catalogue, inspectors=True)
        .groupBy(F.col("product_id").alias("output_product"))
        .agg(F.count(F.lit(1)).alias("_chains"), *[F.any_value(c).alias(c) for c in facts])
        .where("_chains = 1")
        .withColumnRenamed("level", "data_level")
        .drop("_chains")
    )
    names = {
        "SATELLITE": F.col("satellite_name"), "PRODUCT": F.col("product_name"), "INSTRUMENT": F.col("instrument_name"),
    }
    # What hangs on the product alone is worked out once per product.
    product = product.withColumns({
        "_fields": F.regexp_extract_all("format", F.lit(r"\{([^{}]*)\}"), F.lit(1)), "_named": fill(F.col("format"), names),
    })
    process = catalogue.process.select("process_id", "process_name", "output_product")
    rows = plan.join(process, "process_id").join(product, "output_product", "left")
    run = F.col("timebase") == "RUN"
    words = F.when(
        ~F.exists("input_keywords", lambda k: k.isNull()),
        merge_keywords(F.transform("input_keywords", keyword_map)),
    )
    by_keyword = F.aggregate(
        F.map_entries(F.coalesce(words, F.create_map().cast("map<string,string>"))),
        F.col("format"),
        lambda text, kv: F.replace(text, F.concat(F.lit("{"), kv["key"], F.lit("}")), kv["value"]),
    )
    # Keywords are taken apart only where one may name a field of the template, days written only as the template asks.
    may_fill = F.exists("input_keywords", lambda k: k.contains("{") | k.contains("}") | F.exists("_fields", lambda f: k.contains(f)))
    rows = rows.withColumn("_template", F.when(may_fill, fill(by_keyword, names)).otherwise(F.col("_named")))
    named = fill(F.col("_template"), {
        field: F.when(F.col("_template").contains("{" + field), text) for field, text in date_fields(F.col("day")).items()
    })
    run_name = F.concat(
        F.lit("RUN_"), "process_name", F.lit("_"), F.coalesce(F.array_min("inputs").cast("string"), F.lit("none")))
    reason = F.coalesce("reason", F.when(~run & F.col("data_level").isNull(), F.lit("no single traceback of the output")))
    return rows.select(
        *[c for c in plan.columns if c != "reason"], "process_name",
        F.when(~run, F.col("output_product")).alias("output_product"),
        F.when(run, F.lit(RUN_LEVEL)).otherwise(F.col("data_level")).alias("data_level"),
        F.when(run, run_name).otherwise(named).alias("name_template"),
        reason.alias("reason"),
    )


# -- version ----------------------------------------------------------------


def existing_outputs(catalogue: Catalogue, plan: DataFrame) -> DataFrame:
    """Files that already carry a plan row's name at some version.

    An output belongs to its product and day; within that cell rows and files
    meet on the part of the name before the version, so a crowded cell makes
    no pairs of unlike names.  A name without a version field stands for
    whatever version is asked.
    """
    live = plan.where("reason IS NULL AND timebase <> 'RUN'").select(
        *KEY, "output_product", "name_template", "output_interface_version")
    open_name = F.col("name_template").contains("{VERSION}")
    # A template's text before its first version field is the start of the name before that version;
    # a name is listed under each place its version stands at, and whole for names without a field.
    live = live.withColumn("_key", F.substring_index("name_template", "{VERSION}", 1)).withColumn("_open", open_name)
    cells = live.select(F.col("output_product").alias("product_id"), F.col("day").alias("utc_file_date")).distinct()
    files = _near(catalogue.file, cells).select("file_id", "filename", *CELL, version_of().alias("_version"))
    files = files.withColumn("_text", format_version(F.col("_version")))
    places = F.filter(
        F.sequence(F.lit(1), F.greatest(F.length("filename"), F.lit(1))),
        lambda i: F.substring(F.col("filename"), i, F.length("_text")) == F.col("_text"))
    def before(i: Column) -> Column:
        return F.struct(F.lit(True).alias("open"), F.substring(F.col("filename"), F.lit(1), i - 1).alias("key"))

    whole = F.struct(F.lit(False).alias("open"), F.col("filename").alias("key"))
    # Most names hold their version once; only others are searched place by place.
    first, second = F.col("_place"), F.position(F.col("_text"), F.col("filename"), F.col("_place") + 1)
    keys = (
        F.when(first == 0, F.array(whole))
        .when(second == 0, F.array(before(first), whole))
        .otherwise(F.concat(F.transform(places, before), F.array(whole)))
    )
    files = files.withColumn("_place", F.position(F.col("_text"), F.col("filename"))).withColumn("_keys", keys)
    listed = files.withColumn("_at", F.explode("_keys")).drop("_place", "_keys")
    same = (
        (F.col("output_product") == F.col("product_id")) & (F.col("day") == F.col("utc_file_date"))
        & (F.col("_key") == F.col("_at.key")) & (F.col("_open") == F.col("_at.open"))
    )
    name = F.replace("name_template", F.lit("{VERSION}"), F.col("_text"))
    start = version(F.col("output_interface_version"), 0, 0)
    return live.join(listed, same).where(F.col("filename") == name).select(
        *KEY, "file_id", F.col("_open").alias("versioned"),
        F.when(F.col("_open"), F.col("_version")).otherwise(start).alias("version"),
    )


def parent_changes(catalogue: Catalogue, ids: DataFrame) -> DataFrame:
    """Per file: how many inputs it was made from and the worst change among them.

    `changed` is 2 when an input has a newer revision only, 1 when a newer
    quality or interface, null when all are current.  The newest version of
    an input's product and day counts whether it is on disk or not.
    """
    links = catalogue.filefilelink.join(
        ids.select(F.col("file_id").alias("resulting_file")).distinct(), "resulting_file", "left_semi")
    # Ids of parents first: only their cells are ranked and compared.
    used = links.select(F.col("source_file").alias("file_id")).distinct()
    files = catalogue.file.select("file_id", *CELL, *_VERSION_ORDER)
    parents = files.join(used, "file_id", "left_semi")
    compared = join_to_groups(
        parents.select("file_id", *CELL, version_of().alias("_version")), cell_versions(files), CELL, "file_id")
    gap = version_difference(F.col("max_version"), F.col("_version"))
    stale = F.when((gap["interface"] != 0) | (gap["quality"] != 0), 1).when(gap["revision"] != 0, 2)
    state = compared.select(F.col("file_id").alias("source_file"), stale.alias("_stale"))
    return (
        links.join(state, "source_file")
        .groupBy(F.col("resulting_file").alias("file_id"))
        .agg(F.count(F.lit(1)).alias("n_parents"), F.min("_stale").alias("changed"))
    )


def output_steps(catalogue: Catalogue, plan: DataFrame, existing: DataFrame) -> DataFrame:
    """For each existing output: the version that follows it, or the outcome that stops there.

    In order: an asked bump; a change of code (an interface change counts as
    quality); a different number of inputs; a newer input.  Outcomes are
    ``up to date``, ``no parents`` (run again under the same name) and
    errors, which are never walked past.
    """
    facts = plan.select(*KEY, F.size("inputs").alias("_inputs"), F.col("code_id").alias("_code"), "code_version")
    ids = existing.select("file_id").distinct()
    codes = catalogue.filecodelink.withColumnRenamed("resulting_file", "file_id")
    made = ids.join(codes, "file_id", "left").groupBy("file_id").agg(F.min("source_code").alias("_made_by"))
    # Without a recorded code, the one valid for the maker of the product on that day.
    unknown = made.where("_made_by IS NULL").join(
        catalogue.file.select("file_id", "product_id", F.col("utc_file_date").alias("day")), "file_id"
    ).join(process_of_output(catalogue), "product_id")
    inferred = unknown.select("file_id", "process_id", "day").join(
        code_for_process(unknown.select("process_id", "day").distinct(), catalogue.code), ["process_id", "day"]
    ).select("file_id", F.col("code_id").alias("_inferred"))
    old_code = catalogue.code.select(F.col("code_id").alias("_made_by"), version_of().alias("_old_version"))
    made = (
        made.join(inferred, "file_id", "left")
        .select("file_id", F.coalesce("_made_by", "_inferred").alias("_made_by"))
        .join(old_code, "_made_by", "left")
    )
    rows = (
        existing.alias("e").join(facts.alias("p"), _same("e", "p", KEY))
        .select("e.*", "p._inputs", "p._code", "p.code_version")
        .join(made, "file_id", "left")
        .join(parent_changes(catalogue, ids), "file_id", "left")
    )
    change = version_difference(F.col("code_version"), F.col("_old_version"))
    any_up = (change["quality"] > 0) | (change["revision"] > 0)
    other_code = ~F.col("_code").eqNullSafe(F.col("_made_by"))

    def go(part) -> Column:
        part = part if isinstance(part, Column) else F.lit(part)
        return F.struct(part.cast("smallint").alias("part"), F.lit(None).cast("string").alias("outcome"))

    def stop(word: str) -> Column:
        return F.struct(F.lit(None).cast("smallint").alias("part"), F.lit(word).alias("outcome"))

    # The part to raise first and the version from it: a version built in every branch makes code too long to be compiled.
    step = (
        F.when(F.col("version_bump").isNotNull(), go(F.col("version_bump")))
        .when(F.col("_old_version").isNull(), stop("error: code of existing output unknown"))
        .when(other_code & (F.col("_old_version") == F.col("code_version")), stop("error: two codes of one version"))
        .when(other_code & (change["interface"] != 0), go(1))
        .when(other_code & any_up, go(F.when(change["quality"] > 0, 1).otherwise(2)))
        .when(other_code, stop("error: code is older than that of the existing output"))
        .when(F.col("_inputs") == 0, stop("up to date"))
        .when(F.col("n_parents").isNull(), stop("no parents"))
        .when(F.col("n_parents") != F.col("_inputs"), go(1))
        .when(F.col("changed") == 1, go(1))
        .when(F.col("changed") == 2, go(2))
        .otherwise(stop("up to date"))
    )
    stepped = rows.select(*KEY, "version", "versioned", step.alias("_step")).select(
        *KEY, "version", "versioned", F.col("_step.outcome").alias("_outcome"),
        next_version(F.col("version"), F.col("_step.part")).alias("_next"))
    endless = ~F.col("versioned") & F.col("_next").isNotNull()
    return stepped.select(
        *KEY, "version",
        F.when(~endless, F.col("_next")).alias("next"),
        F.when(endless, F.lit("error: name carries no version")).otherwise(F.col("_outcome")).alias("outcome"),
    )


def walk(starts: DataFrame, steps: DataFrame) -> DataFrame:
    """Follow the steps from each start to the version to write or to a stop.

    `starts` has the key and `start`; `steps` the key, `version`, `next` and
    `outcome`.  Adds `version` and `outcome` (``run`` when the version is
    free).  Pointer doubling: after n rounds each step knows what lies 2^n
    steps ahead.  The join key holds the version, so no single key gathers
    many rows, however many versions an output has.
    """
    state = durable(steps.select(
        *KEY, "version", F.coalesce("next", "version").alias("at"),
        F.when(F.col("next").isNull(), F.col("outcome")).alias("outcome"),
    ))
    while not state.where("outcome IS NULL").isEmpty():
        ahead = state.select(*KEY, F.col("version").alias("at"), F.col("at").alias("_at"),
                             F.col("outcome").alias("_outcome"), F.lit(True).alias("_known"))
        joined = state.where("outcome IS NULL").alias("a").join(
            ahead.alias("b"), _same("a", "b", [*KEY, "at"]), "left")
        moved = joined.select(
            *[F.col(f"a.{k}") for k in KEY], "a.version",
            F.coalesce("b._at", "a.at").alias("at"),
            F.when(F.col("b._known").isNull(), F.lit("run")).otherwise(F.col("b._outcome")).alias("outcome"),
        )
        state = durable(state.where("outcome IS NOT NULL").unionByName(moved))
    ends = state.select(*KEY, F.col("version").alias("start"), "at", "outcome")
    return starts.alias("s").join(ends.alias("e"), _same("s", "e", [*KEY, "start"]), "left").select(
        "s.*", F.coalesce("e.at", "s.start").alias("version"), F.coalesce("e.outcome", F.lit("run")).alias("outcome"))


def with_version(catalogue: Catalogue, plan: DataFrame, force: bool = False) -> DataFrame:
    """Add `version`, `filename`, `outcome` and `runnable`.

    `force` ignores what exists and writes the first version.
    """
    start = version(F.col("output_interface_version"), 0, 0)
    starts = plan.withColumn("start", start)
    live = F.col("reason").isNull() & (F.col("timebase") != "RUN")
    if force:
        walked = starts.select("*", F.col("start").alias("version"), F.lit("run").alias("outcome"))
    else:
        plan = starts = durable(starts)
        steps = output_steps(catalogue, plan, durable(existing_outputs(catalogue, plan)))
        steps = durable(steps)
        done = starts.where(~live).select("*", F.col("start").alias("version"), F.lit("run").alias("outcome"))
        walked = walk(starts.where(live), steps).unionByName(done)
    outcome = F.when(F.col("reason").isNotNull(), F.concat(F.lit("not runnable: "), "reason")).otherwise(F.col("outcome"))
    return walked.drop("start").withColumns({
        "filename": F.replace("name_template", F.lit("{VERSION}"), format_version(F.col("version"))),
        "outcome": outcome,
        "runnable": F.col("reason").isNull() & F.col("outcome").isin("run", "no parents"),
    })


# -- commands and the run list ----------------------------------------------


def with_arguments(catalogue: Catalogue, plan: DataFrame, root: str, code_root: str) -> DataFrame:
    """Add `code_path`, `params` and `arguments` with date, root and code fields filled."""
    process = catalogue.process.select("process_id", "extra_params")
    code = catalogue.code.select(
        "code_id", "relative_path", F.col("filename").alias("_code_file"), F.col("arguments").alias("_arguments"))
    rows = plan.join(process, "process_id", "left").join(code, "code_id", "left")
    code_version = format_version(F.col("code_version"))
    path = F.replace(join_path(F.lit(code_root), F.col("relative_path"), F.col("_code_file")),
                     F.lit("{CODEVERSION}"), code_version)
    rows = rows.withColumn("code_path", F.when(F.col("code_id").isNotNull(), path))
    folder = F.regexp_replace("code_path", "/[^/]*$", "")

    def filled(text: Column) -> Column:
        for mark, value in (
            ("{DATE}", F.date_format("day", "yyyyMMdd")), ("{ROOTDIR}", F.lit(root)),
            ("{CODEDIR}", folder), ("{CODEVERSION}", code_version),
        ):
            text = F.replace(text, F.lit(mark), value)
        return text

    nothing = F.array().cast("array<string>")
    params = F.coalesce(F.split(filled(F.col("extra_params")), r"\|"), nothing)
    words = F.filter(F.split(filled(F.col("_arguments")), r"\s+"), lambda w: w != "")
    return rows.withColumns({"params": params, "arguments": F.coalesce(words, nothing)}).drop(
        "extra_params", "relative_path", "_code_file", "_arguments")


def run_list(plan: DataFrame) -> DataFrame:
    """Runnable rows, equal ones once and each output name once, in (level, name) order."""
    equal = ["process_id", "day", "code_id", "output_product", "inputs", "filename", "version"]
    order = ["data_level", "day", "process_id", F.col("keywords").asc_nulls_first(),
             F.col("version_bump").asc_nulls_first()]
    name = basename(F.col("filename"))
    blank = F.coalesce(name == "", F.lit(True))
    # Equal rows have equal names, so one pass does both; rows without a name are told apart by the rest.
    keyed = plan.where("runnable").withColumns({"_name": name, "_equal": F.when(blank, F.struct(*equal))})
    return first_seen(keyed, ["_name", "_equal"], order).drop("_name", "_equal").orderBy("data_level", "filename")


def commands(runs: DataFrame, paths: DataFrame, out_dir: str) -> DataFrame:
    """Add `command`: code, parameters, arguments, input paths, output path.

    `paths` has file_id and full_path.  A RUN process has no output path.
    """
    by_input = runs.select("filename", F.explode("inputs").alias("file_id")).join(
        paths.select("file_id", "full_path"), "file_id")
    # Bounded by the inputs of one run.
    gathered = by_input.groupBy("filename").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("file_id", "full_path"))), lambda f: f["full_path"]).alias("_paths"))
    nothing = F.array().cast("array<string>")
    output = F.when(F.col("timebase") == "RUN", nothing).otherwise(
        F.array(join_path(F.lit(out_dir), F.col("filename"))))
    return runs.join(gathered, "filename", "left").withColumn(
        "command",
        F.concat(F.array("code_path"), "params", "arguments", F.coalesce("_paths", nothing), output),
    ).drop("_paths")


# -- entry points -----------------------------------------------------------


def plan_changes(
    catalogue: Catalogue, queue: DataFrame, skip_run: bool = False, only: list[int | str] | None = None,
    neighbours: bool = False,
) -> DataFrame:
    """Everything the queued files make necessary, one row per cell with its outcome."""
    cells = durable(affected(catalogue, queue, skip_run, only, neighbours))
    dated = cells.select("process_id", "day").distinct()
    plan = with_code(catalogue, required_inputs(catalogue, cells), dated)
    return with_version(catalogue, with_output(catalogue, plan))


def range_inputs(catalogue: Catalogue, processes: DataFrame, first, last) -> DataFrame:
    """Plan rows of the given processes (`process_id`) for every day of a range.

    A day takes the newest files of each input product, by time for DAILY
    processes and else by date, on disk or not; neighbouring days and
    optional marks do not count.  A process with input products has no row
    on a day without any file; one without has a row every day.
    """
    links = _links(catalogue).withColumns({"yesterday": F.lit(0), "tomorrow": F.lit(0)})
    links = links.join(processes.select("process_id").distinct(), "process_id", "left_semi")
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    serving = _serving(catalogue.file, links, as_date(first), as_date(last))
    found = input_candidates(serving, links).where((F.col("day") >= low) & (F.col("day") <= high))
    # Bounded by the input products of a process and the dates that touch one day.
    gathered = found.groupBy("process_id", "day").agg(
        F.array_sort(F.collect_list(F.struct("file_id", "process_keywords"))).alias("_found"))
    wanted = processes.select("process_id").distinct().join(
        catalogue.process.select("process_id", F.col("output_timebase").alias("timebase")), "process_id")
    taking = catalogue.productprocesslink.select("process_id").distinct().withColumn("_takes", F.lit(True))
    days = wanted.withColumn("day", F.explode(days_between(low, high))).join(taking, "process_id", "left")
    rows = days.join(gathered, ["process_id", "day"], "left").where("_found IS NOT NULL OR _takes IS NULL")
    empty = F.array().cast("array<struct<file_id:bigint,process_keywords:string>>")
    kept = F.coalesce("_found", empty)
    return rows.select(
        "process_id", "day", F.lit(None).cast("string").alias("keywords"),
        F.lit(None).cast("smallint").alias("version_bump"), "timebase",
        F.lit(None).cast("string").alias("reason"),
        F.transform(kept, lambda f: f["file_id"]).alias("inputs"),
        F.transform(kept, lambda f: f["process_keywords"]).alias("input_keywords"),
    )


def plan_range(
    catalogue: Catalogue, processes: DataFrame | list[int | str], first, last, version_bump: int | None = None,
    update: bool = False,
) -> DataFrame:
    """Plan processes over a range of days: by force, with a bump, or only what is out of date.

    The processes are a table of ids (`process_id`) or a list of ids and
    names.  Only `update` leaves out rows that are not runnable.
    """
    if not isinstance(processes, DataFrame):
        processes = chosen_processes(catalogue, processes)
    if update and version_bump is not None:
        raise ValueError("give update or a version bump, not both")
    rows = range_inputs(catalogue, processes, first, last).withColumn(
        "version_bump", F.lit(version_bump).cast("smallint"))
    days = F.explode(days_between(F.lit(first), F.lit(last)))
    dated = processes.select("process_id").distinct().withColumn("day", days)
    plan = with_output(catalogue, with_code(catalogue, rows, dated))
    out = with_version(catalogue, plan, force=version_bump is None and not update)
    return out.where("runnable") if update else out


def reprocess(catalogue: Catalogue, version_bump: int | None = None, **filters) -> DataFrame:
    """Queue rows for the newest files among those the filters leave, with an optional bump.

    The filters are those of :func:`tidemark.operators.catalogue.select_files`.
    """
    files = select_files(catalogue, newest_version=True, **filters)
    return workset.raw_add(catalogue.processqueue, files, version_bump)
