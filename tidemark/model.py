"""The sixteen catalogue tables: columns, keys, references and checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "id": T.LongType(),
    "int": T.IntegerType(),
    "short": T.ShortType(),
    "float": T.DoubleType(),
    "bool": T.BooleanType(),
    "text": T.StringType(),
    "date": T.DateType(),
    "time": T.TimestampNTZType(),
}

VERSION_COLUMNS = ("interface_version", "quality_version", "revision_version")


@dataclass(frozen=True)
class Table:
    """Columns (``name kind``, nullable ones end in ``?``) and rules of one table."""

    columns: str
    key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    references: dict[str, str] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        fields = []
        for item in self.columns.split(","):
            name, kind = item.split()
            fields.append(T.StructField(name, _TYPES[kind.rstrip("?")], kind.endswith("?")))
        return T.StructType(fields)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


# Table layouts and rules of the catalogue's public data model.
TABLES: dict[str, Table] = {
    "mission": Table(
        "mission_id id, mission_name text, rootdir text, incoming_dir text, codedir text?,"
        "inspectordir text?, errordir text?",
        key=("mission_id",),
        unique=(("mission_name",),),
    ),
    "satellite": Table(
        "satellite_id id, satellite_name text, mission_id id",
        key=("satellite_id",),
        unique=(("satellite_name", "mission_id"),),
        references={"mission_id": "mission.mission_id"},
    ),
    "instrument": Table(
        "instrument_id id, instrument_name text, satellite_id id",
        key=("instrument_id",),
        unique=(("instrument_name", "satellite_id"),),
        references={"satellite_id": "satellite.satellite_id"},
    ),
    "product": Table(
        "product_id id, product_name text, instrument_id id, relative_path text, level float,"
        "format text, product_description text?",
        key=("product_id",),
        unique=(("product_name", "instrument_id", "relative_path"),),
        references={"instrument_id": "instrument.instrument_id"},
    ),
    "instrumentproductlink": Table(
        "instrument_id id, product_id id",
        key=("instrument_id", "product_id"),
        references={
            "instrument_id": "instrument.instrument_id",
            "product_id": "product.product_id",
        },
    ),
    "process": Table(
        "process_id id, process_name text, output_product id?, output_timebase text?,"
        "extra_params text?",
        key=("process_id",),
        unique=(("process_name", "output_product"),),
        references={"output_product": "product.product_id"},
    ),
    "productprocesslink": Table(
        "process_id id, input_product_id id, optional bool, yesterday int, tomorrow int",
        key=("process_id", "input_product_id"),
        references={
            "process_id": "process.process_id",
            "input_product_id": "product.product_id",
        },
        defaults={"yesterday": 0, "tomorrow": 0},
    ),
    "file": Table(
        "file_id id, filename text, utc_file_date date?, utc_start_time time?, utc_stop_time time?,"
        "data_level float, interface_version short, quality_version short, revision_version short,"
        "verbose_provenance text?, check_date time?, quality_comment text?, caveats text?,"
        "file_create_date time, met_start_time float?, met_stop_time float?, exists_on_disk bool,"
        "quality_checked bool?, product_id id, shasum text?, process_keywords text?",
        key=("file_id",),
        unique=(
            ("filename",),
            # One file per date, product and version.  The stored form of this
            # rule names quality_comment; pass `unique=` to check that instead.
            ("utc_file_date", "product_id") + VERSION_COLUMNS,
        ),
        references={"product_id": "product.product_id"},
        checks={
            "has_stop": "utc_stop_time IS NOT NULL OR met_stop_time IS NOT NULL",
            "has_start": "utc_start_time IS NOT NULL OR met_start_time IS NOT NULL",
            "met_order": "met_start_time <= met_stop_time",
            "utc_order": "utc_start_time <= utc_stop_time",
            "interface_from_1": "interface_version >= 1",
        },
        defaults={"quality_checked": False},
    ),
    "unixtime": Table(
        "file_id id, unix_start id?, unix_stop id?",
        key=("file_id",),
        references={"file_id": "file.file_id"},
        checks={"unix_order": "unix_start <= unix_stop"},
    ),
    "filefilelink": Table(
        "source_file id, resulting_file id",
        key=("source_file", "resulting_file"),
        references={"source_file": "file.file_id", "resulting_file": "file.file_id"},
        checks={"not_itself": "source_file <> resulting_file"},
    ),
    "filecodelink": Table(
        "resulting_file id, source_code id",
        key=("resulting_file", "source_code"),
        references={"resulting_file": "file.file_id", "source_code": "code.code_id"},
    ),
    "code": Table(
        "code_id id, filename text, relative_path text, code_start_date date, code_stop_date date,"
        "code_description text, process_id id, interface_version short, quality_version short,"
        "revision_version short, output_interface_version short, active_code bool,"
        "date_written date, shasum text?, newest_version bool, arguments text?, ram float?,"
        "cpu short?",
        key=("code_id",),
        references={"process_id": "process.process_id"},
        checks={
            "code_dates": "code_start_date <= code_stop_date",
            "interface_from_1": "interface_version >= 1",
            "output_interface_from_1": "output_interface_version >= 1",
        },
        defaults={"active_code": False},
    ),
    "inspector": Table(
        "inspector_id id, filename text, relative_path text, description text,"
        "interface_version short, quality_version short, revision_version short,"
        "output_interface_version short, active_code bool, date_written date, shasum text?,"
        "newest_version bool, arguments text?, product id",
        key=("inspector_id",),
        references={"product": "product.product_id"},
        checks={
            "interface_from_1": "interface_version >= 1",
            "output_interface_from_1": "output_interface_version >= 1",
        },
        defaults={"active_code": False},
    ),
    "processqueue": Table(
        "file_id id, version_bump short?",
        key=("file_id",),
        references={"file_id": "file.file_id"},
        checks={"bump_below_3": "version_bump IS NULL OR version_bump < 3"},
    ),
    "release": Table(
        "file_id id, release_num text",
        key=("file_id", "release_num"),
        references={"file_id": "file.file_id"},
    ),
    "logging": Table(
        "logging_id id, currently_processing bool, pid int?, processing_start_time time,"
        "processing_end_time time?, comment text?, mission_id id, user text, hostname text",
        key=("logging_id",),
        references={"mission_id": "mission.mission_id"},
        checks={"run_order": "processing_start_time < processing_end_time"},
        defaults={"currently_processing": False},
    ),
    "logging_file": Table(
        "logging_file_id id, logging_id id, file_id id, code_id id, comments text?",
        key=("logging_file_id",),
        references={
            "logging_id": "logging.logging_id",
            "file_id": "file.file_id",
            "code_id": "code.code_id",
        },
    ),
}


def conform(df: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Give `df` the table's columns in order, filling absent ones by default or null.

    Columns named in `keep` stay behind them where `df` has them.
    """
    spec = TABLES[table]
    columns = []
    for f in spec.schema.fields:
        if f.name in df.columns:
            value = F.col(f.name)
            if f.name in spec.defaults:
                value = F.coalesce(value, F.lit(spec.defaults[f.name]))
        else:
            value = F.lit(spec.defaults.get(f.name))
        columns.append(value.cast(f.dataType).alias(f.name))
    return df.select(*columns, *[c for c in keep if c in df.columns])


class Catalogue:
    """A named set of table DataFrames; attribute access returns one table.

    A table may be given as a function, which is called at its first use.
    """

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]):
        unknown = sorted(set(tables) - set(TABLES))
        if unknown:
            raise ValueError(f"not catalogue tables: {', '.join(unknown)}")
        self.tables = dict(tables)

    def __getattr__(self, name: str) -> DataFrame:
        tables = self.__dict__.get("tables", {})
        if name not in tables:
            raise AttributeError(f"catalogue has no table {name!r}")
        if not isinstance(tables[name], DataFrame):
            tables[name] = tables[name]()
        return tables[name]

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def replace(self, **tables: DataFrame) -> "Catalogue":
        """A catalogue with some tables exchanged."""
        return Catalogue(**{**self.tables, **tables})
