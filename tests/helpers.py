"""A small catalogue built row by row, with defaults for what a test does not care about."""

from __future__ import annotations

import datetime as dt
import re

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.model import TABLES, Catalogue


class Small:
    def __init__(self):
        self.rows = {name: [] for name in TABLES}
        self.add("mission", mission_name="survey", rootdir="/data", incoming_dir="incoming")
        self.add("satellite", satellite_name="sat-a", mission_id=1)
        self.add("instrument", instrument_name="camera", satellite_id=1)
        self.add("instrument", instrument_name="radio", satellite_id=1)

    def add(self, table: str, **values) -> int:
        key = TABLES[table].key
        number = len(self.rows[table]) + 1
        if len(key) == 1 and key[0] not in values and key[0] != "file_id":
            values[key[0]] = number
        if table == "file":
            values.setdefault("file_id", number)
        self.rows[table].append(values)
        return values.get(key[0])

    def product(self, name: str, level: float = 0.0, instrument: int = 1, form: str | None = None,
                path: str = "store", arguments: str | None = None) -> int:
        form = form or name.replace(" ", "_") + "_{Y}{m}{d}_v{VERSION}"
        pid = self.add("product", product_name=name, instrument_id=instrument, relative_path=path,
                       level=float(level), format=form, product_description=f"about {name}")
        self.add("instrumentproductlink", instrument_id=instrument, product_id=pid)
        self.add("inspector", filename="look.py", relative_path="inspectors", description=name,
                 interface_version=1, quality_version=0, revision_version=0, output_interface_version=1,
                 active_code=True, newest_version=True, date_written=dt.date(2010, 1, 1), product=pid,
                 arguments=arguments)
        return pid

    def process(self, name: str, output: int | None, timebase: str = "DAILY", **code) -> tuple[int, int]:
        process = self.add("process", process_name=name, output_product=output, output_timebase=timebase)
        return process, self.code(process, arguments=name.replace(" ", "_") + "_args", **code)

    def code(self, process: int, version=(1, 0, 0), **values) -> int:
        row = dict(filename="work.py", relative_path="scripts", code_start_date=dt.date(2010, 1, 1),
                   code_stop_date=dt.date(2099, 1, 1), code_description=f"code of {process}", process_id=process,
                   interface_version=version[0], quality_version=version[1], revision_version=version[2],
                   output_interface_version=1, active_code=True, newest_version=True,
                   date_written=dt.date(2010, 1, 1))
        return self.add("code", **{**row, **values})

    def link(self, product: int, process: int, optional=False, yesterday=0, tomorrow=0) -> None:
        self.add("productprocesslink", process_id=process, input_product_id=product, optional=optional,
                 yesterday=yesterday, tomorrow=tomorrow)

    def file(self, name: str, product: int, start=None, stop=None, exists=True, **values) -> int:
        digits = re.search(r"(?:19|20)\d{6}", name)
        day = dt.datetime.strptime(digits.group(), "%Y%m%d") if digits else None
        version = re.search(r"_v(\d+)\.(\d+)\.(\d+)", name)
        parts = [int(x) for x in version.groups()] if version else [1, 0, 0]
        row = dict(
            filename=name, utc_file_date=day.date() if day else None, utc_start_time=start or day,
            utc_stop_time=stop or (day and day.replace(hour=23, minute=59, second=59, microsecond=999999)),
            data_level=self.rows["product"][product - 1]["level"], interface_version=parts[0],
            quality_version=parts[1], revision_version=parts[2], exists_on_disk=exists, product_id=product,
            file_create_date=dt.datetime(2024, 1, 1),
        )
        return self.add("file", **{**row, **values})

    def made(self, result: int, *sources: int, code: int | None = None) -> None:
        for source in sources:
            self.add("filefilelink", source_file=source, resulting_file=result)
        if code is not None:
            self.add("filecodelink", resulting_file=result, source_code=code)

    def catalogue(self, spark) -> Catalogue:
        out = {}
        for table, spec in TABLES.items():
            schema = spec.schema
            rows = [{f.name: row.get(f.name, spec.defaults.get(f.name)) for f in schema.fields}
                    for row in self.rows[table]]
            out[table] = spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(schema)))
        return Catalogue(**out)


def ids(df, column="file_id"):
    return sorted(r[0] for r in df.select(column).collect())
