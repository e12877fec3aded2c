"""Any number of CSV layouts in one plan.

A table of layouts takes the place of a read per layout: which cell of a line
is which canonical column is data, not plan.

1. Every file's first line is found in one scan, and the distinct headers (a
   row a layout, not a file) are mapped on the driver.
2. All lines are read in one scan, meet their file's layout in a join, and are
   cut into cells by ``from_csv`` with the layout's delimiter.  Cells are
   picked by the layout's positions; headers that map to nothing stay as a map.

The plan has two scans and the same joins for one layout or a million.  Lines
that are not valid UTF-8 are read as ISO-8859-1, line by line.  A layout
without a required column is set aside and reported; its lines are not parsed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barrio.functions.keys import FILE_NAME_YEAR_PATTERN, FOLDER_YEAR_PATTERN, first_year
from barrio.operators.normalize import INCIDENT_HEADERS, INCIDENT_TYPES, header_plan
from barrio.sources.files import DriftingRead

DELIMITERS = (",", ";")
_LAYOUT = ("header string, layout int, delimiter string, status string, reason string, dropped_headers string, "
           "places array<int>, others map<string, int>, width int")


def _text(value: Column) -> Column:
    """A line as text, whatever its encoding."""
    return F.when(F.is_valid_utf8(value), value).otherwise(F.decode(value.cast("binary"), "ISO-8859-1"))


def _lines(spark: SparkSession, paths: str | Sequence[str], pattern: str) -> DataFrame:
    return (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
            .text(paths if isinstance(paths, str) else list(paths))
            .select(_text(F.col("value")).alias("line"), F.col("_metadata.file_path").alias("_file_path"),
                    F.col("_metadata.file_name").alias("_file_name"),
                    F.col("_metadata.file_modification_time").alias("_file_mtime"),
                    F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_pos")))


def _cells(line: Column, delimiter: str, width: int) -> Column:
    schema = ", ".join(f"c{i} string" for i in range(width))
    row = F.from_csv(line, schema, {"sep": delimiter, "mode": "PERMISSIVE"})
    return F.array(*[row[f"c{i}"] for i in range(width)])


def _split(header: str, delimiter: str) -> list[str]:
    """The names in a header line."""
    import csv

    return next(csv.reader([header], delimiter=delimiter), [])


def layout_rows(headers: Sequence[str], mapping, types: dict[str, str], required: Sequence[str]) -> list[tuple]:
    """One row a layout: where its canonical columns are, and its other columns."""
    out = []
    for i, header in enumerate(headers):
        # `;` when the line has more of them than `,`
        delimiter = ";" if header.count(";") > header.count(",") else ","
        names = _split(header.lstrip("\ufeff"), delimiter)
        # equal names are told apart by their place
        numbered = [f"{n}\0{j}" for j, n in enumerate(names)]
        plan, dropped = header_plan(names if len(set(names)) == len(names) else numbered, mapping)
        place = {source: j for j, source in enumerate(names if len(set(names)) == len(names) else numbered)}
        targets = {target: place[source] for source, target in plan}
        missing = [r for r in required if r not in targets]
        others: dict[str, int] = {}
        for target, j in targets.items():
            base = name = target.split("\0")[0]
            n = 2
            while name in others:
                name, n = f"{base}_{n}", n + 1
            if target not in types:
                others[name] = j
        out.append((header, i, delimiter, "quarantined" if missing else "ok",
                    f"missing {','.join(missing)}" if missing else None,
                    ",".join(d.split("\0")[0] for d in dropped) or None,
                    [targets.get(t, -1) for t in types],
                    others, len(names)))
    return out


def read_layouts(spark: SparkSession, paths: str | Sequence[str], mapping=INCIDENT_HEADERS, types=INCIDENT_TYPES,
                 required: Sequence[str] = ("expedient_id",), name_pattern: str | None = FILE_NAME_YEAR_PATTERN,
                 folder_pattern: str | None = FOLDER_YEAR_PATTERN, pattern: str = "*.csv") -> DriftingRead:
    """Rows of every accepted file in the canonical columns, with ``others`` (a map
    of unmapped headers) and the file's path, name and time; and a report by file."""
    first = F.col("_start") == 0
    files = (_lines(spark, paths, pattern).groupBy("_file_path")
             .agg(F.min_by(F.when(first, F.col("line")), F.when(first, F.col("_pos"))).alias("header"))
             .where(F.col("header").isNotNull()).checkpoint(eager=True))
    headers = [r.header for r in files.select("header").distinct().orderBy("header").collect()]
    layouts = layout_rows(headers, mapping, types, required)
    table = spark.createDataFrame(layouts, _LAYOUT)
    by_file = files.join(table, "header")
    report = by_file.select(F.col("_file_path").alias("file_path"), F.col("layout").alias("variant"), "delimiter",
                            F.lit(None).cast("string").alias("encoding"), "status", "reason", "dropped_headers")

    width = max([row[-1] for row in layouts], default=1)
    lines = _lines(spark, paths, pattern).where(F.length(F.trim("line")) > 0)
    rows = lines.join(by_file.where("status = 'ok'").select(
        "_file_path", "header", "delimiter", "places", "others"), "_file_path")
    rows = rows.where(~(first & (F.col("line") == F.col("header"))))
    cells = F.when(F.col("delimiter") == DELIMITERS[1], _cells(F.col("line"), DELIMITERS[1], width)).otherwise(
        _cells(F.col("line"), DELIMITERS[0], width))
    rows = rows.withColumn("cells", cells)

    def cell(at: Column) -> Column:
        return F.get("cells", at)

    def value(i: int, name: str, dtype: str) -> Column:
        at = F.get("places", F.lit(i))
        got = F.when(at >= 0, cell(at)).try_cast(dtype)
        if name == "year":
            # A layout without a year column takes the file's name or folder
            tries = [first_year(F.col(c), p) for c, p in (("_file_name", name_pattern), ("_file_path", folder_pattern)) if p]
            if tries:
                got = F.when(at >= 0, got).otherwise(F.coalesce(*tries).cast(dtype))
        return got.alias(name)

    data = rows.select(*[value(i, name, dtype) for i, (name, dtype) in enumerate(types.items())],
                       F.transform_values("others", lambda _, at: cell(at)).alias("others"),
                       "_file_path", "_file_name", "_file_mtime")
    return DriftingRead(data, report)
