"""Headers of many CSV files without reading the files.

A task opens one file through Spark's own text reader, so any file system that Spark reads will do, and is
asked for a few lines: Spark stops reading when it has them, which is after a buffer or two, whatever the
size of the file. (A Python task that breaks off would not do: its input is fed to the end.) Several
files are asked for at a time.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

AT_A_TIME = 16
FEW_LINES = 4


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """Paths of the files at or below `paths`, from the listing alone."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return sorted(r[0] for r in listing.load(paths if isinstance(paths, str) else list(paths)).select("path").collect())


def first_record(spark: SparkSession, file: str) -> str | None:
    """The text of the first record of a file, which may span lines; None if it has none."""
    asked = FEW_LINES
    while True:
        lines = [r[0] for r in spark.read.text(file).limit(asked).collect()]
        held = ""
        for line in lines:
            held += f"{line}\n"
            if held.strip() and held.count('"') % 2 == 0:  # no enclosed field is open
                return held.lstrip("\ufeff").strip("\n")
        if len(lines) < asked:
            return held.lstrip("\ufeff").strip("\n") if held.strip() else None
        asked *= 16


def first_records(spark: SparkSession, paths: str | Sequence[str]) -> Iterator[tuple[str, str]]:
    """(file, text of its first record) of every file that has one, by path."""
    files = list_files(spark, paths)
    with ThreadPoolExecutor(AT_A_TIME) as pool:
        for file, header in zip(files, pool.map(lambda file: first_record(spark, file), files), strict=True):
            if header is not None:
                yield file, header


def column_names(header: str) -> tuple[str, ...]:
    """Names of a header record, usable as columns: blank names are numbered, repeated ones get a suffix.

    Names that differ in case only count as repeated, as they do for Spark.
    """
    taken: set[str] = set()
    names = []
    for place, field in enumerate(next(csv.reader(header.splitlines(keepends=True)))):
        name = base = field.strip() or f"_c{place}"
        more = 2
        while name.lower() in taken:
            name, more = f"{base}_{more}", more + 1
        taken.add(name.lower())
        names.append(name)
    return tuple(names)


def files_by_header(spark: SparkSession, paths: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files of each header. Brings one record per file to the driver, as a file listing does."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in first_records(spark, paths):
        groups.setdefault(column_names(header), []).append(file)
    return groups
