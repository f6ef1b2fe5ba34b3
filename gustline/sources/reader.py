"""Sources described by a plain mapping."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gustline.operators.schema import schema_drift_report
from gustline.sources.csv_files import read_csv_directory

# Keys of a flat spec that describe the dataset and are no source options.
DESCRIPTION_KEYS = frozenset(
    {"format", "schema", "columns", "predicates", "table", "options", "read_options", "write_options"}
    | {"partition_by", "rebalance"}
)
# Fixed values: "mode" in a flat spec is a CSV parse mode only with one of these values.
PARSE_MODES = frozenset({"PERMISSIVE", "DROPMALFORMED", "FAILFAST"})


def flat_options(spec: Mapping[str, Any]) -> dict[str, Any]:
    """The options of a spec that keeps them beside its description."""
    return {
        key: value
        for key, value in spec.items()
        if key not in DESCRIPTION_KEYS and not (key == "mode" and str(value).upper() not in PARSE_MODES)
    }


def given(options: Mapping[str, Any]) -> dict[str, Any]:
    """The options that have a value."""
    return {key: value for key, value in options.items() if value is not None}


def _format_of(path: str) -> str:
    extension = os.path.splitext(path.rstrip("/"))[1]
    if not extension:
        raise ValueError(f"No 'format' given and none can be inferred from {path!r}")
    return extension[1:]


@dataclass(frozen=True)
class Reader:
    """Any Spark source: a format, its options and, if wanted, a schema to enforce.

    CSV files with header lines and without a schema are bound by name, whatever form their path
    has (file, folder, glob, several paths); ``columns`` names the header they all have, so that
    their headers need not be looked at. ``predicates`` are conditions that split a JDBC scan, each
    a task of its own (see ``day_predicates``); a JDBC scan that nothing splits asks for one partition.
    """

    format: str
    options: dict[str, Any] = field(default_factory=dict)
    schema: T.StructType | str | None = None
    columns: Sequence[str] | None = None
    predicates: Sequence[str] | None = None

    @classmethod
    def get_reader(cls, spec: Mapping[str, Any]) -> Reader:
        """Reader of a spec: ``read_options``, else ``options``, else the spec's other keys.

        A missing ``format`` is taken from the extension of ``path``. ``ValueError`` if there is
        neither, or if a JDBC source has no ``url``. Several paths are a list under ``path``.
        """
        options = spec.get("read_options") or spec.get("options") or flat_options(spec)
        kind = spec.get("format")
        if not kind:
            if not options.get("path"):
                raise ValueError("No 'format' given and no 'path' to infer it from")
            path = options["path"]
            kind = _format_of(path if isinstance(path, str) else path[0])
        reader = cls(kind, dict(options), spec.get("schema"), spec.get("columns"), spec.get("predicates"))
        reader._check()
        return reader

    def _check(self) -> None:
        if self.format == "jdbc" and "url" not in self.options:
            raise ValueError("Missing 'url' in the options of a JDBC source")

    def extract(self, spark: SparkSession | None = None) -> DataFrame:
        """The source as a lazy frame, of the given session or the active one."""
        self._check()
        session = spark or SparkSession.getActiveSession()
        if session is None:
            raise RuntimeError("No active SparkSession")
        if self.named:
            return read_csv_directory(
                session, self.options["path"], columns=self.columns, options=given(self.options), pattern=None
            )
        options = given(self.options)
        if self.format == "jdbc" and self.predicates is not None:
            connection = {key: str(value) for key, value in options.items() if key not in ("url", "dbtable")}
            return session.read.jdbc(
                options["url"], options["dbtable"], predicates=list(self.predicates), properties=connection
            )
        if self.format == "jdbc" and "numPartitions" not in options:
            options["numPartitions"] = "1"
        paths = options.pop("path") if isinstance(options.get("path"), (list, tuple)) else None
        source = session.read.format(self.format).options(**options)
        if self.schema is not None:
            source = source.schema(self.schema)
            if self.format == "csv" and "enforceSchema" not in self.options:
                # With a header line, refuse files that have the columns in another order.
                source = source.option("enforceSchema", "false")
        return source.load(list(paths)) if paths else source.load()

    @property
    def named(self) -> bool:
        """Whether this is CSV whose columns are bound by the names in the files' headers."""

        def on(name: str) -> bool:
            return str(self.options.get(name, "false")).lower() == "true"

        return (
            self.format == "csv"
            and self.schema is None
            and bool(self.options.get("path"))
            and on("header")
            and not on("inferSchema")
        )

    def drift(self, spark: SparkSession | None = None) -> DataFrame:
        """What the source itself delivers against the schema of this reader."""
        if self.schema is None:
            raise ValueError("This source declares no schema to compare with")
        expected = self.schema
        if isinstance(expected, str):
            expected = T.StructType.fromDDL(expected)
        return schema_drift_report(Reader(self.format, self.options).extract(spark), expected)
