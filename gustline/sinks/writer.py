"""Sinks described by a plain mapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gustline.sources.reader import flat_options, given


# Formats whose writing tasks report observed counts; a JDBC write never would.
FILE_FORMATS = frozenset({"parquet", "orc", "csv", "json", "text", "avro"})


@dataclass(frozen=True)
class Writer:
    """Any Spark sink: a format, its options, a save mode and, for files, partition columns."""

    format: str
    options: dict[str, Any] = field(default_factory=dict)
    mode: str = "error"
    partition_by: Sequence[str] = ()
    rebalance: bool = True

    @classmethod
    def get_writer(cls, spec: Mapping[str, Any]) -> Writer:
        """Writer of a spec: its ``write_options``, else the spec's other keys as options.

        ``ValueError`` without a ``format``; the mode defaults to ``error``.
        """
        if not spec.get("format"):
            raise ValueError("No 'format' specified for the sink")
        options = spec.get("write_options") or flat_options(spec)
        return cls(
            spec["format"],
            dict(options),
            spec.get("mode", "error"),
            tuple(spec.get("partition_by", ())),
            spec.get("rebalance", True),
        )

    @property
    def counts(self) -> bool:
        """Whether this sink can count the rows it writes."""
        return self.format in FILE_FORMATS

    def load(self, df: DataFrame, counted: Observation | None = None) -> None:
        """Write the frame; ``counted`` receives the number of ``rows`` written to files.

        Partitioned tables are rebalanced by their partition columns first: each partition then
        comes from few tasks instead of a file from every task, and adaptive execution cuts an
        oversized one, such as one busy day, into several tasks. Where the rows fall into a
        single partition anyway, ``rebalance=False`` saves that shuffle.

        The count is taken in the tasks that write, whose results Spark takes once each, so a
        lost executor does not distort it.
        """
        if self.partition_by and self.rebalance:
            df = df.hint("rebalance", *self.partition_by)
        if counted is not None and self.counts:
            df = df.observe(counted, F.count(F.lit(1)).alias("rows"))
        sink = df.write.format(self.format).options(**given(self.options)).mode(self.mode)
        if self.partition_by:
            sink = sink.partitionBy(*self.partition_by)
        sink.save()
