"""Writing one micro-batch so that a replay of it leaves the same result."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditflow.operators.reporting import as_documents
from auditflow.streaming.runs import claim


@dataclass(frozen=True)
class FolderSink:
    """A folder per micro-batch, overwritten on replay: each record counts exactly once.

    A folder holds the output of one run; another run's first micro-batch is refused (``claim``).

    ``split_by`` puts rows of different kinds in sub-folders within the same pass.
    """

    path: str
    format: str = "parquet"
    split_by: str | None = None

    def write(self, rows: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            claim(rows.sparkSession, self.path)
        # The whole folder is replaced, whatever the session says about partitions.
        writer = rows.write.mode("overwrite").format(self.format)
        writer = writer.option("partitionOverwriteMode", "static")
        if self.split_by:
            writer = writer.partitionBy(self.split_by)
        writer.save(f"{self.path}/batch_id={batch_id}")


@dataclass(frozen=True)
class ConnectorSink:
    """An external system reached by a Spark connector that must be on the class path.

    A replayed batch is sent again, so delivery is at least once unless the system upserts by a
    key (``doc_id``). For a message bus, ``topics`` names the topic of each kind of row, and under
    ``*`` that of all other kinds; a kind without a topic stops the job rather than being lost.
    """

    format: str
    options: dict[str, str] = field(default_factory=dict)
    topics: dict[str, str] = field(default_factory=dict)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        self.addressed(rows).write.format(self.format).options(**self.options).mode("append").save()

    def addressed(self, rows: DataFrame) -> DataFrame:
        if not self.topics:
            return rows
        named = F.create_map(*(F.lit(part) for pair in self.topics.items() for part in pair))
        missing = F.raise_error(F.concat(F.lit("no topic for rows of kind "), "kind"))
        topic = F.coalesce(
            F.try_element_at(named, F.col("kind")), F.try_element_at(named, F.lit("*")),
            missing.cast("string"),
        )
        return rows.select(topic.alias("topic"), "value")


@dataclass(frozen=True)
class DocumentSink:
    """Turns emissions into result documents ``data, type, area, count`` for another sink.

    ``with_id`` adds ``doc_id``: an index that upserts by it holds the last emission of each pane,
    one that only appends holds every emission.
    """

    sink: FolderSink | ConnectorSink
    with_id: bool = False

    def write(self, rows: DataFrame, batch_id: int) -> None:
        self.sink.write(as_documents(rows, self.with_id), batch_id)
