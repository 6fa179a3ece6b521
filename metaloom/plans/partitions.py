"""Tables of which only the touched part is rewritten.

Plain Parquet tables have no row-level merge, and Spark refuses to overwrite files it is
reading. A ``PartitionedTable`` deals rows to numbered parts by a hash of one column, a large
part to sub-parts by a hash of a second one. A change is computed for the sub-parts it can
touch, written to a new folder, and put in place by pointing those partitions at it. Readers
see a partition as it was or as it is now, a failed write changes nothing, and a refresh of
one schema of a large catalog costs that schema's sub-part, not the catalog or the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from metaloom.functions.text import quoted, sql_literal
from metaloom.session import stage
from metaloom.sources.tables import conform

#: Partition columns: the part, how many sub-parts it has, and which of them.
PART, SUBS, SUB = "part", "subs", "sub"
PARTS_PROPERTY, PENDING_PROPERTY = "metaloom.parts", "metaloom.pending"
#: Rows of a sub-part, about, and sub-parts of a part at most.
SUB_ROWS, MOST_SUBS = 65_536, 1024
#: Statements to the catalog under way at once.
_AT_ONCE = 16
_LAYOUT = StructType([StructField(c, IntegerType()) for c in (PART, SUBS, SUB)])

Spec = tuple[int, int, int]


def _spec(place: Spec) -> str:
    return f"PARTITION ({PART}={place[0]}, {SUBS}={place[1]}, {SUB}={place[2]})"


def _folder(place: Spec) -> str:
    return f"{PART}={place[0]}/{SUBS}={place[1]}/{SUB}={place[2]}"


@dataclass
class PartitionedTable:
    """A catalog table of ``columns``, dealt by ``part_by`` and, within a large part, by ``sub_by``.

    Values that share a part are rewritten together unless the part has sub-parts, so ``parts``
    should exceed the number of values of ``part_by``. A part gets its sub-parts when it is first
    written, about one for each ``sub_rows`` rows (a power of two, at most ``MOST_SUBS``), and
    keeps them until ``redeal``; the number is in the partition's own name. So the driver lists at
    most ``parts * MOST_SUBS`` partitions, and about one for each ``sub_rows`` rows.
    Files live below ``location``. One writer at a time may change the table.
    """

    spark: SparkSession
    catalog: str
    schema: str
    table: str
    columns: StructType
    part_by: str
    location: str
    comment: str = ""
    parts: int = 4096
    sub_by: str | None = None
    sub_rows: int = SUB_ROWS
    #: Folders that changes made through this object have replaced.
    unused: list[str] = field(default_factory=list, init=False)
    _known_parts: int | None = field(default=None, init=False)

    @property
    def name(self) -> str:
        return quoted(self.catalog, self.schema, self.table)

    @property
    def _stored(self) -> StructType:
        """The table's columns and those of its partitions."""
        return StructType([*self.columns.fields, *_LAYOUT.fields])

    def properties(self) -> dict[str, str]:
        return {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}

    def stored_parts(self) -> int:
        """The number of parts the table was made with; rows are dealt by it, whatever ``parts`` says."""
        if self._known_parts is None:
            stored = self.properties().get(PARTS_PROPERTY)
            if stored is None:
                raise RuntimeError(f"{self.name} does not say how many partitions it has ({PARTS_PROPERTY})")
            self._known_parts = int(stored)
        return self._known_parts

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(self.part_by), F.lit(self.stored_parts())).cast("int")

    def _deal_number(self) -> Column:
        """What rows of a part are dealt to its sub-parts by: the remainder, as numbers of sub-parts divide ``MOST_SUBS``."""
        by = F.lit(0) if self.sub_by is None else F.pmod(F.xxhash64(F.lit(1), F.col(self.sub_by)), F.lit(MOST_SUBS))
        return by.cast("int")

    def _dealt(self, rows: DataFrame, subs: dict[int, int]) -> DataFrame:
        """Rows with their partition columns; ``subs`` are the parts with more than one sub-part."""
        return self._placed(rows.withColumn(PART, self._part()), self._deal_number(), subs)

    @staticmethod
    def _placed(rows: DataFrame, number_dealt: Column, subs: dict[int, int]) -> DataFrame:
        if not subs:
            return rows.withColumn(SUBS, F.lit(1)).withColumn(SUB, F.lit(0))
        alike: dict[int, list[int]] = {}
        for part, number in subs.items():
            alike.setdefault(number, []).append(part)
        number = F.lit(1)
        for n, parts in alike.items():  # a condition for each power of two: joined with a layout, all rows would be exchanged
            number = F.when(F.col(PART).isin(*parts), n).otherwise(number)
        rows = rows.withColumn(SUBS, number)
        return rows.withColumn(SUB, F.pmod(number_dealt, F.col(SUBS)).cast("int"))

    def create(self) -> None:
        """Create the table, empty, unless it is there; finish a change that was stopped while it was put in place."""
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in self.columns)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, {PART} INT, {SUBS} INT, {SUB} INT) USING parquet "
            f"PARTITIONED BY ({PART}, {SUBS}, {SUB}) COMMENT {sql_literal(self.comment)} "
            f"LOCATION {sql_literal(f'{self.location}/{self.table}')} "
            f"TBLPROPERTIES ({sql_literal(PARTS_PROPERTY)} = {sql_literal(str(self.parts))})"
        )
        self.finish()

    def read(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.columns.names)

    def partitions(self) -> set[Spec]:
        found = (r.partition.split("/") for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect())
        return {tuple(int(value.split("=")[1]) for value in values) for values in found}

    def _location(self, place: Spec) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name} {_spec(place)}").collect()
        return next(r.data_type for r in rows if r.col_name == "Location")

    def folders(self) -> dict[Spec, str]:
        """Where each partition's files are."""
        places = sorted(self.partitions())
        with ThreadPoolExecutor(_AT_ONCE) as pool:
            return dict(zip(places, pool.map(self._location, places), strict=True))

    def touched(self, rows: DataFrame, rows_each: float = 1) -> set[Spec]:
        """The partitions that rows with these values of ``part_by`` and ``sub_by`` belong to, or will.

        ``rows`` are computed once. Each stands for about ``rows_each`` rows of the table, which sizes new parts.
        """
        subs = {part: n for part, n, _ in self.partitions()}
        counted = stage(rows.groupBy(self._part().alias(PART), self._deal_number().alias("number")).count(), "touched")
        counts = counted.groupBy(PART).agg(F.sum("count").alias("n")).collect()
        if self.sub_by is not None:
            subs |= {r[PART]: self._wanted(r["n"] * rows_each) for r in counts if r[PART] not in subs}
        large = {r[PART]: subs[r[PART]] for r in counts if subs.get(r[PART], 1) > 1}
        places = self._placed(counted, F.col("number"), large).select(PART, SUBS, SUB).distinct()
        return {tuple(r) for r in places.collect()} if counts else set()

    def _wanted(self, rows: float) -> int:
        subs = 1
        while subs < MOST_SUBS and subs * self.sub_rows < rows:
            subs *= 2
        return subs

    def part_of(self, places: Iterable[Spec]) -> DataFrame:
        """The rows of some partitions; others are not listed or read."""
        by_part: dict[int, list[int]] = {}
        for part, _, sub in places:
            by_part.setdefault(part, []).append(sub)
        subs: dict[tuple[int, ...], list[int]] = {}
        for part, own in by_part.items():
            subs.setdefault(tuple(sorted(own)), []).append(part)
        wanted = F.lit(False)
        for own, parts in subs.items():  # parts with the same sub-parts, which most have, are one condition
            wanted = wanted | (F.col(PART).isin(*parts) & F.col(SUB).isin(*own))
        return self.spark.table(self.name).filter(wanted).select(*self.columns.names)

    def rewrite(self, touching: DataFrame, change: Callable[[DataFrame], DataFrame]) -> list[str]:
        """Replace the rows of some partitions by what ``change`` makes of them.

        ``touching`` has the ``part_by`` and ``sub_by`` values the change may concern; only their
        partitions are read and written. ``change`` gets those rows and returns them changed, with
        rows added under the same values. Returns the folders no longer in use, for deletion once
        no reader needs them.
        """
        self.finish()
        places = self.touched(touching)
        if not places:
            return []
        subs = {part: n for part, n, _ in places if n > 1}
        return self._replace(places, change(self.part_of(places)), subs)

    def fill(
        self, touching: DataFrame, rows: DataFrame, made: Callable[[DataFrame], DataFrame], rows_each: float = 1
    ) -> None:
        """Write the first rows of some partitions, made of short rows only where they are written.

        ``rows`` have the ``part_by`` and ``sub_by`` columns and what ``made`` needs to make the table's rows of them,
        each by itself; it keeps the partition columns. So what is exchanged is the short rows. ``touching`` is as for
        ``rewrite``, ``rows_each`` as for ``touched``. Partitions that have rows already are refused.
        """
        self.finish()
        places = self.touched(touching, rows_each)
        if places & self.partitions():
            raise ValueError(f"{self.name} has rows already where rows are to be filled in")
        if places:
            self._replace(places, rows, {part: n for part, n, _ in places if n > 1}, made)

    def redeal(self) -> list[str]:
        """Give parts that have outgrown their sub-parts twofold new ones; nobody should read them meanwhile."""
        self.finish()
        stored = self.spark.table(self.name).groupBy(PART, SUBS).count().collect()
        crowded = {r[PART]: self._wanted(r["count"]) for r in stored if r["count"] > 2 * r[SUBS] * self.sub_rows}
        crowded = {part: n for part, n in crowded.items() if self.sub_by is not None}
        places = {p for p in self.partitions() if p[0] in crowded and crowded[p[0]] != p[1]}
        return self._replace(places, self.part_of(places), crowded) if places else []

    def _replace(
        self,
        places: set[Spec],
        rows: DataFrame,
        subs: dict[int, int],
        made: Callable[[DataFrame], DataFrame] | None = None,
    ) -> list[str]:
        after = self._dealt(conform(rows, self.columns) if made is None else rows, subs)
        if len(places) > 1:  # files of a sensible size, whatever the partitions' sizes
            after = after.hint("rebalance", PART, SUBS, SUB)
        if made is not None:  # the writer needs this order: short rows are sorted, not what is made of them
            order = (PART, SUBS, SUB) if self.sub_by is None else (PART, SUBS, SUB, self.sub_by)
            after = conform(made(after.sortWithinPartitions(*order)), self._stored)
        folder = f"{self.location}/{self.table}-{uuid.uuid4().hex}"
        self.spark.createDataFrame(sorted(places), _LAYOUT).coalesce(1).write.parquet(f"{folder}-touched")
        after.write.partitionBy(PART, SUBS, SUB).parquet(folder, compression="zstd")
        self.set_property(PENDING_PROPERTY, folder)  # from here on the change is finished, by whoever comes next
        return self.finish()

    def set_property(self, key: str, value: str | None) -> None:
        """Set a property of the table, or take it away."""
        pair = f"{sql_literal(key)} = {sql_literal(value)}" if value is not None else sql_literal(key)
        verb = "SET" if value is not None else "UNSET"
        self.spark.sql(f"ALTER TABLE {self.name} {verb} TBLPROPERTIES ({pair})")

    def finish(self) -> list[str]:
        """Put the change in place that is noted as written, if there is one. Safe to repeat.

        Partitions that have files are pointed at them one by one, new ones are added at once, and
        touched ones without files have become empty and go.
        """
        folder = self.properties().get(PENDING_PROPERTY)
        if folder is None:
            return []
        written = self.spark.read.schema(self._stored).parquet(folder).select(PART, SUBS, SUB).distinct().collect()
        touched = self.spark.read.schema(_LAYOUT).parquet(f"{folder}-touched").collect()
        new, known = {tuple(r) for r in written}, self.partitions()
        gone = sorted(({tuple(r) for r in touched} - new) & known)
        kept, added = sorted(new & known), sorted(new - known)
        with ThreadPoolExecutor(_AT_ONCE) as pool:
            replaced = list(pool.map(self._location, [*kept, *gone]))
            list(pool.map(lambda place: self._point(place, folder), kept))
        for verb, own in (("ADD IF NOT EXISTS", added), ("DROP IF EXISTS", gone)):
            if own:
                ends = {p: f" LOCATION {sql_literal(f'{folder}/{_folder(p)}')}" if verb[0] == "A" else "" for p in own}
                joint = " " if verb[0] == "A" else ", "
                self.spark.sql(f"ALTER TABLE {self.name} {verb} {joint.join(_spec(p) + ends[p] for p in own)}")
        self.set_property(PENDING_PROPERTY, None)
        own = folder.rsplit("/", 1)[1]  # a stopped change may have pointed some partitions at it already
        replaced = [r for r in replaced if f"/{own}/" not in r]
        self.unused += replaced
        return replaced

    def _point(self, place: Spec, folder: str) -> None:
        self.spark.sql(
            f"ALTER TABLE {self.name} {_spec(place)} SET LOCATION {sql_literal(f'{folder}/{_folder(place)}')}"
        )
