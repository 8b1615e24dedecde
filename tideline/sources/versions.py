"""A table that several writers append to: versions, and record numbers that never meet.

The folder holds one subfolder per written part and a log of small records, one
file per version.  A record says which parts the table consists of and which
number comes next.  Writing record ``n + 1`` is the commit: the file is renamed
into place without overwriting, so of two writers one succeeds and the other
looks at the new state and tries again.  (That needs a file system with an
atomic rename, as HDFS has.)

An append takes two commits: the first reserves its range of numbers, the second
publishes its part.  Rows are numbered and written in between, without holding
anybody up.  A writer that dies in between leaves a gap in the numbers and a part
that no version names.  Readers see whole versions, and old ones stay readable.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tideline import presets as P
from tideline.operators.ordering import global_row_number

LOG = "_versions"


@dataclass(frozen=True)
class State:
    """``epoch`` counts replacements, each of which begins the numbers anew."""

    version: int = 0
    next: int = 1
    epoch: int = 0
    parts: list[str] = field(default_factory=list)


class Moved(Exception):
    """The table was replaced between reserving and publishing."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, prefix: str = P.TABLE_PREFIX, name: str = "record_id"):
        self.spark, self.path, self.prefix, self.name = spark, path.rstrip("/"), prefix, name
        jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._at = jvm.org.apache.hadoop.fs.Path
        log = self._at(f"{self.path}/{LOG}")
        self._fs = log.getFileSystem(self._conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.makeQualified(log).toUri(), self._conf
        )
        self._fs.mkdirs(log)

    # --- the log ---

    def _record(self, version: int) -> str:
        return f"{self.path}/{LOG}/{version:012d}.json"

    def state(self, version: int | None = None) -> State:
        """The newest state, or that of an older version."""
        if version is None:
            names = [f.getPath().getName() for f in self._fs.listStatus(self._at(f"{self.path}/{LOG}"))]
            version = max((int(n[:-5]) for n in names if n.endswith(".json")), default=0)
        if version == 0:
            return State()
        stream = self._fs.open(self._at(self._record(version)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return State(**json.loads(text))

    def _put(self, state: State) -> bool:
        """Write the record of a new version; False if another writer was first."""
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        draft = self._at(f"{self.path}/{LOG}/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(asdict(state)).encode()))
        out.close()
        # no option: a file that is there is not overwritten
        options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            self._context.rename(draft, self._at(self._record(state.version)), options)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            self._fs.delete(draft, False)
            return False

    def commit(self, change: Callable[[State], State]) -> State:
        """Apply ``change`` to the newest state, as often as other writers come first."""
        while True:
            before = self.state()
            after = replace(change(before), version=before.version + 1)
            if self._put(after):
                return after

    # --- reading and writing ---

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version; columns that a part lacks are NULL."""
        parts = self.state(version).parts
        if not parts:
            raise FileNotFoundError(f"{self.path} holds no rows yet")
        folders = [f"{self.path}/{p}" for p in parts]
        return self.spark.read.option("mergeSchema", True).parquet(*folders)

    def _write(self, numbered: DataFrame, start: int) -> str:
        part = f"part-{uuid.uuid4().hex}"
        text = F.format_string(f"{self.prefix}-%04d", F.col("_rn") + F.lit(start - 1))
        numbered.withColumn(self.name, text).drop("_rn").write.parquet(f"{self.path}/{part}")
        return part

    def begin(self, new: DataFrame, order: Sequence[str | Column]) -> Append:
        """Number the rows in ``order`` and reserve as many record numbers."""
        numbered = global_row_number(new.drop(self.name), order, "_rn")
        return Append(self, numbered, numbered.count())

    def append(self, new: DataFrame, order: Sequence[str | Column]) -> State:
        """Add rows with the next numbers."""
        return self.begin(new, order).publish()

    def replace(self, new: DataFrame, order: Sequence[str | Column]) -> State:
        """Make ``new`` the whole table, numbered from 1; older versions stay readable."""
        numbered = global_row_number(new.drop(self.name), order, "_rn")
        rows, part = numbered.count(), self._write(numbered, 1)
        return self.commit(lambda s: replace(s, next=rows + 1, epoch=s.epoch + 1, parts=[part]))

    def submit(self, records: Sequence[Mapping[str, object]], label: str = P.SUBMIT_LABEL) -> State:
        """Add loose records in their order, marked with ``label``; columns they lack are NULL."""
        known = {f.name: f.dataType for f in self.read().schema}
        names = list(dict.fromkeys(k for r in records for k in r))
        schema = T.StructType([T.StructField("_no", T.LongType())])
        for n in names:
            schema.add(n, known.get(n, T.StringType()))
        rows = [(i, *[r.get(n) for n in names]) for i, r in enumerate(records)]
        new = self.spark.createDataFrame(rows, schema).withColumn("data_source_label", F.lit(label))
        pending = self.begin(new, ["_no"])
        pending.rows_out = lambda df: df.drop("_no")
        return pending.publish()


class Append:
    """Rows that have their numbers and are not yet part of the table."""

    def __init__(self, table: VersionedTable, numbered: DataFrame, rows: int):
        self.table, self.numbered, self.rows = table, numbered, rows
        self.rows_out: Callable[[DataFrame], DataFrame] = lambda df: df
        self._reserve()

    def _reserve(self) -> None:
        after = self.table.commit(lambda s: replace(s, next=s.next + self.rows))
        self.start, self.epoch = after.next - self.rows, after.epoch

    def publish(self) -> State:
        """Write the rows and make them part of the newest version.

        If the table was replaced since, the numbers are reserved and written anew.
        """
        while True:
            part = self.table._write(self.rows_out(self.numbered), self.start)

            def add(state: State) -> State:
                if state.epoch != self.epoch:
                    raise Moved
                return replace(state, parts=[*state.parts, part])

            try:
                return self.table.commit(add)
            except Moved:
                self._reserve()
