"""Exact duplicates by a tree merge of sorted digest runs.

Every row becomes one entry (digest, check, id, count) of a run named after the
partition that read it.  First each task sorts its own entries and merges equal
ones, before anything moves: a text that a third of the rows share leaves a task
as one entry.  From then on a run is a partition, sorted by digest.  In round
``i`` the runs whose numbers differ only in bit ``i`` exchange entries: an entry
goes to the run in which that bit equals the same bit of its digest.  The
receiving run sorts what its partners sent into one run, and of neighbours that
are equal one entry stays, with the best identifier and the sum of the counts.
After all rounds run ``r`` holds the entries whose low digest bits are ``r``, so
all entries of a digest, each digest once.

A round is one shuffle to the partition of the run's number, one sort, and
aggregates that walk the sorted run; none of them shuffles or sorts again.  The
number of runs is the number of shuffle partitions, rounded up to a power of
two, so runs stay as small as the cluster's other partitions.

The best identifier is carried as a struct, named before nameless, for which
Spark walks sorted runs (SortAggregate) instead of building hash maps.
Equality is verified at every level: the 64-bit digest that routes and sorts an
entry is accompanied by the SHA-256 and the byte length of the normalised text,
and only entries equal in all three merge.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import stable


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; NULL counts as empty.

    Pure ASCII texts take the built-in's fast path, which is the same there.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def digest_entries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, digest, check, size) per document row."""
    text = lower_ascii(F.col(text_col))
    return docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id",
        F.xxhash64("t").alias("digest"),
        F.unhex(F.sha2("t", 256)).alias("check"),
        F.octet_length("t").alias("size"),
    )


KEYS = ("digest", "check", "size")


def _merged(runs: DataFrame, largest: bool) -> DataFrame:
    if largest:
        best = F.max(F.struct(F.col("id").isNotNull(), F.col("id").alias("id")))
    else:
        best = F.min(F.struct(F.col("id").isNull(), F.col("id").alias("id")))
    return (
        runs.groupBy("run", *KEYS)
        .agg(best.alias("best"), F.sum("count").alias("count"))
        .select("run", *KEYS, F.col("best.id").alias("id"), "count")
    )


def merge_round(runs: DataFrame, shift: int, bits: int, levels: int, largest: bool) -> DataFrame:
    """Partners exchange by the ``bits`` digest bits from ``shift`` on, then merge."""
    mask = ((1 << bits) - 1) << shift
    own = F.col("run").bitwiseAND(F.lit(~mask))
    run = own.bitwiseOR(F.col("digest").bitwiseAND(F.lit(mask)).cast("int"))
    met = runs.withColumn("run", run).repartitionById(1 << levels, F.col("run"))
    return _merged(met.sortWithinPartitions("run", *KEYS), largest)


def run_levels(spark: SparkSession) -> int:
    """Binary logarithm of the number of runs: shuffle partitions, rounded up."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


def tree_merge(
    entries: DataFrame, levels: int | None = None, bits: int = 1, keep: str = "smallest"
) -> DataFrame:
    """(digest, check, size, keep_id, group_size) of every distinct text.

    ``2 ** levels`` runs meet in ``ceil(levels / bits)`` rounds of ``2 ** bits``
    partners each.  ``entries`` must be written (``stable``), so that a task that
    is run again finds its rows in the same partition.
    """
    levels = run_levels(entries.sparkSession) if levels is None else levels
    own = F.spark_partition_id().bitwiseAND(F.lit((1 << levels) - 1))
    runs = _merged(
        entries.select(own.alias("run"), *KEYS, "id", F.lit(1).cast("long").alias("count")),
        keep == "largest",
    )
    for shift in range(0, levels, bits):
        runs = merge_round(runs, shift, min(bits, levels - shift), levels, keep == "largest")
    return runs.select(*KEYS, F.col("id").alias("keep_id"), F.col("count").alias("group_size"))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
    levels: int | None = None, bits: int = 1,
) -> DataFrame:
    """One row per document row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty
    text.  ``keep`` names the id that stays, "smallest" or "largest".  Rows
    without an id count in group_size and stay only where no row of their group
    has one (keep_id is then NULL).  Rows that repeat the kept id all say kept.
    An empty table gives an empty result; other columns are ignored.

    The entries are written once (checkpoint) and read by the merge and by the
    join that gives every row its group, a sort-merge join on the digest whose
    row side adaptive execution splits where one text has many copies.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    entries = stable(digest_entries(docs, id_col, text_col))
    groups = tree_merge(entries, levels, bits, keep)
    return entries.join(groups.hint("merge"), ["digest", "check", "size"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("check")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows are dropped by the ids that go, normally the shorter list; adaptive
    execution broadcasts it only if it turns out small.  An id counts as a
    document's name: an id that is kept for any of its rows stays.  Rows that
    repeat a kept id with the same text become one, and so do nameless rows
    with the same text.
    """
    found = stable(exact_dedup(docs, id_col, text_col, keep))
    gone = found.filter(~F.col("kept")).select(id_col).join(
        found.filter("kept").select(id_col), id_col, "left_anti"
    ).filter(F.col(id_col).isNotNull()).distinct()
    out = docs.join(gone, id_col, "left_anti")
    repeated = (
        found.filter("kept AND group_size > 1").groupBy(id_col, "text_sha256").count()
        .filter("count > 1").select(id_col)
    )
    nameless = found.filter(F.col(id_col).isNull()).limit(1)
    if repeated.isEmpty() and nameless.isEmpty():
        return out
    # rare: only the rows of such ids are grouped
    again = repeated.filter(F.col(id_col).isNotNull()).distinct()
    once = out.filter(F.col(id_col).isNotNull()).join(again, id_col, "left_anti")
    text = F.sha2(lower_ascii(F.col(text_col)), 256)
    rows = out.filter(F.col(id_col).isNotNull()).join(again, id_col, "left_semi")
    lone = found.filter(F.col(id_col).isNull() & F.col("kept")).select(
        F.col("text_sha256").alias("__text")
    ).distinct()
    bare = out.filter(F.col(id_col).isNull()).withColumn("__text", text).join(
        lone, "__text", "left_semi"
    )
    rows = rows.withColumn("__text", text).unionByName(bare)
    rows = rows.groupBy(id_col, "__text").agg(
        F.min(F.struct(*[c for c in out.columns if c != id_col])).alias("__row")
    ).select(id_col, "__row.*")
    return once.unionByName(rows.select(once.columns))
