"""Near duplicates: banded MinHash candidates, Bayesian sequential verification, exact check.

1. Every text becomes its set of word shingles (64-bit hashes), a MinHash
   signature and one key per band of ``rows`` MinHash values.  Equal sets are
   one node from here on, so exact copies never meet again.
2. Nodes with a band key in common share a bucket.  A node's popularity is the
   sum of the sizes of its buckets; the original of a family of edited copies
   shares more buckets than any copy does.  In a first pass every node is
   compared with the most popular node that it shares a bucket with, at most
   one pair per node, and the links found give provisional components.
3. Only buckets that still hold two or more components have work left, and only
   between components.  Their members' signatures meet in one task, those of a
   bucket of more than ``CELL`` members in the cells of a grid of its parts, and
   are compared there.  In buckets of more than ``FEW`` a pair is taken up in its
   first common bucket only and its shingle sets are compared on the spot, in 32
   bits a shingle, so that near misses of a large family are not listed.
4. Signatures are compared in batches.  After n values of which m agree, the
   similarity has a Beta(m + 1, n - m + 1) posterior; the pair is dropped once
   the chance of reaching the threshold falls below ``miss``.  Survivors are
   verified on the full shingle sets.

Chance of a lost link at the threshold 0.8 with 40 bands of 5 rows: 1.3e-7 for
the bands and ``miss`` per batch; smaller above the threshold.  Texts that stay
just below the threshold of a large family are compared with all its members
they share a bucket with: the comparisons, not the rows, grow with their product.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.components import components
from tideline.llm.textbytes import Words, chunks, flat, mix, shingle_sets
from tideline.session import stable

BANDS, ROWS, MISS = 40, 5, 1e-5
FEW = 64  # members of a bucket whose surviving pairs are listed at once
CELL = 2048  # members of a bucket, or of a part of one, that meet at most


def _families(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return seeds[:n] | np.uint64(1), seeds[n:]


def signatures(
    values: np.ndarray, offsets: np.ndarray, bands: int, rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """8-bit signatures (documents x bands*rows) and 64-bit band keys of non-empty sets.

    One in 256 unequal values looks equal in 8 bits, which can only keep a pair longer.
    """
    docs, total = len(offsets) - 1, bands * rows
    low = np.full((total, docs), np.iinfo(np.uint64).max, np.uint64)
    factor, shift = _families(total)
    first, block = 0, 1 << 15
    while first < docs:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + block, "right")) - 1)
        part, starts = values[offsets[first] : offsets[last]], offsets[first:last] - offsets[first]
        room = np.empty_like(part)
        for i in range(total):
            np.multiply(part, factor[i], out=room)
            room += shift[i]
            low[i, first:last] = np.minimum.reduceat(room, starts)
        first = last
    keys = np.empty((docs, bands), np.uint64)
    weights = mix(np.arange(11, 11 + rows, dtype=np.uint64)) | np.uint64(1)
    for band in range(bands):
        joined = (low[band * rows : (band + 1) * rows] * weights[:, None]).sum(0, dtype=np.uint64)
        keys[:, band] = mix(joined + weights[:1] * np.uint64(band + 1))
    # minima are small numbers: mix them before taking bits
    return (mix(low) >> np.uint64(56)).astype(np.uint8).T.copy(), keys


def fewest_matches(total: int, batch: int, threshold: float, miss: float) -> list[int]:
    """For each batch end n, the least m with P(similarity >= threshold | m of n) >= miss.

    The posterior under a uniform prior is Beta(m + 1, n - m + 1); its upper
    tail at t is the chance of at most m successes in n + 1 trials at t.
    """
    out = []
    for n in [*range(batch, total, batch), total]:
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def sketch_documents(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int
) -> DataFrame:
    """(id, n, set, sig, keys): set size, digest of the set, signature, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                values, offsets = shingle_sets(Words(*flat(batch.column("text"))), shingle)
                size = np.diff(offsets)
                full = np.flatnonzero(size)
                sig, keys = signatures(values, offsets[np.append(full, len(size))], bands, rows)
                digests, sigs = [None] * len(size), [None] * len(size)
                for at, d in enumerate(full.tolist()):
                    own = values[offsets[d] : offsets[d + 1]]
                    digests[d] = hashlib.blake2b(own.data, digest_size=16).digest()
                    sigs[d] = sig[at].tobytes()
                ends = np.zeros(len(size) + 1, np.int32)
                ends[1:] = np.cumsum(np.where(size > 0, bands, 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"), pa.array(size), pa.array(digests, pa.binary()),
                        pa.array(sigs, pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(ends), pa.array(keys.reshape(-1).view(np.int64))
                        ),
                    ],
                    ["id", "n", "set", "sig", "keys"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows_in = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows_in.mapInArrow(
        run, f"id {kind}, n bigint, set binary, sig binary, keys array<bigint>"
    )


def shingle_tables(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, width: int = 8
) -> DataFrame:
    """(id, values): sorted distinct shingle hashes, their upper ``width`` bytes, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                values, offsets = shingle_sets(Words(*flat(batch.column("text"))), shingle)
                if width == 4:
                    values = (values >> np.uint64(32)).astype("<u4")
                at = pa.array(offsets * width, pa.int64())
                blob = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(offsets) - 1,
                    [None, at.buffers()[1], pa.py_buffer(values.tobytes())],
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id"), blob], ["id", "values"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows_in = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows_in.mapInArrow(run, f"id {kind}, values binary")


def among(docs: DataFrame, id_col: str, ids: DataFrame, few: int = 500_000) -> DataFrame:
    """The documents with these ids; the ids are broadcast only if counted to be few."""
    ids = stable(ids.distinct())
    ids = F.broadcast(ids) if ids.count() <= few else ids.hint("merge")
    return docs.join(ids, id_col, "left_semi")


def _alive(
    left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, needed: list[int],
    batch: int, agreed: np.ndarray | None = None, block: int = 1 << 16,
) -> np.ndarray:
    """Places of the pairs (left[i], right[j]) that no batch rules out.

    ``agreed``: matches in the first batch, if they are known and enough.
    """
    out = []
    for start in range(0, len(i), block):
        at = np.arange(start, min(start + block, len(i)))
        count = np.zeros(len(at), np.int64) if agreed is None else agreed[at].astype(np.int64)
        for step in range(agreed is not None, len(needed)):
            own = slice(step * batch, (step + 1) * batch)
            count += (left[i[at], own] == right[j[at], own]).sum(1)
            stay = count >= needed[step]
            at, count = at[stay], count[stay]
        out.append(at)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), np.uint8).reshape(len(blobs), -1)


def _survivors(pairs: DataFrame, nodes: DataFrame, needed: list[int], batch: int) -> DataFrame:
    """The listed pairs that no batch of their signatures rules out."""
    sig = nodes.select("node", "sig")
    joined = pairs.join(
        sig.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")).hint("merge"), "a"
    ).join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")).hint("merge"), "b")
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if rows.num_rows:
                each = np.arange(rows.num_rows)
                left, right = (_matrix(rows.column(c)) for c in ("sig_a", "sig_b"))
                alive = _alive(left, right, each, each, needed, batch)
                yield rows.select(["a", "b"]).take(pa.array(alive))

    return joined.select("a", "b", "sig_a", "sig_b").mapInArrow(run, f"a {kind}, b {kind}")


def _verified(
    pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, threshold: float
) -> DataFrame:
    """The pairs whose full sets reach the threshold, compared in integers.

    Only the texts of the pairs are read again; a member's set travels to its
    partner's, so that no task gathers a hub's partners.
    """
    share = round(threshold * 10_000)
    kind = pairs.schema["a"].dataType.simpleString()
    ids = pairs.select(F.col("a").alias(id_col)).union(pairs.select("b"))
    sets = stable(shingle_tables(among(docs, id_col, ids), id_col, text_col, shingle))
    joined = pairs.join(
        sets.select(F.col("id").alias("a"), F.col("values").alias("values_a")).hint("merge"), "a"
    ).join(
        sets.select(F.col("id").alias("b"), F.col("values").alias("values_b")).hint("merge"), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            linked = []
            for i, (x, y) in enumerate(zip(rows.column("values_a"), rows.column("values_b"))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if 10_000 * min(len(x), len(y)) < share * max(len(x), len(y)):
                    continue
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                if 10_000 * common >= share * (len(x) + len(y) - common):
                    linked.append(i)
            yield rows.select(["a", "b"]).take(pa.array(linked, pa.int64()))

    return joined.select("a", "b", "values_a", "values_b").mapInArrow(
        run, f"a {kind}, b {kind}"
    )


def _first_meeting(keys: np.ndarray, i: np.ndarray, j: np.ndarray, band: int) -> np.ndarray:
    """Whether the pairs share no bucket of an earlier band."""
    out = np.empty(len(i), bool)
    for start in range(0, len(i), 1 << 15):
        at = slice(start, start + (1 << 15))
        out[at] = (keys[i[at], :band] == keys[j[at], :band]).any(1)
    return ~out


def _close(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, share: int) -> np.ndarray:
    """Places of the pairs whose sets, of 32 bits a shingle, reach the threshold.

    Shingles that agree in 32 bits only can add to the overlap, never take from it.
    """
    if not len(i):
        return np.empty(0, np.int64)
    out, order = [], np.argsort(i, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], i[order][1:] != i[order][:-1], [True]]))
    for first, last in zip(edges[:-1], edges[1:]):
        own = sets[i[order[first]]]
        for cut in range(first, last, 512):
            at = order[cut : min(cut + 512, last)]
            others = [sets[k] for k in j[at]]
            size = np.array([len(o) for o in others])
            flat = np.concatenate(others)
            place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            common = np.add.reduceat((own[place] == flat).astype(np.int64), np.cumsum(size) - size)
            out.append(at[10_000 * common >= share * (len(own) + size - common)])
    return np.concatenate(out)


def _meet(
    cell: dict[str, np.ndarray], bounds: np.ndarray, needed: list[int], batch: int, share: int
) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the surviving pairs of different components within each cell.

    A cell's rows stand between two bounds; side 0 meets side 1, and side 2
    meets all of its own cell.
    """
    sig, comp, side = cell["sig"], cell["comp"], cell["side"]
    few_i, few_j, found = [], [], []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if cell["values"][start] is None:
            i, j = np.triu_indices(end - start, 1)
            few_i.append(i + start)
            few_j.append(j + start)
            continue
        whole, rows = side[start] == 2, np.arange(start, end)
        ones, others = (rows, rows) if whole else (rows[side[rows] == 0], rows[side[rows] == 1])
        right = np.ascontiguousarray(sig[others, :batch].T)
        keys = np.array([cell["keys"][r] for r in rows], np.int64)
        sets = [np.frombuffer(cell["values"][r], "<u4") for r in rows]
        for cut in range(0, len(ones), 256):
            part = ones[cut : cut + 256]
            left = np.ascontiguousarray(sig[part, :batch].T)
            count = np.zeros((len(part), len(others)), np.uint8)
            for k in range(batch):
                count += left[k][:, None] == right[k]
            fits = (count >= needed[0]) & (comp[part][:, None] != comp[others])
            if whole:
                fits &= part[:, None] < others
            x, y = np.nonzero(fits)
            i, j, agreed = part[x], others[y], count[x, y]
            new = _first_meeting(keys, i - start, j - start, int(cell["band"][start]))
            i, j = i[new], j[new]
            alive = _alive(sig, sig, i, j, needed, batch, agreed[new])
            i, j = i[alive], j[alive]
            near = _close(sets, i - start, j - start, share)
            found.append((i[near], j[near]))
    if few_i:
        i, j = np.concatenate(few_i), np.concatenate(few_j)
        apart = comp[i] != comp[j]
        i, j = i[apart], j[apart]
        alive = _alive(sig, sig, i, j, needed, batch)
        found.append((i[alive], j[alive]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def cross_survivors(
    shared: DataFrame, labels: DataFrame, signed: DataFrame, sets_of, needed: list[int],
    batch: int, share: int, few: int, cell: int,
) -> DataFrame:
    """Pairs (a < b) that share a bucket, differ in provisional component and survive.

    ``shared``: (key, band, node, m) of all buckets of two or more; ``labels``:
    (node, component); ``signed``: (node, sig, keys); ``sets_of``: the shingle
    sets (id, values) of given ids.
    """
    entries = shared.join(labels.hint("merge"), "node", "left").select(
        "key", "band", "node", "m", F.coalesce("component", "node").alias("comp")
    )
    mixed = entries.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    entries = stable(
        entries.join(mixed.filter("c0 <> c1").select("key").hint("merge"), "key")
    )
    columns = ["key", "x", "y", "side", "band", "node", "comp", "sig", "keys", "values"]
    listed = entries.filter(F.col("m") <= few).join(
        signed.select("node", "sig").hint("merge"), "node"
    ).withColumns(
        {"x": F.lit(0), "y": F.lit(0), "side": F.lit(2),
         "keys": F.lit(None).cast("array<bigint>"), "values": F.lit(None).cast("binary")}
    ).select(columns)
    # a large bucket's parts meet pairwise: part i is side 0 of cells (i, j) and side 1 of (j, i)
    large = entries.filter(F.col("m") > few)
    sets = stable(sets_of(large.select("node")).withColumnRenamed("id", "node"))
    parts = F.ceil(F.col("m") / cell).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    large = large.withColumn("parts", parts).withColumn("own", own).select(
        "key", "band", "node", "comp", "own",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"),
    ).select(
        "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int"))
        .alias("side"),
        "band", "node", "comp",
    ).join(signed.hint("merge"), "node").join(sets.hint("merge"), "node").select(columns)
    rows = listed.unionByName(large).repartition("key", "x", "y")
    rows = rows.sortWithinPartitions("key", "x", "y")
    kind = signed.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(table: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
            held = {c: table.column(c).to_numpy() for c in ("band", "node", "comp", "side")}
            held |= {c: table.column(c).to_pylist() for c in ("keys", "values")}
            held["sig"] = _matrix(table.column("sig"))
            i, j = _meet(held, bounds, needed, batch, share)
            node = held["node"]
            low, high = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
            named = table.schema.field("node").type
            return pa.RecordBatch.from_arrays([pa.array(low, named), pa.array(high, named)], ["a", "b"])

        rest = None
        for batch_rows in batches:
            if not batch_rows.num_rows:
                continue
            table = pa.Table.from_batches([batch_rows])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            cells = np.stack([table.column(c).to_numpy() for c in ("key", "x", "y")])
            new = np.flatnonzero((cells[:, 1:] != cells[:, :-1]).any(0)) + 1
            if len(new):
                yield settle(table.slice(0, new[-1]), np.concatenate([[0], new]))
                table = table.slice(new[-1])
            rest = table.combine_chunks()
        if rest is not None and rest.num_rows:
            yield settle(rest, np.array([0, rest.num_rows]))

    return rows.mapInArrow(run, f"a {kind}, b {kind}").filter("a <> b").distinct()


def roots(links: DataFrame) -> DataFrame:
    """(node, component) from links (a, b) of nodes to more popular ones, at most one per node.

    Such links have no circle, so doubling the steps upward ends at the roots.
    """
    up = stable(links.select(F.col("a").alias("node"), F.col("b").alias("component")).distinct())
    while True:
        above = up.select(F.col("node").alias("component"), F.col("component").alias("next"))
        step = stable(up.join(above.hint("merge"), "component", "left"))
        up = step.select("node", F.coalesce("next", "component").alias("component"))
        if step.filter("next IS NOT NULL").isEmpty():
            return up


def _smallest(members: DataFrame, labels: DataFrame, more: DataFrame) -> DataFrame:
    """(node, component), component the smallest node, after joining trees by further links.

    Only the trees' roots take part in the search for components.
    """
    def root(column: str) -> DataFrame:
        return labels.select(F.col("node").alias(column), F.col("component").alias(f"root_{column}"))

    ties = more.join(root("a").hint("merge"), "a", "left").join(root("b").hint("merge"), "b", "left")
    joined = components(ties.select(
        F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")
    )).select(F.col("node").alias("root"), F.col("component").alias("joint"))
    rooted = members.join(labels.hint("merge"), "node", "left").select(
        "node", F.coalesce("component", "node").alias("root")
    )
    named = stable(rooted.join(joined.hint("merge"), "root", "left").select(
        "node", F.coalesce("joint", "root").alias("joint")
    ))
    least = named.groupBy("joint").agg(F.min("node").alias("component"))
    return named.join(least.hint("merge"), "joint").select("node", "component")


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
    threshold: float = 0.8, bands: int = BANDS, rows: int = ROWS, miss: float = MISS,
    batch: int = 40, few: int = FEW, cell: int = CELL,
) -> DataFrame:
    """One row per document row: id, n_shingles, component_id, kept.

    Documents are linked if the Jaccard similarity of their shingle sets is at
    least ``threshold``; component_id is the smallest id reachable by links, and
    kept says that it is the row's own.  A text of fewer words than a shingle
    has is one shingle; texts that are NULL, empty or without words have none,
    are linked with nothing and are kept.  Rows without an id are counted, not
    linked: component_id is NULL, kept true.  An id that repeats with another
    text stands for one document with several texts: its rows share what any of
    them is linked with only where it is the smallest id of its text.  Ids may be
    of any type that has an order.  An empty table gives an empty result; other
    columns are ignored.
    """
    told = stable(sketch_documents(docs, id_col, text_col, shingle, bands, rows))
    # a node is a distinct set, named by its smallest id
    nodes = stable(
        told.filter("set IS NOT NULL AND id IS NOT NULL").groupBy("set").agg(
            F.min("id").alias("node"), F.first("sig").alias("sig"), F.first("keys").alias("keys")
        )
    )
    entries = nodes.select(F.posexplode("keys").alias("band", "key"), "node")
    sizes = entries.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    shared = stable(entries.join(sizes.hint("merge"), "key"))

    popular = shared.groupBy("node").agg(F.sum("m").alias("weight"))
    ranked = shared.join(popular.hint("merge"), "node").select("key", "node", "weight")
    # the most popular node, of equally popular ones that with the smaller id
    leader = F.min(F.struct((-F.col("weight")).alias("minus"), F.col("node").alias("name")))
    leaders = ranked.groupBy("key").agg(leader.alias("hub"))
    stars = stable(
        ranked.join(leaders.hint("merge"), "key").filter("node <> hub.name").groupBy("node")
        .agg(F.min("hub").alias("hub"))
        .select(F.col("node").alias("a"), F.col("hub.name").alias("b"))
    )

    needed = fewest_matches(bands * rows, batch, threshold, miss)
    signed = stable(
        nodes.select("node", "sig", "keys").join(
            popular.select("node").hint("merge"), "node", "left_semi"
        )
    )
    check = (docs, id_col, text_col, shingle, threshold)

    def sets_of(ids: DataFrame) -> DataFrame:
        told = among(docs, id_col, ids.withColumnRenamed("node", id_col))
        return shingle_tables(told, id_col, text_col, shingle, width=4)

    links = stable(_verified(stable(_survivors(stars, signed, needed, batch)), *check))
    labels = roots(links)
    tested = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stable(
        cross_survivors(
            shared, labels, signed, sets_of, needed, batch, round(threshold * 10_000), few, cell
        ).join(
            tested.distinct().hint("merge"), ["a", "b"], "left_anti"
        )
    )
    more = stable(_verified(rest, *check))
    labels = _smallest(popular.select("node"), labels, more)

    found = nodes.select("set", "node").join(labels.hint("merge"), "node", "left").select(
        "set", F.coalesce("component", "node").alias("component")
    )
    return told.select("id", "n", "set").join(found.hint("merge"), "set", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


MARK = "_near_dedup_row"


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The documents that stay, one of each component, with all their columns.

    Rows without an id, words or text stay; of a component the row with the
    smallest id does.  Ids that go are the shorter list; adaptive execution
    broadcasts it only if it turns out small.  Where an id stands before several
    rows, the table is written once with a number per row, and each row is held
    against the others by its own text, so that a copy takes no other text of its
    id with it.
    """
    again = docs.filter(F.col(id_col).isNotNull()).groupBy(id_col).count().filter("count > 1")
    if again.isEmpty():
        found = near_dedup(docs, id_col, text_col, **options)
        return docs.join(found.filter("NOT kept").select(id_col).distinct(), id_col, "left_anti")
    placed = stable(docs.withColumn(MARK, F.monotonically_increasing_id()))
    named = placed.filter(F.col(id_col).isNotNull())
    found = near_dedup(named, MARK, text_col, **options).select(MARK, "component_id")
    ids = named.select(MARK, F.col(id_col).alias("id"))
    found = stable(found.join(ids.hint("merge"), MARK))
    first = found.groupBy("component_id").agg(
        F.min(F.struct("id", MARK)).alias("first"), F.count("*").alias("n")
    ).filter("n > 1").select("component_id", F.col(f"first.{MARK}").alias("stays"))
    gone = found.join(first, "component_id").filter(F.col(MARK) != F.col("stays")).select(MARK)
    return placed.join(gone, MARK, "left_anti").drop(MARK)
