"""Mixture-controlled packing by deficit round-robin over source queues.

Every text is encoded once; its ids are written in chunks of a small part of a
block, so that a long text crosses blocks and a short one stays whole.  The
corpus is one timeline of tokens on which every source is served at its target.
A source's chunks stand in the order of a hash of their row, and prefix sums of
their tokens, within and between lanes of that hash, give the stretch of the
timeline that each chunk fills.  A point of that stretch, set by the hash, names
the block of about ``BLOCK`` bytes that the chunk goes to.  So at the end of any
block a source is about one chunk away from its target, however many blocks came
before, and neither a source, a partition of the input, a long text nor rows that
are equal or empty decide where tokens go.  Wherever a source with a wanted share
runs dry, the others' shares grow and a new block begins.

A block is a queue of chunks per source.  It takes over the deficits that the
blocks before it left, by prefix sums over blocks, and hands on its own; the
difference is repaid evenly over its windows.  Each window adds to every source's
deficit its target share and that repayment, then takes from the queues in turn
up to their deficits, cutting freely; tokens that an empty queue cannot give are
lent by the others, whose deficits go below zero.  Deficits go on from window to
window.  Blocks are packed independently and a lost one is packed again in the
same way.

Sequences hold ``LENGTH`` tokens; the rest of a block is cut into sequences of
powers of two, so nothing is padded.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.textbytes import chunks
from tideline.llm.tokens import encoder
from tideline.session import stable

LENGTH, WINDOW, BLOCK, LANE, END = 2048, 16, 8 << 20, 1024, 1
LANES = 20  # bits of the hash that name a lane, at most
CHUNK = 256  # bytes of a block for each token of a chunk, a chunk being some 1/60 of a block
ROW = 64  # bytes that a row counts as at least when blocks are numbered


def boundaries(total: int, length: int) -> list[int]:
    """Ends of the sequences of ``total`` tokens: full ones, then powers of two."""
    ends = list(range(length, total + 1, length))
    at, rest = (ends[-1] if ends else 0), total % length
    while rest:
        size = 1 << (rest.bit_length() - 1)
        at, rest = at + size, rest - size
        ends.append(at)
    return ends


def round_robin(
    queues: dict[str, list[tuple[int, int]]], share: dict[str, float], carry: dict[str, float],
    window: int, ends: list[int],
) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one block.

    queues: documents and their sizes by source, in order.
    """
    order = sorted(queues)
    left = {s: sum(n for _, n in queues[s]) for s in order}
    head = {s: [0, 0] for s in order}  # document in the queue, tokens of it taken
    deficit = {s: carry.get(s, 0.0) for s in order}
    at = sequence = begun = 0
    last = None

    def take(source: str, count: int) -> Iterator[tuple[int, int, int, int, int]]:
        nonlocal at, sequence, begun, last
        while count:
            place = head[source]
            document, size = queues[source][place[0]]
            n = min(count, size - place[1], ends[sequence] - at)
            piece = (document, place[1], n, sequence, at - begun)
            if last and last[0] == document and last[3] == sequence and last[1] + last[2] == place[1]:
                last = (document, last[1], last[2] + n, sequence, last[4])
            else:
                if last:
                    yield last
                last = piece
            at, count, place[1] = at + n, count - n, place[1] + n
            if place[1] == size:
                place[0], place[1] = place[0] + 1, 0
            if at == ends[sequence]:
                sequence, begun = sequence + 1, at

    while any(left.values()):
        room = window
        for s in order:
            deficit[s] += share.get(s, 0.0) * window
        while room and any(left.values()):
            served = 0
            for s in order:
                n = min(int(max(deficit[s], 0)), left[s], room)
                if n:
                    yield from take(s, n)
                    left[s], room, deficit[s], served = left[s] - n, room - n, deficit[s] - n, served + n
            if not served:
                open_ = [s for s in order if left[s]]
                weight = sum(share.get(s, 0.0) for s in open_)
                lend = room
                for s in open_:
                    part = share.get(s, 0.0) / weight if weight else 1 / len(open_)
                    n = min(max(1, int(lend * part)), left[s], room)
                    yield from take(s, n)
                    left[s], room, deficit[s] = left[s] - n, room - n, deficit[s] - n
    if last:
        yield last


def deal(
    counts: DataFrame, rows: int, block_tokens: float, tokens: int,
    named: dict[str, tuple[float, int]],
) -> DataFrame:
    """(row, block, share, carry) from (row, source, h, tokens), one row per chunk.

    ``tokens`` is the sum over all rows; ``named`` has weight and tokens of
    sources that are served first, at their weights.  The others follow, each
    at its part of what they hold together.  ``share`` is the source's target in
    the block, ``carry`` the tokens by which earlier blocks fell short of it.
    """
    bits = min(LANES, max(1, (rows // LANE).bit_length()))
    counts = counts.withColumn("lane", F.shiftright("h", 64 - bits))
    before = Window.unboundedPreceding, -1
    inner = Window.partitionBy("lane", "source").orderBy("h", "row").rowsBetween(*before)
    whole = Window.partitionBy("source")
    lanes = counts.groupBy("lane", "source").agg(F.sum("tokens").alias("__v")).select(
        "lane", "source", F.sum("__v").over(whole).alias("own"),
        F.coalesce(F.sum("__v").over(whole.orderBy("lane").rowsBetween(*before)), F.lit(0)).alias("base"),
    )
    point = F.shiftrightunsigned(F.xxhash64("h"), 11) / F.lit(float(1 << 53))
    placed = counts.withColumn("in", F.coalesce(F.sum("tokens").over(inner), F.lit(0))).join(
        lanes, ["lane", "source"]
    ).withColumn("at", F.col("base") + F.col("in") + point * F.col("tokens"))

    # rounds at which named sources run dry, tokens taken by then, blocks between
    dry = sorted({n / w for w, n in named.values()})
    taken = [sum(min(n, w * v) for w, n in named.values()) for v in [0.0, *dry]]
    spans = [b - a for a, b in zip(taken, taken[1:])] + [max(0.0, tokens - taken[-1])]
    sizes = [max(1, math.ceil(x / block_tokens)) for x in spans]
    first = [sum(sizes[:i]) for i in range(len(sizes))]
    last = len(dry)
    begun = [0.0, *dry[:-1]] if dry else []
    # weights of the sources that are not dry yet
    open_ = [sum(w for w, n in named.values() if n / w > v) for v in begun]
    turn = F.col("at") / F.col("own")  # of the source itself
    phase, part, segment = F.lit(last), turn, F.col("own").cast("double")
    share = F.col("own") / F.lit(max(1.0, spans[-1]))
    if named:
        weights = F.create_map(*[F.lit(x) for s, (w, _) in named.items() for x in (s, float(w))])
        weight = F.try_element_at(weights, "source")
        at = F.col("at") / weight
        phase = F.when(weight.isNull(), last).otherwise(F.least(
            F.size(F.filter(F.lit(dry), lambda v: v <= at)), F.lit(last - 1)
        ))
        begin, end = (F.get(F.lit(x), phase) for x in ([*begun, 0.0], [*dry, 1.0]))
        part = (F.coalesce(at, turn) - begin) / (end - begin)
        segment = F.coalesce(weight * (end - begin), segment)
        share = F.coalesce(weight / F.get(F.lit([float(x) for x in open_] + [1.0]), phase), share)
    of = F.get(F.lit(sizes), phase)
    start = F.get(F.lit(first), phase)
    block = start + F.least(F.floor(part * of), of - 1)
    dealt = placed.select(
        "row", "source", "tokens", block.cast("long").alias("block"), share.alias("share"),
        start.cast("long").alias("start"), (segment / of).alias("each"),
    )
    # what a block's source was due before it, less what it got
    held = dealt.groupBy("source", "block", "start", "each").agg(F.sum("tokens").alias("__v"))
    served = F.coalesce(F.sum("__v").over(
        Window.partitionBy("source", "start").orderBy("block").rowsBetween(*before)
    ), F.lit(0))
    due = F.col("each") * (F.col("block") - F.col("start"))
    carry = held.select("source", "block", (due - served).alias("carry"))
    return dealt.join(carry, ["source", "block"]).select("row", "block", "share", "carry")


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    source_col: str | None = "source", target: dict[str, float] | None = None,
    length: int = LENGTH, window: int = WINDOW, block_bytes: int = BLOCK, end_id: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens, source.

    Tokens of a document are the ids of its whole text and ``end_id``; NULL and
    empty texts have that one token.  ``target`` gives the wanted share of
    tokens per source, the shares of the whole input if None; sources it does
    not name follow when the others have run dry, each at its part of their
    tokens.  A NULL source is a source of its own.  Every token is in one piece; sequences are gapless from offset 0
    and hold ``length`` tokens or a smaller power of two.  Rows without an id
    are packed like others.  ``with_ids`` adds the ids.  An empty table gives an
    empty result; other columns are ignored.  The tokenizer file must be at
    that path on every machine.

    Rows that repeat one another are packed as often as they stand there, each
    for itself.  Memory of a task follows ``block_bytes`` and the longest text.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    kind = docs.schema[id_col].dataType.simpleString()
    source = F.col(source_col).cast("string") if source_col else F.lit("all")
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"),
        F.coalesce(source, F.lit("\0")).alias("source"),
    )
    cut = max(length, block_bytes // CHUNK)
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                texts = batch.column("text").to_pylist()
                at, part = [], {c: [] for c in ("start", "tokens", "doc_tokens", "doc", "bytes", "ids")}
                for i, (text, data) in enumerate(zip(texts, encoder(tokenizer).encode(texts))):
                    ids = np.frombuffer(data + end, "<u4")
                    mark = int.from_bytes(hashlib.blake2b(ids.data, digest_size=8).digest(), "big", signed=True)
                    kept = ids.astype("<u2") if ids.max() < 1 << 16 else ids
                    size = len(text.encode())
                    for a in range(0, len(ids), cut):
                        own = kept[a : a + cut]
                        at.append(i)
                        values = (a, len(own), len(ids), mark, size if a == 0 else 0, zlib.compress(own.tobytes(), 1))
                        for held, value in zip(part.values(), values):
                            held.append(value)
                taken = batch.select(["id", "source"]).take(pa.array(at, pa.int64()))
                kinds = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, *(pa.array(v, t) for v, t in zip(part.values(), kinds))],
                    ["id", "source", *part],
                )

    # written once: the numbers of its rows hold for all that follows; ids are moved twice, so deflated
    encoded = stable(rows.select("id", "source", "text").mapInArrow(
        encode, f"id {kind}, source string, start bigint, tokens bigint, doc_tokens bigint, "
        "doc bigint, bytes bigint, ids binary",
    )).withColumn("row", F.monotonically_increasing_id())
    counts = encoded.select("row", "source", "tokens", F.xxhash64("row").alias("h"))
    total = encoded.agg(
        F.count("*").alias("rows"), F.sum("tokens").alias("tokens"), F.sum("bytes").alias("bytes")
    ).first()
    wanted = {s: w for s, w in (target or {}).items() if w > 0}
    named = {
        r["source"]: (wanted[r["source"]], r["n"])
        for r in counts.filter(F.col("source").isin(list(wanted))).groupBy("source")
        .agg(F.sum("tokens").alias("n")).collect()
    } if wanted else {}
    tokens = total["tokens"] or 0
    blocks = max(1, -(-max(total["bytes"] or 0, total["rows"] * ROW) // block_bytes))
    dealt = deal(counts, total["rows"], max(1.0, tokens / blocks), tokens, named)

    def fill(left: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        names, sources, docs = (left.column(c).to_pylist() for c in ("id", "source", "doc"))
        begun, sizes, whole = (left.column(c).to_pylist() for c in ("start", "tokens", "doc_tokens"))
        packed = (zlib.decompress(x.as_buffer()) for x in left.column("ids").combine_chunks())
        parts = [
            np.frombuffer(x, "<u2" if 2 * n == len(x) else "<u4").astype("<u4")
            for x, n in zip(packed, sizes)
        ]
        order = sorted(range(len(parts)), key=lambda i: (
            names[i] is None, 0 if names[i] is None else names[i], docs[i], begun[i]
        ))
        queues: dict[str, list[tuple[int, int]]] = {}
        items: list[list[int]] = []  # chunks that follow each other in one text
        for i in order:
            queue = queues.setdefault(sources[i], [])
            if queue:
                item = items[queue[-1][0]]
                j = item[-1]
                if (names[j], docs[j], begun[j] + sizes[j]) == (names[i], docs[i], begun[i]):
                    item.append(i)
                    queue[-1] = (queue[-1][0], queue[-1][1] + sizes[i])
                    continue
            items.append([i])
            queue.append((len(items) - 1, sizes[i]))
        ids = [parts[x[0]] if len(x) == 1 else np.concatenate([parts[i] for i in x]) for x in items]
        shares, carries = left.column("share").to_pylist(), left.column("carry").to_pylist()
        share, carry = dict(zip(sources, shares)), dict(zip(sources, carries))
        # A block drains.  What it holds beyond its target repays the deficits that the
        # blocks before it left, less those that it leaves itself; repaid evenly, they
        # move no window far from the target.
        held = sum(sizes)
        own = {s: sum(n for _, n in q) for s, q in queues.items()}
        after = {s: carry[s] + share[s] * held - own[s] for s in own}
        rate = {s: share[s] + (carry[s] - after[s]) / held for s in own}
        ends = boundaries(held, length)
        base = (left.column("block")[0].as_py() << 32) if len(ids) else 0
        out = list(round_robin(queues, rate, {}, window * length, ends))
        starts = [0, *ends]
        head = [x[0] for x in items]
        columns = {
            id_col: pa.array([names[head[d]] for d, *_ in out], left.schema.field("id").type),
            "start": pa.array([begun[head[p[0]]] + p[1] for p in out], pa.int64()),
            "length": pa.array([p[2] for p in out], pa.int64()),
            "ids_crc32": pa.array(
                [zlib.crc32(ids[d][s : s + n].data) for d, s, n, *_ in out], pa.int64()
            ),
            "doc_tokens": pa.array([whole[head[p[0]]] for p in out], pa.int64()),
            "sequence_id": pa.array([base + p[3] for p in out], pa.int64()),
            "offset": pa.array([p[4] for p in out], pa.int64()),
            "sequence_tokens": pa.array([ends[p[3]] - starts[p[3]] for p in out], pa.int64()),
            "source": pa.array([sources[head[p[0]]] for p in out], pa.string()),
        }
        if with_ids:
            columns["ids"] = pa.array(
                [ids[d][s : s + n].astype(np.int32) for d, s, n, *_ in out], pa.list_(pa.int32())
            )
        return pa.table(columns)

    schema = (
        f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, sequence_tokens bigint, source string"
        + (", ids array<int>" if with_ids else "")
    )
    return (
        encoded.drop("bytes").join(dealt.hint("shuffle_hash"), "row").drop("row")
        .groupBy("block").applyInArrow(fill, schema)
        .withColumn("source", F.nullif("source", F.lit("\0")))
    )
