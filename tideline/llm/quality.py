"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed on whole texts inside Arrow tasks from flat byte arrays
(``textbytes``).  The trees are fitted on a bounded sample of labelled rows:
statistics are cut into at most 64 quantile bins, and every level of a tree
sums gradients and curvatures per (node, statistic, bin) and takes the best
split of each node.  The forest is flattened into arrays (feature, threshold,
child, value); scoring moves an index matrix (rows x trees) down the arrays
level by level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.textbytes import Words, chunks, flat, mix

FEATURES = (
    "log_bytes", "log_words", "bytes_per_word", "longest_word", "upper", "digit", "space",
    "high_bytes", "symbol", "odd_symbol", "bang", "bar", "stop", "comma", "brace",
    "lines_per_word", "words_per_line", "distinct_words", "distinct_pairs", "repeated_next",
    "top_word", "distinct_lines", "odd_word_ends", "upper_words", "lower_starts",
)
SAMPLE = 40_000  # labelled rows the trees are fitted on, at most

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t\n\r\x0b\x0c",
    "high_bytes": bytes(range(128, 256)), "symbol": b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~",
    "odd_symbol": b"#$%&*^~", "bang": b"!", "bar": b"|", "stop": b".", "comma": b",",
    "brace": b"(){}[]<>=;",
}


def _set(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_MEMBERS = {name: _set(members) for name, members in _KINDS.items()}
_ODD_END = _set(b"#$%&*^~!|")
_LOWER_START = _set(b"abcdefghijklmnopqrstuvwxyz")


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of set flags between consecutive bounds."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[bounds])


def _distinct(keys: np.ndarray, owner: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each owner, and how often its commonest key occurs."""
    count, top = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    if len(keys):
        # equal keys of one owner get one 64-bit word; owners are told apart afterwards
        tagged = mix(keys ^ mix(owner.astype(np.uint64) + np.uint64(1)))
        order = np.argsort(tagged, kind="stable")
        tagged = tagged[order]
        first = np.flatnonzero(np.concatenate([[True], tagged[1:] != tagged[:-1]]))
        runs = np.diff(np.append(first, len(tagged)))
        whose = owner[order[first]]
        count += np.bincount(whose, minlength=docs)
        np.maximum.at(top, whose, runs)
    return count, top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Statistics (documents x FEATURES) of whole texts; an empty text has zeros."""
    docs, size = len(offsets) - 1, np.diff(offsets)
    words = Words(data, offsets)
    hashes, n = words.hashes(), words.per_doc
    owner = np.repeat(np.arange(docs), n)
    per_byte, per_word = np.maximum(size, 1), np.maximum(n, 1)
    out = dict(zip(_MEMBERS, (_sums(t[data], offsets) / per_byte for t in _MEMBERS.values())))
    out["log_bytes"], out["log_words"] = np.log1p(size), np.log1p(n)
    out["bytes_per_word"] = size / per_word
    length, bounds = words.end - words.start, words.bounds
    longest = np.zeros(docs, np.int64)
    some = np.flatnonzero(n)
    if len(some):
        longest[some] = np.maximum.reduceat(length, bounds[:-1][some])
    out["longest_word"] = np.log1p(longest)

    newline = data == ord("\n")
    breaks = _sums(newline, offsets)
    out["lines_per_word"] = breaks / per_word
    out["words_per_line"] = np.log1p(n / (breaks + 1))
    distinct, top = _distinct(hashes, owner, docs)
    out["distinct_words"], out["top_word"] = distinct / per_word, top / per_word
    follows = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else np.empty(0, np.int64)
    pairs = hashes[follows] * np.uint64(3) + hashes[follows + 1] if len(follows) else hashes[:0]
    per_pair = np.maximum(n - 1, 1)
    out["distinct_pairs"] = _distinct(pairs, owner[follows], docs)[0] / per_pair
    again = hashes[follows] == hashes[follows + 1] if len(follows) else np.empty(0, bool)
    out["repeated_next"] = np.bincount(owner[follows], again, docs) / per_pair

    # a line's hash is the sum of its words' hashes, weighted by their places
    line = np.searchsorted(np.flatnonzero(newline), words.start) if len(words.start) else owner
    mark = mix((np.arange(len(hashes)) - _line_start(line, owner)).astype(np.uint64) + np.uint64(7))
    head = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (owner[1:] != owner[:-1])])) if len(owner) else np.empty(0, np.int64)
    if len(head):
        lines = np.add.reduceat(hashes * mark, head)
        per_line = np.bincount(owner[head], minlength=docs)
        out["distinct_lines"] = _distinct(lines, owner[head], docs)[0] / np.maximum(per_line, 1)
    else:
        out["distinct_lines"] = np.zeros(docs)
    out["odd_word_ends"] = _sums(_ODD_END[data[words.end - 1]], bounds) / per_word
    capital = _MEMBERS["upper"][data[words.start]]
    if len(words.start):
        second = np.minimum(words.start + 1, words.end - 1)
        out["upper_words"] = _sums(capital & _MEMBERS["upper"][data[second]], bounds) / per_word
    else:
        out["upper_words"] = np.zeros(docs)
    out["lower_starts"] = _sums(_LOWER_START[data[words.start]], bounds) / per_word
    return np.column_stack([out[name] for name in FEATURES]).astype(np.float32)


def _line_start(line: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each word, the place of the first word of its line."""
    if not len(line):
        return np.empty(0, np.int64)
    new = np.concatenate([[True], (line[1:] != line[:-1]) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(new)
    return first[np.cumsum(new) - 1]


@dataclass
class Forest:
    """Trees as arrays; a leaf is its own child, so that every row takes ``depth`` steps."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray, block: int = 4096) -> np.ndarray:
        out = np.empty(len(x))
        for start in range(0, len(x), block):
            rows = x[start : start + block]
            at = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
            number = np.arange(len(rows))[:, None]
            for _ in range(self.depth):
                right = rows[number, self.feature[at]] > self.threshold[at]
                at = np.where(right, self.right[at], self.left[at])
            raw = self.bias + self.value[at].sum(1)
            out[start : start + block] = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        return out


def fit_forest(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15,
    bins: int = 64, ridge: float = 1.0, least: float = 5.0,
) -> Forest:
    """Second-order boosting of the logistic loss on binned statistics.

    Without rows, or with labels of one kind, the forest has no trees and
    scores everything by the smoothed share of label 1.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    columns = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []

    def node(feature=0, threshold=np.inf, value=0.0) -> int:
        at = len(columns["feature"])
        for k, v in (("feature", feature), ("threshold", threshold), ("left", at), ("right", at),
                     ("value", value)):
            columns[k].append(v)
        return at

    if len(y) and 0 < y.sum() < len(y):
        n, width = x.shape
        cuts = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) for j in range(width)]
        cuts = [c.astype(np.float32) for c in cuts]
        binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
        raw = np.full(n, bias)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            gradient, curvature = y - p, np.maximum(p * (1 - p), 1e-6)
            roots.append(node())
            where, level = np.zeros(n, np.int64), [roots[-1]]
            for step in range(depth + 1):
                g = np.bincount(where, gradient, len(level))
                h = np.bincount(where, curvature, len(level))
                if step == depth:
                    break
                gains = np.full(len(level), 1e-9)
                choice = [None] * len(level)
                for j in range(width):
                    key = where * bins + binned[j]
                    gl = np.bincount(key, gradient, len(level) * bins).reshape(-1, bins).cumsum(1)
                    hl = np.bincount(key, curvature, len(level) * bins).reshape(-1, bins).cumsum(1)
                    gr, hr = g[:, None] - gl, h[:, None] - hl
                    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (g**2 / (h + ridge))[:, None]
                    gain[(hl < least) | (hr < least)] = 0
                    gain[:, len(cuts[j]) :] = 0
                    best = gain.argmax(1)
                    for i in np.flatnonzero(gain[np.arange(len(level)), best] > gains):
                        gains[i], choice[i] = gain[i, best[i]], (j, int(best[i]))
                following, moved = [], where.copy()
                for i, at in enumerate(level):
                    mine = where == i
                    if choice[i] is None:
                        moved[mine] = len(following)
                        following.append(at)
                        continue
                    j, cut = choice[i]
                    columns["feature"][at], columns["threshold"][at] = j, float(cuts[j][cut])
                    columns["left"][at], columns["right"][at] = node(), node()
                    moved[mine] = len(following) + (binned[j][mine] > cut)
                    following += [columns["left"][at], columns["right"][at]]
                where, level = moved, following
            leaf = rate * g / (h + ridge)
            for i, at in enumerate(level):
                columns["value"][at] = leaf[i]
            raw += leaf[where]
    return Forest(
        np.array(roots, np.int32), np.array(columns["feature"], np.int32),
        np.array(columns["threshold"], np.float32), np.array(columns["left"], np.int32),
        np.array(columns["right"], np.int32), np.array(columns["value"]), depth, bias,
    )


def held_out(id_col: Column) -> Column:
    """Rows that take no part in fitting: crc32 of the id's text modulo 4 is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))



def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int
) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``sample`` labelled rows that are not held out.

    The rows with the smallest hashes are taken: first of the labels, so that
    only their documents are read on, and again of the documents found.
    """
    y = F.max(F.col(label_col).cast("int")).alias("__y")
    order = F.xxhash64(F.col(id_col), F.lit(17))
    chosen = (
        labels.filter(F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
        .filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(y)
        .orderBy(order, id_col).limit(sample)
    )
    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), "__y"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                x = statistics(*flat(batch.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("__y"),
                     pa.array([row.tobytes() for row in x], pa.binary())],
                    ["id", "y", "x"],
                )

    rows = found.mapInArrow(run, f"id {kind}, y int, x binary")
    rows = rows.orderBy(F.xxhash64("id", F.lit(17)), "id", "x").limit(sample).collect()
    x = np.frombuffer(b"".join(r.x for r in rows), np.float32).reshape(-1, len(FEATURES))
    return x, np.array([r.y for r in rows], np.float64)


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", threshold: float = 0.7, sample: int = SAMPLE,
    keep: tuple[str, ...] = (), **options,
) -> DataFrame:
    """One row per document row: id, held_out, score (0 to 1), predicted (score >= threshold).

    Labels are learnt from rows whose crc32(id as text) modulo 4 is not 2, at
    most ``sample`` of them, chosen by a hash of the id; a label other than 0
    or 1 is ignored, an id labelled twice takes the larger label.  The only
    inputs of a score are statistics of the whole text.  NULL and empty texts
    have statistics of zero and are scored like any other; without usable
    labels every score is one half or the smoothed share.  Columns named in
    ``keep`` are passed on; an empty table gives an empty result.
    """
    forest = fit_forest(
        *training_rows(docs, labels, id_col, text_col, label_col, sample), **options
    )
    fields = {c: docs.schema[c].dataType.simpleString() for c in (id_col, *keep)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "__text"):
                score = forest.score(statistics(*flat(batch.column("__text"))))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in fields), pa.array(score),
                     pa.array((score >= threshold).astype(np.int32))],
                    [*fields, "score", "predicted"],
                )

    told = ", ".join(f"`{c}` {kind}" for c, kind in fields.items())
    return (
        docs.select(*fields, F.col(text_col).alias("__text"))
        .mapInArrow(run, f"{told}, score double, predicted int")
        .select(*fields, held_out(F.col(id_col)).alias("held_out"), "score", "predicted")
    )


def good_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", threshold: float = 0.7, sample: int = SAMPLE, **options,
) -> DataFrame:
    """The documents that score at least ``threshold``, with all their columns.

    Scores are those of ``quality_scores``; rows are filtered inside the scoring
    task, so that no text moves.
    """
    forest = fit_forest(
        *training_rows(docs, labels, id_col, text_col, label_col, sample), **options
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, text_col):
                score = forest.score(statistics(*flat(batch.column(text_col))))
                yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
