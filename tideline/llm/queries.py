"""One query per operator over the given tables, with SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.bpe import round_trip
from tideline.llm.chat import flat, format_preferences, mask, swapped_endings
from tideline.llm.collisions import near_vectors
from tideline.llm.covertree import hard_negatives
from tideline.llm.exact_dedup import exact_dedup
from tideline.llm.licences import scan_licences
from tideline.llm.merkle import lower_ascii, verified_manifest
from tideline.llm.near_dedup import near_dedup
from tideline.llm.packing import pack
from tideline.llm.quality import quality_scores
from tideline.llm.topk import divisible, top_k
from tideline.llm.urls import judge_urls
from tideline.llm.warc import assemble, page_records, read_archives, write_archives
from tideline.session import scratch_path, stable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL_TEXTS: dict[str, str] = {}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL_TEXTS[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_quality_classifier")
def _(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_license_scan")
def _(spark, sf_dir):
    return scan_licences(table(spark, sf_dir, "documents"))


@query(
    "op3_exact_topk",
    """WITH v AS (SELECT vec_id, list_transform(embedding,
        lambda x: floor(256 * x::DOUBLE)::DOUBLE) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
      AS INT) AS rank, vec_id, score FROM s
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5""",
)
def _(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, divisible(vectors, by=50), k=5)


@query(
    "op4_chat_preferences",
    """WITH e AS (SELECT conv_id, max(turn) AS at, arg_max(text, turn) AS said
      FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
    t AS (SELECT c.conv_id AS pair_id, c.turn, c.role, c.text,
        CASE WHEN c.turn = e.at THEN coalesce(o.said, '') ELSE c.text END AS other
      FROM conversations c LEFT JOIN e USING (conv_id) LEFT JOIN e o ON o.conv_id = c.conv_id + 1),
    f AS (SELECT *, min(CASE WHEN text <> other THEN turn END) OVER (PARTITION BY pair_id) AS f
      FROM t),
    r AS (SELECT pair_id, turn, f IS NULL OR turn < f AS common, '<|' || role || '|>' || chr(10)
        AS head, replace(text, '<|', '< |') || '<|end|>' || chr(10) AS c,
        replace(other, '<|', '< |') || '<|end|>' || chr(10) AS r,
        CASE WHEN role = 'assistant' THEN '1:' ELSE '0:' END AS mark FROM f)
    SELECT pair_id,
      coalesce(string_agg(head || c, '' ORDER BY turn) FILTER (common), '') AS prompt,
      count(*) FILTER (common) AS prompt_turns,
      coalesce(string_agg(head || c, '' ORDER BY turn) FILTER (NOT common), '') AS chosen,
      coalesce(string_agg(head || r, '' ORDER BY turn) FILTER (NOT common), '') AS rejected,
      coalesce(string_agg('0:' || length(head) || ',' || mark || length(c), ',' ORDER BY turn)
        FILTER (NOT common), '') AS chosen_mask,
      coalesce(string_agg('0:' || length(head) || ',' || mark || length(r), ',' ORDER BY turn)
        FILTER (NOT common), '') AS rejected_mask
    FROM r GROUP BY pair_id""",
)
def _(spark, sf_dir):
    chosen, rejected = swapped_endings(table(spark, sf_dir, "conversations"))
    told = format_preferences(chosen, rejected, pair_col="conv_id")
    return told.select(
        told["conv_id"].alias("pair_id"), "prompt", "prompt_turns",
        flat("chosen").alias("chosen"), flat("rejected").alias("rejected"),
        mask("chosen").alias("chosen_mask"), mask("rejected").alias("rejected_mask"),
    )


URL_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


@query("op5_url_filter")
def _(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op6_packing")
def _(spark, sf_dir):
    return pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


@query("op7_bpe_round_trip")
def _(spark, sf_dir):
    return round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


@query("op8_warc")
def _(spark, sf_dir):
    folder = write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    records = read_archives(spark, folder, keep_payload=False)
    # two passes follow, over what one reading of the archives gave
    return page_records(stable(assemble(records)))


@query(
    "op9_exact_dedup",
    f"""WITH d AS (SELECT doc_id, {LOWER} AS t FROM documents),
    g AS (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id,
      count(*) OVER (PARTITION BY t) AS group_size FROM d)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
    FROM g""",
)
def _(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


@query(
    "op10_near_dedup",
    f"""WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []
        ELSE list_distinct(list_transform(generate_series(1, greatest(len(w) - 3, 1)),
          lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
    u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x
      AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
      HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.doc_id)
    SELECT s.doc_id, len(s)::BIGINT AS n_shingles, c.c AS component_id, s.doc_id = c.c AS kept
    FROM s JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) c USING (doc_id)""",
)
def _(spark, sf_dir):
    return near_dedup(table(spark, sf_dir, "documents"), shingle=4)


@query(
    "op11_hard_negatives",
    """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END
        AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::DOUBLE) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
        list_inner_product(a.v, c.v)::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id
        ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id AS negative_id, positive_score,
      score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same
      AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
    QUALIFY rank <= 10""",
)
def _(spark, sf_dir):
    vec_id, label = F.col("vec_id"), F.col("label")
    return hard_negatives(
        table(spark, sf_dir, "embeddings"),
        label=F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label),
        is_anchor=vec_id % 100 == 0,
    )


def _leaf_sql(text: str) -> str:
    fields = (f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
              for c in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({' || '.join(fields)})"


def _levels_sql(name: str) -> str:
    """All levels of the trees over ``name`` (g, pos, n, digest), with the siblings of each node."""
    return f"""{name}_level AS (SELECT 0 AS lv, g, pos, n, digest FROM {name}
      UNION ALL SELECT lv + 1, g, pos // 8, any_value((n + 7) // 8),
        sha256(string_agg(digest, '' ORDER BY pos)) FROM {name}_level WHERE n > 1
        GROUP BY lv, g, pos // 8),
    {name}_near AS (SELECT lv, g, pos, n,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING
          AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING
          AND UNBOUNDED FOLLOWING), '') AS r
      FROM {name}_level WINDOW run AS (PARTITION BY lv, g, pos // 8 ORDER BY pos)),
    {name}_path AS (SELECT 0 AS lv, doc_id, g, pos, n, proof, fold FROM {name}_start
      UNION ALL SELECT p.lv + 1, doc_id, p.g, p.pos // 8, (p.n + 7) // 8, proof || l || r,
        sha256(l || fold || r) FROM {name}_path p JOIN {name}_near s
        ON p.lv = s.lv AND p.g = s.g AND p.pos = s.pos WHERE p.n > 1)"""


_LOWER_SQL = LOWER.replace("coalesce(text, '')", "text")
# unsigned CRC-32 of the id's digits, eight steps for each byte
_CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, x: CASE WHEN xor(c, x) & 1 = 1 THEN xor(xor(c, x) >> 1, 3988292384)
        ELSE xor(c, x) >> 1 END), 4294967295)"""


@query(
    "op12_merkle_manifest",
    f"""WITH RECURSIVE hashed AS (SELECT doc_id, coalesce('=' || lang, '') AS g,
      {_leaf_sql("text")} AS digest, CASE WHEN {_CRC_SQL} % 3 = 0 THEN {_leaf_sql(_LOWER_SQL)}
        ELSE {_leaf_sql("text")} END AS changed FROM documents),
    one AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos,
      count(*) OVER (PARTITION BY g) AS n FROM hashed),
    one_start AS (SELECT doc_id, g, pos, n, '' AS proof, changed AS fold FROM one),
    {_levels_sql("one")},
    two AS (SELECT '' AS g, g AS part, digest, row_number() OVER (ORDER BY g) - 1 AS pos,
      count(*) OVER () AS n FROM one_level WHERE n = 1),
    two_start AS (SELECT doc_id, two.g, two.pos, two.n, proof, fold
      FROM one_path p JOIN two ON p.g = two.part WHERE p.n = 1),
    {_levels_sql("two")},
    root AS (SELECT digest AS root FROM two_level WHERE n = 1)
    SELECT doc_id, one.digest AS leaf, two.digest AS subroot, root, sha256(proof) AS proof_sha256,
      fold AS folded_root, fold = root AS verified
    FROM two_path p JOIN one USING (doc_id) JOIN two ON one.g = two.part CROSS JOIN root
    WHERE p.n = 1""",
)
def _(spark, sf_dir):
    return verified_manifest(
        table(spark, sf_dir, "documents"),
        tampered=F.crc32(F.col("doc_id").cast("string")) % 3 == 0,
        changed_text=lower_ascii(F.col("text")),
    )


@query(
    "op13_embedding_near_dedup",
    """WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
      AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
    r AS (SELECT vec_id, vec_id AS c FROM embeddings
      UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.vec_id),
    n AS (SELECT a AS vec_id, count(*) AS n FROM p GROUP BY a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, min(c) AS component_id,
      vec_id = min(c) AS kept
    FROM r LEFT JOIN n USING (vec_id) GROUP BY vec_id, n""",
)
def _(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)
