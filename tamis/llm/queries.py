"""The queries of the pipeline operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm import (
    conversation_repair,
    decontamination,
    hard_negatives,
    html_extraction,
    language_id,
    minhash_dedup,
    mixing,
    nearest,
    pii,
    substring_dedup,
    suffix_dedup,
    topk,
    toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark, sf_dir):
    found = pii.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [pii.count_of(F.col("_spans"), k).alias(f"n_{k}") for k in pii.KINDS]
    base = F.sha2(F.encode(pii.joined_spans(F.col("_spans"), tuple(pii.KINDS)), "UTF-8"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, pii.joined_spans(F.col("_spans")).alias("spans"))


def op2_mixing(spark, sf_dir):
    documents, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken")


def op3_suffix_dedup(spark, sf_dir):
    found = suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~language_id.held_out()))
    found = language_id.identify(docs, model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op5_decontamination(spark, sf_dir):
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_substring_dedup(spark, sf_dir):
    found = substring_dedup.remove_repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    # the ids are drawn first, a bounded number of them, so no text moves
    labels = toxicity.drawn(table(spark, sf_dir, "labels").where(~toxicity.held_out()))
    learnt = docs.where(~toxicity.held_out()).select("doc_id", "text").join(F.broadcast(labels), "doc_id")
    found = toxicity.score(docs, toxicity.train(learnt))
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op8_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=20)


def op9_html_extraction(spark, sf_dir):
    return html_extraction.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op10_minhash_dedup(spark, sf_dir):
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def damaged(rows):
    """Conversations with known faults: a checksum of conversation and turn says what happens to a row."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fate, text = F.crc32(key) % 20, F.coalesce("text", space)
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(F.col("fate") == 4, "user").otherwise(F.coalesce("role", space))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return rows.withColumn("fate", fate).where("fate != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy"))


def op11_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repair = conversation_repair.repair(damaged(rows))
    hashes = conversation_repair.digests(repair.parts).withColumnRenamed("conv_id", "hashed")
    every = rows.select(F.col("conv_id").alias("asked")).distinct()
    found = every.join(repair.verdicts, F.col("asked").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    found = found.join(hashes, F.col("asked").eqNullSafe(F.col("hashed")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    return found.select(F.col("asked").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)


def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), every=100, label=label)


def op13_nearest(spark, sf_dir):
    return nearest.nearest(table(spark, sf_dir, "embeddings"), every=100)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_mixing": op2_mixing,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_language_id": op4_language_id,
    "op5_decontamination": op5_decontamination,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_top_k": op8_top_k,
    "op9_html_extraction": op9_html_extraction,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_nearest": op13_nearest,
}

_OP8 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id != c.vec_id
    WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_OP12 = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id != c.vec_id
    WHERE q.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), fitting AS (
    SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
      CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM fitting WHERE rank <= 5
"""

_WORDS = """list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"""

# Runs of positions that windows starting at `i` cover: a new one begins where a gap is left.
_RUNS = """
marked AS (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {width} THEN 0 ELSE 1 END AS fresh FROM bad
), numbered AS (
    SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked
), runs AS (
    SELECT doc_id, min(i) AS a, max(i) + {width} - 1 AS b FROM numbered GROUP BY doc_id, run
), pieces AS (
    SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS lo, a - 1 AS hi FROM runs
    UNION ALL SELECT d.doc_id, coalesce(max(b), 0) + 1, max(d.n) FROM d LEFT JOIN runs USING (doc_id) GROUP BY d.doc_id
), totals AS (
    SELECT doc_id, sum(b - a + 1) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id
)"""

_OP3 = f"""
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, len(hex(encode(coalesce(text, '')))) // 2 AS n FROM documents
), windows AS (
    SELECT doc_id, i, md5(substr(x, 2 * i - 1, 200)) AS h FROM (SELECT doc_id, x, unnest(generate_series(1, n - 99)) AS i FROM d) w
), bad AS (
    SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM windows) o WHERE k > 1
), {_RUNS.format(width=100)}, kept AS (
    SELECT doc_id, string_agg(substr(x, 2 * lo - 1, greatest(0, 2 * (hi - lo + 1))), '' ORDER BY lo) AS x
    FROM pieces JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(kept.x)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN totals USING (doc_id)
"""

_OP6 = f"""
WITH d AS (
    SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents) s
), windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(generate_series(1, n - 49)) AS i FROM d) s
), firsts AS (
    SELECT h, min(doc_id) AS first_doc FROM windows GROUP BY h
), bad AS (
    SELECT doc_id, i FROM windows JOIN firsts USING (h) WHERE first_doc < doc_id
), {_RUNS.format(width=50)}, kept AS (
    SELECT doc_id, string_agg(array_to_string(w[lo : hi], ' '), ' ' ORDER BY lo) FILTER (WHERE hi >= lo) AS x
    FROM pieces JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.x, '')) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN totals USING (doc_id)
"""



def _hashed(value: str, key: str) -> str:
    """The arithmetic of `mixing.hashed`."""
    p, (a, b) = mixing.PRIME, mixing.FACTORS
    first = f"(((({value}) & {p}) * {a} + (({value}) >> 31) * {b} + ({key})) % {p})"
    return f"(({first} * {first} + ({key})) % {p})"


def _swapped() -> str:
    """One round of `mixing.block_of`: `x` the place, `r` the round, `seed` and `blocks` of the slot."""
    key = f"((seed + r * 7919) % {mixing.PRIME})"
    mirrored = f"(({_hashed(key, '1')} * {mixing.PRIME} + {_hashed(key, '2')}) % blocks + blocks - x) % blocks"
    return f"CASE WHEN {_hashed(f'greatest(x, {mirrored})', key)} % 2 = 1 THEN {mirrored} ELSE x END"


# The slots of a source are numbered through whatever shards they fall into, so shards don't matter here.
_OP2 = f"""
WITH sized AS (
    SELECT doc_id, source, size, {_hashed(f"coalesce(doc_id, size) & {(1 << 62) - 1}", "3")} % {mixing.CHUNKS} AS chunk
    FROM (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}')) AS BIGINT) AS size FROM documents) d
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS ordinal FROM sized GROUP BY source
), weighed AS (
    SELECT *, [3, 1, 2][ordinal % 3 + 1] AS weight, 2 * source_size / [3, 1, 2][ordinal % 3 + 1] AS filled FROM sources
), levelled AS (
    SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER up, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER up, 0)) AS level
    FROM weighed WINDOW up AS (ORDER BY filled, ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT *, least(CAST(2 * source_size AS DOUBLE), (SELECT level FROM levelled WHERE level <= filled ORDER BY filled, ordinal LIMIT 1) * weight) AS target
    FROM levelled
), rounded AS (
    SELECT *, CAST(ceil(source_size / {mixing.BLOCK}) AS BIGINT) AS blocks, CAST(floor(target / greatest(source_size, 1)) AS BIGINT) AS rounds FROM targets
), planned AS (
    SELECT *, least(rounds * blocks + CAST(floor((target - rounds * source_size) / {mixing.BLOCK} + 0.5) AS BIGINT), 2 * blocks) AS slots FROM rounded
), slots AS (
    SELECT ordinal, blocks, unnest(range(slots)) AS slot FROM planned
), times AS (
    SELECT ordinal, block, count(*) AS times FROM (
      SELECT ordinal, list_reduce(list_prepend(CAST(slot % blocks AS BIGINT), CAST(range(1, {mixing.ROUNDS + 1}) AS BIGINT[])), lambda x, r: {_swapped()}) AS block
      FROM (SELECT *, CAST((ordinal * 1000003 + (slot // blocks) * 8191) % {mixing.PRIME} AS BIGINT) AS seed FROM slots) seeded) s GROUP BY ALL
), placed AS (
    SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY chunk, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start, row_number() OVER () AS k
    FROM sized
), parts AS (
    SELECT k, ordinal, start, size, unnest(range(start // {mixing.BLOCK}, (start + size - 1) // {mixing.BLOCK} + 1)) AS block
    FROM placed JOIN sources ON placed.source IS NOT DISTINCT FROM sources.source WHERE size > 0
), taken AS (
    SELECT k, sum((least(start + size, (block + 1) * {mixing.BLOCK}) - greatest(start, block * {mixing.BLOCK})) * times) AS taken
    FROM parts JOIN times USING (ordinal, block) GROUP BY k
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM placed JOIN planned ON placed.source IS NOT DISTINCT FROM planned.source LEFT JOIN taken USING (k)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP10 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + 4], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(generate_series(1, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(1, len(w) - 4) END)) AS i FROM d) x
), n AS (
    SELECT d.doc_id, count(h) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2
), one_way AS (
    SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)
), links AS (
    SELECT x, y FROM one_way UNION ALL SELECT y, x FROM one_way
), reach(a, b) AS (
    SELECT doc_id, doc_id FROM d UNION SELECT a, y FROM reach JOIN links ON b = x
)
SELECT doc_id, n AS n_shingles, min(b) AS component_id, doc_id = min(b) AS kept FROM reach JOIN n ON doc_id = a GROUP BY doc_id, n
"""

ORACLE_SQL: dict[str, str] = {
    "op2_mixing": _OP2,
    "op3_suffix_dedup": _OP3,
    "op6_substring_dedup": _OP6,
    "op8_top_k": _OP8,
    "op10_minhash_dedup": _OP10,
    "op12_hard_negatives": _OP12,
}
