"""The registered queries of the training-data operators, and their SQL where it can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.llm import (
    boilerplate,
    byte_bpe,
    chat,
    collocations,
    compression,
    fingerprints,
    hard_negatives,
    mixing,
    ngram_join,
    packing,
    quality_rules,
    token_files,
    warc,
)
from docketspark.llm.common import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "sequence_tokens", "sequence_cost",
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    trees = quality_rules.learn(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, trees)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    freed = boilerplate.drop_boilerplate(docs, F.col("source"))
    return freed.select("doc_id", "source", "text", "n_lines", "n_dropped")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    examples = stored(chat.prefix_examples(turns.unionByName(extra)), "chat-examples")
    return chat.read_back(examples)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write_tokens(_table(spark, sf_dir, "documents"))
    found = token_files.read_tokens(spark, folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = compression.learn(docs, _table(spark, sf_dir, "labels"))
    return compression.score(docs, model)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = byte_bpe.decode(byte_bpe.encode(_table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_archive(_table(spark, sf_dir, "pages"))
    parsed = warc.with_references(warc.parse_records(warc.restore(spark, folder)))
    return parsed.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "sound"
    )


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"))
    weight = F.when(F.col("q") == 1, 4.0).when(F.col("q") == 0, 0.25).otherwise(1.0)
    weights = labels.select("doc_id", weight.alias("weight"))
    keyed = mixing.keyed_documents(_table(spark, sf_dir, "documents"), weights)
    planned = mixing.plan_mix(stored(keyed, "mix-keys"))
    return planned.select(
        "doc_id", "size", "source_size", "target", "taken", "source", "epochs", "part_words"
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    shifted = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0, label=shifted)


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing, op2_fingerprints, op3_quality_rules, op4_ngram_join, op5_line_dedup,
        op6_chat_formatting, op7_token_files, op8_compression_classifier, op9_byte_bpe, op10_warc,
        op11_mixing, op12_collocations, op13_hard_negatives,
    )
}

ORACLES = {
    "op5_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS l FROM documents
), bare AS (
  SELECT doc_id, source, unnest(list_distinct(list_filter(
    list_transform(l, lambda x: trim(x, ' ')), lambda x: x <> ''))) AS line
  FROM lines
), totals AS (
  SELECT source, count(*) AS total FROM documents WHERE source IS NOT NULL GROUP BY source
), gone AS (
  SELECT source, list(line) AS lines FROM (
    SELECT source, line, count(*) AS n FROM bare WHERE source IS NOT NULL GROUP BY source, line
  ) JOIN totals USING (source)
  WHERE n - {boilerplate.CHANCE_PAGES} > {boilerplate.MAX_SHARE}::DOUBLE * total GROUP BY source
), passages AS (
  SELECT line, min(doc_id) AS keeper FROM bare
  WHERE length(line) > 2 * {boilerplate.LONG_WORDS}
    AND len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) > {boilerplate.LONG_WORDS}
  GROUP BY line HAVING count(*) >= {boilerplate.PASSAGE_DOCS}
), lost AS (
  SELECT doc_id, list(line) AS lines FROM bare JOIN passages USING (line)
  WHERE doc_id IS DISTINCT FROM keeper GROUP BY doc_id
), kept AS (
  SELECT lines.doc_id, lines.source, text, l, list_filter(l, lambda x: trim(x, ' ') = ''
    OR NOT (coalesce(list_contains(gone.lines, trim(x, ' ')), false)
      OR coalesce(list_contains(lost.lines, trim(x, ' ')), false))) AS k
  FROM lines LEFT JOIN gone ON lines.source = gone.source LEFT JOIN lost ON lines.doc_id = lost.doc_id
)
SELECT doc_id, source, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(k, chr(10)) END AS text,
  coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(l) - len(k), 0)::BIGINT AS n_dropped
FROM kept""",
    "op10_warc": """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex,
    min(page_id) OVER (PARTITION BY payload) AS first_id FROM p
)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to, true AS sound
FROM d""",
    "op11_mixing": f"""
WITH q AS (
  SELECT doc_id, CASE max(quality) WHEN 1 THEN 4.0 WHEN 0 THEN 0.25 ELSE 1.0 END::DOUBLE AS weight
  FROM labels GROUP BY doc_id
), d AS (
  SELECT d.doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    -ln((('0x' || substr(md5('{mixing.SEED}:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
      / 4503599627370496.0::DOUBLE) / coalesce(weight, 1.0) AS key
  FROM documents d LEFT JOIN q ON d.doc_id = q.doc_id
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::HUGEINT AS cap,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source
), filled AS (  -- sources that stop at their cap are the first ones by cap a weight
  SELECT *, sum(cap) OVER () // 3 - coalesce(sum(cap) OVER before, 0) AS remaining,
    sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS free
  FROM s WINDOW before AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT max(remaining) AS remaining, max(free) AS free FROM filled
  WHERE cap * free >= w * remaining
), t AS (
  SELECT source, source_size, CASE WHEN free IS NULL OR cap * free < w * remaining THEN cap::DOUBLE
    ELSE w * remaining::DOUBLE / free END AS target
  FROM s LEFT JOIN level ON true
), b AS (
  SELECT *, least(round(target)::BIGINT, 3 * source_size) AS budget,
    CASE WHEN source_size > 0 THEN least(round(target)::BIGINT, 3 * source_size) // source_size ELSE 0 END AS epochs
  FROM t
), r AS (
  SELECT d.*, source_size, target, epochs, budget - epochs * source_size AS rest,
    sum(size) OVER (PARTITION BY d.source, key) AS own,
    sum(size) OVER (PARTITION BY d.source ORDER BY key) AS running
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
), p AS (
  SELECT *, CASE WHEN running <= rest THEN size WHEN running - own < rest THEN size * (rest - running + own) // own
    ELSE 0 END::BIGINT AS part_words FROM r
)
SELECT doc_id, size, source_size, target, (epochs * size + part_words)::BIGINT AS taken, source,
  epochs::BIGINT AS epochs, part_words
FROM p""",
    "op12_collocations": f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
  FROM documents
), g AS (
  SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i:i])) AS ph FROM p
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i:i+1])) FROM p
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i+2])) FROM p
), f AS (  -- phrases as text: words have no blanks
  SELECT lang, array_to_string(ph, ' ') AS ph, len(ph) AS words, count(*) AS f FROM g GROUP BY ALL
), c AS (
  SELECT lang, ph, f AS a, string_split(ph, ' ') AS w FROM f WHERE f >= {collocations.MIN_COUNT} AND words > 1
), cut AS (
  SELECT lang, ph, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k+1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, len(w))) AS k FROM c)
), s AS (
  SELECT cut.lang, cut.ph, a, k, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.ph = head JOIN f r ON r.lang = cut.lang AND r.ph = tail
  QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.ph ORDER BY score, k) = 1
), longer AS (
  SELECT lang, part, max(a) AS most FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS part, a FROM c WHERE len(w) = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE len(w) = 3
  ) GROUP BY lang, part
), n AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, ph) AS rank,
  ph AS phrase, a, l, r, n, score::BIGINT AS score
FROM s JOIN n ON n.lang = s.lang LEFT JOIN longer ON longer.lang = s.lang AND longer.part = s.ph
WHERE most IS NULL OR 100 * most < 50 * a
QUALIFY rank <= 2000""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
}
