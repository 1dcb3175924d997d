"""The registered queries of the operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import stored
from headway.llm.alignment import align
from headway.llm.best_fit import pack_whole
from headway.llm.chat_tree import conversations_of, tree
from headway.llm.exact_copies import exact_copies
from headway.llm.html_region import extract
from headway.llm.language import fit, predicted
from headway.llm.line_rules import CLOSING, LOWER, MAX_LOST_PERCENT, OPEN_WORDS, PHRASES, SYMBOLS, UPPER, clean_lines
from headway.llm.mixing import OFFSET, SHIFTS, mix
from headway.llm.near_copies import near_copies
from headway.llm.packing import pack
from headway.llm.phrases import collocations
from headway.llm.resampling import resample
from headway.llm.token_blocks import read_documents, token_segments


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    segments = stored(token_segments(table(spark, folder, "documents"), word_vocabulary(), end_id=2), "tokens")
    return read_documents(segments).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_bbit_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_copies(table(spark, folder, "documents").select("doc_id", "text"), width=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_cutting_stock(spark: SparkSession, folder: str) -> DataFrame:
    made = pack(table(spark, folder, "documents"), word_vocabulary(), end_id=1)
    return made.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = clean_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.drop("text", "clean_text")


def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2


def op5_subword_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    model = fit(docs.where(~F.col("held_out")))
    found = docs.select("doc_id", "held_out", predicted(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.rejected")


def op6_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    good = table(spark, folder, "labels").where("quality = 1 AND toxic = 0").select("doc_id").distinct()
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return resample(docs, good, fraction=0.8).drop("text")


def op7_systematic_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_quotient_filter(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_copies(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_prefix_tree(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    nodes, members = tree(turns.unionByName(extra), byte_vocabulary())
    return conversations_of(nodes, members, byte_vocabulary())


def op10_scored_region(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_hat_trie_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


def op12_certified_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    made = pack_whole(table(spark, folder, "documents"), byte_vocabulary(), end_id=2)
    return made.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op13_galloping_alignment(spark: SparkSession, folder: str) -> DataFrame:
    def digest(groups):
        return F.when(groups == "", "").otherwise(F.sha2(groups, 256))

    found = align(table(spark, folder, "documents"), byte_vocabulary(), piece_vocabulary(), shown=digest)
    return found.withColumnRenamed("groups", "groups_sha256")


MIX_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, size, substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 3) AS shard,
         CASE WHEN size < 16 THEN size ELSE length(bin(size)) * 16 + (size >> (length(bin(size)) - 4)) END AS class
  FROM (SELECT doc_id, source,
               coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents)),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [1.0, 2.0, 3.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () - 3.0::DOUBLE * coalesce(sum(source_size) OVER up, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER up, 0)) AS level
  FROM sources
  WINDOW up AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         CASE WHEN source_size * 3.0::DOUBLE <= level * weight THEN source_size * 3.0::DOUBLE
              ELSE weight * max(CASE WHEN source_size * 3.0::DOUBLE > level * weight THEN level END) OVER () END AS target
  FROM levels),
ranked AS (
  SELECT doc_id, size, source,
         row_number() OVER (PARTITION BY source ORDER BY class, shard, size, doc_id NULLS FIRST) AS k
  FROM sized),
rated AS (
  SELECT doc_id, size, t.*, k, coalesce(target / nullif(source_size, 0), 0) AS rate
  FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
starts AS (SELECT unnest([{", ".join(f"{(OFFSET + k / SHIFTS) % 1.0!r}::DOUBLE" for k in range(SHIFTS))}]) AS u, unnest(range({SHIFTS})) AS j),
sums AS (
  SELECT source, target, j, u, sum(size * (floor(u + rate * k) - floor(u + rate * (k - 1)))::BIGINT)::BIGINT AS t
  FROM rated, starts GROUP BY source, target, j, u),
best AS (SELECT source, u, row_number() OVER (PARTITION BY source ORDER BY abs(t - target), j) AS place FROM sums)
SELECT doc_id, size, source_size, target, size * (floor(u + rate * k) - floor(u + rate * (k - 1)))::BIGINT AS taken
FROM rated r JOIN best b ON r.source IS NOT DISTINCT FROM b.source WHERE place = 1
"""

COPIES_SQL = r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS whole FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(whole) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY whole)
"""

NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN [[w[1]]]
         ELSE list_transform(range(1, greatest(len(w), 1)::BIGINT), lambda i: [w[i], w[i + 1]]) END) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS met
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * met >= 80 * (p.n + q.n - met)),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r.y) AS component_id, min(r.y) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id JOIN reached r ON r.x = d.doc_id GROUP BY d.doc_id
"""

_CLOSING = CLOSING.replace("'", "''")
LINES_SQL = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
read AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols FROM docs),
lines AS (
  SELECT doc_id, l, row_number() OVER (PARTITION BY doc_id, l ORDER BY k) > 1 AS again,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
         length(l) - length(translate(l, '|', '')) AS bars,
         length(l) - length(translate(l, '{SYMBOLS}', '')) AS symbols,
         length(l) - length(translate(l, '{UPPER}', '')) AS upper_,
         length(l) - length(translate(l, '{LOWER}', '')) AS lower_
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS k FROM docs)),
judged AS (
  SELECT doc_id, sum(CASE WHEN again THEN 1 ELSE 0 END)::BIGINT AS n_dup_lines,
         sum(CASE WHEN again OR (bars >= 3 AND 5 * bars >= n) OR 2 * symbols > n OR upper_ > lower_
                       OR (n < {OPEN_WORDS} AND NOT regexp_matches(rtrim(l, ' '), '{_CLOSING}')) OR regexp_matches(lower(l), '{PHRASES}')
                  THEN n ELSE 0 END)::BIGINT AS lost_words
  FROM lines WHERE n > 0 GROUP BY doc_id),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1)::BIGINT)) AS i FROM read)),
repeats AS (
  SELECT doc_id, count(DISTINCT i + j)::BIGINT AS n_repeat_words
  FROM windows, (SELECT unnest([0, 1, 2]) AS j) WHERE c > 1 GROUP BY doc_id),
joined AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         n_symbols::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost_words, 0) AS lost_words
  FROM read LEFT JOIN judged USING (doc_id) LEFT JOIN repeats USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_words <= {MAX_LOST_PERCENT} * n_words AS kept
FROM joined
"""

PHRASES_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
counted AS (
  SELECT lang, m, phrase, count(*) AS f
  FROM (SELECT lang, m, unnest(list_transform(range(1, greatest(len(w) - m + 2, 1)::BIGINT),
                                              lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
        FROM pieces, (SELECT unnest(range(1, 6)) AS m))
  GROUP BY lang, m, phrase),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang),
often AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f FROM counted WHERE f >= 100),
inner_ AS (
  SELECT lang, f, array_to_string(w[i:i + s - 1], ' ') AS phrase
  FROM often, (SELECT unnest(range(2, 5)) AS s), (SELECT unnest(range(1, 5)) AS i) WHERE s < m AND i + s - 1 <= m),
covered AS (SELECT DISTINCT lang, phrase FROM often o JOIN inner_ l USING (lang, phrase) WHERE 100 * l.f >= 100 * o.f),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS first_, array_to_string(w[k + 1:], ' ') AS rest
  FROM often ANTI JOIN covered USING (lang, phrase), (SELECT unnest(range(1, 5)) AS k) WHERE m >= 2 AND k < m),
scored AS (
  SELECT c.*, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.first_
  JOIN counted y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM lowest WHERE place = 1)
SELECT * FROM ranked WHERE rank <= 2000
"""

QUERIES = {
    "op1_token_blocks": op1_token_blocks,
    "op2_bbit_minhash": op2_bbit_minhash,
    "op3_cutting_stock": op3_cutting_stock,
    "op4_line_rules": op4_line_rules,
    "op5_subword_language": op5_subword_language,
    "op6_importance_resampling": op6_importance_resampling,
    "op7_systematic_mix": op7_systematic_mix,
    "op8_quotient_filter": op8_quotient_filter,
    "op9_prefix_tree": op9_prefix_tree,
    "op10_scored_region": op10_scored_region,
    "op11_hat_trie_phrases": op11_hat_trie_phrases,
    "op12_certified_best_fit": op12_certified_best_fit,
    "op13_galloping_alignment": op13_galloping_alignment,
}
ORACLE = {"op2_bbit_minhash": NEAR_SQL, "op4_line_rules": LINES_SQL, "op7_systematic_mix": MIX_SQL, "op8_quotient_filter": COPIES_SQL, "op11_hat_trie_phrases": PHRASES_SQL}
