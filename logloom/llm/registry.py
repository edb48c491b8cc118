"""The queries of the training-data operators, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, digest, licenses, near_dup, packing, phrases, pii, repair, substring, suffix, toxicity, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op2_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")


def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


OP4_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT payload_digest, max(page_id) AS newest FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN g.newest IS NULL OR g.newest = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.newest <> p.page_id THEN g.newest END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND p.payload_bytes >= 1000
"""


def op10_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_with_probe(table(spark, sf_dir, "conversations"))


OP10_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), r AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM rows
), e AS (
  SELECT *, length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS>|\|)', '\1\\\2\3', 'g'))
          + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS>|\|)', '\1\\\2\3', 'g'))
          + length('<|im_start|><|im_sep|><|im_end|>') AS chars
  FROM r
), g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY n) AS turns,
         coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '') AS loss, sum(chars)::BIGINT AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.scan_licenses(docs.withColumn("path", F.concat_ws("/", "lang", "source", F.col("doc_id").cast("string"))))


def op6_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op7_improbable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.fingerprint_documents(table(spark, sf_dir, "documents"))


def op8_maximal_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_multi_index_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op11_recursive_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_report(table(spark, sf_dir, "conversations"))


#: The checksum's table is made by its rule; the way through a conversation by recursion over its rows.
OP11_SQL = r"""
WITH RECURSIVE bits(n, c, k) AS (
  SELECT n, n::BIGINT, 0 FROM range(256) t(n)
  UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
keys AS (SELECT DISTINCT conv_id, turn, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
crc(key, i, c) AS (
  SELECT DISTINCT key, 0, 4294967295 FROM keys
  UNION ALL SELECT key, i + 1, xor((SELECT t FROM crc_table)[1 + (xor(c, ord(key[i + 1])) & 255)], c >> 8) FROM crc WHERE i < length(key)
), fault AS (SELECT key, xor(c, 4294967295) % 20 AS k FROM crc WHERE i = length(key)),
spoiled AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role, k,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
  FROM (SELECT c.*, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations c) JOIN fault USING (key)
), convs AS (SELECT conv_id, row_number() OVER () AS id FROM (SELECT DISTINCT conv_id FROM conversations)),
doubled AS (SELECT c.id, s.* FROM spoiled s JOIN convs c ON c.conv_id IS NOT DISTINCT FROM s.conv_id, range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
r AS (
  SELECT id, turn, role, text, role[1] AS initial, row_number() OVER w AS pos, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY id, role, text ORDER BY turn NULLS FIRST) > 1 AS again, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut
  FROM doubled WINDOW w AS (PARTITION BY id ORDER BY turn NULLS FIRST, role, text)
), t AS (
  SELECT *, CASE WHEN blank THEN 'blank' WHEN again THEN 'duplicate' WHEN cut THEN 'truncated' ELSE '' END AS kind,
         lag(initial) OVER (PARTITION BY id ORDER BY pos) || initial NOT IN ('su', 'ua', 'au') AS bad
  FROM r
), step(src, dst, initial) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (2, 3, 'a'), (3, 2, 'u')),
added AS (
  SELECT DISTINCT src AS a, src AS b, '' AS ins FROM step
  UNION ALL SELECT src, dst, 'I' FROM step WHERE initial <> 's'
  UNION ALL SELECT x.src, y.dst, 'II' FROM step x JOIN step y ON x.dst = y.src WHERE x.initial <> 's' AND y.dst <> x.src
), move AS (
  SELECT a AS src, b AS dst, ins || 'D' AS edits, 5 * length(ins) + 2 AS price, 'D' AS kind, '' AS initial FROM added
  UNION ALL SELECT a, s.dst, ins || 'R', 5 * length(ins) + 1, 'R', '' FROM added JOIN step s ON s.src = b AND s.initial <> 's'
  UNION ALL SELECT a, s.dst, ins || 'K', 5 * length(ins), 'K', s.initial FROM added JOIN step s ON s.src = b
), best(id, pos, state, way) AS (
  SELECT id, 0, 0, '000000000' FROM convs
  UNION ALL
  SELECT id, p, dst, min(way) FROM (
    SELECT b.id, b.pos + 1 AS p, m.dst, lpad((substr(b.way, 1, 9)::BIGINT + m.price + CASE WHEN t.kind = 'truncated' AND m.kind <> 'D' THEN 5 ELSE 0 END)::VARCHAR, 9, '0') || substr(b.way, 10) || m.edits AS way
    FROM best b JOIN t ON t.id = b.id AND t.pos = b.pos + 1 JOIN move m ON m.src = b.state AND (m.kind = 'D' OR t.kind NOT IN ('blank', 'duplicate') AND (m.kind = 'R' OR m.initial = t.initial))
  ) GROUP BY id, p, dst
), size AS (SELECT id, coalesce(max(pos), 0) AS n FROM convs LEFT JOIN t USING (id) GROUP BY id),
ended AS (
  SELECT id, min(lpad((substr(way, 1, 9)::BIGINT + CASE state WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END)::VARCHAR, 9, '0') || substr(way, 10) || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END) AS way
  FROM best JOIN size USING (id) WHERE pos = n GROUP BY id
), edit AS (
  SELECT id, i, substr(way, 10)[i] AS e, length(replace(substr(way, 10, i), 'I', '')) AS pos, length(replace(substr(way, 10, i), 'D', '')) AS nth FROM ended, unnest(range(1, length(way) - 8)) u(i)
), head AS (SELECT edit.id, t.initial = 's' AND e = 'K' AS led FROM edit JOIN t USING (id, pos) WHERE nth = 1 AND e <> 'D'),
line AS (
  SELECT edit.id, i, CASE WHEN e = 'K' THEN t.role WHEN (nth - CASE WHEN coalesce(led, FALSE) THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE t.text END AS said
  FROM edit LEFT JOIN t ON t.id = edit.id AND t.pos = edit.pos LEFT JOIN head ON head.id = edit.id WHERE e <> 'D'
), told AS (SELECT id, string_agg(said, chr(10) ORDER BY i) AS said FROM line GROUP BY id),
counted AS (
  SELECT id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (WHERE kind = 'blank') AS blank, count(*) FILTER (WHERE kind = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE kind = 'truncated') AS truncated, count(*) FILTER (WHERE bad) AS illegal
  FROM t GROUP BY id
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       substr(way, 1, 9)::BIGINT AS cost, substr(way, 10) AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM convs JOIN ended USING (id) LEFT JOIN counted USING (id) LEFT JOIN told USING (id)
"""


def op12_anchor_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_report(table(spark, sf_dir, "documents"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.find_phrases(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH piece AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(part, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS part FROM documents)
), gram AS (
  SELECT lang, list_slice(w, i, i + k - 1) AS g, count(*) AS f FROM piece, range(1, 6) s(k), unnest(range(1, len(w) - k + 2)) u(i) GROUP BY ALL
), total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM piece GROUP BY lang),
often AS (SELECT * FROM gram WHERE f >= 100),
held AS (
  SELECT lang, g, max(f) AS most FROM (
    SELECT lang, list_slice(g, 1, len(g) - 1) AS g, f FROM often WHERE len(g) > 2 UNION ALL SELECT lang, list_slice(g, 2, len(g)), f FROM often WHERE len(g) > 2
  ) GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.g, c.f AS a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM often c, unnest(range(1, len(g))) u(k) JOIN often x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, k) JOIN often y ON y.lang = c.lang AND y.g = list_slice(c.g, k + 1, len(c.g)) JOIN total ON total.lang = c.lang
), best AS (SELECT lang, g, a, n, min((score, k, l, r)) AS m FROM cuts GROUP BY ALL),
named AS (
  SELECT best.lang, array_to_string(best.g, ' ') AS phrase, a, m[3] AS l, m[4] AS r, n, m[1] AS score
  FROM best LEFT JOIN held ON held.lang = best.lang AND held.g = best.g WHERE most IS NULL OR most < a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named) WHERE rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_paragraph_minhash": op1_paragraph_minhash,
        "op2_pigeonhole_decontamination": op2_pigeonhole_decontamination,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_warc_round_trip": op4_warc_round_trip,
        "op5_license_scan": op5_license_scan,
        "op6_prefix_free_parsing": op6_prefix_free_parsing,
        "op7_improbable_features": op7_improbable_features,
        "op8_maximal_segments": op8_maximal_segments,
        "op9_multi_index_hamming": op9_multi_index_hamming,
        "op10_reply_trees": op10_reply_trees,
        "op11_recursive_repair": op11_recursive_repair,
        "op12_anchor_expansion": op12_anchor_expansion,
        "op13_phrase_mining": op13_phrase_mining,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc_round_trip": OP4_SQL,
        "op10_reply_trees": OP10_SQL,
        "op11_recursive_repair": OP11_SQL,
        "op13_phrase_mining": OP13_SQL,
    }
