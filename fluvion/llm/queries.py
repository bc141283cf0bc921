"""Driver queries of the corpus operators: each applies one operator, with production parameters, to whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvion.llm.alignment import token_alignments
from fluvion.llm.conversations import damage, repair_conversations, repair_digests
from fluvion.llm.decontamination import decontaminate, proximity_matches
from fluvion.llm.html_extract import extract_pages
from fluvion.llm.language import language_ids
from fluvion.llm.near_dedup import near_duplicates
from fluvion.llm.packing import packed_documents
from fluvion.llm.pii import pii_scan
from fluvion.llm.quality import robust_quality
from fluvion.llm.sampled_pieces import sample_pieces
from fluvion.llm.secrets import secret_scan
from fluvion.llm.sharding import balanced_shards
from fluvion.llm.tokenfiles import token_files
from fluvion.session import table


def op1_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_quality(table(spark, sf_dir, "documents"))


def op2_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(table(spark, sf_dir, "documents"), shards=8)


def op3_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op4_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_ids(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proximity matches alone, with their ids as an array."""
    return proximity_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_minimum_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op8_secret_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op9_gumbel_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


def op10_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_scan(table(spark, sf_dir, "documents"))


def op11_interval_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignments(table(spark, sf_dir, "documents"), *paths, with_groups=False)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digests(repair_conversations(damage(table(spark, sf_dir, "conversations")), present=F.col("present")))


def op13_dominance_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2, with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {
    "op1_quality_mcd": op1_quality_mcd,
    "op2_balanced_shards": op2_balanced_shards,
    "op3_bit_planes": op3_bit_planes,
    "op4_superminhash": op4_superminhash,
    "op5_language_filter": op5_language_filter,
    "op6_decontamination": op6_decontamination,
    "op6_proximity": op6_proximity,
    "op7_minimum_cut": op7_minimum_cut,
    "op8_secret_formats": op8_secret_formats,
    "op9_gumbel_pieces": op9_gumbel_pieces,
    "op10_skip_chain": op10_skip_chain,
    "op11_interval_alignment": op11_interval_alignment,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_dominance_packing": op13_dominance_packing,
}

#: CRC-32 by its table of 256 remainders, which a recursive query builds.
CRC32 = """bits(b, r, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT b, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (SELECT list(r ORDER BY b) AS t FROM bits WHERE k = 8)"""

OP2 = f"""
WITH RECURSIVE {CRC32}, sized AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
    CAST(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda p: ('0x' || p)::BIGINT)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS BIGINT) AS text_crc32
  FROM documents, crc_table
), summed AS (
  SELECT *, CAST(sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start, CAST(sum(size) OVER () AS BIGINT) AS total FROM sized
), placed AS (
  SELECT *, CAST(least(((2 * start + size) * 8) // (2 * total), 7) AS INTEGER) AS shard FROM summed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY start, doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""

#: Lower-cased words of a text column, for exact windows.
WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
lengths AS (SELECT DISTINCT least(len(w), 13) AS k FROM b WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[s + 1:s + k], ' ') AS window_text
  FROM (SELECT item_id, w, least(len(w), 13) AS k, unnest(range(0, len(w) - least(len(w), 13) + 1)) AS s FROM b WHERE len(w) > 0)
),
doc_windows AS (
  SELECT doc_id, k, s, array_to_string(w[s + 1:s + k], ' ') AS window_text
  FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS s FROM d, lengths WHERE len(w) >= k)
),
found AS (SELECT doc_id, item_id, s, k FROM doc_windows JOIN item_windows USING (k, window_text)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM found) GROUP BY doc_id),
pairs AS (
  SELECT doc_id, item_id, n, ipos, pos - ipos AS delta
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d)
  JOIN (SELECT item_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS ipos FROM b) USING (word)
),
near AS (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM (SELECT DISTINCT doc_id, item_id, n, ipos, unnest(range(delta - 4, delta + 1)) AS low FROM pairs)
  GROUP BY doc_id, item_id, n, low HAVING count(*) >= ceil(0.8 * n - 1e-9)
),
near_ids AS (SELECT doc_id, count(i) AS n_near_items, string_agg(i, ',' ORDER BY i) AS near_items FROM near GROUP BY doc_id),
items AS (SELECT doc_id, count(i) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  coalesce(n_near_items, 0) AS n_near_items, coalesce(near_items, '') AS near_items
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near_ids USING (doc_id)
"""

OP4 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n f ON x = f.doc_id JOIN n g ON y = g.doc_id WHERE 100 * c >= 85 * (f.n + g.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.reach = e.x),
c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""

def more(key: str, cost: int | str, letters: str) -> str:
    """SQL of the key of a dearer, longer audit."""
    return f"lpad(CAST(CAST(substr({key}, 1, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({key}, 10) || '{letters}'"


#: States are keys of fixed-width cost and audit string, so the least key is the cheapest and then the first by ASCII.
OP12 = f"""
WITH RECURSIVE {CRC32}, keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    CAST(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))), '..'), lambda p: ('0x' || p)::BIGINT)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS BIGINT) % 20 AS kind
  FROM conversations, crc_table
), harmed AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed
), sorted AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, substr(role, 1, 1) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut
  FROM harmed
), marked AS (
  SELECT *, CASE WHEN cut = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(i) OVER (PARTITION BY conv_id ORDER BY pos) || i AS pair
  FROM sorted
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM marked GROUP BY conv_id
), walk(conv_id, pos, ks, kn, ku, ka) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, NULL::VARCHAR, '000000000', '000000005I', '000000010II' FROM marked
  UNION ALL
  SELECT conv_id, pos, ks, kn, least(ku, {more("ka", 5, "I")}), least(ka, {more(f"least(ku, {more('ka', 5, 'I')})", 5, "I")}) FROM (
    SELECT conv_id, pos, ks, kn, least(ku, {more("kn", 5, "I")}, {more("ks", 5, "I")}) AS ku, ka FROM (
      SELECT w.conv_id, m.pos,
        least({more("ks", 2, "D")}, CASE WHEN ok AND i = 's' THEN {more("kn", "dear", "K")} END) AS ks, {more("kn", 2, "D")} AS kn,
        least({more("ku", 2, "D")}, CASE WHEN ok THEN CASE WHEN i = 'u' THEN {more("least(kn, ks, ka)", "dear", "K")} ELSE {more("least(kn, ks, ka)", "dear + 1", "R")} END END) AS ku,
        least({more("ka", 2, "D")}, CASE WHEN ok THEN CASE WHEN i = 'a' THEN {more("ku", "dear", "K")} ELSE {more("ku", "dear + 1", "R")} END END) AS ka
      FROM walk w JOIN (SELECT *, fault NOT IN ('b', 'd') AS ok, CASE WHEN fault = 't' THEN 5 ELSE 0 END AS dear FROM marked) m ON m.conv_id = w.conv_id AND m.pos = w.pos + 1
    )
  )
), ended AS (
  SELECT conv_id, least(kn, ka) AS best FROM walk JOIN counts USING (conv_id) WHERE pos = n
), letters AS (
  SELECT conv_id, substr(substr(best, 10), p, 1) AS letter, p, len(replace(substr(best, 10, p), 'I', '')) AS pos, len(replace(substr(best, 10, p), 'D', '')) AS place
  FROM (SELECT *, unnest(range(1, len(best) - 8)) AS p FROM ended)
), first_role AS (
  SELECT conv_id, max(CASE WHEN place = 1 AND letter = 'K' AND i = 's' THEN 1 ELSE 0 END) AS s FROM letters JOIN marked USING (conv_id, pos) WHERE letter <> 'D' GROUP BY conv_id
), turns AS (
  SELECT conv_id, place, CASE WHEN letter = 'K' THEN role WHEN (place + coalesce(s, 0)) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END AS line
  FROM letters LEFT JOIN marked USING (conv_id, pos) LEFT JOIN first_role USING (conv_id) WHERE letter <> 'D'
), joined AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY place) AS body FROM turns GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(CAST(substr(best, 1, 9) AS BIGINT), 0) AS cost, coalesce(substr(best, 10), '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN counts USING (conv_id) LEFT JOIN ended USING (conv_id) LEFT JOIN joined USING (conv_id)
"""
ORACLES: dict[str, str] = {
    "op2_balanced_shards": OP2,
    "op4_superminhash": OP4,
    "op6_decontamination": OP6,
    "op12_conversation_repair": OP12,
}
