"""The queries of the text operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskweave.llm import (
    block_naming, chat_format, decontamination, difference_cover, histogram_shards, hyperminhash, middle_frames, mixing, packing,
    token_counts, toxicity, vector_codes, warc,
)
from riskweave.llm.common import table

TOKENIZER = "byte_bpe_50k.json"
PACKING_TOKENIZER = "word_bpe_49k.json"


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, folder, "pages"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.draws(table(spark, folder, "documents")).drop("_row")


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return histogram_shards.shard_table(table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return difference_cover.without_repeats(table(spark, folder, "documents"), with_text=False).drop("kept_text")


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return hyperminhash.near_duplicate_table(table(spark, folder, "documents"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return block_naming.exact_duplicates(table(spark, folder, "documents"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    tricky = "\\### Assistant: </turn> ok"
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], given.schema)
    return chat_format.conversation_digests(chat_format.formatted_turns(given.union(extra)))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.code_table(table(spark, folder, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return middle_frames.fim_table(table(spark, folder, "documents"))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path(PACKING_TOKENIZER)).drop("ids")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc, op2_mixing, op3_toxicity, op4_sharding, op5_token_counts, op6_substring_dedup, op7_near_dedup,
        op8_exact_dedup, op9_decontamination, op10_chat_format, op11_vector_codes, op12_fill_in_middle, op13_packing,
    )
}
# SQL for the queries that SQL can state; the others are compared with plain versions in the tests.
_SPLIT = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_WARC = """WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
  r AS (SELECT *, sha1(h) AS d, min(page_id) OVER (PARTITION BY h) AS head FROM p)
SELECT page_id, url, octet_length(encode(h))::BIGINT AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(d, 5 * (k // 4) + 1, 5))::BIGINT >> (15 - 5 * (k % 4))::BIGINT) & 31) + 1, 1) for k in range(32)], '') AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> head THEN head END AS refers_to FROM r"""

_PASSAGES = f"""WITH d AS (SELECT doc_id, {_SPLIT.format("coalesce(text, '')")} AS l FROM documents),
  w AS (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS j FROM d),
  g AS (SELECT doc_id, i, array_to_string(list_slice(l, i, i + 12), ' ') AS win FROM (SELECT *, unnest(range(1, len(l) - 11)) AS i FROM d WHERE len(l) >= 13)),
  s AS (SELECT doc_id, i AS j, min(doc_id) OVER (PARTITION BY win) < doc_id AS dup FROM g),
  c AS (SELECT doc_id, j, word, coalesce(bool_or(dup) OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), false) AS gone
    FROM w LEFT JOIN s USING (doc_id, j)),
  o AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n, string_agg(word, ' ' ORDER BY j) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT doc_id, len(l)::BIGINT AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN o USING (doc_id)"""

_NEAR = f"""WITH RECURSIVE d AS (SELECT doc_id, {_SPLIT.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS l FROM documents),
  s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(l, i, i + 2), ' ') AS sh FROM (SELECT *, unnest(range(1, greatest(len(l) - 1, 2))) AS i FROM d WHERE len(l) > 0)),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  b AS (SELECT a.doc_id AS x, c.doc_id AS y, count(*) AS k FROM s a JOIN s c ON a.sh = c.sh AND a.doc_id <> c.doc_id GROUP BY ALL),
  e AS (SELECT x, y FROM b JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
  r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
  o AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM o LEFT JOIN n USING (doc_id)"""

_EXACT = """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW same AS (PARTITION BY t)"""

_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+')"
_LEAKS = f"""WITH i AS (SELECT item_id, l, least(5, len(l)) AS k FROM (SELECT item_id, {_WORDS} AS l FROM benchmark) WHERE len(l) > 0),
  q AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(l, p, p + k - 1), ' ') AS sh FROM (SELECT *, unnest(range(1, len(l) - k + 2)) AS p FROM i)),
  z AS (SELECT item_id, count(*) AS n FROM q GROUP BY item_id),
  d AS (SELECT doc_id, {_WORDS} AS l FROM documents),
  h AS (SELECT DISTINCT doc_id, k, array_to_string(list_slice(l, p, p + k - 1), ' ') AS sh
    FROM (SELECT *, unnest(range(1, len(l) - k + 2)) AS p FROM d JOIN (SELECT DISTINCT k FROM i) ON len(l) >= k)),
  m AS (SELECT doc_id, item_id, count(*) AS shared FROM h JOIN q USING (k, sh) GROUP BY ALL)
SELECT doc_id, item_id, n AS item_shingles, shared, shared / n AS containment FROM m JOIN z USING (item_id) WHERE 10 * shared >= 8 * n"""

_CHAT = r"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
  f AS (SELECT *, length('<turn >' || '</turn>') + length(replace(replace(replace(role, '\', '\\'), '<', '\l'), '>', '\g'))
    + length(replace(replace(text, '\', '\\'), '<', '\l')) AS chars FROM c),
  o AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS loss, sum(chars)::BIGINT AS formatted_chars FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars, 0::BIGINT AS attachments, 0::BIGINT AS attachment_tokens FROM o"""

# Two rounds of nearest entries and floored means, then the final entries; d * 64 + e orders by distance, then entry.
def _assigned(book: str) -> str:
    distance = " + ".join(f"(x[{j}] - y[{j}]) * (x[{j}] - y[{j}])" for j in range(1, 5))
    return f"SELECT vec_id, label, s, any_value(x) AS x, min(({distance}) * 64 + e) AS best FROM p JOIN {book} USING (s) GROUP BY vec_id, label, s"


def _moved(book: str, assigned: str) -> str:
    means = ", ".join(f"floor(sum(x[{j}])::DOUBLE / count(*))::BIGINT" for j in range(1, 5))
    return f"""SELECT s, e, coalesce(m, y) AS y FROM {book} LEFT JOIN
    (SELECT s, best % 64 AS e, [{means}] AS m FROM {assigned} GROUP BY s, best % 64) USING (s, e)"""


_CODES = f"""WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda c: floor(c::DOUBLE * 256)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
  p AS (SELECT vec_id, label, s, list_slice(v, 4 * s + 1, 4 * s + 4) AS x FROM k, range(16) t(s)),
  c0 AS (SELECT s, e, list_slice(v, 4 * s + 1, 4 * s + 4) AS y FROM (SELECT v, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k) i, range(16) t(s) WHERE e < 64),
  a0 AS MATERIALIZED ({_assigned("c0")}), c1 AS MATERIALIZED ({_moved("c0", "a0")}), a1 AS MATERIALIZED ({_assigned("c1")}),
  c2 AS MATERIALIZED ({_moved("c1", "a1")}), a2 AS MATERIALIZED ({_assigned("c2")}),
  o AS (SELECT vec_id, label, string_agg(printf('%02x', best % 64), '' ORDER BY s) AS code, sum(best // 64)::BIGINT AS error FROM a2 GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY s, e)) FROM c2) AS codebooks_sha256 FROM o"""

_LINES = r"regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+')"
_MIDDLE = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_LINES} AS l, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
  c AS (SELECT *, len(l) AS n, [('0x' || substr(h, 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS r FROM d),
  f AS (SELECT doc_id, t, n, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b, l,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
      WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c),
  q AS (SELECT doc_id, t, n, form, coalesce(array_to_string(list_slice(l, 1, a), ''), '') AS pre, coalesce(array_to_string(list_slice(l, a + 1, b), ''), '') AS mid,
    coalesce(array_to_string(list_slice(l, b + 1, n), ''), '') AS suf FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM q"""

ORACLES: dict[str, str] = {
    "op1_warc": _WARC,
    "op6_substring_dedup": _PASSAGES,
    "op7_near_dedup": _NEAR,
    "op8_exact_dedup": _EXACT,
    "op9_decontamination": _LEAKS,
    "op10_chat_format": _CHAT,
    "op11_vector_codes": _CODES,
    "op12_fill_in_middle": _MIDDLE,
}
