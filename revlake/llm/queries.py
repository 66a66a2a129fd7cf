"""One registered query per operator, with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.llm import (
    chat,
    decontaminate,
    dedup,
    jaccard_join,
    licenses,
    mixing,
    quality,
    runs,
    sentence_pieces,
    spellings,
    token_output,
    toxicity,
    warc,
)
from revlake.llm.common import WORD

QUERIES, ORACLES = {}, {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


QUERIES["op1_mix_sources"] = op1_mix_sources
ORACLES["op1_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source
), summed AS (
  SELECT *, row_number() OVER up AS place,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         sum(weight) OVER () - coalesce(sum(weight) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_left
  FROM sources WINDOW up AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST)
), free AS (
  SELECT place, left_over, weight_left FROM summed
  WHERE CAST(3 * source_size AS DOUBLE) * weight_left >= CAST(left_over AS DOUBLE) * weight ORDER BY place LIMIT 1
), targets AS (
  SELECT s.source, s.source_size,
         CASE WHEN f.place IS NULL OR s.place < f.place THEN CAST(3 * s.source_size AS DOUBLE)
              ELSE CAST(f.left_over AS DOUBLE) * s.weight / f.weight_left END AS target
  FROM summed s LEFT JOIN free f ON true
), placed AS (
  SELECT d.*, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs,
         CASE WHEN source_size > 0 THEN budget % source_size ELSE 0 END AS rest
  FROM placed
)
SELECT doc_id, source, size, source_size, target,
       CAST(epochs * size + least(size, greatest(0, rest - before)) AS BIGINT) AS taken,
       CAST(epochs + CASE WHEN rest > 0 AND 2 * before + size <= 2 * rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM cut
"""


def op2_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.exact_groups(table(spark, sf, "documents")).drop("n_chars")


QUERIES["op2_exact_dedup"] = op2_exact_dedup
ORACLES["op2_exact_dedup"] = r"""
WITH plain AS (
  SELECT doc_id, coalesce(length(text), 0) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
  FROM documents
), ranked AS (
  SELECT doc_id, plain, first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place,
         count(*) OVER (PARTITION BY plain) AS group_size
  FROM plain WINDOW best AS (PARTITION BY plain ORDER BY n_chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(plain) AS text_sha256 FROM ranked
"""


def tokenizer_definition(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return token_output.encode_and_read(table(spark, sf, "documents"), tokenizer_definition())


QUERIES["op7_token_files"] = op7_token_files


def op8_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], rows.schema)
    messages = rows.unionByName(planted).withColumn("content", chat.text_part(F.col("text")))
    return chat.write_and_read(messages).drop("expanded_tokens")


QUERIES["op8_chat_format"] = op8_chat_format
ORACLES["op8_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, '<|turn:' || replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsq;') || '|>'
            || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsq;') || '<|end|>' AS segment
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, segment)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, segment) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(segment)) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.write_and_read(table(spark, sf, "pages"))


QUERIES["op10_warc"] = op10_warc
# SQL has no base32: five bits of the digest at a time, from its hexadecimal digits.
ORACLES["op10_warc"] = r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), bits AS (
  SELECT html, string_agg(substr('0000000100100011010001010110011110001001101010111100110111101111',
                                 4 * (strpos('0123456789abcdef', substr(sha1(html), CAST(i AS INTEGER), 1)) - 1) + 1, 4), '' ORDER BY i) AS b
  FROM (SELECT DISTINCT html FROM payloads), range(1, 41) AS r(i) GROUP BY html
), base32 AS (
  SELECT html, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           16 * CAST(substr(b, CAST(5 * i + 1 AS INTEGER), 1) AS INTEGER) + 8 * CAST(substr(b, CAST(5 * i + 2 AS INTEGER), 1) AS INTEGER)
           + 4 * CAST(substr(b, CAST(5 * i + 3 AS INTEGER), 1) AS INTEGER) + 2 * CAST(substr(b, CAST(5 * i + 4 AS INTEGER), 1) AS INTEGER)
           + CAST(substr(b, CAST(5 * i + 5 AS INTEGER), 1) AS INTEGER) AS INTEGER), 1), '' ORDER BY i) AS payload_digest
  FROM bits, range(0, 32) AS r(i) GROUP BY html
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM firsts JOIN base32 USING (html)
"""


def op3_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"))


QUERIES["op3_license_scan"] = op3_license_scan
ORACLES["op3_license_scan"] = licenses.scan_sql()


def held_out() -> Column:
    """Rows whose labels no model may learn from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality.train(docs, table(spark, sf, "labels").where(~held_out()), "quality")
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


QUERIES["op6_quality"] = op6_quality


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels").where(~held_out()), "toxic")
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


QUERIES["op5_toxicity"] = op5_toxicity


def op9_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.link_components(table(spark, sf, "documents")).drop("mark", "stays")


QUERIES["op9_jaccard_join"] = op9_jaccard_join


def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


QUERIES["op4_decontaminate"] = op4_decontaminate


def piece_model(name: str = "piece_bpe_32k.model") -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op11_sentence_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return sentence_pieces.digests(sentence_pieces.round_trip(table(spark, sf, "documents"), piece_model()))


QUERIES["op11_sentence_pieces"] = op11_sentence_pieces


def misspelt(run: Column, doc: Column) -> Column:
    """A run as op12 reads it: about one in 97 loses a letter. A null id counts as empty."""
    h = F.crc32(F.concat(F.coalesce(doc.cast("string"), F.lit("")), F.lit(":"), run))
    k = (h % F.length(run)).cast("int")
    return F.when(h % 97 == 0, F.concat(F.substring(run, F.lit(1), k), F.substring(run, k + 2, F.length(run)))).otherwise(run)


def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    found = spellings.letter_runs(table(spark, sf, "documents"))
    return spellings.variants(spellings.counted_words(found.select(misspelt(F.col("run"), F.col("doc_id")).alias("word"))))


QUERIES["op12_spelling_variants"] = op12_spelling_variants
# SQL has no crc32: a table by its rule, then one step a byte. Words one edit apart share a word with one
# letter left out at the same place, or one is the other with a letter left out.
ORACLES["op12_spelling_variants"] = r"""
WITH RECURSIVE bits AS (
  SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) AS r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), steps AS (
  SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), tokens AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), per_doc AS (
  SELECT doc_id, run, count(*) AS n FROM tokens GROUP BY doc_id, run
), keyed AS (
  SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM per_doc
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(0, length(x) // 2),
             lambda i: CAST(16 * (strpos('123456789ABCDEF', x[2 * i + 1])) + strpos('123456789ABCDEF', x[2 * i + 2]) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM keyed, steps
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         CAST(sum(n) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word AS a, b.word AS b, b.n AS bn FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
  UNION
  SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word
), ranked AS (
  SELECT a, b, bn, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY bn DESC, b) AS place FROM near
), forms AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.bn >= 2 * w.n THEN r.b END AS form, CASE WHEN r.bn >= 2 * w.n THEN r.bn END AS form_n
  FROM words w LEFT JOIN ranked r ON r.a = w.word AND r.place = 1
), chains AS (
  SELECT word, word AS root, 0 AS depth FROM forms
  UNION ALL
  SELECT c.word, f.form, depth + 1 FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, max_by(c.root, c.depth) AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chains c ON c.word = f.word GROUP BY ALL
"""


def with_repeats(docs: DataFrame) -> DataFrame:
    """Texts as op13 reads them: every tenth document, by crc32 of its id, repeats some of its words to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = docs.select("doc_id", "text", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w"))
    marked = words.withColumns({"n": F.size("w"), "g": g}).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    marked = marked.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.expr("transform(w, (x, i) -> CASE WHEN i < a THEN x ELSE w[CAST(a + (i - a) % p AS INT)] END)")
    return marked.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return runs.digests(runs.find_runs(with_repeats(table(spark, sf, "documents"))))


QUERIES["op13_periodic_runs"] = op13_periodic_runs
