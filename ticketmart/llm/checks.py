"""Registered queries of the corpus operators on the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart.llm import (
    decontamination,
    lines,
    mixing,
    negatives,
    pages,
    personal_data,
    quality,
    quotes,
    sentencepiece,
    simhash,
    spelling,
    toxicity,
    vectors,
)
from ticketmart.llm.common import crc_remainder, table

#: Where the public vocabulary lies.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            SQL[query.__name__] = sql
        return query

    return register


@check()
def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@check()
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = crc_remainder(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs.select("doc_id", "text"), labels, allowed=~held_out)
    return toxicity.with_scores(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


_WORDS = """list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""


@check(f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS v
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(s) WHERE len(w) > 0),
dw AS (
  SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS v
  FROM d, (SELECT DISTINCT n FROM iw) AS lengths, unnest(range(1, len(w) - n + 2)) AS t(s)),
hit AS (SELECT DISTINCT r, s, n, item_id FROM dw JOIN iw USING (n, v)),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + n)) AS t(p) GROUP BY r),
item AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(digest, sha256('')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN item USING (r)
""")
def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@check()
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = sentencepiece.read_model(MODEL)
    return sentencepiece.encoded(table(spark, folder, "documents"), model)


_CUT = "' ' || chr(9) || chr(13) || chr(11) || chr(12)"


@check(f"""
WITH a AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
cut AS (SELECT doc_id, i, trim(parts[i], {_CUT}) AS line FROM a, unnest(range(1, len(parts) + 1)) AS t(i)),
l AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS place,
    len(regexp_extract_all(line, '[^' || {_CUT} || ']+')) AS words
  FROM cut WHERE line <> ''),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY place) AS after FROM l),
p AS (
  SELECT doc_id, s.place AS s, e.place AS e FROM c AS s JOIN c AS e USING (doc_id)
  WHERE e.place >= s.place AND e.after - s.after + s.words >= 50
    AND (e.after - e.words - s.after + s.words < 50 OR e.after - s.after < 50)),
named AS (
  SELECT doc_id, s, e, string_agg(line, chr(10) ORDER BY place) AS passage
  FROM p JOIN l USING (doc_id) WHERE place BETWEEN s AND e GROUP BY doc_id, s, e),
later AS (
  SELECT doc_id, s, e FROM named
  QUALIFY row_number() OVER (PARTITION BY passage ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, place FROM later, unnest(range(s, e + 1)) AS t(place)),
counted AS (
  SELECT doc_id, count(*) AS n_lines, count(gone.place) AS n_removed,
    string_agg(line, chr(10) ORDER BY place) FILTER (WHERE gone.place IS NULL) AS rest
  FROM l LEFT JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CASE WHEN coalesce(n_removed, 0) = 0 THEN text ELSE coalesce(rest, '') END AS text,
  CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM documents LEFT JOIN counted USING (doc_id)
""")
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lines.with_deduped_text(docs)


@check()
def op3_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.linked_vectors(table(spark, folder, "embeddings"))


@check()
def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = crc_remainder(F.col("doc_id"), 4) == 2
    rules = quality.fit(docs, labels, allowed=~held_out)
    return quality.with_scores(docs, rules).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


@check()
def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return pages.main_texts(table(spark, folder, "pages"))


@check("""
WITH RECURSIVE t AS (
  SELECT row_number() OVER () AS r, conv_id, turn, role,
    array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9))),
      lambda x: x <> ''), chr(10)) AS text
  FROM conversations),
n AS (SELECT *, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS plain FROM t),
quote AS (
  SELECT n.r, n.conv_id, n.turn, q.plain, n.turn - q.turn AS level
  FROM n JOIN n AS q ON q.conv_id = n.conv_id AND q.turn IN (n.turn - 1, n.turn - 2)),
near AS (
  SELECT quote.r, level, max(n.turn) AS turn
  FROM quote JOIN n ON n.conv_id = quote.conv_id AND n.plain = quote.plain AND n.turn < quote.turn
  GROUP BY ALL),
far AS (SELECT plain, min((turn, conv_id)) AS first FROM n GROUP BY ALL),
owner AS (
  SELECT quote.r, quote.level, CASE WHEN near.turn IS NULL THEN first[2] ELSE quote.conv_id END AS pc,
    CASE WHEN near.turn IS NULL THEN first[1] ELSE near.turn END AS pt, quote.turn
  FROM quote JOIN far USING (plain) LEFT JOIN near ON near.r = quote.r AND near.level = quote.level),
parent AS (
  SELECT r, min((level, pt, pc)) AS best FROM owner WHERE pt < turn GROUP BY r),
step AS (
  SELECT n.*, best[2] AS pt, best[3] AS pc FROM n LEFT JOIN parent USING (r)),
walk AS (
  SELECT r, conv_id, turn, pc, pt, 0 AS depth, conv_id AS rc, turn AS rt FROM step WHERE pt IS NULL
  UNION ALL
  SELECT s.r, s.conv_id, s.turn, s.pc, s.pt, w.depth + 1, w.rc, w.rt
  FROM step AS s JOIN walk AS w ON s.pc = w.conv_id AND s.pt = w.turn)
SELECT n.conv_id, n.turn, n.role, n.text, w.pc AS parent_scope, w.pt AS parent_place,
  w.rc AS root_scope, w.rt AS root_place, CAST(w.depth AS BIGINT) AS depth,
  CAST((SELECT count(*) FROM quote AS q WHERE q.r = n.r) AS BIGINT) AS n_quotes
FROM n JOIN walk AS w USING (r)
""")
def op8_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """The turns, written as mail with nested quotes, made conversations again."""
    mail = quotes.as_mail(table(spark, folder, "conversations"))
    return quotes.conversations(mail, "conv_id", "turn", keep=("role",))


@check()
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.find(table(spark, folder, "documents"))


@check("""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM e AS a JOIN e AS r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
""")
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    rows = negatives.whole_rows(
        table(spark, folder, "embeddings"),
        label=F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label),
        is_anchor=vec_id % 100 == 0,
    )
    return negatives.hard_negatives(rows)


@check()
def op12_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@check("""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
run AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
once AS (
  SELECT run, count(*) AS times, encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS bytes
  FROM run WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(bytes)),
    lambda j: CAST('0x' || substring(hex(bytes), 2 * j + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM once, crc),
word AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2)
    ELSE run END AS word, CAST(sum(times) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING sum(times) >= 5 AND length(word) >= 6),
cut AS (
  SELECT word, n, p, left(word, p - 1) || substring(word, p + 1) AS rest
  FROM word, unnest(range(1, length(word) + 1)) AS t(p)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut AS a JOIN cut AS b USING (rest, p) WHERE a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut AS c JOIN word AS w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cut AS c JOIN word AS w ON c.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, min((-near_n, near)) AS best FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -best[1] >= 5 * w.n THEN best[2] END AS form, CASE WHEN -best[1] >= 5 * w.n THEN -best[1] END AS form_n
  FROM word AS w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS here, 0 AS steps FROM formed
  UNION ALL SELECT c.word, f.form, steps + 1 FROM chain AS c JOIN formed AS f ON f.word = c.here WHERE f.form IS NOT NULL),
root AS (SELECT word, arg_max(here, steps) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM formed JOIN root USING (word)
""")
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))
