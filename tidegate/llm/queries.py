"""One query for each operator over its whole table, and its SQL where SQL can express it.

The queries derive plain columns and digests from what the operators return.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import (bpe, chat, clustering, decontamination, fingerprints, language, licences,
                          line_dedup, scoring, search, sharding, simhash_dedup, toxicity)
from tidegate.llm.common import table
from tidegate.session import stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    return sharding.histogram_sort(table(spark, sf_dir, "documents"), shards=24)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text; labels of held-out rows are never learned."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs)
    return language.identify(docs.select("doc_id", "text"), model, keep=("doc_id",)).select(
        "row.doc_id", language.held_out(F.col("row.doc_id"), 5, 0).alias("held_out"),
        "lang_pred", "score")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the bytes they decode to, as digests."""
    ranks = bpe.read_ranks(RANKS)
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(encoded, ranks))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own and inherited licence of every document.

    Documents have no paths, so each is a file in nested folders by the digits of its id; ids
    divisible by 1000, 100 and 10 are the licence files of the folders of that many.
    """
    id_ = F.col("doc_id")
    folders = [F.concat(F.lit("k"), F.floor(id_ / 1000).cast("string")),
               F.concat(F.lit("c"), F.floor(id_ / 100).cast("string")),
               F.concat(F.lit("x"), F.floor(id_ / 10).cast("string"))]
    path = (F.when(id_ % 1000 == 0, F.concat_ws("/", folders[0], F.lit("LICENSE")))
            .when(id_ % 100 == 0, F.concat_ws("/", *folders[:2], F.lit("LICENSE")))
            .when(id_ % 10 == 0, F.concat_ws("/", *folders, F.lit("LICENSE")))
            .otherwise(F.concat_ws("/", *folders, id_.cast("string"))))
    return licences.scan(table(spark, sf_dir, "documents").withColumn("path", path))


OP5_SQL = r"""
WITH files AS (SELECT doc_id, coalesce(text, '') AS text,
    'k' || doc_id // 1000 || CASE WHEN doc_id % 1000 = 0 THEN '/LICENSE'
      ELSE '/c' || doc_id // 100 || CASE WHEN doc_id % 100 = 0 THEN '/LICENSE'
        ELSE '/x' || doc_id // 10 || CASE WHEN doc_id % 10 = 0 THEN '/LICENSE'
          ELSE '/' || doc_id END END END AS path FROM documents),
templates(licence, template) AS (VALUES {templates}),
t AS (SELECT licence, unnest(regexp_extract_all(lower(template), '{word}')) AS word
  FROM templates),
corpus AS (SELECT count(*) AS total FROM files),
held AS (SELECT word, count(*) AS n FROM (SELECT DISTINCT doc_id,
    unnest(regexp_extract_all(lower(text), '{word}')) AS word FROM files) GROUP BY word),
idf AS (SELECT word, 1 + ln((1 + total) / (1 + coalesce(n, 0))) AS w
  FROM (SELECT DISTINCT word FROM t) LEFT JOIN held USING (word), corpus),
tv AS (SELECT licence, word, count(*) * any_value(w) AS tw FROM t JOIN idf USING (word)
  GROUP BY ALL),
tn AS (SELECT licence, sqrt(sum(tw * tw)) AS t_norm FROM tv GROUP BY licence),
lines AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS n,
    unnest(string_split(text, chr(10))) AS line FROM files),
words AS (SELECT doc_id, n, word, count(*) AS tf FROM (SELECT doc_id, n,
    unnest(regexp_extract_all(lower(line), '{word}')) AS word FROM lines) GROUP BY ALL),
norms AS (SELECT doc_id, n, sqrt(sum(CASE WHEN w IS NULL THEN (1 + ln(1 + total)) ** 2
    ELSE (tf * w) ** 2 END)) AS norm
  FROM words LEFT JOIN idf USING (word), corpus GROUP BY doc_id, n),
near AS (SELECT doc_id, licence,
    round(sum(tf * w * tw) / (any_value(norm) * any_value(t_norm)), 9) AS cosine
  FROM words JOIN idf USING (word) JOIN tv USING (word) JOIN tn USING (licence)
    JOIN norms USING (doc_id, n) GROUP BY doc_id, n, licence HAVING cosine >= 0.7),
best AS (SELECT doc_id, licence, cosine FROM near
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, licence) = 1),
own AS (SELECT doc_id, path, licence, cosine, regexp_replace(path, '/[^/]*$', '') AS dir
  FROM files LEFT JOIN best USING (doc_id)),
declared AS (SELECT dir AS above, licence AS inherited FROM own
  WHERE licence IS NOT NULL AND path LIKE '%/LICENSE'),
up AS (SELECT doc_id, above, inherited FROM own JOIN declared
    ON own.licence IS NULL AND (dir = above OR starts_with(dir, above || '/'))
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(above) DESC) = 1)
SELECT doc_id, path, licence AS own_licence, cosine, coalesce(licence, inherited) AS licence,
  above AS inherited_from FROM own LEFT JOIN up USING (doc_id)""".format(
    word=r"[\p{L}\p{N}.\-]*[\p{L}\p{N}]",
    templates=", ".join(f"('{name}', '{text}')" for name, text in licences.TEMPLATES))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited form, and for ids divisible by 50 how many
    documents have a fingerprint within the radius, the document itself included."""
    rows = stored(fingerprints.with_successors(table(spark, sf_dir, "documents")),
                  "fingerprints")
    classes = rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.count(F.lit(1)).alias("n"))
    asked = rows.where("doc_id % 50 = 0").select(F.col("fingerprint").alias("fp"))
    near = (fingerprints.within_radius(asked, classes).join(classes, "fp")
            .groupBy(F.col("query").alias("fingerprint")).agg(F.sum("n").alias("within_radius")))

    def text(column: str):
        return F.lower(F.lpad(F.hex(column), 16, "0"))

    def likeness(other: str):
        return 1 - F.bit_count(F.col("fingerprint").bitwiseXOR(F.col(other))) / 64

    return rows.join(near, "fingerprint", "left").select(
        "doc_id", "n_chars", "edited_sha256", text("fingerprint").alias("fingerprint"),
        text("edited_fingerprint").alias("edited_fingerprint"),
        likeness("edited_fingerprint").alias("near_edited"),
        likeness("next_fingerprint").alias("near_next"),
        F.when(F.col("doc_id") % 50 == 0, F.col("within_radius")).alias("within_radius"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its lines, its deleted lines and a digest of the text that stays."""
    return line_dedup.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_deleted", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS n FROM d),
u AS (SELECT doc_id, n, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
        row_number() OVER (PARTITION BY doc_id ORDER BY n) AS p
      FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
same AS (SELECT b.doc_id, b.p, b.n, b.words, a.doc_id AS other, b.p - a.p AS diagonal
  FROM u b JOIN u a ON a.line = b.line
    AND (a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.p < b.p))),
islands AS (SELECT *, p - row_number() OVER (PARTITION BY doc_id, other, diagonal ORDER BY p)
  AS island FROM same),
runs AS (SELECT *, sum(words) OVER (PARTITION BY doc_id, other, diagonal, island) AS total
  FROM islands),
gone AS (SELECT DISTINCT doc_id, n FROM runs WHERE total >= 50),
kept AS (SELECT l.doc_id, count(*) AS n_lines, count(gone.n) AS n_deleted,
    bool_or(gone.n IS NULL AND regexp_matches(line, '[^\x20\x09-\x0D]')) AS any_left,
    string_agg(line, chr(10) ORDER BY l.n) FILTER (gone.n IS NULL) AS text
  FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.n = l.n GROUP BY l.doc_id)
SELECT doc_id, CAST(n_lines AS INTEGER) AS n_lines, CAST(n_deleted AS INTEGER) AS n_deleted,
  sha256(CASE WHEN n_deleted = 0 OR any_left THEN text ELSE '' END) AS kept_sha256 FROM kept"""


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the smallest id that links reach."""
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and its digests read back from the windows."""
    hard = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.windows(turns.union(extra)))


OP9_SQL = r"""
WITH turns AS (SELECT coalesce(conv_id, -9223372036854775808) AS conv_id, turn,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
pieces AS (SELECT *, '<' || replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
    || '>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
    || '</turn>' || chr(10) AS piece FROM turns),
counted AS (SELECT *, len(regexp_extract_all(piece, '\p{L}+|\p{N}+|[^\s\p{L}\p{N}]')) AS tokens,
    length(piece) AS chars FROM pieces),
placed AS (SELECT *, row_number() OVER w - 1 AS place,
    coalesce(sum(tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 512
    AS span FROM counted WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
spans AS (SELECT conv_id, span, min(place) AS start FROM placed GROUP BY ALL HAVING start > 0),
past AS (SELECT s.conv_id, p.chars, coalesce(f.tokens, 0) + sum(p.tokens) OVER (
    PARTITION BY s.conv_id, s.span ORDER BY p.place DESC) AS total
  FROM spans s LEFT JOIN placed f ON f.conv_id = s.conv_id AND f.place = 0 AND f.role = 'system'
    JOIN placed p ON p.conv_id = s.conv_id AND p.place < s.start
    AND p.place >= s.start - 4 AND NOT (p.place = 0 AND p.role = 'system')),
chars AS (SELECT conv_id, sum(chars) AS n FROM (SELECT conv_id, chars FROM placed
  UNION ALL SELECT conv_id, chars FROM past WHERE total <= 256
  UNION ALL SELECT s.conv_id, p.chars FROM spans s JOIN placed p
    ON p.conv_id = s.conv_id AND p.place = 0 AND p.role = 'system') GROUP BY conv_id),
texts AS (SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS lines,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS loss
  FROM placed GROUP BY conv_id)
SELECT nullif(conv_id, -9223372036854775808) AS conv_id, n_turns, sha256(lines) AS turns_sha256,
  length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars
FROM texts JOIN chars USING (conv_id)"""


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds."""
    return decontamination.leaks(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its cluster of 16 after 3 rounds, and the inertia."""
    rows = stored(clustering.scaled(table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                                    64, 64), "vectors")
    return clustering.with_inertia(clustering.cluster(rows, 64, clusters=16, rounds=3))


def _assignment(number: int) -> str:
    """SQL of one assignment and of the centroids that come from it."""
    return f"""
a{number} AS (SELECT id, any_value(v) AS v, min_by(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT id, x.v, c, list_sum(list_transform(list_zip(x.v, m.v),
      lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM x, m{number} m) GROUP BY id),
m{number + 1} AS (SELECT c, coalesce(n.v, m.v) AS v FROM m{number} m LEFT JOIN (
  SELECT c, list(CAST(floor(CAST(s AS DECIMAL(38, 0)) / n) AS BIGINT) ORDER BY i) AS v
  FROM (SELECT c, i, sum(e) AS s, count(*) AS n FROM (
    SELECT c, unnest(v) AS e, generate_subscripts(v, 1) AS i FROM a{number}) GROUP BY c, i)
  GROUP BY c) n USING (c)),"""


OP11_SQL = f"""
WITH kept AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0),
x AS (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding,
    lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM kept),
m0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v
  FROM x WHERE vec_id IS NOT NULL ORDER BY c LIMIT 16),
{"".join(map(_assignment, range(3)))}
{_assignment(3).split("m4 AS")[0].rstrip().rstrip(",")}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(m3.v, ',')) AS centroid_sha256
FROM a3 JOIN x USING (id) JOIN m3 USING (c)"""


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    index = search.build(table(spark, sf_dir, "documents"))
    return search.search(index, table(spark, sf_dir, "benchmark"), 20)


OP12_SQL = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
dt AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, up, low), '{term}')) AS t
  FROM documents, letters),
tf AS (SELECT doc_id, t, count(*) AS tf FROM dt GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM n),
m AS (SELECT doc_id, 75 + (25 * n * docs) // l AS m FROM n, total),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM df, total),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id,
    unnest(regexp_extract_all(translate(text, up, low), '{term}')) AS t
  FROM benchmark, letters) GROUP BY ALL),
s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT
    AS score
  FROM q JOIN w USING (t) JOIN tf USING (t) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM s WHERE score > 0) WHERE rank <= 20""".replace(
    "{term}", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def op13_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every text by the base model and the bigram model."""
    scores, train = scoring.score(table(spark, sf_dir, "documents"),
                                  scoring.held_out(F.col("doc_id")))
    return scores.select("doc_id", "held_out", "n_tokens", "n_known",
                         F.lit(train).cast("long").alias("train_tokens"), "base_score", "score")


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_toxicity, op3_language, op4_bpe, op5_licences, op6_fingerprints,
    op7_line_dedup, op8_simhash_dedup, op9_chat, op10_decontamination, op11_clustering,
    op12_search, op13_scoring)}
ORACLES = {"op5_licences": OP5_SQL, "op7_line_dedup": OP7_SQL, "op9_chat": OP9_SQL,
           "op11_clustering": OP11_SQL, "op12_search": OP12_SQL}
