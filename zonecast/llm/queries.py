"""Queries of the corpus operators over the driver's tables, with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import langid, toxicity
from zonecast.llm.ann import nearest
from zonecast.llm.chat_format import Template, format_conversations, read_loss, read_turns
from zonecast.llm.decontaminate import contamination
from zonecast.llm.hard_negatives import mine
from zonecast.llm.html_text import extract_text
from zonecast.llm.mixing import mix
from zonecast.llm.near_dup import near_duplicates
from zonecast.llm.sentence_dedup import remove_repeated_sentences
from zonecast.llm.shared import shared_path, ship_package
from zonecast.llm.suffix_dedup import remove_repeats
from zonecast.llm.turn_repair import damage, repair, text_digests
from zonecast.llm.warc import read_warc, write_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op1_decontaminate", f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g FROM (
    SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, p, n, item_id FROM doc_windows JOIN item_windows USING (n, g)),
covered AS (SELECT doc_id, count(*) AS n_hit FROM (
    SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS at FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op1_decontaminate(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def _remainder(doc_id: str, n: int):
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def label_fold(doc_id: str):
    """0 for the fifth of the documents whose labels are held out."""
    return _remainder(doc_id, 5)


@query("op2_toxicity")
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(label_fold("doc_id") != 0)
    scored = toxicity.score(docs, toxicity.fit(docs, labels), to="score")
    return scored.select("doc_id", (label_fold("doc_id") == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark, sf_dir):
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))



@query("op4_nearest")
def op4_nearest(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"))


@query("op5_html_text")
def op5_html_text(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))


@query("op6_langid")
def op6_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(_remainder("doc_id", 3) != 1))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (_remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op7_mix", r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, list_extract([3, 1, 2], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)) AS weight FROM s),
l AS (SELECT *, row_number() OVER o AS rank,
    (1.5 * CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
    FROM w WINDOW o AS (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, source NULLS LAST)),
v AS (SELECT min_by(level, rank) AS level FROM l WHERE level * weight <= 2 * source_size),
t AS (SELECT source, source_size, coalesce(least(CAST(2 * source_size AS DOUBLE), (SELECT level FROM v) * weight), CAST(2 * source_size AS DOUBLE)) AS target FROM w),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
c AS (SELECT d.*, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY d.source, h) AS own
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(size * (passes + CASE WHEN upto <= rest
    OR (upto - own <= rest AND upto - rest < rest - (upto - own)) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c""")
def op7_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), columns=["doc_id"])


@query("op8_warc", """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
k AS (SELECT *, CASE WHEN n >= 1000 AND page_id IS NOT NULL THEN max(page_id) OVER (PARTITION BY d, n) END AS keeper FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < keeper THEN keeper END AS refers_to FROM k""")
def op8_warc(spark, sf_dir):
    path = shared_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    records = read_warc(spark, path, payloads=False).where("type <> 'gap'")
    return records.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


@query("op9_near_duplicates", r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM reach r JOIN both_ways l ON r.y = l.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) r USING (doc_id)""")
def op9_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, threshold=85, m=128)


@query("op10_sentence_dedup")
def op10_sentence_dedup(spark, sf_dir):
    return remove_repeated_sentences(table(spark, sf_dir, "documents"))


_TEMPLATE = Template()


def _escaped_sql(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for c in _TEMPLATE.controls:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


@query("op11_chat_format", f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (SELECT *, row_number() OVER w AS n, lag(role) OVER w AS before FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, length({_escaped_sql('text')}) + CASE WHEN n > 1 AND before = role THEN {len(_TEMPLATE.join)}
    ELSE {len(_TEMPLATE.open + _TEMPLATE.head)} + length({_escaped_sql('role')}) + CASE WHEN n > 1 THEN {len(_TEMPLATE.close)} ELSE 0 END END AS chars FROM o)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) + {len(_TEMPLATE.begin + _TEMPLATE.close)} AS BIGINT) AS formatted_chars FROM p GROUP BY conv_id""")
def op11_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("</s>[INST] ok [/INST]")
    more = spark.range(2).select(F.lit(-1).cast("long"), "id", F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")), text)
    done = format_conversations(rows.union(more))
    back = done.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                       F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    lines = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("op12_turn_repair")
def op12_turn_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found, left = repair(damage(rows))
    left = left.withColumn("line", F.concat("role", F.lit(":"), "text"))
    hashes = text_digests(left, key="conv_id", order="place", line="line")
    out = rows.select("conv_id").distinct().alias("c")
    out = out.join(found.alias("f"), F.col("c.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
    out = out.join(hashes.alias("h"), F.col("c.conv_id").eqNullSafe(F.col("h.conv_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("c.conv_id", *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op13_hard_negatives", """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
c AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM e),
v AS (SELECT vec_id, label, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM c WHERE vec_id NOT IN (
  SELECT vec_id FROM c WHERE x IS NULL OR NOT isfinite(x))),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, any_value(a.label) = any_value(b.label) AS same, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM v a JOIN v b USING (i) WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id GROUP BY 1, 2),
p AS (SELECT anchor_id, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank,
    s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""")
def op13_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", "embedding", label.alias("label")))
