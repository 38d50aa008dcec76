"""The registered queries of this package and their SQL."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlens.joins import attach_groups
from loadlens.llm import (
    alignment,
    bpe,
    decontaminate,
    exact_dedup,
    html_text,
    mixing,
    quotes,
    repair,
    secrets,
    simhash,
    token_counts,
    toxicity,
    warc,
)
from loadlens.llm.common import table, text_of

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.expr("doc_id <=> keep_id").alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op10_exact_dedup"] = f"""
WITH t AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)"""


@_query
def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents")).drop("root")


@_query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"),
    )
    c = F.col("contamination")
    return found.select(
        "doc_id",
        c["n_words"].alias("n_words"),
        c["n_hit"].alias("n_hit"),
        F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", c["items"]), 256).alias("items_sha256"),
        (c["n_hit"] > 0).alias("contaminated"),
    )


ORACLES["op5_decontamination"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
           FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
      FROM benchmark),
win AS (SELECT item_id, least(len(w), 10) AS k, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS s
        FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM win),
occ AS (SELECT doc_id, p, k, array_to_string(w[p:p + k - 1], ' ') AS s
        FROM d, sizes, unnest(range(1, len(w) - k + 2)) AS u(p) WHERE len(w) >= k),
hit AS (SELECT doc_id, p, occ.k, item_id FROM occ JOIN win ON occ.s = win.s AND occ.k = win.k),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit
      FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id),
m AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""


@_query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id",
        F.expr("coalesce(crc32(CAST(doc_id AS STRING)) % 5 = 0, false)").alias("held_out"),
        toxicity.score(model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoded_digests(docs: DataFrame) -> DataFrame:
    """What op1 and the last stage of the pipeline return of the encoded texts."""
    encoded = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id",
        F.expr("CAST(octet_length(ids) / 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))


WORDS = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 2048


@_query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = docs.select(
        "doc_id",
        F.octet_length(text_of("text")).cast("long").alias("n_bytes"),
        token_counts.token_counts(WORDS).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


@_query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", secrets.find_secrets(secrets.train(docs)).alias("found"))

    def number(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
    )


@_query
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", html_text.extract_text().alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )


@_query
def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


ORACLES["op7_warc_round_trip"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h,
                  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
d AS (SELECT *, sha1(h) AS x FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + CAST((CAST('0x' || substr(x, 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31
               AS INTEGER), 1), '' ORDER BY k) FROM range(32) AS r(k)) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d"""


#: Turns of a conversation that a task looks back over at a time.
_TURNS = 4096


def mail_thread(conversations: DataFrame) -> DataFrame:
    """Conversations as mail: each turn quotes the turn before it, and that one's quotation.

    Every row is a message. Of several rows of a turn the largest text is quoted; rows without
    conversation or turn quote nothing. A long conversation is read in blocks of turns, each with
    the two turns before it, so texts move once and no group is unbounded in turns.
    """
    rows = conversations.select("conv_id", "turn", "role", text_of("text").alias("text"))
    place = F.expr(f"pmod(turn, {_TURNS})")
    block = F.col("turn") - place
    also = F.when(place >= _TURNS - 2, F.array(block, block + _TURNS)).otherwise(F.array(block))
    spread = rows.withColumn("block", F.explode(also))
    before = Window.partitionBy("conv_id", "block").orderBy("turn")
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    for k in (1, 2):
        spread = spread.withColumn(f"text{k}", F.when(known, F.max("text").over(before.rangeBetween(-k, -k))))
    sent = spread.filter("block IS NULL OR turn >= block AND turn < block + " + str(_TURNS))
    parts = [
        F.when(F.col(f"text{k}") != "", quotes.quote(F.col(f"text{k}"), k)) for k in (2, 1)
    ]
    return sent.select("conv_id", "turn", "role", F.concat_ws("\n", *parts, "text").alias("text"))


@_query
def op3_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = mail_thread(table(spark, sf_dir, "conversations"))
    linked = quotes.conversations(quotes.link_quotations(mail, carry=["role"]), ["role", "text"])
    return linked.select(
        F.col("thread").alias("conv_id"),
        F.col("at").alias("turn"),
        "role",
        "position",
        "n_quotes",
        "n_linked",
        F.col("parent").alias("parent_turn"),
        F.col("root").alias("root_turn"),
        "depth",
        F.sha2("text", 256).alias("text_sha256"),
    )


_SPACE = "[ \\t\\n\\x0B\\f\\r]+"


def _normal_sql(text: str) -> str:
    lowered = _LOWER.replace("coalesce(text, '')", text)
    return f"trim(regexp_replace({lowered}, '{_SPACE}', ' ', 'g'))"


#: Every quotation is a whole turn, so it links to the earliest turn with that text or line.
ORACLES["op3_quotation_links"] = f"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
t AS (SELECT conv_id, turn, max(text) AS text FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
u AS (SELECT conv_id, turn, {_normal_sql("text")} AS unit FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL
      UNION ALL
      SELECT conv_id, turn, {_normal_sql("line")} FROM m, unnest(string_split(text, chr(10))) AS l(line)
      WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
first AS (SELECT conv_id, unit, min(turn) AS source FROM u WHERE unit <> '' GROUP BY ALL),
q AS (SELECT t.conv_id, t.turn, k, b.text AS quoted, f.source
      FROM t, unnest([1, 2]) AS n(k) JOIN t AS b ON b.conv_id = t.conv_id AND b.turn = t.turn - k
      LEFT JOIN first AS f ON f.conv_id = t.conv_id AND f.unit = {_normal_sql("b.text")}
      WHERE b.text <> ''),
p AS (SELECT conv_id, turn, count(*) AS n_quotes, count(source) AS n_linked,
             arg_min(source, k) FILTER (WHERE source IS NOT NULL) AS parent FROM q GROUP BY ALL),
c AS (SELECT conv_id, turn, parent, 1 AS depth FROM p WHERE parent IS NOT NULL
      UNION ALL
      SELECT c.conv_id, c.turn, p.parent, c.depth + 1 FROM c JOIN p
      ON p.conv_id = c.conv_id AND p.turn = c.parent WHERE p.parent IS NOT NULL),
r AS (SELECT conv_id, turn, arg_max(parent, depth) AS root, max(depth) AS depth FROM c GROUP BY ALL),
o AS (SELECT m.conv_id, m.turn, role, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked,
             parent AS parent_turn, coalesce(root, m.turn) AS root_turn,
             CAST(coalesce(r.depth, 0) AS BIGINT) AS depth,
             regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS own
      FROM m LEFT JOIN p USING (conv_id, turn) LEFT JOIN r USING (conv_id, turn))
SELECT * EXCLUDE (own), sha256(own) AS text_sha256,
       row_number() OVER (PARTITION BY conv_id, root_turn ORDER BY turn NULLS FIRST, role NULLS FIRST, own) AS position
FROM o"""


@_query
def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = mixing.mix_sources(table(spark, sf_dir, "documents"))
    rows = made.documents.withColumn("source", F.element_at("sources", 1))
    sources = made.sources.select("source", "source_size", "target")
    return attach_groups(rows, sources, ["source"], kept=True).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


#: A document belongs to one source, so its quota is met by whole passes and the start of one more.
ORACLES["op11_source_mix"] = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS key
           FROM documents),
s AS (SELECT source, sum(size) AS size, row_number() OVER (ORDER BY source NULLS LAST) AS n
      FROM d GROUP BY source),
w AS (SELECT *, CASE n % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS w FROM s),
b AS (SELECT *, sum(size) OVER () AS total, sum(w) OVER () AS weights,
             coalesce(sum(3 * size) OVER before, 0) AS cap_before, coalesce(sum(w) OVER before, 0) AS w_before
      FROM w WINDOW before AS (ORDER BY size * 10 / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, 3 * size * (weights - w_before) <= w * (total - cap_before) AS is_full FROM b),
r AS (SELECT *, total - coalesce(sum(3 * size) FILTER (is_full) OVER (), 0) AS remaining,
             coalesce(sum(w) FILTER (NOT is_full) OVER (), 0) AS sharing FROM f),
t AS (SELECT source, size AS source_size,
             CASE WHEN is_full THEN CAST(3 * size AS DOUBLE)
                  ELSE CAST(w * remaining AS DOUBLE) / CAST(sharing AS DOUBLE) END AS target FROM r),
q AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS quota FROM t),
x AS (SELECT d.*, q.source_size, q.target, q.quota,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY key ROWS UNBOUNDED PRECEDING) - d.size AS before
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE CAST(size * (quota // source_size) + CASE WHEN 2 * before + size < 2 * (quota % source_size)
                                                          THEN size ELSE 0 END AS BIGINT) END AS taken
FROM x"""


MODEL = public_tokenizers.path("piece_bpe_32k.model")


@_query
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = alignment.Tokenizers(RANKS, public_tokenizers.PATTERN, MODEL)
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), names)


_EMPTY_SHA256 = hashlib.sha256().hexdigest()


@_query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    made = repair.repair_conversations(repair.damaged(conversations))
    every = conversations.select("conv_id").distinct()
    digests = repair.digests(made.rows).withColumnRenamed("conv_id", "c")
    found = made.report.join(digests, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    found = found.withColumnRenamed("conv_id", "c")
    found = every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(_EMPTY_SHA256)).alias("repaired_sha256"),
    )


def _best_sql(*options: tuple[str, str, int, str]) -> str:
    """The least of (condition, state before, added cost, edit)."""
    made = [
        f"CASE WHEN {v} IS NOT NULL AND {when} THEN {{'c': {v}.c + {cost}, 'a': {v}.a || '{edit}'}} END"
        for when, v, cost, edit in options
    ]
    return f"list_min([{', '.join(made)}])"


def _row_sql(state: int, before: str, initial: str) -> str:
    """The least way to a state by the next row: deleted, kept or given another role."""
    keep = [(f"NOT r.unwanted AND r.initial = '{initial}'", v, "r.extra", "K") for v in before.split()]
    other = [("NOT r.unwanted", v, "r.extra + 1", "R") for v in before.split() if initial != "s"]
    return _best_sql(("TRUE", f"v{state}", 2, "D"), *keep, *other)


_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

#: From left to right in a recursion: the least edits that lead to each state after each row.
ORACLES["op12_conversation_repair"] = f"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: {_CRC_STEP}, n)) AS t),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
      FROM conversations),
m AS (SELECT k.*, xor(list_reduce(list_transform(string_split(key, ''), lambda x: CAST(ord(x) AS BIGINT)),
                      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind
      FROM k, tab),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM m, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS u(x)),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
             right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last_char FROM d),
f AS (SELECT *, CASE WHEN last_char = '' THEN 'blank'
                     WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                     WHEN last_char NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS two FROM n),
r AS (SELECT *, left(role, 1) AS initial, fault IN ('blank', 'duplicate') AS unwanted,
             CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra FROM f),
w AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': ''}} AS v0,
             CAST(NULL AS STRUCT(c BIGINT, a VARCHAR)) AS v1,
             {{'c': CAST(5 AS BIGINT), 'a': 'I'}} AS v2, {{'c': CAST(10 AS BIGINT), 'a': 'II'}} AS v3
      FROM r GROUP BY conv_id
      UNION ALL
      SELECT conv_id, i, n0, n1,
             {_best_sql(("TRUE", "n2", 0, ""), ("TRUE", "n0", 5, "I"), ("TRUE", "n1", 5, "I"), ("TRUE", "n3", 5, "I"))},
             {_best_sql(("TRUE", "n3", 0, ""), ("TRUE", "n2", 5, "I"), ("TRUE", "n0", 10, "II"), ("TRUE", "n1", 10, "II"))}
      FROM (SELECT w.conv_id, r.i, {_best_sql(("TRUE", "v0", 2, "D"))} AS n0, {_row_sql(1, "v0", "s")} AS n1,
                   {_row_sql(2, "v0 v1 v3", "u")} AS n2, {_row_sql(3, "v2", "a")} AS n3
            FROM w JOIN r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1)),
e AS (SELECT conv_id, arg_max(list_min([v0, v3]), i) AS best FROM w GROUP BY conv_id),
j AS (SELECT conv_id, best.a AS audit, p, best.a[p] AS edit, len(replace(best.a[:p], 'I', '')) AS i,
             len(replace(best.a[:p], 'D', '')) AS place FROM e, unnest(range(1, len(best.a) + 1)) AS u(p)),
o AS (SELECT j.*, r.role, r.text, r.initial,
             max(CASE WHEN place = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY j.conv_id) AS s
      FROM j LEFT JOIN r ON j.conv_id IS NOT DISTINCT FROM r.conv_id AND j.i = r.i AND edit <> 'I'),
h AS (SELECT conv_id, sha256(string_agg(
             CASE WHEN edit = 'K' THEN role WHEN (place - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
             CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS digest
      FROM o WHERE edit <> 'D' GROUP BY conv_id),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
LEFT JOIN g ON c.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN h ON c.conv_id IS NOT DISTINCT FROM h.conv_id"""
