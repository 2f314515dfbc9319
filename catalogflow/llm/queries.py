"""The operators of this folder over the given tables, and the SQL that gives the same rows."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.llm import (
    bag_minhash,
    fertility,
    html_text,
    language_id,
    line_templates,
    mixture_packing,
    pair_bpe,
    periodic_runs,
    substring_dedup,
    token_automaton,
    tool_links,
    turn_alignment,
    wu_manber,
)

#: The folder of the public tokenizers' files.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary(name: str) -> str:
    return f"{TOKENIZERS}/{name}"


@query()
def op1_language_family(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.identify(table(spark, sf, "documents"))


@query(r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT doc_id, i, hash(array_to_string(w[i:i + 34], ' ')) AS h, md5(array_to_string(w[i:i + 34], ' ')) AS m
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), r AS (
  SELECT doc_id, i FROM s JOIN (SELECT h, m FROM s GROUP BY h, m HAVING count(*) > 1) USING (h, m)
), g AS (
  SELECT doc_id, list(DISTINCT k) AS gone
  FROM (SELECT doc_id, unnest(range(i, i + 35)) AS k FROM r) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
              ELSE array_to_string(list_transform(list_sort(list_filter(range(1, len(w) + 1),
                   lambda i : NOT list_contains(gone, i))), lambda i : w[i]), ' ') END) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)""")
def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf, "documents"), with_text=False)


@query()
def op3_html_crf(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.main_text(table(spark, sf, "pages"), keep=("url",))


@query()
def op4_bag_minhash(spark: SparkSession, sf: str) -> DataFrame:
    found = bag_minhash.classes(table(spark, sf, "documents"))
    return found.select("doc_id", "class_id", "class_size")


@query()
def op5_pair_index_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return pair_bpe.digests(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"))


#: Schemas of the tools that conversations may call.
TOOLS = {
    "search": {
        "type": "object",
        "required": ["query"],
        "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1}},
        "additionalProperties": False,
    },
}


@query("""
SELECT conv_id, turn, turn AS order_turn, CAST(0 AS INTEGER) AS order_level, role,
       '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":'
       || CAST(to_json(role) AS VARCHAR) || '}' AS message,
       CAST(0 AS BIGINT) AS n_calls, CAST(0 AS BIGINT) AS n_answered,
       CAST(0 AS BIGINT) AS n_invalid, 'text' AS status
FROM conversations""")
def op6_tool_links(spark: SparkSession, sf: str) -> DataFrame:
    return tool_links.format_turns(table(spark, sf, "conversations"), TOOLS)


@query()
def op7_fertility(spark: SparkSession, sf: str) -> DataFrame:
    return fertility.judge(table(spark, sf, "documents"), vocabulary("piece_bpe_32k.model"))


@query(line_templates.digest_sql())
def op8_line_templates(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_templates.drop_lines(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_WORDS = r"regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(rf"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM
             (SELECT doc_id, {_LOWER} AS lower_az FROM documents)),
b AS (SELECT item_id, {_WORDS} AS w FROM (SELECT item_id, {_LOWER} AS lower_az FROM benchmark)),
bw AS (
  SELECT DISTINCT item_id, len(w[i:i + 9]) AS size, array_to_string(w[i:i + 9], ' ') AS pattern
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS pattern
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d), sizes
  WHERE i + size - 1 <= len(w)
),
hits AS (SELECT doc_id, i, bw.size, item_id FROM dw JOIN bw USING (size, pattern)),
words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM hits) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits
        WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op9_wu_manber(spark: SparkSession, sf: str) -> DataFrame:
    return wu_manber.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query()
def op10_token_automaton(spark: SparkSession, sf: str) -> DataFrame:
    return token_automaton.token_counts(
        table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"), limit=2048
    )


@query()
def op11_mixture_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = mixture_packing.pack(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def _made_periodic(docs: DataFrame) -> DataFrame:
    """Every document whose hash of its id ends in 0 repeats a stretch of its words up to its end.

    A null id has no hash; its document stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    spread = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, words)
    )
    placed = spread.withColumns({"g": F.expr("h div 10"), "n": F.size("words").cast("bigint")})
    placed = placed.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))

    def source(i):
        i = i.cast("bigint")
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))

    made = F.transform("words", lambda w, i: F.get("words", source(i).cast("int")))
    text = F.when(F.col("a").isNotNull(), F.array_join(made, " ")).otherwise(F.col("text"))
    return placed.select("doc_id", text.alias("text"))


@query()
def op12_scale_tiles(spark: SparkSession, sf: str) -> DataFrame:
    docs = _made_periodic(table(spark, sf, "documents"))
    found = periodic_runs.collapse_runs(docs, with_text=False)
    best = periodic_runs.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    exponent = F.expr("1000 * best.length div best.period")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        exponent.alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.col("kept_sha256").alias("collapsed_sha256"),
    )


def _damaged(turns: DataFrame) -> DataFrame:
    """The conversations with turns dropped, emptied, cut, repeated and given to the user."""
    space = F.lit(" ")
    number = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *number)) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    emptied = F.when(F.col("kind") == 1, "").when(
        F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")
    )
    copies = F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))
    return (
        turns.withColumn("kind", kind)
        .where("kind != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"),
            emptied.otherwise(text).alias("text"),
            F.explode(copies).alias("copy"),
        )
        .drop("copy")
    )


#: CRC-32 of an ASCII text, bit by bit (fixed value: the reversed polynomial).
_CRC32 = """xor(list_reduce(list_transform(string_split({}, ''), lambda c: CAST(ascii(c) AS BIGINT)),
  lambda crc, b: list_reduce([CAST(i AS BIGINT) FOR i IN range(8)],
    lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)),
  CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"""

_DAMAGED_SQL = f"""
SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
    ELSE coalesce(text, ' ') END AS text
FROM (
  SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM (SELECT *, {_CRC32.format(
    "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
  )} % 20 AS kind FROM conversations)
)"""


@query(turn_alignment.digest_sql(_DAMAGED_SQL))
def op13_turn_alignment(spark: SparkSession, sf: str) -> DataFrame:
    conversations = table(spark, sf, "conversations")
    found = turn_alignment.repair(_damaged(conversations))
    audits, hashes = (
        f.withColumnRenamed("conv_id", c)
        for f, c in ((found.audits, "_audited"), (found.hashes(), "_hashed"))
    )
    every = conversations.select("conv_id").distinct()
    joined = every.join(audits, F.col("conv_id").eqNullSafe(F.col("_audited")), "left").join(
        hashes, F.col("conv_id").eqNullSafe(F.col("_hashed")), "left"
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
