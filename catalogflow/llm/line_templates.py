"""Line dedup by a log-template tree, in DataFrame functions only.

The tree has a fixed depth: a line goes by its number of tokens, then by its first ``LEAD``
tokens, to a leaf. Tokens with a digit are variable fields (``<*>``) from the start. Within a
leaf the remaining positions are generalised: a position keeps the token that most documents
have there and becomes ``<*>`` where no token has half of them. A line belongs to the leaf's
template if enough of its tokens equal the template's. A template that recurs in enough
documents is dropped from all of them but the first, which keeps the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.llm.blocks import id_and_text
from catalogflow.session import materialize

#: Leading tokens on the path to a leaf.
LEAD = 3
#: Shorter lines are never dropped.
MIN_TOKENS = 3
#: A template recurs if it is found in so many documents.
MIN_DOCS = 10
#: The share of a line's tokens that must equal the template's.
SIMILARITY = 0.7
#: With so many tokens without a digit, a line is long: it recurs from two documents on.
LONG_TOKENS = 20
#: A document that shares so much of its text with one other, line by line, is a copy of it.
COPY_SHARE = 0.4
WILD = "<*>"


def _bound(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """``frame`` with a column whose value is made once, however often it is used later.

    A generator keeps the optimizer from copying the expression into each of its uses.
    """
    return frame.select("*", F.explode(F.array(value)).alias(name))


def _lines(rows: DataFrame, min_tokens: int, lead: int) -> DataFrame:
    """Every line that may be dropped: id, v, number, leaf, variant and the masked line.

    A masked line has one space between tokens and ``<*>`` for each token that holds a digit.
    """
    more = [c for c in ("size",) if c in rows.columns]
    raw = rows.select("id", "v", *more, F.posexplode(F.split("text", "\n")).alias("number", "raw"))
    odd = F.lit(False)
    for space in ("  ", "\t", "\r", "\x0b", "\x0c"):
        odd |= F.contains("raw", F.lit(space))
    spaced = F.when(odd, F.regexp_replace("raw", r"[\x20\x09-\x0D]+", " ")).otherwise(F.col("raw"))
    lines = _bound(raw, "spaced", F.trim(spaced)).drop("raw")
    digits = F.regexp_replace("spaced", "[^ ]*[0-9][^ ]*", WILD)
    masked = F.when(F.col("spaced").rlike("[0-9]"), digits).otherwise(F.col("spaced"))
    lines = _bound(lines, "line", masked).drop("spaced")
    gaps = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit("")))
    lines = _bound(lines, "n", F.when(F.col("line") == "", 0).otherwise(gaps + 1))
    return lines.where(F.col("n") >= min_tokens).select(
        "id",
        "v",
        "number",
        F.xxhash64("n", F.substring_index("line", " ", lead)).alias("leaf"),
        F.xxhash64("line").alias("variant"),
        "line",
        "n",
        *more,
    )


def recurring(
    rows: DataFrame,
    min_docs: int = MIN_DOCS,
    min_tokens: int = MIN_TOKENS,
    similarity: float = SIMILARITY,
    lead: int = LEAD,
) -> tuple[DataFrame, DataFrame]:
    """The lines in leaves that may hold a recurring template, and the variants to drop.

    ``rows`` has id, text and v, a hash of the text.

    The second frame has leaf, variant and ``keep``, the id of the document that keeps its
    lines: the lowest among those with the template.
    """
    lines = _lines(rows, min_tokens, lead).drop("n")
    leaves = materialize(
        lines.groupBy("leaf").count().where(F.col("count") >= min_docs).select("leaf"), "leaves"
    )
    near = materialize(lines.join(leaves, "leaf"), "near")
    variants = materialize(
        near.groupBy("leaf", "variant").agg(
            F.countDistinct("id").alias("docs"),
            F.min("id").alias("first"),
            F.min("line").alias("line"),
        ),
        "variants",
    )
    # The token of most documents at each position; ties go to the greater token.
    tokens = variants.select("leaf", "docs", F.posexplode(F.split("line", " ")).alias("at", "token"))
    at = (
        tokens.groupBy("leaf", "at", "token")
        .agg(F.sum("docs").alias("docs"))
        .groupBy("leaf", "at")
        .agg(F.max(F.struct("docs", "token")).alias("most"), F.sum("docs").alias("all"))
        .select(
            "leaf",
            "at",
            F.when(F.col("most.docs") * 2 >= F.col("all"), F.col("most.token"))
            .otherwise(F.lit(WILD))
            .alias("token"),
        )
    )
    templates = at.groupBy("leaf").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "token"))), lambda x: x["token"])
        .alias("template")
    )
    own = F.split("line", " ")
    equal = F.size(F.filter(F.zip_with(own, "template", lambda a, b: a == b), lambda x: x))
    judged = variants.join(templates, "leaf").select(
        "leaf",
        "variant",
        "docs",
        "first",
        (equal >= F.size(own) * F.lit(similarity)).alias("member"),
    )
    judged = materialize(judged, "judged")
    whole = (
        judged.where("member")
        .groupBy("leaf")
        .agg(F.sum("docs").alias("all_docs"), F.min("first").alias("all_first"))
        .where(F.col("all_docs") >= min_docs)
    )
    general = F.col("member") & F.col("all_docs").isNotNull()
    drop = (
        judged.join(whole, "leaf", "left")
        .where(general | (F.col("docs") >= min_docs))
        .select(
            "leaf", "variant", F.when(general, F.col("all_first")).otherwise(F.col("first")).alias("keep")
        )
    )
    return near, materialize(drop, "drop")


def repeated(rows: DataFrame, long_tokens: int) -> DataFrame:
    """id, v and number of each long line that a document with a lower id has too, up to digits."""
    fields = F.size(F.split("line", WILD, -1)) - 1
    lines = _lines(rows, long_tokens, LEAD).where(F.col("n") - fields >= long_tokens)
    more = [F.length("line").alias("chars"), "size"] if "size" in rows.columns else []
    lines = materialize(lines.select("id", "v", "number", "leaf", "variant", *more), "long")
    first = lines.groupBy("leaf", "variant").agg(F.min("id").alias("keep"), F.max("id").alias("last"))
    first = first.where("keep <> last").drop("last")
    found = lines.join(first, ["leaf", "variant"]).where("id <> keep")
    return found.select("id", "v", "number", *(["keep", "chars", "size"] if more else []))


def not_copied(gone: DataFrame, copy_share: float) -> DataFrame:
    """The lines of ``gone`` without those of copies: id, v and number.

    A document is taken for a copy of another one if the lines that it would lose because that one
    keeps them make up ``copy_share`` of its characters.
    """
    once = gone.groupBy("id", "v", "number", "size").agg(
        F.min("keep").alias("keep"), F.max("chars").alias("chars")
    )
    lost = F.sum(F.col("chars") + 1).over(Window.partitionBy("id", "v", "keep"))
    return once.withColumn("lost", lost).where(F.col("lost") < F.col("size") * copy_share).select("id", "v", "number")


def drop_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    long_tokens: int | None = None,
    copy_share: float | None = None,
    **settings,
) -> DataFrame:
    """``docs`` without recurring lines: all columns, the text replaced by the lines that stay.

    Added columns: ``n_lines`` and ``n_dropped``. A template in ``min_docs`` documents or more
    stays in the one with the lowest id only; so does, if ``long_tokens`` is given, a line of so
    many tokens without a digit that two documents or more have. If ``copy_share`` is given, a
    document that would lose this share of its characters or more to one other document keeps those
    lines: it is a copy, and cut to what was changed no near-duplicate search would find it. Lines of fewer than ``min_tokens`` tokens always
    stay. A null text stays null (0 lines), an empty one stays empty (1 line). Rows with the
    same id count as one document; rows with a null id lose no line.
    Columns of ``docs`` named like the added ones are replaced.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("v", F.xxhash64("text"))
    more = []
    if copy_share is not None:
        rows = rows.withColumn("size", F.length("text"))
        more = ["keep", F.length("line").alias("chars"), "size"]
    near, drop = recurring(rows.where("id is not null"), **settings)
    gone = near.join(drop, ["leaf", "variant"]).where(F.col("id") != F.col("keep"))
    gone = gone.select("id", "v", "number", *more)
    if long_tokens is not None:
        gone = gone.unionByName(repeated(rows.where("id is not null"), long_tokens))
    if copy_share is not None:
        gone = not_copied(gone, copy_share)
    gone = (
        gone.groupBy(F.col("id").alias("gone_id"), F.col("v").alias("gone_v"))
        .agg(F.collect_set("number").alias("gone"))
    )
    # As one column, the row's own names cannot clash with those of the join.
    whole = docs.select(F.struct("*").alias("row"))
    own_id, text = F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`")
    joined = whole.join(
        gone, (own_id == F.col("gone_id")) & (F.xxhash64(text) == F.col("gone_v")), "left"
    )
    stay = F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains("gone", i))
    kept = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(stay, "\n"))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return joined.select(
        *[
            kept.alias(c) if c == text_col else F.col(f"row.`{c}`")
            for c in docs.columns
            if c not in ("n_lines", "n_dropped")
        ],
        F.coalesce(breaks + 1, F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


def digest_sql(
    min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, similarity: float = SIMILARITY
) -> str:
    """DuckDB SQL for doc_id, n_lines, n_dropped and kept_sha256 of ``documents``."""
    return rf"""
WITH l AS (
  SELECT doc_id, i AS line_no, string_split(text, chr(10))[i] AS raw
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
        FROM documents WHERE text IS NOT NULL)
), m AS (
  SELECT doc_id, line_no, raw, regexp_replace(trim(regexp_replace(raw, '[\x20\x09-\x0D]+', ' ', 'g')),
         '[^ ]*[0-9][^ ]*', '<*>', 'g') AS line FROM l
), t AS (
  SELECT *, CASE WHEN line = '' THEN [] ELSE string_split(line, ' ') END AS tokens FROM m
), c AS (
  SELECT *, (len(tokens), tokens[1:{LEAD}]) AS leaf FROM t
  WHERE len(tokens) >= {min_tokens} AND doc_id IS NOT NULL
), v AS (
  SELECT leaf, line, tokens, count(DISTINCT doc_id) AS docs, min(doc_id) AS first
  FROM c WHERE leaf IN (SELECT leaf FROM c GROUP BY leaf HAVING count(*) >= {min_docs})
  GROUP BY leaf, line, tokens
), p AS (
  SELECT leaf, i AS pos, tokens[i] AS token, sum(docs) AS docs
  FROM (SELECT leaf, docs, tokens, unnest(range(1, len(tokens) + 1)) AS i FROM v) GROUP BY ALL
), g AS (
  SELECT leaf, list(token ORDER BY pos) AS template FROM (
    SELECT leaf, pos, CASE WHEN max(docs) * 2 >= sum(docs)
           THEN arg_max(token, (docs, token)) ELSE '<*>' END AS token
    FROM p GROUP BY leaf, pos) GROUP BY leaf
), j AS (
  SELECT v.*, len(list_filter(range(1, len(tokens) + 1), lambda i : tokens[i] = template[i]))
              >= len(tokens) * {similarity} AS member
  FROM v JOIN g USING (leaf)
), w AS (
  SELECT leaf, sum(docs) AS all_docs, min(first) AS all_first FROM j WHERE member
  GROUP BY leaf HAVING sum(docs) >= {min_docs}
), d AS (
  SELECT j.leaf, j.line, CASE WHEN member AND all_docs IS NOT NULL THEN all_first ELSE first END AS keep
  FROM j LEFT JOIN w USING (leaf)
  WHERE (member AND all_docs IS NOT NULL) OR docs >= {min_docs}
), gone AS (
  SELECT DISTINCT doc_id, line FROM c JOIN d USING (leaf, line) WHERE doc_id <> keep
), k AS (
  SELECT doc_id, count(*) AS n_lines, count(gone.line) AS n_dropped,
         coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (gone.line IS NULL), '') AS kept
  FROM t LEFT JOIN gone USING (doc_id, line) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       CASE WHEN documents.text IS NOT NULL THEN sha256(kept) END AS kept_sha256
FROM documents LEFT JOIN k USING (doc_id)"""
