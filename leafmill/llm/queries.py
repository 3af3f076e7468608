"""Queries of the subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import content, encoding, mixing, nearest, personal, repeats, spans
from leafmill.operators.ranking import distinct_texts
from leafmill.session import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "person_names")
    pages = personal.found_lines(table(spark, folder, "fetch_attempts"), "page_id", "markdown", names)
    meta = table(spark, folder, "page_meta")
    authors = personal.found_lines(meta, "meta_id", "author", names, one_line=True)
    return pages.select(F.lit("markdown").alias("src"), "rec_key", "line_no", "kind").unionByName(authors.select(F.lit("author").alias("src"), "rec_key", "line_no", "kind"))


def p1_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = distinct_texts(table(spark, folder, "fetch_attempts").where(F.col("markdown").rlike(r"\S")), ["page_id", "strategy_idx"], "markdown")
    return personal.redacted(pages, ["page_id", "strategy_idx"], ["markdown"], table(spark, folder, "person_names"))


def p1_authors(spark: SparkSession, folder: str) -> DataFrame:
    meta = table(spark, folder, "page_meta").dropDuplicates(["meta_id"])
    return personal.redacted(meta, ["meta_id"], ["author"], table(spark, folder, "person_names"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = nearest.near_duplicate_pairs(table(spark, folder, "fetch_attempts"), "page_id", "markdown")
    return pairs.select(F.col("page_a").alias("page_id_a"), F.col("page_b").alias("page_id_b"))


def p2_groups(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.near_duplicate_groups(table(spark, folder, "fetch_attempts"), "page_id", "markdown").withColumnRenamed("page", "page_id")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return content.boilerplate_lines(table(spark, folder, "fetch_attempts"), table(spark, folder, "page_trees"))


def p3_content(spark: SparkSession, folder: str) -> DataFrame:
    return content.main_content(table(spark, folder, "fetch_attempts"), table(spark, folder, "page_trees"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.repeated_lines(table(spark, folder, "fetch_attempts"), "tree_id", "page_id", "markdown")
    return found.select(F.col("page").alias("page_id"), "line_no")


def p4_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "fetch_attempts").where(F.col("markdown").rlike(r"\S"))
    return repeats.without_repeated_lines(pages, "tree_id", "page_id", "markdown")


def p4_templates(spark: SparkSession, folder: str) -> DataFrame:
    """Learnt templates that cover at least five pages of a site, with ``*`` for their slots."""
    found = repeats.slot_templates(table(spark, folder, "fetch_attempts"), "tree_id", "page_id", "markdown")
    return found.select(F.col("site").alias("tree_id"), F.replace("template", F.lit(repeats.SLOT), F.lit("*")).alias("template"), F.col("n").alias("n_lines"))


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.encode_texts(table(spark, folder, "documents"), "doc_id", "text")


def p6_decoded(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.decode_ids(p6_ids(spark, folder), "doc_id", "ids")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.found_short(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[0]


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.shares(*mixing.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets")))


def p7_curriculum(spark: SparkSession, folder: str) -> DataFrame:
    """A mix whose repeatable sources grow in weight over training while the others shrink."""
    targets = table(spark, folder, "mix_targets")
    growing, shrinking = ("array(" + ", ".join(f"named_struct('at', {t}D, 'factor', {w}D)" for t, w in plan) + ")" for plan in ([(0.0, 0.2), (0.5, 1.0), (1.0, 1.8)], [(0.0, 1.5), (1.0, 0.5)]))
    knots = F.expr(f"CASE WHEN max_repeats > 1 THEN {growing} ELSE {shrinking} END")
    return mixing.mix(table(spark, folder, "documents"), targets, targets.select("source", knots.alias("knots")))[0]


def p7_char_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares of a mix whose sizes are characters."""
    return mixing.shares(*mixing.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"), size=F.length("text")))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return spans.shared_spans(table(spark, folder, "documents"), "doc_id", "text").select(F.col("doc").alias("doc_id"), "span_start", "span_end")


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    return spans.shared_report(table(spark, folder, "documents"), "doc_id", "text").withColumnRenamed("doc", "doc_id")


QUERIES = {"p1_found": p1_found, "p1_pages": p1_pages, "p1_authors": p1_authors, "p2_found": p2_found, "p2_groups": p2_groups, "p3_found": p3_found, "p3_content": p3_content, "p4_found": p4_found, "p4_cleaned": p4_cleaned, "p4_templates": p4_templates, "p6_ids": p6_ids, "p6_decoded": p6_decoded, "p7_found": p7_found, "p7_mix": p7_mix, "p7_shares": p7_shares, "p7_curriculum": p7_curriculum, "p7_char_shares": p7_char_shares, "p8_found": p8_found, "p8_report": p8_report}

#: DuckDB: lines of a page compared in lower case with digit runs and white space runs folded.
P4_SQL = r"""
WITH lines AS (
  SELECT DISTINCT tree_id, page_id, i AS line_no,
    trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '0', 'g'), '[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g')) AS c
  FROM (SELECT tree_id, page_id, unnest(string_split(markdown, chr(10))) AS l, generate_subscripts(string_split(markdown, chr(10)), 1) AS i
        FROM fetch_attempts WHERE markdown IS NOT NULL)
), long AS (
  SELECT * FROM lines WHERE length(regexp_replace(c, '[^\p{L}\p{N}]+', '', 'g')) >= 12
), hot AS (
  SELECT tree_id, c FROM long GROUP BY tree_id, c HAVING count(DISTINCT page_id) >= 5
)
SELECT page_id, CAST(line_no AS INTEGER) AS line_no FROM long JOIN hot USING (tree_id, c)
"""

#: DuckDB: pairs of pages by the sets of their five-token runs, counted through a join on the runs.
P2_SQL = r"""
WITH p AS (SELECT DISTINCT page_id, regexp_extract_all(regexp_replace(lower(markdown), '([\x{4E00}-\x{9FFF}])', ' \1 ', 'g'), '[\p{L}\p{N}]+') AS k FROM fetch_attempts WHERE markdown IS NOT NULL AND page_id IS NOT NULL),
s AS (SELECT DISTINCT page_id, hash(array_to_string(k[i : i + 4], ' ')) AS g FROM (SELECT page_id, k, unnest(range(1, len(k) - 3)) AS i FROM p WHERE len(k) >= 5)),
n AS (SELECT page_id, count(*) AS n FROM s GROUP BY page_id),
c AS (SELECT a.page_id AS page_id_a, b.page_id AS page_id_b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.page_id < b.page_id GROUP BY 1, 2)
SELECT page_id_a, page_id_b FROM c JOIN n x ON x.page_id = page_id_a JOIN n y ON y.page_id = page_id_b WHERE c >= 0.6 * (x.n + y.n - c)
"""

#: DuckDB: every window of 250 characters by its digest, those of two documents joined into runs.
P8_SQL = r"""
WITH t AS (SELECT DISTINCT doc_id, text FROM documents WHERE length(text) >= 250),
w AS (SELECT doc_id, i, md5_number(substr(text, CAST(i AS BIGINT) + 1, 250)) AS h FROM (SELECT doc_id, text, unnest(range(0, length(text) - 249)) AS i FROM t)),
s AS (SELECT h FROM w GROUP BY h HAVING min(doc_id) < max(doc_id)),
m AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM w JOIN s USING (h)),
r AS (SELECT doc_id, i, sum(CASE WHEN i <= p + 250 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM m)
SELECT doc_id, CAST(min(i) AS INTEGER) AS span_start, CAST(max(i) + 250 AS INTEGER) AS span_end FROM r GROUP BY doc_id, k
"""

#: DuckDB: the pages without the lines of P4_SQL.
P4_CLEANED_SQL = (
    "WITH gone AS ("
    + P4_SQL
    + r"""), d AS (SELECT DISTINCT tree_id, page_id, markdown FROM fetch_attempts WHERE regexp_matches(markdown, '\S')),
l AS (SELECT tree_id, page_id, unnest(string_split(markdown, chr(10))) AS l, generate_subscripts(string_split(markdown, chr(10)), 1) AS line_no FROM d)
SELECT tree_id, page_id, coalesce(string_agg(l.l, chr(10) ORDER BY line_no) FILTER (g.line_no IS NULL), '') AS markdown FROM l LEFT JOIN gone g USING (page_id, line_no) GROUP BY tree_id, page_id"""
)

#: DuckDB: the mix's shares with characters for tokens; documents come in the order of their ids' digests.
P7_CHARS_SQL = """
WITH g AS (SELECT source, max(coalesce(target_weight, 0)) AS target_weight, max(coalesce(max_repeats, 0)) AS max_repeats FROM mix_targets WHERE source IS NOT NULL GROUP BY source),
d AS (SELECT doc_id, source, coalesce(length(text), 0) AS n, md5(CAST(doc_id AS VARCHAR)) AS k FROM documents WHERE source IN (SELECT source FROM g)),
r AS (SELECT *, sum(size) OVER () AS budget FROM (SELECT g.*, coalesce((SELECT sum(n) FROM d WHERE d.source = g.source), 0) AS size FROM g)),
c AS (SELECT d.source, d.n, r.size, r.max_repeats, r.target_weight * r.budget AS demand, coalesce(sum(d.n) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
      FROM d JOIN r ON d.source = r.source WHERE d.n > 0),
u AS (SELECT source, sum(n * m) AS used_tokens, sum(m) AS n_copies, max(m) AS repeats FROM (SELECT source, n, greatest(0, least(max_repeats, ceil((demand - first) / size))) AS m FROM c WHERE demand > 0) GROUP BY source)
SELECT r.source, r.target_weight, r.max_repeats, CAST(r.size AS BIGINT) AS size, CAST(r.budget AS BIGINT) AS budget, r.max_repeats * r.size < r.target_weight * r.budget AS is_short, CAST(coalesce(used_tokens, 0) AS BIGINT) AS used_tokens,
  CAST(coalesce(n_copies, 0) AS BIGINT) AS n_copies, CAST(coalesce(repeats, 0) AS INTEGER) AS repeats, coalesce(used_tokens, 0) / sum(coalesce(used_tokens, 0)) OVER () AS actual_share FROM r LEFT JOIN u ON u.source = r.source
"""

ORACLES = {"p2_found": P2_SQL, "p4_found": P4_SQL, "p4_cleaned": P4_CLEANED_SQL, "p7_char_shares": P7_CHARS_SQL, "p8_found": P8_SQL}
