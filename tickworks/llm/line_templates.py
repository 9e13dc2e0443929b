"""Line dedup by a log-template tree, in DataFrame functions only.

Every line walks a tree of fixed depth: its token count, then its ``DEPTH``
leading tokens. Tokens with a digit are variable fields and stand as ``<*>``.
In the leaf, the tokens after the leading ones are cut into ``PARTS`` runs, and
a line belongs to one template for each pair of runs, which stand open as ``<*>``.
So lines that differ in any two fields, wherever these are, share a template;
more fields may lie in the two runs. Lines under ``OPEN_TOKENS`` constant tokens, or with so
many variable ones that an open pair might leave under ``LEAST_TOKENS`` constant,
only have the template without an open run.

A template that occurs in two or more documents recurs. One with under
``LEAST_TOKENS`` constant tokens must stand in ``SHORT_DOCS`` documents or more, and more often than chance makes it:

- with two or more constant tokens: in one document of ``SHORT_SHARE`` or more, and in ``LIFT``
  times as many as expected of the other short lines of its token count (and one more) if their tokens were
  drawn one by one, place by place;
- with one: in one document of ``COMMON_SHARE`` or more, as nothing else tells
  a heading from a word that happens to stand alone;
- with none (only variable fields): never.

Lines of a recurring template stay in its first document (smallest id, then smallest text hash)
and are dropped from all others; ``keep_first=False`` drops them everywhere. Repeats
inside one document are left alone. Lines are parted by ``\n``; dropped lines go with one
separator, the others keep their bytes and order.

Hot templates: a document counts once per template before any exchange of rows
(first and last combine map-side), and only templates that recur are
joined back, a join that adaptive execution may split.

Nulls: a null text has no lines and stays null. A null id sorts last as owner.
Rows with equal id and text are one document: their lines are not dropped for
each other's sake. Empty texts stay. Other columns are carried through by
``drop_recurring_lines`` whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

DEPTH, PARTS = 2, 4
LEAST_TOKENS, OPEN_TOKENS = 5, 12
SHORT_DOCS, SHORT_SHARE, LIFT, COMMON_SHARE = 3, 10_000, 8, 20


def hashes(*parts: Column) -> Column:
    return F.struct(F.xxhash64(*parts).alias("h"), F.hash(*parts).alias("g"))


def closed_key(m: Column) -> Column:
    """Key of the template without an open run: two hashes, 96 bits."""
    return hashes(F.size(m), F.lit(-1), m)


def line_marks(line: Column) -> Column:
    """(marks, short) of one line: what its keys are made of, see ``keys_of``; the tokens of a line that needs to beat chance.

    Marks are one hash of the token count and leading tokens and one of each run; or both
    hashes of the key, if the line has no open template; or none.
    """
    variable = F.when(line.rlike("[0-9]"), F.regexp_replace(line, "[^ \t\r]*[0-9][^ \t\r]*", "<*>")).otherwise(line)

    def of(m: Column) -> Column:
        n = F.size(m)
        constant = F.when(F.array_contains(m, "<*>"), F.size(F.array_remove(m, "<*>"))).otherwise(n)

        def bound(k: int) -> Column:
            return DEPTH + F.floor((n - DEPTH) * k / PARTS).cast("int")

        closed = closed_key(m)
        open_size = 2 * F.ceil((n - DEPTH) / PARTS)
        marks = (F.when(constant < 1, F.array().cast("array<bigint>"))
                 .when((constant < OPEN_TOKENS) | (constant - open_size < LEAST_TOKENS),
                       F.array(closed["h"], closed["g"].cast("bigint")))
                 .otherwise(F.array(F.xxhash64(n, F.slice(m, 1, DEPTH)),
                                    *[F.xxhash64(F.slice(m, bound(k) + 1, bound(k + 1) - bound(k))) for k in range(PARTS)])))
        return F.struct(marks.alias("marks"), F.when((constant > 0) & (constant < LEAST_TOKENS), m).alias("short"))

    # a one-element transform computes the tokens once
    return F.transform(F.array(F.array_remove(F.split(variable, "[ \t\r]+"), "")), of)[0]


def keys_of(marks: Column) -> Column:
    """The keys of a line's templates: one for each pair of open runs, or the one without."""
    pairs = [hashes(F.lit(PARTS * a + b), marks[0], *[marks[k + 1] for k in range(PARTS) if k not in (a, b)])
             for a, b in combinations(range(PARTS), 2)]
    return (F.when(F.size(marks) == PARTS + 1, F.array(*pairs))
            .when(F.size(marks) == 2, F.array(F.struct(marks[0].alias("h"), marks[1].cast("int").alias("g"))))
            .otherwise(F.array().cast("array<struct<h:bigint,g:int>>")))


def chance_templates(lines: DataFrame) -> DataFrame:
    """(h, g) of the short templates that two documents or more hold and chance explains.

    Works on distinct short lines and their counts of documents.
    """
    n_docs = lines.count()
    seen = (lines.select("_doc", "_text", F.explode(F.array_distinct("_lines.short")).alias("m")).where("m is not null")
            .groupBy("m").agg(F.count_distinct(F.struct("_doc", "_text")).alias("docs")))
    seen = stored(seen.select("m", "docs", F.size("m").alias("n")), "line-short")
    of_count = seen.groupBy("n").agg(F.sum("docs").alias("of_n"))
    at = seen.select("m", "docs", "n", F.posexplode("m").alias("place", "token")).where("token <> '<*>'")
    of_token = at.groupBy("n", "place", "token").agg(F.sum("docs").alias("of_token"))
    others = F.col("of_n") - F.col("docs") + 1
    share = (F.col("of_token") - F.col("docs") + 1) / others
    judged = (at.where("docs > 1").join(of_token, ["n", "place", "token"]).join(of_count, "n")
              .groupBy("m").agg(F.first("docs").alias("docs"), F.first(others).alias("others"), F.count("*").alias("constant"),
                                F.sum(F.ln(share)).alias("ln_share")))
    docs = F.col("docs")
    beyond = (docs >= SHORT_DOCS) & F.when(F.col("constant") == 1, docs * COMMON_SHARE >= n_docs).otherwise(
        (docs * SHORT_SHARE >= n_docs) & (docs >= LIFT * F.col("others") * F.exp("ln_share")))
    return judged.where(~beyond).select(closed_key(F.col("m")).alias("key")).select("key.h", "key.g")


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    keep_first: bool = True) -> DataFrame:
    """(_doc, _text, _drop): by document, places (from 0) of the lines to drop."""
    rows = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("_doc"), F.xxhash64(text_col).alias("_text"), F.col(text_col).alias("_body"))
    lines = stored(rows.select(F.monotonically_increasing_id().alias("_row"), "_doc", "_text",
                               F.transform(F.split("_body", "\n", -1), line_marks).alias("_lines")), "line-marks")
    owner = F.struct(F.col("_doc").isNull().alias("no_id"), F.col("_doc").alias("id"), F.col("_text").alias("text"))
    at = (lines.select("_row", "_doc", "_text", F.posexplode("_lines.marks").alias("_line", "_marks"))
          .select("_row", "_doc", "_text", "_line", F.explode(keys_of(F.col("_marks"))).alias("key"))
          .select("_row", "_doc", "_text", "_line", "key.h", "key.g"))
    # a template is in two documents when its first and last differ; where the first keeps its lines,
    # one that repeats inside a document drops nothing, so a count will do, which is less to move
    heads = at.groupBy("h", "g").agg(F.min(owner).alias("first"),
                                     (F.count("*") > 1 if keep_first else F.min(owner) != F.max(owner)).alias("recurs"))
    heads = heads.where("recurs").drop("recurs").join(chance_templates(lines), ["h", "g"], "left_anti")
    # rows travel by number; their ids and text hashes are looked up for the lines that recur only
    hit = at.select("_row", "_line", "h", "g").join(heads, ["h", "g"]).select("_row", "_line", "first")
    hit = hit.join(lines.select("_row", "_doc", "_text"), "_row")
    if keep_first:
        hit = hit.where(~F.col("first").eqNullSafe(owner))
    return hit.groupBy("_doc", "_text").agg(F.collect_set("_line").alias("_drop"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         keep_first: bool = True) -> DataFrame:
    """``docs`` with the text column rebuilt from the lines that stay, plus n_lines and n_dropped."""
    drops = stored(recurring_lines(docs, id_col, text_col, keep_first), "line-drops").select(
        F.col("_doc").alias("_drop_doc"), F.col("_text").alias("_drop_text"), "_drop")
    body = F.split(F.col(text_col), "\n", -1)
    # array_except goes by a hash set and keeps order: linear in the lines of a text
    places = F.array_except(F.sequence(F.lit(0), F.size(body) - 1), "_drop")
    rebuilt = F.transform(F.array(body), lambda b: F.array_join(F.transform(places, lambda i: b[i]), "\n"))[0]
    kept = F.when(F.col("_drop").isNull(), F.col(text_col)).otherwise(rebuilt)
    joined = docs.join(drops, F.col(id_col).eqNullSafe(F.col("_drop_doc"))
                       & F.xxhash64(text_col).eqNullSafe(F.col("_drop_text")) & F.col(text_col).isNotNull(), "left")
    others = [F.col(f"`{c}`") if c != text_col else kept.alias(text_col) for c in docs.columns]
    return joined.select(*others, F.coalesce(F.size(body), F.lit(0)).alias("_n_lines"),
                         F.coalesce(F.size("_drop"), F.lit(0)).alias("_n_dropped"))


def document_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, text)."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return drop_recurring_lines(slim, "doc_id", "text").select(
        "doc_id", F.col("_n_lines").cast("bigint").alias("n_lines"),
        F.col("_n_dropped").cast("bigint").alias("n_dropped"), "text")


#: The same rows in SQL, on the template strings themselves.
ORACLE_SQL = rf"""
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS body FROM documents),
one AS (
  SELECT doc_id, text, unnest(body) AS line, unnest(range(len(body))) AS place FROM lines WHERE text IS NOT NULL),
masked AS (
  SELECT doc_id, text, place, list_transform(
    list_filter(regexp_split_to_array(line, '[ \t\r]+'), lambda t: t <> ''),
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS m FROM one),
sized AS (
  SELECT *, len(m) AS n, len(list_filter(m, lambda t: t <> '<*>')) AS c FROM masked),
may AS (
  SELECT *, c >= {OPEN_TOKENS} AND c - 2 * CAST(ceil((n - {DEPTH}) / {PARTS}) AS BIGINT) >= {LEAST_TOKENS} AS may_open
  FROM sized WHERE c > 0),
runs AS (
  SELECT doc_id, place, n, m[1:{DEPTH}] AS lead, list_transform(range({PARTS}), lambda k: array_to_string(
    m[{DEPTH} + (n - {DEPTH}) * k // {PARTS} + 1:{DEPTH} + (n - {DEPTH}) * (k + 1) // {PARTS}], ' ')) AS r
  FROM may WHERE may_open),
keys AS (
  SELECT doc_id, place, n || ' - ' || array_to_string(m, ' ') AS tmpl FROM may WHERE NOT may_open
  UNION ALL
  SELECT doc_id, place, n || ' ' || a.k || b.k || ' ' || array_to_string(lead, ' ') || chr(10) || array_to_string(
    list_transform(range({PARTS}), lambda k: CASE WHEN k IN (a.k, b.k) THEN '<*>' ELSE r[k + 1] END), chr(10))
  FROM runs, range({PARTS}) a(k), range({PARTS}) b(k) WHERE a.k < b.k),
short AS (
  SELECT m, any_value(n) AS n, any_value(c) AS c, count(DISTINCT doc_id) AS docs FROM may WHERE c < {LEAST_TOKENS} GROUP BY m),
of_count AS (SELECT n, sum(docs) AS of_n FROM short GROUP BY n),
spots AS (SELECT m, n, docs, unnest(m) AS token, unnest(range(n)) AS at_place FROM short),
of_token AS (SELECT n, at_place, token, sum(docs) AS of_token FROM spots GROUP BY n, at_place, token),
likely AS (
  SELECT a.m, sum(ln((t.of_token - a.docs + 1) / (o.of_n - a.docs + 1))) AS ln_share
  FROM spots a JOIN of_token t USING (n, at_place, token) JOIN of_count o USING (n) WHERE token <> '<*>' GROUP BY a.m),
chance AS (
  SELECT s.n || ' - ' || array_to_string(s.m, ' ') AS tmpl
  FROM short s JOIN likely USING (m) JOIN of_count USING (n), (SELECT count(text) AS n_docs FROM documents) d
  WHERE s.docs < {SHORT_DOCS} OR NOT CASE WHEN s.c = 1 THEN s.docs * {COMMON_SHARE} >= n_docs
    ELSE s.docs * {SHORT_SHARE} >= n_docs AND s.docs >= {LIFT} * (of_n - s.docs + 1) * exp(ln_share) END),
heads AS (
  SELECT tmpl, min(doc_id) AS first FROM keys WHERE tmpl NOT IN (SELECT tmpl FROM chance)
  GROUP BY tmpl HAVING count(DISTINCT doc_id) >= 2),
hits AS (SELECT DISTINCT doc_id, place FROM keys JOIN heads USING (tmpl) WHERE doc_id <> first),
kept AS (
  SELECT o.doc_id, string_agg(o.line, chr(10) ORDER BY o.place) AS text
  FROM one o ANTI JOIN hits h ON o.doc_id = h.doc_id AND o.place = h.place GROUP BY o.doc_id),
dropped AS (SELECT doc_id, count(*) AS n_dropped FROM hits GROUP BY doc_id)
SELECT l.doc_id, CAST(len(l.body) AS BIGINT) AS n_lines, CAST(coalesce(d.n_dropped, 0) AS BIGINT) AS n_dropped,
       CASE WHEN l.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM lines l LEFT JOIN kept k USING (doc_id) LEFT JOIN dropped d USING (doc_id)
"""
