"""License scans by canonical digests.

A text is brought to a canonical form: lower case, copyright lines (a copyright word or sign with a year, a sign or a
holder in brackets) removed, every run of white space and punctuation one space, equivalent spellings made one. The
digest of an entire canonical text is joined with those of the known licences (``known_licenses``), a list of fixed
size that is broadcast. Entire texts are a document as a whole, its paragraphs (between empty lines) and its lines.

Defined cases: null and empty texts hold no licence; a unit without words is no unit; rows of equal doc_id and text,
repeated or of null doc_id, get equal results; extra columns are ignored. Texts are normalised where they lie; only
the ids of hits are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan.llm.known_licenses import EQUAL_WORDS, TEXTS

COPYRIGHT = r"(?m)^[^a-z0-9\n]*(?:copyright|\(c\)|©)[ \t]+(?:\(c\)|©|[0-9]{4}|<year>|\[year\]|\[yyyy\])[^\n]*$"
#: ASCII without digits and letters, and the typographic marks of texts that were set.
PUNCTUATION = "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "“”‘’–—•© "


#: The empty lines between paragraphs, and the mark that stands for one (punctuation, so in no canonical text).
EMPTY_LINE, MARK = r"\n[ \t\r]*\n", "\v"
#: PUNCTUATION but for line feeds and marks: what a class of single bytes holds, which is quick, and the rest.
INSIDE_LINES = "".join(f"\\x{c:02X}" for c in range(256) if c not in b"\n\v" and (c < 128 and not chr(c).isalnum() or chr(c) in "©\u00a0"))
WIDE = "“”‘’–—•"


def _spelled(plain: Column) -> Column:
    """Equivalent spellings made one, in words that are separated by one space each."""
    plain = F.concat(F.lit(" "), plain, F.lit(" "))
    for old, new in EQUAL_WORDS:
        plain = F.replace(plain, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(plain)


def canonical(text: Column) -> Column:
    return _spelled(F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT, ""), f"[{PUNCTUATION}]+", " "))


def plain_lines(text: Column) -> Column:
    """The text with every run of white space and punctuation inside a line one space, copyright lines too, and a line of
    MARK where an empty line separates paragraphs; it has as many lines as the text."""
    low = F.lower(text)
    for c in (MARK, *WIDE):
        low = F.replace(low, F.lit(c), F.lit("."))
    marked = F.regexp_replace(F.regexp_replace(low, COPYRIGHT, "."), EMPTY_LINE, f"\n{MARK}\n")
    return F.regexp_replace(marked, f"[{INSIDE_LINES}]+", " ")


def _one_line(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, f" ?[\n{MARK}][ \n{MARK}]*", " "))


def known(spark: SparkSession) -> DataFrame:
    """(digest, license) of the fixed list."""
    rows = spark.createDataFrame(list(TEXTS), "license string, text string")
    return rows.select(F.md5(canonical(F.col("text"))).alias("digest"), "license").distinct()


def matches(docs: DataFrame) -> DataFrame:
    """(doc_id, own, unit, license): entire texts that are a known licence; unit is the text as it stands.

    A text is normalised once, and its paragraphs and lines are cut from that; the result is ``canonical`` of each unit.
    """
    def unit(text: Column, form: Column) -> Column:
        return F.struct(text.alias("unit"), F.md5(F.when(F.col("other"), _spelled(form)).otherwise(form)).alias("digest"))

    # no unit has another spelling if the whole text has none
    others = f" (?:{'|'.join(old for old, _ in EQUAL_WORDS)}) "
    texts = docs.select("doc_id", "text", F.md5("text").alias("own"), plain_lines(F.col("text")).alias("plain"))
    texts = texts.withColumn("whole", _one_line(F.col("plain")))
    texts = texts.withColumn("other", F.concat(F.lit(" "), "whole", F.lit(" ")).rlike(others))
    units = F.flatten(F.array(
        F.array(unit(F.col("text"), F.col("whole"))),
        F.zip_with(F.split("text", EMPTY_LINE), F.transform(F.split("plain", f"\n{MARK}\n"), _one_line), unit),
        F.zip_with(F.split("text", "\n"), F.transform(F.split("plain", "\n"), _one_line), unit)))
    # outer: else the planner adds a filter on the number of units, and splits the texts twice; digests are made before
    # rows, as the join's filter on them would make them once more
    found = texts.select("doc_id", "own", F.explode_outer(units).alias("x")).select("doc_id", "own", "x.*")
    return found.join(F.broadcast(known(docs.sparkSession)), "digest").select("doc_id", "own", "unit", "license").distinct()


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, licenses, n_licenses) for every row of documents: sorted names joined by commas."""
    found = matches(docs).groupBy("doc_id", "own").agg(F.array_sort(F.collect_set("license")).alias("names"))
    found = found.withColumnsRenamed({"doc_id": "__id", "own": "__own"})
    rows = docs.select("doc_id", F.md5("text").alias("own"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("own") == F.col("__own")), "left")
    return joined.select("doc_id", F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"),
                         F.coalesce(F.size("names"), F.lit(0)).alias("n_licenses"))


def sql() -> str:
    """The same scan in DuckDB."""
    def canon(x: str) -> str:
        out = f"' ' || regexp_replace(regexp_replace(lower({x}), '{COPYRIGHT}', '', 'g'), '[{PUNCTUATION}]+', ' ', 'g') || ' '"
        for old, new in EQUAL_WORDS:
            out = f"replace({out}, ' {old} ', ' {new} ')"
        return f"trim({out})"

    quoted = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEXTS)
    return f"""WITH k(license, t) AS (VALUES {quoted}),
    known AS (SELECT DISTINCT license, {canon('t')} AS c FROM k),
    d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
    u AS (SELECT DISTINCT r, unnest(list_concat([text], list_concat(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'),
            string_split(text, chr(10))))) AS unit FROM d),
    h AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(DISTINCT license) AS n
          FROM (SELECT r, {canon('unit')} AS c FROM u) JOIN known USING (c) GROUP BY r)
    SELECT doc_id, coalesce(licenses, '') AS licenses, CAST(coalesce(n, 0) AS INTEGER) AS n_licenses FROM d LEFT JOIN h USING (r)"""
