"""Articles and signatures in the text of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

ARTICLE = f"(?iu)điều[{X.BLANKS}\n\r]+[0-9]+"
SIGNED = ("Đã ký", "Ðã ký")


def split_articles(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, article_no, article_number, title, content) of the articles of a text, in order.

    An article begins at `Điều` and a number; its title goes to the end of the line, its content to the next
    such mark. A mark on the last line, or one that the same line goes on to, has no content and is none.
    """
    marks = F.regexp_extract_all(F.col(text), F.lit(f"({ARTICLE})"), 1)
    rest = F.slice(F.split(F.col(text), ARTICLE), 2, 1_000_000)
    pieces = F.arrays_zip(marks.alias("mark"), rest.alias("rest"))
    rows = df.select(*keys, F.posexplode(pieces).alias("_no", "p")).select(*keys, "_no", "p.mark", "p.rest").where(F.instr("rest", "\n") > 0)
    head = F.substring_index("rest", "\n", 1)
    strip = lambda c: F.regexp_replace(c, f"^[{X.BLANKS}\n\r]+|[{X.BLANKS}\n\r]+$", "")
    return rows.select(
        *keys,
        (F.col("_no") + 1).alias("article_no"),
        F.regexp_extract("mark", "([0-9]+)$", 1).alias("article_number"),
        strip(F.concat("mark", head)).alias("title"),
        strip(F.expr("substring(rest, instr(rest, '\n') + 1)")).alias("content"),
    )


def text_lines(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, line_no, line): lines without those equal to the one before them."""
    rows = df.select(*keys, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))
    before = F.lag("line").over(Window.partitionBy(*keys).orderBy("line_no"))
    return rows.withColumn("_b", before).where(~F.col("line").eqNullSafe(F.col("_b"))).drop("_b")


def signatures(lines: DataFrame, keys: list[str], before: int = 5, after: int = 7, titles: int = 5) -> DataFrame:
    """(keys, signer, signer_title) read from lines (keys, line_no, line).

    Places to look at are the lines that say `signed`, or else the last `titles` titles. The title is made of
    the last three titles in the lines up to the place, the signer is the first person's name in the lines after
    it, or else what follows `signed` in the line. The first place that gives each is taken.
    """
    w = Window.partitionBy(*keys).orderBy("line_no")
    rows = lines.select(*keys, "line_no", "line", X.is_signature_title(F.col("line")).alias("t"), X.is_person_name(F.col("line")).alias("p"), (F.instr("line", SIGNED[0]) > 0).alias("s1"), (F.instr("line", SIGNED[1]) > 0).alias("s2"))
    rows = rows.withColumn("s", F.col("s1") | F.col("s2"))
    back = Window.partitionBy(*keys).orderBy(F.desc("line_no"))
    rows = rows.withColumn("_any", F.max("s").over(Window.partitionBy(*keys))).withColumn("_last", F.sum(F.col("t").cast("int")).over(back))
    around = rows.select(
        *keys, "line_no", "line", "s", "t", "_any", "_last",
        F.collect_list(F.when(F.col("t"), F.col("line"))).over(w.rowsBetween(-before, 0)).alias("up"),
        F.collect_list(F.when(F.col("p"), F.col("line"))).over(w.rowsBetween(1, after)).alias("down"),
    )
    places = around.where("s or (not _any and t and _last <= " + str(titles) + ")")
    own = F.trim(F.regexp_extract("line", r"(?iu)\(?đã ký\)?[ \t]*(.+)$", 1))
    title = F.trim(F.regexp_replace(F.array_join(F.slice("up", F.greatest(F.size("up") - 2, F.lit(1)), 3), " "), r"\(?Đã ký\)?.*$", ""))
    signer = F.coalesce(F.get("down", 0), F.when((own != "") & X.is_person_name(own), own))
    found = places.select(*keys, "line_no", F.when(F.size("up") > 0, title).alias("title"), signer.alias("signer"))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("line_no")))
    return found.groupBy(*keys).agg(first("signer").alias("signer"), first("title").alias("signer_title")).where("signer is not null or signer_title is not null")


def sentence_offsets(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, sentence_no, start_char, end_char) with true offsets: the white space between sentences counts as long as it is."""
    pattern = "([ \t\n\r\x0b\f]+)"
    parts = F.split(F.col(text), f"(?<=[.!?;])(?={pattern})")  # each part but the first begins with its white space
    rows = df.select(*keys, F.posexplode(parts).alias("sentence_no", "_part"))
    w = Window.partitionBy(*keys).orderBy("sentence_no").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("_part")).over(w), F.lit(0))
    lead = F.when(F.col("sentence_no") > 0, F.length(F.regexp_extract("_part", f"^{pattern}", 1))).otherwise(0)
    return rows.select(*keys, "sentence_no", (start + lead).alias("start_char"), (start + F.length("_part")).alias("end_char"))


def column_signature(people: Column) -> Column:
    """struct<signer, signer_title> of the people that the source names."""
    names = lambda f: X.join_names(F.transform(people, lambda p: p[f]))
    return F.struct(names("person_name").alias("signer"), names("job_title_name").alias("signer_title"))
