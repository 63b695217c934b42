"""Table of contents, body and back matter of scanned books, and their manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.text import nonempty_lines, strip
from corpuskiln.operators import scan
from corpuskiln.sources import sinks

# Fixed values.
SEARCHED_PAGES = 32
CONTENTS_HEADING = r"(?iu)^(?:#{1,6}(?U:\s*))?(?:table(?U:\s+)of(?U:\s+)contents|contents|目录)(?U:\s*)\z"
CONTENTS_ENTRY = r"(?:\.{2,}|…{2,}|(?U:\s))(?U:\s*)(?U:\d+)(?U:\s*)\z"
BACK_MATTER = (
    r"(?iu)^(?:#{1,6}(?U:\s*))?(?:"
    r"bibliography|references?|index|name(?U:\s+)index|glossary|"
    r"biographical(?U:\s+)notes?|about(?U:\s+)the(?U:\s+)authors?|chronology|"
    r"参考文献|参考书目|索引|人名索引|术语表|"
    r".*?(?:作者|人物|人名|学者|数学家|科学家).*?(?:生卒|简介|生平|传略|年表).*"
    r")(?U:\s*)\z"
)
DEFAULT_TITLE = "OCR Document"
HEADINGS, OPENING = 8, 3


def has_contents_heading(lines: Column) -> Column:
    return F.exists(F.slice(lines, 1, 5), lambda x: F.regexp_like(x, F.lit(CONTENTS_HEADING)))


def continues_contents(lines: Column) -> Column:
    """Whether a page after a contents page still belongs to it: blank, headed anew, or two entries or more."""
    return (F.size(lines) == 0) | has_contents_heading(lines) | (F.size(F.filter(lines, lambda x: F.regexp_like(x, F.lit(CONTENTS_ENTRY)))) >= 2)


def is_back_matter(lines: Column) -> Column:
    """Whether one of the first eight or last three lines heads back matter."""
    tail = F.slice(lines, F.greatest(F.size(lines) - 2, F.lit(1)), F.lit(3))
    return F.exists(F.concat(F.slice(lines, 1, 8), tail), lambda x: F.regexp_like(x, F.lit(BACK_MATTER)))


def _flagged(pages: DataFrame, book: str) -> DataFrame:
    """One row per book with its pages' flags in order; texts are not gathered."""
    lines = nonempty_lines(F.coalesce("text", F.lit("")))
    flags = pages.select(book, "page_no", has_contents_heading(lines).alias("heads"), continues_contents(lines).alias("continues"), (F.size(lines) == 0).alias("blank"), is_back_matter(lines).alias("back"))
    return flags.groupBy(book).agg(F.sort_array(F.collect_list(F.struct("page_no", "heads", "continues", "blank", "back"))).alias("p"))


def detect_boundaries(pages: DataFrame, book: str = "book") -> DataFrame:
    """contents_page, body_start_page, end_page_excluded and error of each book.

    ``pages`` has the book, page_no and text. The contents begin on the first headed page of the first 32; the body
    begins behind their continuation and blank pages, and ends before its first page of back matter.
    """
    first = lambda cond, start=0: F.array_min(F.transform(F.filter(F.transform("p", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda y: (y["i"] >= start) & cond(y)), lambda y: y["i"]))
    packed = _flagged(pages, book).withColumn("c", first(lambda y: (y["i"] < SEARCHED_PAGES) & y["x"]["heads"]))
    packed = packed.withColumn("after", F.coalesce(first(lambda y: ~y["x"]["continues"], F.col("c") + 1), F.size("p")))
    packed = packed.withColumn("b", first(lambda y: ~y["x"]["blank"], F.col("after")))
    end = F.array_min(F.transform(F.filter(F.slice("p", F.col("b") + 1, F.size("p")), lambda x: x["back"]), lambda x: x["page_no"]))
    error = F.when(F.col("c").isNull(), "no contents page among the first pages").when(F.col("b").isNull(), "no body page after the contents")
    page = lambda i: F.try_element_at(F.col("p.page_no"), F.col(i) + 1)
    return packed.withColumn("error", error).select(book, page("c").alias("contents_page"), page("b").alias("body_start_page"), F.when(F.col("b").isNotNull(), end).alias("end_page_excluded"), "error")


def infer_metadata(pages: DataFrame, manifest: DataFrame, book: str = "book") -> DataFrame:
    """Title and author of each book: the first heading before the contents, and the line after it."""
    before = pages.join(manifest.select(book, "contents_page"), book).where("page_no < contents_page")
    lines = nonempty_lines(F.coalesce("text", F.lit("")))
    at = before.select(book, "page_no", lines.alias("l")).withColumn("i", F.array_position(F.transform("l", lambda x: F.regexp_like(x, F.lit(r"^#(?U:\s+).+"))), F.lit(True)).cast("int")).where("i > 0")
    heading = strip(F.regexp_replace(F.element_at("l", F.col("i")), r"^#(?U:\s+)", ""))
    second = strip(F.regexp_replace(F.coalesce(F.try_element_at("l", F.col("i") + 1), F.lit("")), r"^[【\[].*?[】\]](?U:\s*)", ""))
    author = F.when((second != "") & ~second.startswith("#"), second).otherwise("")
    found = at.groupBy(book).agg(F.min_by(F.struct(heading.alias("title"), author.alias("author")), "page_no").alias("m"))
    return manifest.join(found, book, "left").select(book, F.coalesce("m.title", F.lit(DEFAULT_TITLE)).alias("title"), F.coalesce("m.author", F.lit("")).alias("author"))


def body_pages(pages: DataFrame, manifest: DataFrame, book: str = "book") -> DataFrame:
    """Pages from the start of the body to before its end (F8)."""
    joined = pages.join(manifest.select(book, "body_start_page", "end_page_excluded"), book)
    return joined.where((F.col("page_no") >= F.col("body_start_page")) & (F.col("end_page_excluded").isNull() | (F.col("page_no") < F.col("end_page_excluded")))).select(*pages.columns)


def page_index(pages: DataFrame) -> DataFrame:
    """``pages`` with its first eight headings and first three lines instead of its text."""
    lines = nonempty_lines(F.coalesce("text", F.lit("")))
    headings = F.slice(F.filter(lines, lambda x: F.regexp_like(x, F.lit(r"^#{1,6}(?U:\s+)"))), 1, HEADINGS)
    return pages.withColumn("headings", headings).withColumn("opening", F.slice(lines, 1, OPENING)).drop("text")


def manifest_errors(manifest: DataFrame, pages: DataFrame, book: str = "book") -> DataFrame:
    """First broken rule of each page manifest, null if it is valid."""
    known = pages.groupBy(book).agg(F.collect_set("page_no").alias("known"))
    joined = manifest.join(known, book, "left").withColumn("known", F.coalesce("known", F.expr("cast(array() as array<int>)")))
    has = lambda c: F.col(c).isNotNull() & F.array_contains("known", F.coalesce(F.col(c), F.lit(-1)).cast("int"))
    error = (
        F.when(~has("contents_page"), "contents_page is not a page")
        .when(~has("body_start_page"), "body_start_page is not a page")
        .when(F.col("contents_page") >= F.col("body_start_page"), "the body does not follow the contents")
        .when(F.col("end_page_excluded").isNotNull() & ~has("end_page_excluded"), "end_page_excluded is not a page")
        .when(F.col("end_page_excluded") <= F.col("body_start_page"), "the end does not follow the body's start")
    )
    return joined.select(book, error.alias("error"))


def changed_manifests(new: DataFrame, old: DataFrame, book: str = "book") -> DataFrame:
    """Manifests that differ from what is stored, so that only these are written."""
    return new.exceptAll(old.select(*new.columns))


def _with_page_counts(chapters: DataFrame, pages: DataFrame, book: str) -> DataFrame:
    """``chapters`` with ``held``, the number of distinct pages from their first to their last: both ends meet the running count of pages.

    Pages and ends of a book are folded along ranges, so no book is in one task and none is multiplied by its chapters.
    """
    numbered = sinks.stored(chapters.withColumn("__row", F.monotonically_increasing_id()), "chapters")
    first, last = F.col("ocr_start_page").cast("long"), F.col("ocr_end_page").cast("long")
    ends = F.explode(F.array(F.struct((first - 1).alias("at"), F.lit(-1).alias("sign")), F.struct(last.alias("at"), F.lit(1).alias("sign"))))
    asked = numbered.where(first <= last).select(book, "__row", ends.alias("e")).select(book, "e.at", F.lit(1).alias("kind"), "__row", "e.sign", F.lit(0).cast("long").alias("one"))
    known = pages.where("page_no is not null").select(book, F.col("page_no").cast("long").alias("at")).distinct()
    known = known.select(book, "at", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("__row"), F.lit(None).cast("int").alias("sign"), F.lit(1).cast("long").alias("one"))
    folded = scan.running(known.unionByName(asked), [book], ["at", "kind"], {"upto": scan.Fold("sum", F.col("one"))})
    held = folded.where("kind = 1").groupBy("__row").agg(F.sum(F.col("sign") * F.col("upto")).alias("held"))
    return numbered.join(held, "__row", "left").drop("__row")


def chapter_errors(chapters: DataFrame, manifest: DataFrame, pages: DataFrame, book: str = "book", ends: DataFrame | None = None) -> DataFrame:
    """Broken rules of chapter manifests: book, number, error, one row per violation.

    ``chapters`` has book, number, title, ocr_start_page, ocr_end_page and sections (array of title and ocr_start_page). ``ends`` has what
    each outline says of the body's end: book and ocr_start_page, null where it names no page; of these books the end is checked
    too, with a null number. Types are those of the schema: what is no integer is null when it is read.
    """
    from pyspark.sql import Window

    order = Window.partitionBy(book).orderBy("number")
    plain = F.transform("sections", lambda s: F.struct(s["title"].alias("title"), s["ocr_start_page"].cast("int").alias("ocr_start_page")))
    rows = chapters.withColumn("sections", plain).withColumn("no", F.row_number().over(order)).withColumn("before", F.lag("ocr_end_page").over(order)).withColumn("is_last", F.lead("number").over(order).isNull())
    rows = rows.join(manifest.select(book, "body_start_page", "end_page_excluded"), book, "left")
    rows = _with_page_counts(rows, pages, book)
    start, end = F.col("ocr_start_page").cast("long"), F.col("ocr_end_page").cast("long")
    ordered = F.coalesce(start <= end, F.lit(False))
    outside = lambda s: s["ocr_start_page"].isNotNull() & ~s["ocr_start_page"].between(F.col("ocr_start_page"), F.col("ocr_end_page"))
    rules = [
        (~F.col("number").eqNullSafe(F.col("no")), "numbers are not consecutive"),
        (F.coalesce(strip(F.col("title")), F.lit("")) == "", "the title is empty"),
        (~ordered, "no valid page range"),
        (ordered & (F.col("held") < end - start + 1), "the range has pages that do not exist"),
        (F.col("ocr_start_page") < F.col("body_start_page"), "starts before the body"),
        (F.col("before").isNotNull() & (F.col("ocr_start_page") != F.col("before") + 1), "does not follow the chapter before"),
        (F.col("sections").isNull(), "the list of sections is missing"),
        (F.exists(F.coalesce("sections", F.expr("cast(array() as array<struct<title:string,ocr_start_page:int>>)")), lambda s: s["title"].isNull()), "a section has no title"),
        (F.exists(F.coalesce("sections", F.expr("cast(array() as array<struct<title:string,ocr_start_page:int>>)")), outside), "a section starts outside its chapter"),
        (F.col("is_last") & (F.col("ocr_end_page") != F.col("end_page_excluded") - 1), "the last chapter does not reach the end"),
    ]
    found = F.array_compact(F.array(*(F.when(F.coalesce(cond, F.lit(False)), F.lit(text)) for cond, text in rules)))
    broken = rows.select(book, "number", F.explode(found).alias("error"))
    if ends is None:
        return broken
    outlined = chapters.select(book).distinct().withColumn("outlined", F.lit(True))
    marked = manifest.where("error is null").select(book, "end_page_excluded").join(outlined, book, "left")
    marked = marked.join(ends.select(book, F.col("ocr_start_page").alias("named"), F.lit(True).alias("ended")), book, "left")
    rules = [
        (F.col("outlined").isNull(), "no chapters"),
        (F.col("outlined") & F.col("ended").isNull(), "the end of the body is missing"),
        (F.col("named") != F.col("end_page_excluded"), "the end of the body differs from the page boundary"),
    ]
    found = F.array_compact(F.array(*(F.when(F.coalesce(cond, F.lit(False)), F.lit(text)) for cond, text in rules)))
    return broken.unionByName(marked.select(book, F.lit(None).cast(broken.schema["number"].dataType).alias("number"), F.explode(found).alias("error")))
