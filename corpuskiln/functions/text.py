"""Text functions as Column expressions: white space, lines, tokens, offsets, escapes."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
GENERIC_TOKENS = [
    "begin", "end", "table", "tabular", "array", "figure", "caption", "includegraphics", "text", "style", "border", "width", "height", "align",
    "center", "left", "right", "word", "wrap", "break", "html", "frac", "sqrt", "cdots", "ldots", "dots", "qquad", "quad", "hfill",
]
TEX_ESCAPES = {"\\": "\\textbackslash{}", "&": "\\&", "%": "\\%", "#": "\\#", "_": "\\_", "{": "\\{", "}": "\\}"}
CONTENT_TOKEN = r"[\x{3400}-\x{9fff}]{2,}|[A-Za-z0-9][A-Za-z0-9_]{3,}"
ARXIV_ID = r"((?:\d{4}\.\d{4,5}|[a-z-]+(?:\.[A-Z]{2})?/\d{7})(?:v\d+)?)"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
HTML_IMAGE = r"(?i)<img\b[^>]*?src=[\"']([^\"']+)[\"']"
MARKDOWN_IMAGE = r"!\[[^\]]*\]\(([^)]+)\)"

LINE_END = r"\R|[\x1c-\x1e]"


def squeeze(c: Column) -> Column:
    """Runs of white space become one space."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def strip(c: Column) -> Column:
    """Without white space at both ends (C14)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


@cache
def _folds() -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """Signs beyond ASCII that one sign, or several, stand for when case is folded, and those that another is equal to where case is ignored sign by sign."""
    one, several, like = {}, {}, {"\u0130": "i"}
    for sign in map(chr, range(128, sys.maxunicode + 1)):
        full, high = sign.casefold(), sign.upper()
        low = (high if len(high) == 1 else sign).lower()
        if full != sign:
            (one if len(full) == 1 else several)[sign] = full
        if len(low) == 1 and low != sign:
            like[sign] = low
    return one, several, like


def _translated(c: Column, table: dict[str, str]) -> Column:
    return F.translate(c, "".join(table), "".join(table.values()))


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def _ascii_lower(c: Column) -> Column:
    letters = "".join(map(chr, range(65, 91)))
    return F.translate(c, letters, letters.lower())


def fold_case(c: Column) -> Column:
    """Full case folding, by which ``ß`` and ``ss`` are the same; the tables are those of the running Python."""
    one, several, _ = _folds()
    signs = "".join(several)
    many = F.str_to_map(F.lit(",".join(f"{a}:{b}" for a, b in several.items())), F.lit(","), F.lit(":"))  # a constant; none of the signs is a comma or colon
    plain = _ascii_lower(_translated(c, one))
    parts = F.transform(F.regexp_extract_all(plain, F.lit(f"[{signs}]|[^{signs}]+"), F.lit(0)), lambda x: F.coalesce(F.try_element_at(many, x), x))
    return F.when(_is_ascii(c), F.lower(c)).when(F.regexp_like(plain, F.lit(f"[{signs}]")), F.array_join(parts, "")).otherwise(plain)


def fold_signs(c: Column) -> Column:
    """Case folded sign by sign, so that places stay; what a pattern that ignores case takes as equal."""
    return F.when(_is_ascii(c), F.lower(c)).otherwise(_ascii_lower(_translated(c, _folds()[2])))


def like_signs() -> dict[int, str]:
    """``fold_signs`` as a table of ``str.translate``."""
    return {ord(a): b for a, b in _folds()[2].items()} | {n: chr(n).lower() for n in range(65, 91)}


def word_signs() -> str:
    """Signs beyond ASCII that are word signs where case is ignored, such as the Kelvin sign."""
    return "".join(a for a, b in _folds()[2].items() if b.isascii())


def term_key(c: Column) -> Column:
    """What phrases are compared by: stripped, squeezed, case folded."""
    return fold_case(squeeze(strip(c)))


def drop_class_marker(c: Column) -> Column:
    """Squeezed, without a single capital that stands alone at the end."""
    return strip(F.regexp_replace(squeeze(strip(c)), r"\s+[A-Z]\z", ""))


def lines(c: Column) -> Column:
    """Lines without their ends; one empty line at the end does not count."""
    parts = F.split(c, LINE_END)
    last_empty = F.element_at(parts, -1) == ""
    return F.when(last_empty, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def nonempty_lines(c: Column) -> Column:
    """Stripped and squeezed lines that are not blank."""
    return F.filter(F.transform(lines(c), lambda x: squeeze(strip(x))), lambda x: x != "")


def content_tokens(c: Column) -> Column:
    """Distinct Han runs and word runs that mark content, without generic ones."""
    generic = F.array(*map(F.lit, GENERIC_TOKENS))
    return F.filter(F.array_distinct(F.regexp_extract_all(c, F.lit(CONTENT_TOKEN), F.lit(0))), lambda x: ~F.array_contains(generic, F.lower(x)))


def tex_escape(c: Column) -> Column:
    """Special characters escaped one by one, so that no escape is escaped again."""
    known = F.create_map(*(F.lit(x) for pair in TEX_ESCAPES.items() for x in pair))
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"(?s)[\\&%#_{}]|[^\\&%#_{}]+"), F.lit(0)), lambda x: F.coalesce(F.try_element_at(known, x), x)), "")


def image_references(c: Column) -> Column:
    """Distinct image paths of HTML and Markdown, stripped, with forward slashes."""
    found = F.array_union(F.regexp_extract_all(c, F.lit(HTML_IMAGE), F.lit(1)), F.regexp_extract_all(c, F.lit(MARKDOWN_IMAGE), F.lit(1)))
    return F.array_distinct(F.filter(F.transform(found, lambda x: F.replace(strip(x), F.lit("\\"), F.lit("/"))), lambda x: x != ""))


def arxiv_id(c: Column) -> Column:
    """First arXiv identifier, null if there is none."""
    return F.nullif(F.regexp_extract(c, ARXIV_ID, 1), F.lit(""))


def safe_dir_name(c: Column) -> Column:
    """Folder name of an identifier."""
    return F.concat(F.lit("arXiv_"), F.replace(c, F.lit("/"), F.lit("_")))


def control_character(c: Column) -> Column:
    """First forbidden control character as U+XXXX, null if there is none."""
    found = F.nullif(F.regexp_extract(c, f"({CONTROL})", 1), F.lit(""))
    return F.when(F.regexp_like(c, F.lit(CONTROL)), F.concat(F.lit("U+"), F.lpad(F.hex(F.ascii(F.coalesce(found, F.lit("\0")))), 4, "0")))


def count_of(c: Column, needle: Column) -> Column:
    """Occurrences of a literal that do not overlap."""
    return F.when(F.length(needle) > 0, (F.length(c) - F.length(F.replace(c, needle, F.lit("")))) / F.length(needle)).otherwise(0).cast("int")


def document_format(path: Column) -> Column:
    """LaTeX or Markdown by suffix, null for any other."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./\\]+)\z", 1))
    return F.when(suffix.isin("tex", "ltx"), "LaTeX").when(suffix.isin("md", "markdown"), "Markdown")


def output_path(path: Column) -> Column:
    """Where a translation goes unless told otherwise: before the suffix, ``.zh``."""
    return F.regexp_replace(path, r"(\.[^./\\]+)\z", ".zh$1")


#: Items of an inner fold of ``fold_items``; an append copies an array of at most so many items.
FOLD_ITEMS = 256


def fold_items(items: Column, at: Column, none: Column, step: Callable[[Column, Column], tuple[Column, Column, Column]]) -> Column:
    """The array of what a fold over ``items`` gives out; null for null.

    ``step(at, item)`` is the next state, whether something is given out, and what; ``none`` is the empty array of it. Items are
    folded in blocks, whose results are put together at the end, so the work grows with their number and not with its square.
    """

    def one(acc: Column, x: Column) -> Column:
        state, given, value = step(acc["at"], x)
        return F.struct(state.alias("at"), F.when(given, F.array_append(acc["out"], value)).otherwise(acc["out"]).alias("out"))

    def block(acc: Column, x: Column) -> Column:
        folded = F.aggregate(x, F.struct(acc["at"].alias("at"), none.alias("out")), one)
        return bound(folded, lambda f: F.struct(f["at"].alias("at"), F.array_append(acc["out"], f["out"]).alias("out")))

    def whole(all_items: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor(F.greatest(F.size(all_items) - 1, F.lit(0)) / FOLD_ITEMS).cast("int"))
        blocks = F.transform(starts, lambda i: F.slice(all_items, i * FOLD_ITEMS + 1, F.lit(FOLD_ITEMS)))
        return F.flatten(F.aggregate(blocks, F.struct(at.alias("at"), F.slice(F.array(none), 1, 0).alias("out")), block, lambda acc: acc["out"]))

    return bound(items, whole)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def find_all(c: Column, pattern: Column | str) -> Column:
    """Array of (start, end, text) of every match, in code points, from the pieces between matches.

    Matches are marked by a sign that the text lacks, so that it is searched once; a text that has the sign is searched twice.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    pair = lambda gaps, hits: F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))
    marked = F.split(F.regexp_replace(c, pattern, F.lit("\0$0\0")), "\0", -1)
    once = bound(marked, lambda p: pair(F.filter(p, lambda _, i: i % 2 == 0), F.filter(p, lambda _, i: i % 2 == 1)))
    both = F.when(F.contains(c, F.lit("\0")), pair(F.split(c, pattern, -1), F.regexp_extract_all(c, pattern, F.lit(0)))).otherwise(once)
    none = F.expr("cast(array() as array<struct<start:int,end:int,text:string>>)")

    def step(at: Column, x: Column) -> tuple[Column, Column, Column]:
        start = at + x["gap"]
        end = start + F.length(x["hit"])
        return end, F.lit(True), F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("text"))

    return fold_items(both, F.lit(0), none, step)


def phrase_pattern(phrase: Column) -> Column:
    """Pattern of a phrase: literal words, any white space between, ASCII word boundaries, any case (C4)."""
    words = F.transform(F.split(squeeze(strip(phrase)), " "), lambda w: F.concat(F.lit("\\Q"), F.replace(w, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    return F.concat(F.lit("(?iu)(?<![A-Za-z0-9_])"), F.array_join(words, r"(?U:\s+)"), F.lit("(?![A-Za-z0-9_])"))


def macro_before_han(c: Column) -> Column:
    """Whether a line has a TeX macro directly followed by a Han character (C20)."""
    return F.exists(lines(c), lambda x: F.regexp_like(x, F.lit(r"\\[A-Za-z]+[\x{4e00}-\x{9fff}]")))


def resolved(path: Column) -> Column:
    """A relative path without empty, ``.`` and ``..`` segments; null if it leaves the folder it starts from, even for a while."""

    def step(acc: Column, x: Column) -> Column:
        up = x == ".."
        return F.when(acc.isNull() | up & (F.size(acc) == 0), F.lit(None)).when(up, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when((x == ".") | (x == ""), acc).otherwise(F.array_append(acc, x))

    folded = F.aggregate(F.split(path, "/"), F.expr("cast(array() as array<string>)"), step)
    return F.when(~path.startswith("/"), F.array_join(folded, "/"))
