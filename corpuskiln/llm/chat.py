"""Chat formatting of typed content parts, with loss masks and an exact way back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Part kinds that become placeholders.
ATTACHMENTS = ("image", "audio", "document")
PART_SCHEMA = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: Column) -> Column:
    """No ``<|`` is left in the result: one backslash is added between the two signs, also where some stand already."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """As ``escape``; a line feed, which would end the role, is written ``<nl>`` and a literal ``<nl>`` gets a backslash."""
    return F.replace(F.regexp_replace(escape(role), r"<(\\*)nl>", r"<$1\\nl>"), F.lit("\n"), F.lit("<nl>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(F.replace(role, F.lit("<nl>"), F.lit("\n")), r"<(\\*)\\nl>", r"<$1nl>"))


def part_tokens(part: Column, patch: int = 28, audio_per_second: int = 25, per_page: int = 256) -> Column:
    """Tokens that a model spends on an attachment; unknown measures count as the least, one unit."""
    tiles = F.ceil(F.coalesce(part["width"], F.lit(1)) / patch) * F.ceil(F.coalesce(part["height"], F.lit(1)) / patch)
    n = (
        F.when(part["type"] == "image", tiles)
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * audio_per_second))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(1)) * per_page)
    )
    return F.greatest(n, F.lit(1)).cast("long")


def visit_parts(parts: Column, **rates: int) -> Column:
    """Flatten typed parts, in order: text is escaped, an attachment becomes the placeholder ``<|kind|>``.

    A struct of ``body``, ``attachments`` (ordinal, kind, ref, tokens) and ``expanded_tokens``. Parts of an unknown or
    null type count as text; null parts and null texts are empty. Texts side by side are escaped as one, so that no
    control string comes about where they meet.
    """
    attached = lambda p: F.coalesce(p["type"].isin(*ATTACHMENTS), F.lit(False))

    def visit(parts: Column) -> Column:
        places = F.array_compact(F.transform(parts, lambda p, i: F.when(attached(p), i + 1)))
        run = lambda start, stop: F.transform(F.slice(parts, start + 1, stop - start - 1), lambda p: F.coalesce(p["text"], F.lit("")))
        placeholder = lambda at: F.when(at > 0, F.concat(F.lit("<|"), F.try_element_at(parts, at)["type"], F.lit("|>"))).otherwise("")
        starts, stops = F.concat(F.array(F.lit(0)), places), F.concat(places, F.array(F.size(parts) + 1))
        body = F.zip_with(starts, stops, lambda start, stop: F.concat(placeholder(F.nullif(start, F.lit(0))), escape(F.array_join(run(start, stop), ""))))
        found = F.transform(F.filter(parts, attached), lambda p, i: F.struct((i + 1).cast("int").alias("ordinal"), p["type"].alias("kind"), p["ref"].alias("ref"), part_tokens(p, **rates).alias("tokens")))
        spent = F.aggregate(found, F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
        return F.struct(F.array_join(body, "").alias("body"), found.alias("attachments"), spent.alias("expanded_tokens"))

    parts = F.filter(F.coalesce(parts, F.expr(f"cast(array() as {PART_SCHEMA})")), lambda p: p.isNotNull())
    return F.transform(F.array(parts), visit)[0]  # the filtered array is worked out once


def text_part(text: Column) -> Column:
    null = lambda kind: F.lit(None).cast(kind)
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), null("string").alias("ref"), null("int").alias("width"), null("int").alias("height"), null("double").alias("seconds"), null("int").alias("pages")))


def format_conversations(turns: DataFrame, parts: str = "parts", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per ``conv_id`` of ``turns`` (conv_id, turn, role and an array of typed parts).

    Returns conv_id, n_turns, formatted, loss_spans (start and length in code points, over the text of each turn of a
    ``loss_roles`` role), attachments (turn_no, ordinal, kind, ref, tokens) and expanded_tokens. Turns go by ``turn``;
    equal turns by role, then body; null turns first, null roles and texts as empty, rows without conv_id as one
    conversation. Repeated rows are turns of their own. Other columns are ignored; no rows give no rows. All turns of
    a conversation meet in one row, as its formatted text does.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), visit_parts(F.col(parts)).alias("m")).select("conv_id", "turn", "role", "m.*")
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    rows = rows.withColumn("head", head).withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    by = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    upto = F.sum(F.length("piece").cast("long")).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("no", F.row_number().over(by)).withColumn("start", upto - F.length("piece") + F.length("head"))
    turn = F.struct("no", "role", "piece", "start", F.length("body").cast("long").alias("len"), "attachments", "expanded_tokens")
    packed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    spans = F.transform(F.filter("t", lambda x: x["role"].isin(*loss_roles)), lambda x: F.struct(x["start"].alias("start"), x["len"].alias("len")))
    attached = F.flatten(F.transform("t", lambda x: F.transform(x["attachments"], lambda a: F.struct(x["no"].alias("turn_no"), *(a[k].alias(k) for k in ("ordinal", "kind", "ref", "tokens"))))))
    return packed.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"),
        attached.alias("attachments"),
        F.aggregate("t", F.lit(0).cast("long"), lambda a, x: a + x["expanded_tokens"]).alias("expanded_tokens"),
    )


def _turns(formatted: Column, read: Callable[[Column], Column]) -> Column:
    pieces = F.split(formatted, r"<\|im_start\|>")
    pieces = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        skip = F.length(role) + 1
        return F.struct(unescape_role(role).alias("role"), read(p.substr(skip + 1, F.length(p) - skip - len(END) - 1)))

    return F.transform(pieces, turn)


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) that a formatted conversation holds, unescaped; placeholders stand in the text as they are."""
    return _turns(formatted, lambda body: unescape(body).alias("text"))


def read_typed_turns(formatted: Column) -> Column:
    """The array of (role, parts) that a formatted conversation holds, with its parts as ``read_parts`` gives them."""
    return _turns(formatted, lambda body: read_parts(body).alias("parts"))


def read_parts(body: Column) -> Column:
    """The parts (type, text) of a turn's body as it stands in the formatted text.

    Escaped texts hold no ``<|``, so a placeholder is told from the same signs in a text. An attachment has a null text; its reference stands in ``attachments``
    in the same order. Texts side by side come back as one, and empty texts are left out.
    """
    kinds = "|".join(ATTACHMENTS)
    found = F.regexp_extract_all(body, F.lit(rf"<\|(?:{kinds})\|>|(?s:(?:[^<]|<(?!\|))++)"), F.lit(0))
    kind = lambda x: F.regexp_extract(x, rf"\A<\|({kinds})\|>\z", 1)
    return F.transform(found, lambda x: F.struct(F.when(kind(x) == "", "text").otherwise(kind(x)).alias("type"), F.when(kind(x) == "", unescape(x)).alias("text")))


def read_loss_texts(formatted: Column, spans: Column) -> Column:
    return F.transform(spans, lambda s: unescape(formatted.substr((s["start"] + 1).cast("int"), s["len"].cast("int"))))
