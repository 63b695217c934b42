"""Masking of regions that must not change, and putting them back."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions.text import bound, control_character

# The token, and what is masked, in this order.
PREFIX = "@@MATH_TRANSLATOR_"
TOKEN = r"@@MATH_TRANSLATOR_\d{6}@@"
FORMATS = ("Markdown", "LaTeX")
CODE_ENVIRONMENTS = "lstlisting|minted|verbatim|Verbatim|tikzpicture|pgfpicture|pspicture"
MATH_ENVIRONMENTS = r"equation\*?|align\*?|alignat\*?|gather\*?|multline\*?"
ARGUMENT_COMMANDS = "ref|eqref|autoref|cref|Cref|cite|citep|citet|label|url|href|input|include|includegraphics|bibliography|bibliographystyle|textsuperscript"
RULES = (
    # format, name, pattern
    ("Markdown", "front matter", r"\A---\r?\n(?s:.*?)\r?\n---(?:\r?\n|\Z)"),
    ("Markdown", "backtick fence", r"(?m)^`{3,}[^\n]*\n(?s:.*?)^`{3,}[ \t]*$"),
    ("Markdown", "tilde fence", r"(?m)^~{3,}[^\n]*\n(?s:.*?)^~{3,}[ \t]*$"),
    ("Markdown", "comment", r"<!--(?s:.*?)-->"),
    ("Markdown", "inline code", r"(?s)(?P<ticks>`+)(?!`).*?(?P=ticks)"),
    (None, "code environment", rf"\\begin\{{(?:{CODE_ENVIRONMENTS})\}}(?:\[[^\]]*\])?(?:\{{[^{{}}]*\}})?(?s:.*?)\\end\{{(?:{CODE_ENVIRONMENTS})\}}"),
    (None, "dollar display", r"(?<!\\)\$\$(?s:.*?)(?<!\\)\$\$"),
    (None, "bracket display", r"\\\[(?s:.*?)\\\]"),
    (None, "math environment", rf"\\begin\{{(?:{MATH_ENVIRONMENTS})\}}(?s:.*?)\\end\{{(?:{MATH_ENVIRONMENTS})\}}"),
    (None, "percent line", r"(?m)^[ \t]*%.*$"),
    (None, "parenthesis math", r"\\\((?s:.*?)\\\)"),
    (None, "dollar math", r"(?<![\\$])\$(?!\$)(?:\\.|[^$\n])+?(?<!\\)\$"),
    (None, "argument command", rf"\\(?:{ARGUMENT_COMMANDS})\*?(?:\[[^\]]*\])?(?:\{{[^{{}}]*\}})+"),
    (None, "section sign", r"\\S(?=~|\s|[{}.,;:!?)]|$)"),
    (None, "verbatim", r"\\(?:verb|lstinline)(.).*?\1"),
    (None, "link target", r"(?<=\]\()[^\n)]+(?=\))"),
    (None, "autolink", r"<https?://[^>]+>"),
    (None, "bare url", r"https?://[^\s)>]+"),
    ("Markdown", "html tag", r"</?[A-Za-z][^>]*>"),
)

MASKED = "masked string, tokens array<string>, originals array<string>, error string"
_FIELDS, _KINDS = ["masked", "tokens", "originals", "error"], [pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
#: Texts that a task holds as objects at once.
SLICE = 64
#: Signs without which a rule finds nothing, so that most texts are searched for these only.
NEEDED = {
    "front matter": "---", "backtick fence": "```", "tilde fence": "~~~", "comment": "<!--", "inline code": "`", "code environment": "\\begin{", "dollar display": "$$",
    "bracket display": "\\[", "math environment": "\\begin{", "percent line": "%", "parenthesis math": "\\(", "dollar math": "$", "argument command": "\\", "section sign": "\\S",
    "verbatim": "\\", "link target": "](", "autolink": "<http", "bare url": "http", "html tag": "<",
}
_COMPILED = [(kind, name, NEEDED[name], re.compile(pattern)) for kind, name, pattern in RULES]
_TOKEN = re.compile(TOKEN)


def _mask(text: str, kind: str) -> tuple[str, list[str], str | None]:
    """Masked text, originals by token number, and why the text cannot be masked."""
    if PREFIX in text:
        return text, [], "the text holds the reserved prefix"
    if kind not in FORMATS:
        return text, [], f"unknown format {kind}"
    originals: list[str] = []
    for only, name, needed, pattern in _COMPILED:
        if only not in (None, kind) or needed not in text:
            continue
        found = [m for m in pattern.finditer(text)]
        if any(PREFIX in m[0] and _TOKEN.search(m[0]) for m in found):
            return text, originals, f"nested: {name}"
        parts, at = [], 0
        for m in found:
            parts += [text[at : m.start()], f"{PREFIX}{len(originals):06d}@@"]
            originals.append(m[0])
            at = m.end()
        text = "".join(parts) + text[at:]
    seen = _TOKEN.findall(text) if originals else []  # a text without originals is as it was, without the prefix
    if len(seen) != len(originals) or len(set(seen)) != len(seen):
        return text, originals, "a token is not there exactly once"
    return text, originals, None


def masked_slices(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Texts and their formats masked, some at a time: a batch's bytes are bounded by Spark, its texts and originals are objects for one slice only."""
    for texts, kinds in batches:
        for at in range(0, len(texts), SLICE):
            out = []
            for t, k in zip(texts.slice(at, SLICE).to_pylist(), kinds.slice(at, SLICE).to_pylist(), strict=True):
                masked, originals, error = _mask(t or "", k or "")
                out.append((masked, [f"{PREFIX}{i:06d}@@" for i in range(len(originals))], originals, error))
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _KINDS, strict=True)], _FIELDS)


def mask(docs: DataFrame, text: str = "text", kind: str | Column = "Markdown") -> DataFrame:
    """``docs`` with a struct ``mask``: masked text, tokens and their originals in order, and an error instead of a failure (O3).

    A null text is masked as empty. Where ``error`` is set the text is left out of use, but its row stays.
    """

    run = F.arrow_udf(masked_slices, MASKED)
    run = run.asNondeterministic()  # else a filter on the error would mask every text a second time
    return docs.withColumn("mask", run(F.col(text), F.lit(kind) if isinstance(kind, str) else kind))


def token_places(c: Column) -> Column:
    """Every token where it stands, in order, also where two share their signs at the border; a text without the prefix is not searched by the pattern."""
    none = F.when(c.isNotNull(), F.expr("cast(array() as array<string>)"))
    return F.when(F.contains(c, F.lit(PREFIX)), F.regexp_extract_all(c, F.lit(f"(?=({TOKEN}))"), F.lit(1))).otherwise(none)


def tokens_in(chunk: Column, tokens: Column | None = None) -> Column:
    """The tokens that a chunk holds, in their order; without ``tokens`` all that look like one."""
    return F.array_sort(F.array_distinct(token_places(chunk))) if tokens is None else F.array_intersect(tokens, token_places(chunk))


def not_once(tokens: Column, places: Column) -> Column:
    """Those of ``tokens`` that ``places`` (as ``token_places`` gives them) does not hold exactly once, in their order: by a sorted array."""
    alone = lambda s: F.filter(s, lambda t, i: ~t.eqNullSafe(F.get(s, i - 1)) & ~t.eqNullSafe(F.get(s, i + 1)))
    return F.array_except(tokens, bound(F.array_sort(places), alone))


def token_errors(chunk: Column, output: Column, tokens: Column) -> Column:
    """First reason why an output is not a valid rewrite of a chunk, null if it is."""
    wrong = not_once(tokens_in(chunk, tokens), token_places(output))
    return F.coalesce(F.concat(F.lit("control character "), control_character(output)), F.concat(F.lit("token not exactly once: "), F.get(wrong, 0)))


def restore(masked: Column, tokens: Column, originals: Column) -> Column:
    """Struct of the text with its regions put back and an error; every token must stand there once, and no other."""
    number = lambda t: F.substring(t, len(PREFIX) + 1, 6).cast("int")

    def back(places: Column) -> Column:
        """All from one pass that finds the tokens, and one that cuts the text between them."""
        gaps = F.when(F.contains(masked, F.lit(PREFIX)), F.split(masked, TOKEN, -1)).when(masked.isNotNull(), F.array(masked))
        unknown, wrong = F.get(F.array_except(places, tokens), 0), F.get(not_once(tokens, places), 0)
        error = F.coalesce(F.concat(F.lit("unknown token: "), unknown), F.concat(F.lit("token not exactly once: "), wrong))
        filled = F.transform(places, lambda t: F.coalesce(F.try_element_at(originals, number(t) + 1), t))
        whole = lambda g: F.array_join(F.flatten(F.zip_with(g, filled, lambda x, o: F.array(x, F.coalesce(o, F.lit(""))))), "")
        # tokens that share their signs at a border leave fewer gaps
        text = bound(gaps, lambda g: F.when(F.size(g) == F.size(places) + 1, whole(g)))
        return bound(F.struct(error.alias("error"), F.when(error.isNull(), text).alias("text")), lambda r: F.struct(r["text"].alias("text"), F.when(r["error"].isNull() & r["text"].isNull() & masked.isNotNull(), "tokens overlap").otherwise(r["error"]).alias("error")))

    return bound(token_places(masked), back)
