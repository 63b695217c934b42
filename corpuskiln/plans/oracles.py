"""DuckDB SQL with the results of the registered queries."""

from __future__ import annotations

from corpuskiln.functions.text import GENERIC_TOKENS
from corpuskiln.operators.assemble import ROOT_COMMENT
from corpuskiln.operators.audit import EXEMPT_CHARS
from corpuskiln.plans.queries import FAULTS, HEADS, OUTLINES, SPELLINGS, TERMS

_ACTIVE = [t for t in TERMS if (t[4] or "approved") == "approved"]
_PHRASES = sorted(((p.lower(), s, t) for s, t, _, a, _, _ in _ACTIVE for p in (s, *a)), key=lambda x: (-len(x[0]), x[0]))
_VALUES = ", ".join(f"('{p}', '{s}', '{t}')" for p, s, t in _PHRASES)
_BODY = "|".join(p.replace(" ", r"\s+") for p, _, _ in _PHRASES)

#: Accepted matches: separators are doubled, so that each match can eat one on both sides.
_MATCHES = rf"""
with k(phrase, source, target) as (values {_VALUES}),
h as (select doc_id, regexp_extract_all(regexp_replace(coalesce(text, ''), '([^A-Za-z0-9_])', '\1\1', 'g'), '(?i)(?:^|[^A-Za-z0-9_])({_BODY})(?:$|[^A-Za-z0-9_])', 1) as l from documents),
u as (select doc_id, unnest(l) as raw, unnest(range(0, len(l))) as no from h),
m as (select u.doc_id, u.no, regexp_replace(u.raw, '([^A-Za-z0-9_])[^A-Za-z0-9_]', '\1', 'g') as form, k.source, k.target from u join k on lower(regexp_replace(u.raw, '\s+', ' ', 'g')) = k.phrase)
"""
#: The same matches in masked texts, under ``doc_id`` and ``text`` of ``masked``.
_TOKEN = "@@MATH_TRANSLATOR_000000@@"
_DOLLARS = r"\$[^$\n]+\$"
#: The rules of masking that the test tables can trigger, in order: comments, display math, dollar math, tags; a rule that takes in a token stops.
_MASK = rf"""
x1 as (select *, regexp_extract_all(text, '(?s)<!--.*?-->') as c, regexp_replace(text, '(?s)<!--.*?-->', '{_TOKEN}', 'g') as t1 from texts),
x2 as (select *, regexp_extract_all(t1, '(?s)\$\$.*?\$\$') as d, regexp_replace(t1, '(?s)\$\$.*?\$\$', '{_TOKEN}', 'g') as t2 from x1),
x3 as (select *, regexp_extract_all(t2, '(?:^|[^\\$]){_DOLLARS}') as g, regexp_replace(t2, '(^|[^\\$]){_DOLLARS}', '\1{_TOKEN}', 'g') as t3 from x2),
x4 as (select *, regexp_extract_all(t3, '</?[A-Za-z][^>]*>') as h, regexp_replace(t3, '</?[A-Za-z][^>]*>', '{_TOKEN}', 'g') as t4 from x3),
x5 as (select *, case when contains(array_to_string(d, ''), '{_TOKEN}') then 'nested: dollar display' when contains(array_to_string(g, ''), '{_TOKEN}') then 'nested: dollar math' when contains(array_to_string(h, ''), '{_TOKEN}') then 'nested: html tag' end as error from x4),
masked as (select *, len(c) + case when error = 'nested: dollar display' then 0 when error = 'nested: dollar math' then len(d) when error is not null then len(d) + len(g) else len(d) + len(g) + len(h) end as n_tokens from x5)
"""
_DOCUMENTS = "texts as (select doc_id, 'document' as kind, coalesce(text, '') as text from documents)"
_SPELLED = ", ".join(f"({i}, '{x}', '{x.casefold()}')" for i, x in enumerate(x for group in SPELLINGS for x in group))
_RUN = "[a-z0-9_]+"
_NOTES = ", ".join(f"('{s}', {i}, {d!r}, '{n}')" for i, (s, _, d, _, _, n) in enumerate(TERMS))
_IN_MASKED = (
    _MATCHES.replace("from documents)", "from masked where error is null)").replace("coalesce(text, '')", "t4").replace("with k(", f"with {_DOCUMENTS}, {_MASK}, n(source, term_no, domains, note) as (values {_NOTES}), k(")
)
_BOOKS = "books as (select source as book, (row_number() over (partition by source order by doc_id) - 1)::int as page_no, doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as chars from documents)"
_PARTS = f"""
with recursive {_BOOKS},
t as (select book, sum(chars)::bigint as total, greatest(1, (sum(chars)::bigint + 44999) // 45000) as planned from books group by book),
w as (select b.book, b.page_no, b.chars::bigint as chars, b.chars::bigint as reached, 0::bigint as part, case when b.chars::bigint * t.planned >= t.total and 1 < t.planned then 1 else 0 end::bigint as next
      from books b join t on t.book is not distinct from b.book where b.page_no = 0
      union all
      select b.book, b.page_no, b.chars::bigint, w.reached + b.chars, w.next,
             case when (w.reached + b.chars) * t.planned >= t.total * (w.next + 1) and w.next + 1 < t.planned then w.next + 1 else w.next end
      from w join books b on b.book = w.book and b.page_no = w.page_no + 1 join t on t.book = w.book),
parts as (select book, part, min(page_no) as first_page, max(page_no) as last_page, count(*) as n_pages, sum(chars)::bigint as chars from w group by book, part)
"""
_SCANS = """
s0 as (select conv_id as book, turn::int as turn, coalesce(text, '') as text, max(turn) over (partition by conv_id) as last from conversations),
scans as (select book, turn as page_no, case when turn = 0 then '# Book ' || book || chr(10) || '[by] Author ' || book when turn = 1 then 'Contents' || chr(10) || text
          when turn = 2 then 'A .... 1' || chr(10) || 'B .... 2' || chr(10) || text when turn = last and last > 4 then '## Index' || chr(10) || text else text end as text from s0),
lined as (select book, page_no, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '') as l from scans),
flags as (select book, page_no, len(l) = 0 as blank, len(list_filter(l[1:5], lambda x: regexp_full_match(x, '(?i)(?:#{1,6}\\s*)?(?:table\\s+of\\s+contents|contents|目录)\\s*'))) > 0 as heads,
          len(list_filter(l, lambda x: regexp_matches(x, '(?:\\.{2,}|…{2,}|\\s)\\s*\\d+\\s*$'))) >= 2 as listed,
          len(list_filter(l[1:8] || l[greatest(len(l) - 2, 1):], lambda x: regexp_full_match(x, '(?i)(?:#{1,6}\\s*)?(?:bibliography|references?|index|name\\s+index|glossary|biographical\\s+notes?|about\\s+the\\s+authors?|chronology)\\s*'))) > 0 as back from lined),
c as (select book, min(page_no) filter (heads and page_no < 32) as contents_page from flags group by book),
a as (select c.book, c.contents_page, coalesce(min(f.page_no) filter (f.page_no > c.contents_page and not (f.blank or f.heads or f.listed)), max(f.page_no) + 1) as after from c join flags f on f.book = c.book group by all),
b as (select a.book, a.contents_page, min(f.page_no) filter (f.page_no >= a.after and not f.blank) as body_start_page from a left join flags f on f.book = a.book group by all),
bounds as (select b.book, b.contents_page, b.body_start_page, min(f.page_no) filter (f.page_no >= b.body_start_page and f.back) as end_page_excluded,
           case when b.contents_page is null then 'no contents page among the first pages' when b.body_start_page is null then 'no body page after the contents' end as error
           from b left join flags f on f.book = b.book group by b.book, b.contents_page, b.body_start_page)
""".replace("\\\\", "\\")
_GENERIC = ", ".join(f"'{t}'" for t in GENERIC_TOKENS)
_TOKENS = f"list_filter(list_distinct(regexp_extract_all({{}}, '[\\x{{{{3400}}}}-\\x{{{{9fff}}}}]{{{{2,}}}}|[A-Za-z0-9][A-Za-z0-9_]{{{{3,}}}}')), lambda x: lower(x) not in ({_GENERIC}))"


def _tokens(column: str) -> str:
    return _TOKENS.format(column)


_COVERAGE = f"""
with {_BOOKS},
s as (select book, page_no, length(trim(text)) < {EXEMPT_CHARS} as short, {_tokens("text")} as t from books),
o as (select distinct source as book, unnest({_tokens("coalesce(text, '')")}) as token from documents where doc_id in (select doc_id from labels where quality = 1)),
x as (select book, page_no, unnest(t) as token from s where not short),
h as (select x.book, x.page_no, count(*) as hits from x join o on o.book = x.book and o.token = x.token group by all),
c as (select s.book, s.page_no, len(s.t)::bigint as tokens, case when not s.short and len(s.t) > 0 then coalesce(h.hits, 0) end::bigint as hits,
             case when s.short or len(s.t) = 0 then 1.0::double else coalesce(h.hits, 0)::double / len(s.t) end as coverage
      from s left join h on h.book = s.book and h.page_no = s.page_no)
"""
_TURNS = "t as (select conv_id as doc_id, string_agg(coalesce(text, ''), chr(10) || chr(10) order by turn) as text from conversations group by conv_id)"
_PACKED = f"""
with recursive {_TURNS},
g as (select doc_id, regexp_split_to_array(text, '\\r?\\n[ \\t]*\\r?\\n') as gaps, regexp_extract_all(text, '\\r?\\n[ \\t]*\\r?\\n') as ends from t),
k as (select doc_id, flatten(list_transform(range(1, len(gaps) + 1), lambda i: case when i <= len(ends) then [gaps[i], ends[i]] else [gaps[i]] end)) as b from g),
e as (select doc_id, unnest(b) as block, unnest(range(1, len(b) + 1)) as i from k),
w as (select doc_id, i, block, length(block) as size, 0 as chunk_no from e where i = 1
      union all
      select e.doc_id, e.i, e.block, case when w.size > 0 and w.size + length(e.block) > 1000 then length(e.block) else w.size + length(e.block) end,
             case when w.size > 0 and w.size + length(e.block) > 1000 then w.chunk_no + 1 else w.chunk_no end
      from w join e on e.doc_id = w.doc_id and e.i = w.i + 1),
ch as (select doc_id, chunk_no, string_agg(block, '' order by i) as chunk from w group by all),
chunks as (select doc_id, chunk_no, chunk, (sum(length(chunk)) over (partition by doc_id order by chunk_no))::int as chunk_end from ch)
"""
_CANDIDATES = """
c as (select role, conv_id, turn, regexp_extract(text, '([A-Za-z]+)', 1) as source, case when turn > 2 then 'r' || turn else '' end as reason from conversations),
n as (select role, lower(source) as source, count(*) as n, max_by(reason, conv_id * 1000000 + turn) filter (reason <> '') as reason from c where source <> '' and length(source) <= 120 group by all)
"""
_ARTIFACT = r"""case when trim(regexp_replace(text, '^\s+', '')) = '' then 'empty' when regexp_matches(text, '^\s*```') then 'code fence' when contains(text, '\documentclass') or contains(text, '\begin{document}') or contains(text, '\end{document}') or contains(text, '\bibliography') then 'root document command'
            when regexp_matches(text, '(?i)<\s*/?(?:table|tr|td|th)\b') then 'html table' when regexp_matches(text, '(?i)\\caption\s*\{\s*Image\s*\}') then 'placeholder caption'
            when len(regexp_extract_all(text, '\\text\s*\{')) >= 40 or len(list_filter(string_split(text, chr(10)), lambda x: length(x) > 700 and len(regexp_extract_all(x, '\\text\s*\{')) >= 3)) >= 2 then 'prose in text wrappers'
            when regexp_matches(text, '\\chapter\*?\s*\{') then 'chapter heading in a chunk' end"""
_STRUCTURES = [
    ("headings", r"regexp_extract_all({}, '(?m)^(#{{1,6}})[ \t]+', 1)"),
    ("rules", r"len(regexp_extract_all({}, '(?m)^\s*(?:---+|\*\*\*+|___+)\s*$'))"),
    ("sections", r"regexp_extract_all({}, '\\(?:part|chapter|section|subsection|subsubsection|paragraph)\*?\s*\{{')"),
    ("labels", r"list_sort(list_distinct(regexp_extract_all({}, '\\label\{{([^{{}}]+)\}}', 1)))"),
    ("references", r"list_sort(list_distinct(regexp_extract_all({}, '\\(?:ref|eqref|autoref|cref|Cref|cite|citep|citet)\*?(?:\[[^\]]*\])?\{{([^{{}}]+)\}}', 1)))"),
]
_CHUNKED = f"""{_PARTS}, tx as (select w.book, w.part, string_agg(b.text, chr(10) order by w.page_no) as text from w join books b on b.book = w.book and b.page_no = w.page_no group by all),
    made as (select book, part, 'chapter_01_part_' || lpad(part::varchar, 2, '0') as chunk_id, text, {_ARTIFACT} as error from tx)"""
_HOST = "regexp_extract(url, '://([^/?#]*)', 1)"

def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_OUTLINED = ", ".join(f"({i}, '{x}')" for i, x in enumerate(OUTLINES))
_CHAPTER_FIELDS = "('number', 'integer', 0, 0), ('title', 'string', 0, 0), ('printed_start_page', 'integer', 1, 1), ('ocr_start_page', 'integer', 0, 0), ('ocr_end_page', 'integer', 0, 0), ('sections', 'array', 0, 0)"
_SECTION_FIELDS = "('title', 'string', 0, 0), ('printed_start_page', 'integer', 1, 1), ('ocr_start_page', 'integer', 1, 1)"
_END_FIELDS = "('heading', 'string', 1, 0), ('printed_start_page', 'integer', 1, 1), ('ocr_start_page', 'integer', 1, 1)"


def _kind(where: str) -> str:
    return f"case json_type({where}) when 'VARCHAR' then 'string' when 'UBIGINT' then 'integer' when 'BIGINT' then 'integer' when 'DOUBLE' then 'number' else lower(json_type({where})) end"


def _typed(rows: str, fields: str) -> str:
    """Faults of the fields of objects ``c`` at ``place``; what is no object has one fault."""
    got = f"coalesce({_kind("c, '$.' || n")}, 'missing')"
    return f"""select event_id, place || ': ' || coalesce({_kind("c")}, 'missing') as f from {rows} where json_type(c) is distinct from 'OBJECT'
      union all select event_id, place || '.' || n || ': ' || {got} from {rows} cross join (values {fields}) w(n, k, optional, nullable)
      where json_type(c) = 'OBJECT' and {got} <> k and not (optional = 1 and {got} = 'missing') and not (nullable = 1 and {got} = 'null')"""


SQL: dict[str, str] = {
    "dictionary_matches": rf"""
with k as (select distinct unnest(l) as k from (select regexp_extract_all(lower(coalesce(text, '')), '{_RUN} {_RUN}') as l from conversations
             union all select regexp_extract_all(lower(coalesce(text, '')), '{_RUN} {_RUN} {_RUN}') from benchmark union all select regexp_extract_all(lower(coalesce(text, '')), '{_RUN}') from benchmark)),
t as (select doc_id, unnest(l) as t, unnest(range(len(l))) as i from (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '{_RUN}|\s+|[^a-z0-9_\s]') as l from documents)),
p as (select doc_id, i, case when t[1] in (' ', chr(9), chr(10), chr(11), chr(12), chr(13)) then ' ' else t end as t, length(t) as n, coalesce(sum(length(t)) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as s from t),
g as (select doc_id, s, t as g1, s + n as e1, t || lead(t) over w || lead(t, 2) over w as g3, lead(s + n, 2) over w as e3,
             t || lead(t) over w || lead(t, 2) over w || lead(t, 3) over w || lead(t, 4) over w as g5, lead(s + n, 4) over w as e5 from p window w as (partition by doc_id order by i)),
c as (select doc_id, s, e1 as e, g1 as k from g union all select doc_id, s, e3, g3 from g union all select doc_id, s, e5, g5 from g),
m as (select doc_id, list({{'s': s::bigint, 'e': e::bigint, 'p': contains(k, ' ')::bigint}} order by s, e desc) as l from c join k using (k) group by doc_id),
f as (select doc_id, list_reduce(list_prepend({{'s': 0::bigint, 'e': 0::bigint, 'p': 0::bigint, 'n': 0::bigint, 'c': 0::bigint}}, list_transform(l, lambda x: {{'s': x.s, 'e': x.e, 'p': x.p, 'n': 1::bigint, 'c': x.e - x.s}})),
             lambda a, x: case when x.s >= a.e then {{'s': x.s, 'e': x.e, 'p': a.p + x.p, 'n': a.n + 1, 'c': a.c + x.c}} else a end) as f from m)
select doc_id, f.n as n_matches, f.c as matched_chars, f.p as n_phrases from f
""",
    "folded_spellings": f"""with s(i, x, f) as (values {_SPELLED}), d as (select f, lower(regexp_extract(coalesce(text, ''), '([A-Za-z]+)', 1)) as w from documents join s on doc_id % {3 * len(SPELLINGS)} = s.i)
select case when w = '' then f else f || ' ' || w end as key, count(*) as n from d group by 1""",
    "term_frequency": f"{_MATCHES} select source, target, count(*) as occurrences from m group by source, target",
    "term_forms_top8": f"""{_MATCHES}, c as (select source, form, count(*) as n, min(doc_id * 1000000 + no) as first from m group by source, form),
        r as (select source, form, n, row_number() over (partition by source order by n desc, first) as form_no from c) select source, form, n, form_no from r where form_no <= 8""",
    "longest_match": f"{_MATCHES} select doc_id, count(*) as n_matches, sum(length(form))::bigint as matched_chars, count(*) filter (source like '% %') as n_phrases from m group by doc_id",
    "terminology_missing": f"""{_MATCHES}, r as (select distinct doc_id, source from m) select r.source, count(*) as n_docs from r join documents d using (doc_id) where not contains(d.text, r.source) group by r.source""",
    "term_conflicts": """with h as (select distinct lower(regexp_extract(url, '://([^/]*)', 1)) as key, regexp_extract(url, '^([a-z]+)://', 1) as target from pages where url is not null)
        select key, count(distinct target) as n_targets, min(target) as first_target, max(target) as last_target from h where key <> '' group by key having count(distinct target) > 1""",
    "domain_filter": "with t(domain, source, target) as (values "
    + ", ".join(f"('{d}', '{s}', '{t}')" for d in ("en", "fr", "de", "es") for s, t, ds, _, _, _ in _ACTIVE if {"*", "general", d} & set(ds))
    + ") select t.domain, t.source, t.target from t where t.domain in (select lang from documents)",
    "table_term_filter": f"""with p as (select p_partkey, trim(regexp_replace(trim(regexp_replace(p_name, '\\s+', ' ', 'g')), '\\s+[A-Z]$', '')) as source, regexp_replace(p_brand || ' ' || p_type, '\\s+', '', 'g') as target from part),
        u as (select *, row_number() over (partition by lower(source) order by p_partkey) as no from p where length(source) between 4 and 120 and regexp_matches(source, '[\\s/-]') and not regexp_matches(source, '[{{}}\\\\$]'))
        select source, target from u where no = 1 and lower(source) not in ({", ".join(f"'{p}'" for p, _, _ in _PHRASES)})""",
    "content_tokens": f"with d as (select doc_id, {_tokens("coalesce(text, '')")} as t from documents) select doc_id, len(t)::bigint as n_tokens, list_min(t) as first_token from d",
    "coverage_audit": f"{_COVERAGE} select book, page_no, tokens, hits, coverage, coverage < 0.2 as missing from c",
    "missing_pages": f"""{_COVERAGE}, s2 as (select book, count(*) as n, coalesce(sum(hits)::double / sum(tokens) filter (hits is not null), 1.0) as o, sum((coverage < 0.2)::int)::bigint as m from c group by book)
        select book, o as overall_coverage, m as missing_pages, greatest(1, n // 10)::bigint as allowed_missing_pages, o >= 0.72 and m <= greatest(1, n // 10) as passed from s2""",
    "chapter_parts": f"{_PARTS} select book, part, first_page, last_page, n_pages, chars from parts",
    "chapter_ranges": f"{_PARTS} select book, min(first_page) as start_page, max(last_page) as end_page, count(*) as parts from parts group by book",
    "range_pages": f"{_PARTS} select book, part, n_pages as pages, chars as characters from parts",
    "section_in_chunk": f"{_PARTS} select p.book, p.part, count(*) as n_sections from parts p join books b on b.book = p.book and b.chars > 3000 and b.page_no between p.first_page and p.last_page group by all",
    "chunk_index": f"{_PARTS} select book, part, string_agg(page_no::varchar, ',' order by page_no) as pages, sum(chars)::bigint as characters from w group by book, part",
    "ordered_assembly": rf"""{_PARTS}, i as (select book, '\chapter{{On ' || replace(book, '_', '\_') || '\_\&}}' || chr(10) || string_agg('\input{{chapters/chapter_01_part_' || lpad(part::varchar, 2, '0') || '}}', chr(10) order by part) as inputs from parts group by book)
        select book, true as complete, sha256('{ROOT_COMMENT}' || chr(10) || '\documentclass{{article}}' || chr(10) || '\input{{preamble}}' || chr(10) || '\title{{' || replace(book, '_', '\_') || '}}' || chr(10) ||
            '\begin{{document}}' || chr(10) || '\maketitle' || chr(10) || '\frontmatter' || chr(10) || '\tableofcontents' || chr(10) || '\mainmatter' || chr(10) || inputs || chr(10) || '\end{{document}}' || chr(10)) as tex_sha256 from i""",
    "block_packing": f"{_PACKED} select doc_id, chunk_no, (chunk_end - length(chunk))::int as chunk_start, chunk_end, sha256(chunk) as chunk_sha256 from chunks",
    "chunk_match_overlap": f"""{_PACKED}, l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(0, len(string_split(text, chr(10))))) as line_no from t),
        s as (select doc_id, line_no, length(line) as n, coalesce(sum(length(line) + 1) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding), 0) as start from l)
        select c.doc_id, c.chunk_no, count(*) as n_lines, min(s.line_no)::int as first_line from chunks c join s on s.doc_id = c.doc_id and s.start < c.chunk_end and s.start + s.n > c.chunk_end - length(c.chunk) group by all""",
    "neighbour_pages": f"with {_BOOKS} select book, page_no, lag(page_no) over w as previous_page, lead(page_no) over w as next_page from books window w as (partition by book order by page_no)",
    "contiguity_violations": "with l as (select source, doc_id, lag(doc_id) over (partition by source order by doc_id) as before from documents) select source, count(*) as n_violations from l where before is not null and doc_id <> before + 1 group by source",
    "body_bounds": f"with {_SCANS} select book, contents_page, body_start_page, end_page_excluded, error from bounds",
    "metadata_heading": f"with {_SCANS} select book, 'Book ' || book as title, 'Author ' || book as author from bounds where contents_page is not null union all select book, 'OCR Document', '' from bounds where contents_page is null",
    "body_page_count": f"""with {_SCANS} select b.book, b.contents_page is not null and b.body_start_page is not null and coalesce(b.end_page_excluded > b.body_start_page, true) as valid,
        count(s.page_no) as n_pages from bounds b left join scans s on s.book = b.book and s.page_no >= b.body_start_page and (b.end_page_excluded is null or s.page_no < b.end_page_excluded) group by all""",
    "chapter_violations": f"""with {_SCANS},
        p as (select b.book, b.book % 13 as f, b.body_start_page as bs, b.end_page_excluded as ee, s.page_no as p from bounds b join scans s on s.book = b.book and s.page_no >= b.body_start_page and (b.end_page_excluded is null or s.page_no < b.end_page_excluded)),
        k as (select *, p - 2 + (f = 1)::int as number, case when f = 2 then '' else 'T' end as title, case when f = 5 and p = 3 then 0 when f = 6 and p = 4 then 3 else p end as s, case when f = 3 then p - 1 when f = 4 then p + 1000 else p end as e, p + (f = 9)::int as sec
              from p where not (f = 10 and coalesce(p = ee - 1, false)) and not (f = 0 and book % 26 = 0)),
        r as (select k.*, row_number() over w as no, lag(e) over w as before, lead(number) over w is null as is_last, (select count(*) from scans x where x.book = k.book and x.page_no between k.s and k.e) as have from k window w as (partition by book order by number)),
        ce as (select unnest(list_filter([case when number <> no then 'numbers are not consecutive' end, case when title = '' then 'the title is empty' end, case when s > e then 'no valid page range' end,
              case when s <= e and have <> e - s + 1 then 'the range has pages that do not exist' end, case when s < bs then 'starts before the body' end, case when s <> before + 1 then 'does not follow the chapter before' end,
              case when f = 7 then 'the list of sections is missing' end, case when f = 8 then 'a section has no title' end, case when f <> 7 and not sec between s and e then 'a section starts outside its chapter' end,
              case when is_last and e <> ee - 1 then 'the last chapter does not reach the end' end], lambda x: x is not null)) as error from r),
        o as (select case when not exists (select 1 from k where k.book = b.book) then 'no chapters' when book % 13 = 11 then 'the end of the body is missing' when book % 13 = 12 and end_page_excluded is not null then 'the end of the body differs from the page boundary' end as error from bounds b where b.error is null)
        select error, count(*) as n from (select error from ce union all select error from o where error is not null) group by error""",
    "page_lines": """with d as (select doc_id, list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '') as l from documents)
        select doc_id, len(l)::bigint as n_lines, sha256(array_to_string(l, chr(10))) as lines_sha256 from d""".replace("\\\\", "\\"),
    "page_index": """with d as (select doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '') as l from documents)
        select doc_id, least(8, len(list_filter(l, lambda x: regexp_matches(x, '^#{1,6}\\s+'))))::bigint as n_headings, array_to_string(l[1:3], ' | ') as opening from d""",
    "image_refs": f"""with p as (select page_id, url, {_HOST} as host from pages where url is not null) select page_id, len(r)::bigint as n_refs, array_to_string(r, '|') as refs
        from (select page_id, list_sort(list_distinct(['img/' || host || '.png', 'pic/' || host || '.jpg', url])) as r from p)""",
    "missing_refs": f"""with p as (select distinct {_HOST} as host from pages where url is not null) select 'pic/' || host || '.jpg' as path from p union select 'img/' || host || '.png' from p where not starts_with(host, 'blog.')""",
    "artifact_violations": f"""with t as (select case when doc_id % 17 = 0 then ' ' || chr(10) else [{", ".join(_quoted(x) for x in FAULTS)}][doc_id % {len(FAULTS)} + 1] || coalesce(text, '') end as text from documents union all select coalesce(html, '') from pages)
        select coalesce({_ARTIFACT}, 'valid') as rule, count(*) as n from t group by rule""",
    "control_chars": "with d as (select regexp_extract(replace(coalesce(text, ''), '%', chr(7)), '([\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f])', 1) as c from documents) select case when c <> '' then 'U+' || lpad(upper(printf('%x', ascii(c))), 4, '0') end as code, count(*) as n from d group by code",
    "structural_diff": f"""with d as (select doc_id, {_quoted(HEADS[0])} || coalesce(text, '') as a, [{", ".join(_quoted(x) for x in HEADS)}][doc_id % {len(HEADS)} + 1] || case when doc_id % 7 = 0 then translate(coalesce(text, ''), '#-', '') else coalesce(text, '') end as b from documents)
        select doc_id, array_to_string(list_filter([{", ".join(f"case when {p.format('a')} <> {p.format('b')} then '{n}' end" for n, p in _STRUCTURES)}], lambda x: x is not null), ',') as warnings from d""",
    "candidate_upsert": f"""with {_CANDIDATES} select coalesce(u.source, a.source) as source, 't' as target, 'unspecified' as domain, coalesce(a.reason, u.reason, '') as reason, 'candidate' as status, coalesce(u.n, 0) + coalesce(a.n, 0) as occurrences,
        case when u.n is null then '2024-02-01' else '2024-01-01' end as first_seen, case when a.n is null then '2024-01-01' else '2024-02-01' end as last_seen
        from (select * from n where role = 'user') u full join (select * from n where role = 'assistant') a on a.source = u.source""",
    "approve_term": "with t(term_no, source, target, status, reference) as (values "
    + ", ".join(f"({i}, '{s}', '{'T11' if s == 'und' else t}', '{'approved' if s == 'und' else (st or '')}', '{'r1' if s == 'und' else ''}')" for i, (s, t, _, _, st, _) in enumerate(TERMS))
    + f", ({len(TERMS)}, 'neu', 'T12', 'approved', 'r2')) select term_no::bigint as term_no, source, target, status, reference, (select count(*) from documents where lang = 'de') as n_docs from t",
    "pending_chunks": "select doc_id, source from documents where doc_id not in (select doc_id from labels where quality = 1)",
    "latest_valid_attempt": "select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as no from events where event_type <> 'error') where no = 1",
    "jsonl_pages": "select conv_id as line_no, row_number() over (order by conv_id, turn) - 1 as page_no, length(coalesce(text, ''))::bigint as chars, coalesce(role, '') as role from conversations",
    "arxiv_ids": r"""with u as (select page_id, 'https://arxiv.org/abs/' || case when contains(url, '/en/') then 'math.AG/' else '2101.' end || lpad(page_id::varchar, 7, '0') || 'v2' as u from pages where url is not null),
        x as (select page_id, regexp_extract(u, '((?:\d{4}\.\d{4,5}|[a-z-]+(?:\.[A-Z]{2})?/\d{7})(?:v\d+)?)', 1) as arxiv_id from u) select page_id, arxiv_id, 'arXiv_' || replace(arxiv_id, '/', '_') as folder from x""",
    "command_set_diff": f"""with h as (select {_HOST} as host, bool_or(starts_with(url, 'https:')) as safe, bool_or(not starts_with(url, 'https:')) as plain from pages where url is not null group by host)
        select host, case when safe then 'left' else 'right' end as side from h where safe <> plain""",
    "tex_escape": r"""select doc_id, sha256(replace(regexp_replace(replace(coalesce(text, ''), '\', chr(1)), '([&%#_{}])', '\\\1', 'g'), chr(1), '\textbackslash{}')) as tex_sha256 from documents""",
    "sanitized_candidates": """with c as (select trim(regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g')) as source, coalesce(role, '') as target, case when role = 'user' then 'algebra' else 'general' end as domain from conversations)
        select domain, count(*) as n, sum(length(target))::bigint as target_chars from c where source <> '' and target <> '' and length(source) <= 120 group by domain""",
    "output_names": r"""with p as (select coalesce(source, '') || '/a.' || ['md', 'TeX', 'ltx', 'txt'][(length(lang) + length(coalesce(source, ''))) % 4 + 1] as path from documents)
        select case when lower(path) like '%.tex' or lower(path) like '%.ltx' then 'LaTeX' when lower(path) like '%.md' then 'Markdown' end as format, regexp_replace(path, '(\.[^./]+)$', '.zh\1') as output, count(*) as n from p group by all""",
    "mask_counts": f"""with texts as (select 'document' as kind, coalesce(text, '') as text from documents union all select 'page', coalesce(html, '') from pages), {_MASK}
        select kind, error, count(*) as n, sum(n_tokens)::bigint as n_tokens from masked group by kind, error""",
    "mask_roundtrip": f"with {_DOCUMENTS}, {_MASK} select doc_id, case when error is null then true end as same, error from masked",
    "translate_documents": f"with {_DOCUMENTS}, {_MASK} select doc_id, case when error is null then sha256(text) end as text_sha256, case when error is null then 1 end as tries, error from masked",
    "translation_warnings": f"""{_IN_MASKED}, f as ({_MATCHES} select doc_id, source, target, min(no) as no from m group by all)
        select x.doc_id, coalesce(string_agg(f.source || ' -> ' || f.target, '; ' order by f.no, f.source) filter (not contains(x.text, f.target)), '') as warnings from masked x left join f on f.doc_id = x.doc_id where x.error is null group by x.doc_id""",
    "prompt_rules": f"""{_MATCHES}, n(source, term_no, domains, note) as (values {_NOTES}), f as (select doc_id, source, target, min(no) as no, min_by(form, no) as form from m group by all)
        select doc_id, string_agg('- ' || source || ' -> ' || target || case when lower(form) <> lower(source) then '; found as: ' || form else '' end || case when note <> '' then '; note: ' || note else '' end, chr(10) order by no) as rules from f join n using (source) group by doc_id""",
    "report_counters": f"""{_IN_MASKED}, t as (select count(distinct source || chr(0) || target) as n from m)
        select (select count(*) from masked) as files, (select sum(n_tokens) filter (error is null)::bigint from masked) as protected_segments, t.n as matched_unique_terms, least(t.n, 300) as reported_terms, greatest(t.n - 300, 0) as omitted_terms, {len(_ACTIVE)} as active_terms from t""",
    "term_report": f"""{_IN_MASKED}, c as (select source, target, form, count(*) as n, min(doc_id * 1000000 + no) as first from m group by source, target, form),
        r as (select *, row_number() over (partition by source, target order by n desc, first) as form_no from c),
        f as (select source, target, string_agg(form || ' (' || n || ')', ', ' order by form_no) as forms from r where form_no <= 8 group by source, target),
        t as (select source, target, count(*) as occurrences, count(distinct doc_id) as n_files from m group by source, target)
        select row_number() over (order by occurrences desc, length(source) desc, lower(source), target) as rank, source, target, occurrences, forms, array_to_string(list_sort(domains), ',') as domains, note as notes, n_files
        from t join f using (source, target) join n using (source) order by rank limit 300""",
    "convert_chunks": f"{_CHUNKED} select book, part, chunk_id, sha256(text) as tex_sha256, error, 1.0::double as overall_coverage, error is null as accepted from made",
    "conversion_faults": f"""{_CHUNKED}, x as (select book, part, case part % 7 when 5 then 'empty' when 6 then 'code fence' else error end as rule,
        case part % 7 when 1 then 'chunk_id differs' when 2 then 'source_pages differ' when 3 then 'structure_notes is missing' when 4 then 'image_notes is missing' end as report from made)
        select book, part, coalesce(rule, report) as error, coalesce(rule, report) is null as accepted from x""",
    "review_faults": f"""{_CHUNKED} select book, part, case part % 7 when 1 then 'chunk_id differs' when 2 then 'source_pages differ' when 5 then 'empty' when 6 then 'root document command' end as error from made where error is null""",
    "answer_faults": f"""select doc_id, case doc_id % 7 when 0 then 1 when 3 then 1 else 2 end::int as tries,
        case doc_id % 7 when 3 then 'unknown token: @@MATH_TRANSLATOR_000009@@' when 4 then 'token not exactly once: {_TOKEN}' when 6 then 'wrong shape' end as error,
        case when doc_id % 7 in (0, 1, 2, 5) then sha256('$a$ ' || coalesce(text, '') || ' $b$') end as text_sha256 from documents""",
    "learned_terms": rf"""with {_DOCUMENTS}, {_MASK}, w as (select d.lang, unnest(regexp_extract_all(m.t4, '\b[a-z]{{7,12}}\b')) as w from masked m join documents d using (doc_id) where m.error is null)
        select w as source, upper(w) as target, case when starts_with(w, 'e') then coalesce(nullif(trim(lang), ''), 'unspecified') else 'General' end as domain, 'ends in ' || right(w, 1) as reason, 'candidate' as status, count(*) as occurrences
        from w where not starts_with(w, 'a') group by all""",
    "assembly_checks": rf"""{_PARTS}, k as (select *, coalesce(try_cast(regexp_extract(book, '(\d+)$', 1) as int), 2) as n from parts), c as (select book, part, n, part // 2 + case when n % 4 = 0 then 2 else 1 end as chapter from k),
        f as (select *, 'chapter_' || lpad(chapter::varchar, 2, '0') || '_part_' || lpad(part::varchar, 2, '0') as id,
              case when n % 2 = 1 then case (part + n // 2) % 12 when 0 then 'the fragment is missing' when 3 then 'chunk_id differs' when 5 then 'structure_notes is missing' when 6 then 'the report is missing' when 7 then 'code fence' when 8 then 'root document command' end end as fault from c),
        h as (select book, chapter, '\chapter{{On}}' || chr(10) || string_agg('\input{{chapters/' || id || '}}', chr(10) order by part) as text from f group by all),
        b as (select book, count(*) as chapters, max(chapter) as top, string_agg(text, chr(10) order by chapter) as inputs from h group by book),
        e as (select book, count(fault) as n_faults, min_by(id || ': ' || fault, part) filter (fault is not null) as fault from f group by book)
        select b.book, case when error is null then sha256(inputs) end as inputs_sha256, chapters, n_faults, error
        from (select b.*, e.n_faults, coalesce(e.fault, case when top <> b.chapters then 'the chapters'' numbers do not run from 1' end) as error from b join e on e.book is not distinct from b.book) b""",
    "legacy_chapters": r"""with l as (select conv_id, turn, 'chapters/chapter_' || lpad((turn + 1)::varchar, 2, '0') as name, coalesce(role, '') as role from conversations),
        i as (select conv_id, string_agg(case when role = 'user' and not (conv_id % 7 = 0 and turn = 1) then '' else '\chapter{' || replace(role, '_', '\_') || '\_\&}' || chr(10) end || '\input{' || name || '}', chr(10) order by turn) as inputs,
              bool_or(conv_id % 7 = 0 and turn = 1) as blank, bool_or(conv_id % 11 = 0 and turn = 0) as missing from l group by conv_id)
        select conv_id, sha256(inputs) as inputs_sha256, case when blank then 'a chapter file is empty' end as error from i where not missing""",
    "book_outlines": f"""with {_SCANS}, n as (select b.book, b.end_page_excluded as e, count(*) as n, max(s.page_no) as last from bounds b join scans s on s.book = b.book and s.page_no >= b.body_start_page and (b.end_page_excluded is null or s.page_no < b.end_page_excluded) where b.error is null and b.book % 5 <> 0 group by all)
        select book, case when n % 4 = 1 then -1 else n end as chapters, case n % 4 when 0 then case when e is not null then 'the last chapter does not reach the end; ' else '' end || 'the range has pages that do not exist' when 1 then 'wrong shape' when 3 then 'the title is empty' else '' end as errors from n""",
    "json_type_faults": f"""
with e as (select event_id, replace(o.t, 'K', coalesce(json_extract_string(props, '$.k'), '0')) as t from events join (values {_OUTLINED}) o(i, t) on event_id % {len(OUTLINES)} = o.i),
v as (select event_id, case when json_valid(t) then t::json end as v from (select event_id, ltrim(t, chr(65279)) as t from e)),
c as (select event_id, 'chapters[' || i || ']' as place, c from (select event_id, unnest(json_extract(v, '$.chapters[*]')) as c, unnest(range(len(json_extract(v, '$.chapters[*]')))) as i from v)),
s as (select event_id, place || '.sections[' || i || ']' as place, c from (select event_id, place, unnest(json_extract(c, '$.sections[*]')) as c, unnest(range(len(json_extract(c, '$.sections[*]')))) as i from c)),
b as (select event_id, 'body_end' as place, json_extract(v, '$.body_end') as c from v where json_type(v) = 'OBJECT'),
q as ({_typed("c", _CHAPTER_FIELDS)} union all {_typed("s", _SECTION_FIELDS)} union all {_typed("b", _END_FIELDS)} union all
      select event_id, 'no JSON' from v where v is null union all select event_id, '$: ' || {_kind("v")} from v where json_type(v) <> 'OBJECT' union all
      select event_id, 'chapters: ' || case when {_kind("v, '$.chapters'")} = 'array' then 'empty' else coalesce({_kind("v, '$.chapters'")}, 'missing') end from v
      where json_type(v) = 'OBJECT' and (coalesce({_kind("v, '$.chapters'")}, '') <> 'array' or json_array_length(v, '$.chapters') = 0))
select coalesce(q.f, 'none') as fault, count(*) as n from v left join q using (event_id) group by 1""",
    "review_chunks": f"{_CHUNKED} select book, part, true as same, null::varchar as error from made where error is null",
    "recovered_chunks": f"{_CHUNKED} select book, part, sha256(text) as tex_sha256, error is null as accepted, error is null and part % 2 = 0 as recovered from made",
    "document_report": f"""{_CHUNKED}, p as (select book, max(last_page) as end_page from parts group by book)
        select made.book, count(*) as chunks, 1::bigint as chapters, p.end_page, count(*) filter (error is null) as reviewed_chunks, string_agg(chunk_id || ':' || (error is null)::varchar, ',' order by part) as completeness from made join p using (book) group by made.book, p.end_page""",
    "completeness_report": f"""{_PARTS}, s as (select w.book, w.part, b.page_no, b.doc_id, length(trim(b.text)) < {EXEMPT_CHARS} as short, {_tokens("b.text")} as t from w join books b on b.book = w.book and b.page_no = w.page_no),
        o as (select distinct book, part, unnest(t) as token from s where doc_id in (select doc_id from labels where quality = 1)),
        x as (select book, part, page_no, unnest(t) as token from s where not short),
        h as (select x.book, x.part, x.page_no, count(*) as hits from x join o using (book, part, token) group by all),
        c as (select s.book, s.part, s.page_no, not short and len(t) > 0 as audited, len(t) as n, coalesce(hits, 0) as hits, case when short or len(t) = 0 then 1.0::double else coalesce(hits, 0)::double / len(t) end as coverage from s left join h on h.book = s.book and h.part = s.part and h.page_no = s.page_no),
        g as (select book, part, coalesce(sum(hits) filter (audited)::double / sum(n) filter (audited), 1.0) as o, count(*) filter (coverage < 0.2) as m, greatest(1, count(*) // 10)::bigint as allowed, coalesce(string_agg(page_no::varchar, ',' order by page_no) filter (coverage < 0.2), '') as missing, string_agg(round(printf('%.3f', coverage)::double * 1000)::int::varchar, ',' order by page_no) as shares from c group by all)
        select book, part, o >= 0.72 and m <= allowed as passed, printf('%.3f', o)::double as overall_coverage, allowed as allowed_missing_pages, missing as missing_pages, shares from g""",
    "unknown_pages": "with b as (select source as book, count(*) - 1 as last from documents group by source) select book, (last - last % 2 + 2)::int as page_no from b where book is not null",
    "changed_manifests": f"with {_SCANS} select book, contents_page, body_start_page, end_page_excluded, error from bounds where book % 3 = 0 and end_page_excluded is not null",
    "main_files": r"""select doc_id, case when doc_id % 50 = 0 then 0 else 1 end as priority, case when doc_id % 50 = 0 then '\documentclass{a}' || chr(10) || '\title{New}' || chr(10) || '\input{chapters/c_' || doc_id || '-zh}' || chr(10) || '\textbf中' end as root, doc_id % 50 = 0 as macro_before_han from documents""",
}

_SUFFIX = "(['md', 'TEX', 'markdown', 'txt'])[(doc_id % 4)::int + 1]"
_NAME = f"'texts/' || lpad((doc_id % 16)::varchar, 2, '0') || '/d' || lpad(doc_id::varchar, 12, '0') || '.' || {_SUFFIX}"
_MEMBER = "case page_id % 9 when 1 then '../' || page_id when 2 then '/p/' || page_id when 3 then 'p/../../p-more/' || page_id else 'p/' || page_id end"
_SAFE = "page_id % 9 not in (1, 2, 3)"
SQL |= {
    "scanned_files": f"""with f as (select *, {_NAME} as name, case when doc_id % 4 = 3 then 'no known format' when doc_id % 10 = 1 then 'no UTF-8' end as error from documents)
        select row_number() over (order by name) - 1 as file_no, name, case doc_id % 4 when 1 then 'LaTeX' when 3 then null else 'Markdown' end as format, case when error is null then sha256(replace(coalesce(text, ''), chr(13), chr(10)) || chr(10)) end as text_sha256, error from f""",
    "ledger_versions": """with c as (select lower(regexp_extract(coalesce(text, ''), '([A-Za-z]+)', 1)) as source, 1 as b, case when turn > 2 then 'r' || turn else '' end as reason, conv_id as i, turn as j from conversations where role = 'user'
        union all select lower(regexp_extract(coalesce(text, ''), '([A-Za-z]+)', 1)), 2, 'b', item_id, 0 from benchmark),
        k as (select *, ('0x' || substr(md5(source || chr(10) || 't' || chr(10) || 'unspecified'), 1, 4))::int % 128 as bucket from c where source <> '' and length(source) <= 120)
        select source, count(*) as occurrences, coalesce(arg_max(reason, (b, i, j)) filter (reason <> ''), '') as reason, case when max(b) = 2 then '2024-02-01' else '2024-01-01' end as last_seen,
        bool_or(bucket in (select bucket from k where b = 2)) as rewritten from k group by source""",
    "written_translations": f"select doc_id, text_sha256, null::varchar as error from ({SQL['translate_documents']}) where error is null",
    "archive_members": f"""select page_id // 100 as archive, {_MEMBER} as name, strlen(coalesce(html, ''))::bigint as size, case when {_SAFE} then sha256(coalesce(html, '')) end as content_sha256,
        case page_id % 9 when 2 then 'absolute or empty' when 1 then 'leaves the folder' when 3 then 'leaves the folder' end as error from pages""",
    "report_document": f"""with r as ({SQL['term_report']}), c as ({SQL['report_counters']})
        select unnest(range(12))::int as line_no, unnest(['# Terms in use', '', '- domain: all', '- files: ' || files, '- protected segments: ' || protected_segments, '- active terms: ' || active_terms, '- matched unique terms: ' || matched_unique_terms,
            '- reported terms: ' || reported_terms, '- omitted terms: ' || omitted_terms, '', '| source | target | occurrences | forms | notes |', '| --- | --- | ---: | --- | --- |']) as value from c
        union all select (rank + 11)::int, '| ' || source || ' | ' || target || ' | ' || occurrences || ' | ' || forms || ' | ' || notes || ' |' from r""",
}
