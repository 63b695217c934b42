"""The report masks and searches each text once, and plain texts are not searched by the patterns of masking."""

import re

from corpuskiln.operators import masking, matching, report
from corpuskiln.plans import queries

SMOKE = "/root/testdata/sf0.001"


def test_report_masks_and_matches_texts_once(spark, monkeypatch):
    calls = []
    mask, find = masking.mask, matching.find_terms
    counted = lambda name, step: lambda *a, **k: calls.append(name) or step(*a, **k)
    for module in (masking, report):
        monkeypatch.setattr(module, "mask", counted("mask", mask))
    for module in (matching, report):
        monkeypatch.setattr(module, "find_terms", counted("find", find))
    lines = [r["value"] for r in queries.report_document(spark, SMOKE).orderBy("line_no").collect()]
    assert len(lines) > 12 and calls == ["mask", "find"]  # before, both twice


def test_a_rule_is_tried_where_its_signs_are(monkeypatch):
    class Counting:
        def __init__(self, pattern):
            self.pattern, self.n = pattern, 0

        def finditer(self, text):
            self.n += 1
            return self.pattern.finditer(text)

    tried = [(kind, name, needed, Counting(re.compile(pattern))) for (kind, name, pattern), needed in zip(masking.RULES, (masking.NEEDED[r[1]] for r in masking.RULES))]
    monkeypatch.setattr(masking, "_COMPILED", tried)
    assert masking._mask("plain words " * 1000, "Markdown") == ("plain words " * 1000, [], None)
    assert sum(t[3].n for t in tried) == 0  # before, 19
    samples = {
        "front matter": "---\na: 1\n---\n", "backtick fence": "```\nx\n```", "tilde fence": "~~~\nx\n~~~", "comment": "<!-- x -->", "inline code": "`x`", "code environment": "\\begin{verbatim}x\\end{verbatim}",
        "dollar display": "$$x$$", "bracket display": "\\[x\\]", "math environment": "\\begin{align*}x\\end{align*}", "percent line": "% x", "parenthesis math": "\\(x\\)", "dollar math": "$x$",
        "argument command": "\\cite{x}", "section sign": "\\S 1", "verbatim": "\\verb|x|", "link target": "](x)", "autolink": "<https://x>", "bare url": "http://x", "html tag": "<b>",
    }
    assert {n for n, s in samples.items() if len(masking._mask(s, "Markdown")[1]) == 1} == set(samples) == set(masking.NEEDED)


def test_forms_are_counted_before_they_are_moved(spark):
    rows = [(d, k, f"{'The' if k % 2 else 'the'}") for d in range(3) for k in range(40)]
    matches = spark.createDataFrame(rows, "doc_id long, start int, matched_text string").selectExpr("*", "'the' source", "'T' target", "array('en') domains", "'' note").coalesce(1)
    got = {r["form"]: (r["n"], r["files"], tuple(r["first"]), r["domains"], r["notes"]) for r in report.count_forms(matches).collect()}
    assert got == {"the": (60, 3, (0, 0), [["en"]], [""]), "The": (60, 0, (0, 1), [["en"]], [""])}
    plan = report.count_forms(matches)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan and plan.count("collect_list(struct(start") <= 4
    top = report.rank_terms(matches).first()
    assert (top["occurrences"], top["n_files"], top["domains"]) == (120, 3, ["en"])
