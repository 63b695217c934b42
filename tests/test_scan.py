import random

import pytest
from pyspark.sql import functions as F

from corpuskiln.operators import chunking, scan


def window(rows):
    """Each group's folds by plain loops: sum with the row, least and last without it, and the group's sum."""
    out, groups = [], {}
    for k, o, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        total, least, last = groups.get(k, (None, None, None))
        groups[k] = ((total or 0) + v if v is not None else total, v if least is None else least if v is None else min(least, v), v)
        out.append((k, o, v, groups[k][0], least, last))
    return [(*r, groups[r[0]][0]) for r in out]


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_folds_equal_plain_loops(spark, parts):
    random.seed(parts)
    rows = [(random.choice(["a", "a", "a", "b", None, "c"]), i, random.choice([None, *range(-50, 50)])) for i in random.sample(range(10000), 400)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "k string, o int, v int")
        v = F.col("v")
        got = scan.running(df, ["k"], ["o"], {"upto": scan.Fold("sum", v), "least": scan.Fold("min", v, -1), "last": scan.Fold("last", v, -1)}, {"whole": scan.Fold("sum", v)})
        assert got.select(scan.PART).distinct().count() > parts // 2
        key = lambda r: (r[0] is not None, r[0] or "", r[1])
        assert sorted((tuple(r) for r in got.drop(scan.PART).collect()), key=key) == window(rows)
        empty = scan.running(df.limit(0), ["k"], ["o"], {"upto": scan.Fold("sum", v)})
        assert empty.count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plan(chars, most):
    """The parts of one chapter, page by page."""
    total, done, part, out = sum(chars), 0, 0, []
    planned = max(1, -(-total // most))
    for i, c in enumerate(chars):
        out.append(part)
        done += c
        part += i + 1 < len(chars) and part + 1 < planned and done * planned >= total * (part + 1)
    return out


def test_one_book_over_many_ranges(spark):
    random.seed(4)
    chars = [random.randint(0, 400) for _ in range(3000)]
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        pages = spark.createDataFrame([("b", i, c) for i, c in enumerate(chars)], "book string, page_no int, chars int")
        got = chunking.plan_parts(pages, ["book"], 1000)
        assert [r["part"] for r in got.orderBy("page_no").collect()] == plan(chars, 1000)
        near = {r["page_no"]: (r["previous_page"], r["next_page"]) for r in chunking.neighbours(pages.where("page_no % 3 = 0"), ["book"]).collect()}
        assert near == {i: (i - 3 if i else None, i + 3 if i + 3 < 3000 else None) for i in range(0, 3000, 3)}
        ranges = pages.where("page_no not in (77, 1500)").selectExpr("book", "page_no as first_page", "page_no as last_page")
        assert sorted(r["first_page"] for r in chunking.contiguity_violations(ranges, ["book"], "first_page").collect()) == [78, 1501]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
