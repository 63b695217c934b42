"""Translations come back as they were written, whatever the text."""

import duckdb

import __spark_entry__ as entry


def test_translations_come_back_whatever_the_text(spark, tmp_path):
    texts = ["A text.", "", None, "one\r\ntwo\rthree", "﻿A text with a mark.", "<!-- a --> b $c$", "\r", "$$ a <!-- b --> $$"]
    rows = [(i - 2, t, "en", "src0", 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = db.sql(entry.oracle_sql()["written_translations"]).fetchall()
    got = entry.queries()["written_translations"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 5  # before, four of them were missing or differed
