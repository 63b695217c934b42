"""Folders within folders are listed once, and no contents are moved to tell."""

from corpuskiln.sources import files


def test_a_folder_named_twice(spark, tmp_path):
    for name in ("a/x.md", "a/b/y.md", "ab/z.md"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    root = f"file://{tmp_path}"
    out = files.scan_texts(spark, f"{root}/a", f"{root}/a/b", f"{root}/a/")
    assert [r["text"] for r in out.orderBy("file_no").collect()] == ["a/b/y.md", "a/x.md"]
    assert "first(content" not in out._jdf.queryExecution().optimizedPlan().toString()
    both = files.scan_texts(spark, f"{root}/a", f"{root}/ab", f"{root}/a/b")
    assert sorted(r["text"] for r in both.collect()) == ["a/b/y.md", "a/x.md", "ab/z.md"]
    assert files.scan_texts(spark, f"{root}/*", f"{root}/a").count() == 3
