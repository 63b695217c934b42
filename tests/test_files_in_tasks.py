"""Files are listed, read and moved in tasks."""

from corpuskiln.sources import files, text_sink


def test_the_driver_lists_no_file(spark, tmp_path):
    names = ["a/x.md", "a/ü b%20.md", "a/b/c/y.tex", "a/_gone.md", "_gone/z.md", ".gone/z.md", "_k=1/z.md", "z.md"]
    rows = spark.createDataFrame([(n, n) for n in names], "name string, text string").repartition(3)
    for root in (f"file://{tmp_path}/one", f"{tmp_path}/two"):
        text_sink.write_files(rows, root)
        out = files.scan_texts(spark, root)
        assert "binaryFile" not in out._jdf.queryExecution().optimizedPlan().toString()
        plain = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(root).select("path").collect()
        found = out.orderBy("file_no").collect()
        assert [r["path"] for r in found] == sorted(r["path"] for r in plain) and len(found) == 5
        assert all(r["path"].endswith(r["text"]) for r in found)


def test_a_file_of_no_bytes_has_a_row_if_told(spark, tmp_path):
    text_sink.write_files(spark.createDataFrame([("a.md", ""), ("b.md", "\r\n")], "name string, text string"), str(tmp_path / "out"))
    assert [r["text"] for r in files.scan_texts(spark, str(tmp_path / "out")).collect()] == ["\n"]
    assert [r["text"] for r in files.scan_texts(spark, str(tmp_path / "out"), empty=True, as_is=True).orderBy("file_no").collect()] == ["", "\r\n"]
    assert not [f for f in (tmp_path / "out").iterdir() if f.name.startswith("_")]
