import io
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from corpuskiln.functions.text import resolved
from corpuskiln.sources import archives, files, text_sink


def found(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if not f.endswith(".crc"))


def test_files_are_written_once_and_refused_twice(spark, tmp_path):
    rows = spark.createDataFrame([("a/x.md", "one\n"), ("b.tex", None), ("ü .md", "é😀")], "name string, text string").repartition(3)
    root = str(tmp_path / "out")
    text_sink.write_files(rows, root)
    assert found(root) == ["a/x.md", "b.tex", "ü .md"] and (tmp_path / "out/ü .md").read_bytes() == "é😀".encode()
    with pytest.raises(Exception, match="FileExistsError"):
        text_sink.write_files(rows.withColumn("text", F.lit("new")), root)
    assert found(root) == ["a/x.md", "b.tex", "ü .md"] and (tmp_path / "out/a/x.md").read_text() == "one\n"
    text_sink.write_files(rows.withColumn("text", F.lit("new")), root, overwrite=True)
    assert (tmp_path / "out/a/x.md").read_text() == "new"
    text_sink.write_files(rows.limit(0), str(tmp_path / "none"))


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.createDataFrame([(f"f{i}.md", "x") for i in range(20)] + [("../out-of-it.md", "x")], "name string, text string").repartition(4)
    with pytest.raises(Exception, match="leaves the folder"):
        text_sink.write_files(rows, root)
    assert [f for f in found(root) if not f.startswith("_staging")] == [] and not (tmp_path / "out-of-it.md").exists()
    assert spark.read.option("recursiveFileLookup", True).format("binaryFile").load(root).count() == 0 if os.path.isdir(root) else True


@pytest.mark.parametrize(("name", "error"), [("a/b", None), ("a/../b", None), ("", "absolute or empty"), ("/a", "absolute or empty"), ("..", "leaves the folder"), ("a/../../a-more/b", "leaves the folder"), ("./.", "names the folder itself"), ("a/..", "names the folder itself")])
def test_components(name, error):
    assert text_sink.component_error(name) == error


def test_resolved_paths(spark):
    paths = ["img/../pic/a.png", "./a//b", "../a", "a/../../b", "/a", "", None]
    got = [r[0] for r in spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string").orderBy("i").select(resolved(F.col("p"))).collect()]
    assert got == ["pic/a.png", "a/b", None, None, None, "", None]


def test_strict_scan(spark, tmp_path):
    for name, data in {"b.md": b"\xef\xbb\xbfone\r\ntwo\r", "a/c.TeX": "é".encode(), "a/bad.md": b"ok \xff", "z.txt": b"x", "empty.ltx": b""}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    out = files.scan_texts(spark, str(tmp_path), str(tmp_path / "a"), str(tmp_path / "b.md")).orderBy("file_no").collect()
    assert [(r["file_no"], r["path"].rpartition(f"{tmp_path.name}/")[2], r["format"], r["text"], r["error"]) for r in out] == [
        (0, "a/bad.md", "Markdown", None, "no UTF-8"), (1, "a/c.TeX", "LaTeX", "é", None), (2, "b.md", "Markdown", "one\ntwo\n", None), (3, "z.txt", None, None, "no known format"),
    ]


def tar(members, mode):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as archive:
        for name, data, link in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            if link:
                info.type, info.linkname, info.size = tarfile.SYMTYPE, link, 0
            archive.addfile(info, io.BytesIO(data))
    return out.getvalue()


@pytest.mark.parametrize("mode", ["w", "w:gz"])
def test_archives(spark, tmp_path, mode):
    members = [("a.tex", b"1", None), ("d/../b.tex", b"22", None), ("../evil", b"3", None), ("/abs", b"4", None), ("l", b"", "/etc/passwd"), ("out-of-it/../../out-more/x", b"5", None), ("big", b"6" * 500_000, None)]
    whole = tar(members, mode)
    (tmp_path / "good.tar").write_bytes(whole)
    (tmp_path / "cut.tar").write_bytes(whole[: len(whole) - len(whole) // 3])
    (tmp_path / "none.tar").write_bytes(b"no archive at all")
    rows = archives.read_archives(spark, str(tmp_path)).orderBy("archive", "member_no").collect()
    of = lambda name: [(r["name"], r["size"], None if r["content"] is None else len(r["content"]), r["error"]) for r in rows if r["archive"].endswith(name)]
    assert of("good.tar") == [
        ("a.tex", 1, 1, None), ("b.tex", 2, 2, None), ("../evil", 1, None, "leaves the folder"), ("/abs", 1, None, "absolute or empty"), ("l", 0, None, "no plain file"), ("out-of-it/../../out-more/x", 1, None, "leaves the folder"), ("big", 500_000, 500_000, None),
    ]
    assert of("cut.tar")[0][0] == "a.tex" and of("cut.tar")[-1][3].startswith("broken archive") or mode == "w:gz"
    assert [r[3][:14] for r in of("none.tar")] == ["broken archive"]


def test_pack_and_read(spark, tmp_path):
    rows = spark.createDataFrame([(i % 3, f"p/{i}", bytes([i]) * i) for i in range(30)], "no int, name string, content binary")
    packed = archives.pack(rows, "no").select(F.concat(F.lit("a"), F.col("no").cast("string"), F.lit(".tar.gz")).alias("name"), "content")
    text_sink.write_files(packed, str(tmp_path))
    back = archives.read_archives(spark, str(tmp_path)).collect()
    assert sorted((r["name"], bytes(r["content"])) for r in back) == sorted((f"p/{i}", bytes([i]) * i) for i in range(30)) and not any(r["error"] for r in back)
