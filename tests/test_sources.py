import io
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamline.operators import shards as sh
from loamline.sources import extract as ex
from loamline.sources import io as sio


def docx(paragraphs):
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {ns}><w:body>{body}</w:body></w:document>")
    return out.getvalue()


def test_files(spark, tmp_path):
    for folder in ("pdf", "html", "text"):
        (tmp_path / folder).mkdir()
    (tmp_path / "html/a.html").write_text("<html><script>x</script><body><p> One  two </p>\n<p>three</p></body></html>")
    (tmp_path / "html/skip.HTML").write_text("no")
    (tmp_path / "text/a.txt").write_bytes(b"plain \xff text")
    (tmp_path / "text/a.docx").write_bytes(docx(["first", "second"]))
    (tmp_path / "text/bad.docx").write_bytes(b"broken")
    (tmp_path / "pdf/x.pdf").write_bytes(b"%PDF")
    out = {r.filename: r for r in ex.extract_files(ex.scan_files(spark, str(tmp_path))).collect()}
    assert set(out) == {"a.html", "a.txt", "a.docx", "bad.docx", "x.pdf"}
    assert out["a.html"].text == "One\ntwo\nthree" and out["a.txt"].text == "plain  text" and out["a.docx"].text == "first\n\nsecond"
    assert not out["bad.docx"].success and not out["x.pdf"].success and out["x.pdf"].file_type == "pdf"
    with pytest.raises(FileNotFoundError):
        ex.scan_files(spark, str(tmp_path / "none"))


def test_main_text(spark):
    html = "<body><nav>menu</nav><h1>Title</h1><p>Body text</p><footer>end</footer></body>"
    df = spark.createDataFrame([(html,), (None,), ("<nav>x</nav>",)], "h string")
    assert [r.t for r in df.select(ex.html_main_text(F.col("h")).alias("t")).collect()] == ["Title\nBody text", None, None]


def test_chunks_and_lines(spark, tmp_path):
    (tmp_path / "c/sub").mkdir(parents=True)
    (tmp_path / "c/sub/a.json").write_text('{"id": "1",\n "text": "t", "metadata": {"word_count": 3}}')
    (tmp_path / "c/bad.json").write_text("{broken")
    rows = sio.read_chunks(spark, str(tmp_path / "c")).where("id IS NOT NULL").collect()
    assert len(rows) == 1 and rows[0].metadata.word_count == 3
    sio.write_json_lines(spark.createDataFrame([("a", None), ("b", "x")], "id string, niche string"), str(tmp_path / "o"), "niche")
    back = spark.read.json(str(tmp_path / "o"))
    assert {(r.id, r.niche, r.niche_folder) for r in back.collect()} == {("a", None, "general"), ("b", "x", "x")}


def test_sidecars(spark):
    a, b = spark.createDataFrame([("x", "t"), ("y", "u")], "stem string, text string"), spark.createDataFrame([("x", 1)], "stem string, n int")
    assert [tuple(r) for r in sio.join_sidecars(a, b).collect()] == [("x", "t", 1)]


def test_corrupt_json_is_kept_or_dropped(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "1", "text": "fine"}')
    (tmp_path / "b.json").write_text('{"id": ')
    assert [r.id for r in sio.read_chunks(spark, str(tmp_path)).collect()] == ["1"]
    rows = {r.id: r.corrupt_record for r in sio.read_chunks(spark, str(tmp_path), keep_corrupt=True).collect()}
    assert rows["1"] is None and rows[None].startswith('{"id"')
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "x.jsonl").write_text('{"id": "1"}\nno json\n{"id": "2"}\n')
    lines = sio.read_json_lines(spark, str(tmp_path / "lines"), T.StructType([T.StructField("id", T.StringType())]))
    assert sorted((r.id or "", r.corrupt_record or "") for r in lines.collect()) == [("", "no json"), ("1", ""), ("2", "")]


def test_written_stages_and_listings(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", True), (2, None, True), (3, "b", False), (4, "", True)], "id int, text string, ok boolean")
    sio.write_successful(rows, str(tmp_path / "ok"), "ok")
    assert [r.id for r in sio.read_parquet(spark, str(tmp_path / "ok")).collect()] == [1]
    sio.write_chunks(spark.createDataFrame([("1", "x")], "id string, text string"), str(tmp_path / "chunks"))
    assert sio.read_chunks(spark, str(tmp_path / "chunks")).first().text == "x"
    listed = sh.list_shards(spark, str(tmp_path / "ok")).collect()
    assert listed and all(r.path.endswith(".parquet") and r.bytes > 0 for r in listed)
    (tmp_path / "one.txt").write_text("alone")
    assert ex.extract_files(ex.scan_file(spark, str(tmp_path / "one.txt"))).first().text == "alone"
