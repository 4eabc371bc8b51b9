import io
import json
import zipfile

import pytest

from quire.sources import config, files, recognize
from quire.streaming.ingest import process_new

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx() -> bytes:
    cell = lambda text, props="": f"<w:tc><w:tcPr>{props}</w:tcPr><w:p><w:r><w:t>{text}</w:t></w:r></w:p></w:tc>"
    restart, going = '<w:vMerge w:val="restart"/>', "<w:vMerge/>"
    table = f"<w:tbl><w:tr>{cell('A', restart)}{cell('B', '<w:gridSpan w:val=\"2\"/>')}</w:tr><w:tr>{cell('', going)}{cell('C')}{cell('D')}</w:tr></w:tbl>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body><w:p><w:r><w:t>first</w:t></w:r></w:p><w:p/>{table}</w:body></w:document>")
    return out.getvalue()


def test_docx():
    html = '<table><tr><td rowspan="2">A</td><td colspan="2">B</td></tr><tr><td>C</td><td>D</td></tr></table>'
    assert files.docx_tables(docx()) == [html]
    assert files.docx_markdown(docx()) == f"first\n\n{html}\n"
    assert files.docx_text(docx()) == "first\n\nA\nB\nC\nD"


def test_loose_texts(spark, tmp_path):
    (tmp_path / "a.md").write_text("x\ny")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/b.docx").write_bytes(docx())
    assert {r.doc_id: r.text for r in files.read_texts(spark, str(tmp_path)).collect()} == {"a": "x\ny", "b": "first\n\nA\nB\nC\nD"}
    (tmp_path / "sub/a.txt").write_text("again")
    with pytest.raises(files.SourceError, match="twice"):
        files.read_texts(spark, str(tmp_path))


def record(folder, doc_id, text_file, text="t"):
    (folder / f"{doc_id or 'none'}.json").write_text(json.dumps({"doc_id": doc_id, "text_file": text_file, "metadata": {"k": 1}}))
    if text is not None:
        (folder / f"{doc_id}.md").write_text(text)


def test_gold(spark, tmp_path):
    record(tmp_path, "b", "b.md", "tb")
    record(tmp_path, "a", "a.md", "ta")
    rows = files.read_gold(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.text, r.metadata) for r in rows] == [("a", "ta", '{"k":1}'), ("b", "tb", '{"k":1}')]


@pytest.mark.parametrize(("doc_id", "text_file", "text"), [("a", "a.md", None), ("a", "../a.md", "t"), (None, "a.md", "t")])
def test_gold_errors(spark, tmp_path, doc_id, text_file, text):
    record(tmp_path, doc_id, text_file, text)
    with pytest.raises(files.SourceError):
        files.read_gold(spark, str(tmp_path))


def test_pages(spark, tmp_path):
    (tmp_path / "i.png").write_bytes(b"png")
    (tmp_path / "p.pdf").write_bytes(b"/Type /Page /Type/Pages /Type /Page")
    found = files.binary_files(spark, str(tmp_path))
    assert files.content_hashes(found).count() == 2
    assert files.page_count(b"/Type /Page /Type/Pages /Type /Page", "pdf") == 2 and files.page_count(b"", "png") == 1
    with pytest.raises(files.SourceError):
        files.page_count(b"", "xls")
    render = lambda content, suffix, dpi: iter([{"page": k, "content": content, "dpi": dpi, "rotation_applied": 0} for k in (1, 2)])
    assert files.load_pages(found, render).count() == 4
    page = files.load_pages(found.where("suffix = 'png'")).first()
    assert (page.doc_id, page.page, page.deskew_matrix[0]) == ("i", 1, 1.0)
    (tmp_path / "x.xls").write_bytes(b"x")
    with pytest.raises(Exception, match="unsupported format"):
        files.load_pages(files.binary_files(spark, str(tmp_path)), render).collect()


def test_recognition_keeps_failures(spark):
    def detect(content):
        if content == b"bad":
            raise ValueError("no layout")
        return [{"category": "text", "x": 0, "y": 0, "w": 5, "h": 5}, {"category": "text", "x": 9, "y": 0, "w": 5, "h": 5}]

    def read(content, box):
        if box["x"]:
            raise RuntimeError
        return {"text": content.decode(), "rec_score": 0.9}

    pages = spark.createDataFrame([("d", 1, b"ok"), ("d", 2, b"bad")], "doc_id string, page int, content binary")
    rows = sorted(recognize.recognize_pages(pages, detect, read).collect(), key=lambda r: (r.page, r.pos or 0))
    assert rows[0].text == "ok" and rows[1].text is None and rows[1].flags == ["recognize_failed"] and (rows[2].stage, rows[2].message) == ("layout", "ValueError: no layout")
    with pytest.raises(recognize.UnknownStep):
        recognize.preprocess(b"", {}, ["zoom"], {})


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("qa_threshold: 0.9\noutputs: [markdown, coco]\n")
    c = config.load_config(path, dpi=200, engine=None)
    assert (c.qa_threshold, c.dpi, c.outputs, c.engine) == (0.9, 200, ("markdown", "coco"), "tesseract")
    assert c.version() != config.Config().version() and config.Config(output_dir="x").version() == config.Config().version()
    for wrong in ({"engine": "x"}, {"langs": []}, {"qa_threshold": 2}, {"nope": 1}, {"engine": "paddle"}, {"engine": "paddleocr"}):
        with pytest.raises(config.ConfigError):
            config.load_config(**wrong)
    with pytest.raises(config.ConfigError):
        config.evaluation_dirs(None, None, tmp_path)


def test_streaming_adds_each_key_once(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    put = lambda ids: spark.createDataFrame([(i, float(i)) for i in ids], "doc_id long, v double").coalesce(1).write.mode("append").parquet(source)
    run = lambda: process_new(spark, source, "doc_id long, v double", lambda b: b.selectExpr("doc_id", "v * 2 AS v"), sink, str(tmp_path / "check")).awaitTermination()
    put([1, 2])
    run()
    put([2, 3])
    run()
    assert sorted(tuple(r) for r in spark.read.parquet(sink).collect()) == [(1, 2.0), (2, 4.0), (3, 6.0)]
